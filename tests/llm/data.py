"""Small documents that hold every odd case the operators have to bear."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # extra columns, named like the operators' own
    "id string, fp int, digest double, kept string, doc string, length int, n string, bucket boolean"
)


def prose(seed: int, words: int) -> str:
    """Made-up sentences, all different."""
    r = random.Random(seed)
    made = ["".join(r.choice(["ka", "lo", "mi", "ten", "sur", "ve", "ño", "rd"]) for _ in range(r.randint(1, 4))) for _ in range(words)]
    lines = [" ".join(made[k : k + 12]).capitalize() + "." for k in range(0, words, 12)]
    return "\n".join(lines)


def texts() -> list[tuple[int | None, str | None]]:
    base = prose(1, 120)
    return [
        (1, None),
        (2, ""),
        (3, " \n\t\x0b\x0c\r "),
        (4, base),
        (5, base.replace(" ", "  ")),  # equal but for white space, and longer
        (6, base),
        (6, base),  # a repeated row
        (7, base + " extra tail"),
        (8, "few words"),
        (9, "###$$$ %%% " * 60),
        (10, "same same same " * 100),
        (11, prose(2, 20_000)),  # very long
        (12, "x" * 300_000),  # one very long word
        (13, "Release <|endoftext|> notes: it's we'll 'tis\n\n\n  done ½ 日本語 ▁mark \\back"),
        (14, "Released under the MIT License."),
        (None, prose(3, 80)),
        (None, None),
        (15, prose(4, 90)),
        (16, "12345 67890 !!! ---"),
    ]


def rows():
    out = []
    for k, (name, text) in enumerate(texts()):
        lang = None if k % 5 == 4 else ("xx" if k % 2 else "yy")
        out.append((name, text, lang, "s", None, "a", 1, 2.0, "no", "d", 7, "n", True))
    return out


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def given(spark, tmp_path, frame=None):
    """A folder like the given ones."""
    folder = str(tmp_path)
    (documents(spark) if frame is None else frame).write.parquet(f"{folder}/documents.parquet")
    return folder
