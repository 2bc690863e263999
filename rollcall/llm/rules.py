"""Quality rules as a ledger: every rule evaluated once, its failures kept as bits next
to the measurements; policies are masks over the bits. Built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.operators.scratch import materialize

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"

#: Rules in the order of their bits: a rule is true where a text fails it. A bit is
#: never given to another rule, so that old ledgers stay readable.
RULES: list[tuple[str, Callable[[], Column]]] = [
    ("few_words", lambda: F.col("n_words") < 50),
    ("repeated_words", lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    ("symbols", lambda: 5 * F.col("n_symbols") > F.col("word_chars")),
    ("repeated_lines", lambda: 2 * F.col("n_dup_lines") > F.col("n_lines")),
    ("capitals", lambda: 2 * F.col("n_capitals") > F.col("word_chars")),
    ("short_words", lambda: F.col("word_chars") < 2 * F.col("n_words")),
    ("long_words", lambda: F.col("word_chars") > 15 * F.col("n_words")),
]
BIT = {name: i for i, (name, _) in enumerate(RULES)}

#: Policies by version: the rules that reject.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "2": ("few_words", "repeated_words", "symbols", "repeated_lines", "capitals", "short_words", "long_words"),
}


def mask(version: str) -> int:
    return sum(1 << BIT[name] for name in POLICIES[version])


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once: a bound name, not a copy of the expression."""
    return F.transform(F.array(value), use)[0]


def _covered(starts: Column) -> Column:
    """Words covered by 3-word windows at these ascending starts."""
    total = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
    )
    return total["n"]


def _repeated(windows: Column) -> Column:
    """Words in windows found twice or more. Most texts have none and stop at the set;
    the others sort (hash, place) pairs, so that equal windows are neighbours."""

    def by_sorting(pairs: Column) -> Column:
        def twin(x: Column, j: Column) -> Column:
            before = F.when(j > 0, F.get(pairs, j - 1)["h"] == x["h"])
            return F.coalesce(before, F.lit(False)) | F.coalesce(F.get(pairs, j + 1)["h"] == x["h"], F.lit(False))

        return _covered(F.sort_array(F.transform(F.filter(pairs, twin), lambda x: x["i"])))

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_let(pairs, by_sorting))


def _word_measures(words: Column) -> Column:
    windows = F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
        F.lit(1),
        F.greatest(F.size(words) - 2, F.lit(0)),
    )
    return F.struct(
        F.size(words).cast("long").alias("n_words"), _let(windows, _repeated).cast("long").alias("n_repeat_words")
    )


def _line_measures(lines: Column) -> Column:
    n = F.size(lines).cast("long")
    return F.struct(n.alias("n_lines"), (n - F.size(F.array_distinct(lines))).alias("n_dup_lines"))


def ledger(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per row of `docs`: id, the measurements, and `failures`, a bit per rule.

    A null text has no words. Windows of words are compared by 64-bit hash within one
    text. A scan and a projection, nothing is shuffled and no row waits for another;
    sorting inside a long text is n log n. Rows repeated in `docs` are repeated here;
    other columns are not looked at, but with `carry` the whole row goes along as `doc`.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_remove(F.split(text, WORD_GAP), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    points = F.char_length(text).cast("long")
    whole = [F.struct("*").alias("doc")] if carry else []
    measured = docs.select(
        F.col(id_col).alias("id"),
        *whole,
        F.char_length(F.regexp_replace(text, WORD_GAP, "")).cast("long").alias("word_chars"),
        (points - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).alias("n_symbols"),
        (points - F.char_length(F.regexp_replace(text, r"\p{Lu}+", ""))).alias("n_capitals"),
        _let(words, _word_measures).alias("w"),
        _let(lines, _line_measures).alias("l"),
    ).select("id", *["doc"] * carry, "w.*", "l.*", "word_chars", "n_symbols", "n_capitals")
    bits = [F.when(rule(), F.lit(1 << BIT[name])).otherwise(F.lit(0)) for name, rule in RULES]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    return measured.withColumn("failures", failures.cast("long"))


def rejected(version: str) -> Column:
    """Whether a policy rejects a row of the ledger."""
    return F.col("failures").bitwiseAND(F.lit(mask(version))) != 0


def written(docs: DataFrame, version: str) -> tuple[DataFrame, DataFrame]:
    """The ledger of `docs` and the ablations of a policy, as tables: the ledger with all
    measurements and failure bits is written once (rule-ledger-*), and the ablations are
    counted from what was written (rule-ablations-*). Another policy, or the ablations of
    one, is read from the written ledger without looking at a text again."""
    rows = materialize(ledger(docs), "rule-ledger")
    return rows, materialize(ablations(rows, version), "rule-ablations")


def ablations(rows: DataFrame, version: str) -> DataFrame:
    """For each rule of a policy: texts that fail it, that only it rejects (they would
    stay without it), and that the policy keeps. The ledger is first reduced to one
    count per pattern of failure bits, at most 2^rules rows; an empty one gives zeros."""
    whole = mask(version)
    patterns = rows.groupBy("failures").agg(F.count("*").alias("n"))
    of_rule = []
    for name in POLICIES[version]:
        bit = 1 << BIT[name]
        hit = F.col("failures").bitwiseAND(F.lit(bit)) != 0
        only = F.col("failures").bitwiseAND(F.lit(whole)) == bit
        of_rule.append(F.struct(F.lit(name).alias("rule"), hit.alias("hit"), only.alias("only")))
    kept = F.col("failures").bitwiseAND(F.lit(whole)) == 0
    counted = patterns.select("n", kept.alias("kept"), F.explode(F.array(*of_rule)).alias("r"))
    return counted.groupBy("r.rule").agg(
        F.sum(F.when(F.col("r.hit"), F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("r.only"), F.col("n")).otherwise(0)).alias("kept_without"),
        F.sum(F.when(F.col("kept"), F.col("n")).otherwise(0)).alias("kept"),
    )


def by_pattern(rows: DataFrame, version: str) -> DataFrame:
    """Ablation counts per pattern of failure bits, at most 2^rules rows (failures,
    pattern_rows, kept_without): texts that fail just these rules and, where a policy
    rejects them by one rule alone, the texts it would keep without that rule (else 0)."""
    hit = F.col("failures").bitwiseAND(F.lit(mask(version)))
    counts = rows.groupBy("failures").agg(F.count("*").alias("pattern_rows")).withColumn("hit", hit)
    alone = (F.col("hit") != 0) & (F.col("hit").bitwiseAND(F.col("hit") - 1) == 0)
    freed = counts.where(alone).groupBy("hit").agg(F.sum("pattern_rows").alias("kept_without"))
    return counts.join(freed, "hit", "left").select(
        "failures", "pattern_rows", F.coalesce("kept_without", F.lit(0).cast("long")).alias("kept_without")
    )
