"""Reading rosters: headers, blank rows, positions, snapshots, annotated output."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.functions.text import or_default
from rollcall.plans import reports
from rollcall.sources import fingerprint, roster

SPANISH = [
    "CÓDIGO de  infraestructura", "Escuela", "departamento", " Distrito", "DOCENTE", "coach", "asignatura",
    "Grado", "Sección", "turno", "Enlace de video", "Enlace de Transcripción",
]
CELLS = 12


def write_csv(folder, header, rows, name="roster.csv"):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        for row in [header, *rows]:
            f.write(",".join("" if c is None else f'"{c}"' for c in row) + "\n")
    return path


def row(i):
    return [f"{i}.0", f"s{i}", "d", "", "Ñ, X", "c", "m", "4", "A", None, "Sin dato", f"https://x/{i}"]


def test_spanish_csv_with_blank_rows(spark, folder):
    blank = [None] * (CELLS + 1)
    rows = [row(1) + ["n1"], blank, row(2) + [None], blank, blank, row(3) + ["n3"]]
    path = write_csv(folder, SPANISH + ["Observación"], rows)
    df = roster.read_roster(spark, path)
    assert set(df.columns) == {*S.ROSTER_COLUMNS, "Observación", S.POSITION}
    found = sorted((r[S.POSITION], r["school"], r["Observación"], r["district"], r["shift"]) for r in df.collect())
    assert found == [(1, "s1", "n1", "", None), (2, "s2", None, "", None), (3, "s3", "n3", "", None)]


def test_positions_follow_file_order_over_many_splits(spark, folder):
    n = 3000
    path = write_csv(folder, S.ROSTER_COLUMNS, [row(i) for i in range(1, n + 1)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = roster.read_roster_file(spark, path)
        assert raw.rdd.getNumPartitions() > 4
        found = {r["school"]: r[S.POSITION] for r in roster.read_roster(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == {f"s{i}": i for i in range(1, n + 1)}


def test_csv_numbers_and_line_breaks(spark, folder):
    rows = [row(i)[:11] + [f"https://x/{i}\nsecond, line"] for i in range(1, 5)]
    rows[1][0], rows[2][0], rows[3][0] = "11769.00", "7.5", "A.0"
    path = write_csv(folder, S.ROSTER_COLUMNS, rows)
    found = roster.read_roster(spark, path, multi_line=True).orderBy(S.POSITION).collect()
    assert [r["infrastructureCode"] for r in found] == ["1", "11769", "7.5", "A.0"]
    assert [(r[S.POSITION], r["transcriptLink"]) for r in found] == [
        (i, f"https://x/{i}\nsecond, line") for i in range(1, 5)
    ]


def test_integer_columns_become_text(spark):
    df = spark.createDataFrame([(1, 3), (None, None)], "infrastructureCode int, grade long")
    found = roster.repair_numbers(df).select("infrastructureCode", or_default(F.col("grade"), "none").alias("g"))
    assert [tuple(r) for r in found.collect()] == [("1", "3"), (None, "none")]


def test_parquet_roster_repairs_numbers(spark, folder):
    df = spark.createDataFrame([tuple(row(i)) for i in range(1, 4)], ", ".join(f"{c} string" for c in S.ROSTER_COLUMNS))
    df = df.withColumn("infrastructureCode", F.col("infrastructureCode").cast("double"))
    df.write.parquet(f"{folder}/r")
    found = roster.read_roster(spark, f"{folder}/r", "parquet")
    assert sorted(r["infrastructureCode"] for r in found.collect()) == ["1", "2", "3"]


def test_right_most_of_two_headers_wins(spark):
    df = spark.createDataFrame([("old", "new", "x")], "Escuela string, school string, other string")
    assert roster.canonicalize(df).first().asDict() == {"school": "new", "other": "x"}


def test_missing_columns_are_named(spark):
    df = spark.createDataFrame([("a",)], "school string")
    with pytest.raises(roster.MissingColumns, match="transcriptLink"):
        roster.prepare(df, ["school"])


def test_fingerprint_ignores_order_and_sees_changes(spark):
    rows = [(i, str(i % 3)) for i in range(100)] + [(None, "")]
    df = spark.createDataFrame(rows, "a int, b string")
    first = fingerprint.table_fingerprint(df).first()
    assert fingerprint.table_fingerprint(df.orderBy(F.desc("a")).repartition(7)).first() == first
    assert fingerprint.table_fingerprint(df.union(df.limit(1))).first() != first
    nulls = df.withColumn("b", F.nullif("b", F.lit("")))
    assert fingerprint.table_fingerprint(nulls).first() != first
    assert fingerprint.table_fingerprint(df.limit(0)).first()["source_digest"] == "0-0-0-0"


def test_fingerprint_tells_cells_apart(spark):
    """Null, the text of a null mark, and cells that run into one another."""
    rows = [(None, "x"), ("N", "x"), ("\\N", "x"), ("", "x"), ("1:x", ""), ("", "1:x"), ("a,1:b", "c"), ("a", "b,1:c")]
    prints = {
        fingerprint.table_fingerprint(spark.createDataFrame([r], "a string, b string")).first()["source_digest"]
        for r in rows
    }
    assert len(prints) == len(rows)


def test_fingerprint_sees_every_column(spark):
    df = spark.createDataFrame([tuple(row(i)) for i in range(3)], ", ".join(f"{c} string" for c in S.ROSTER_COLUMNS))
    whole = fingerprint.table_fingerprint(df).first()
    for c in S.ROSTER_COLUMNS:
        assert fingerprint.table_fingerprint(df.withColumn(c, F.concat(F.coalesce(c, F.lit("")), F.lit("!")))).first() != whole


def test_output_path():
    assert reports.default_output_path("/a/b/roster.csv") == "/a/b/roster_with_reports.csv"
    assert reports.default_output_path("roster") == "roster_with_reports"
    assert reports.default_output_path("s3://x/r.v2.parquet") == "s3://x/r.v2_with_reports.parquet"


def test_annotations_do_not_shift_after_blank_rows(spark, folder):
    """Results belong to the row they were computed for, blank rows or not."""
    blank = [None] * CELLS
    path = write_csv(folder, S.ROSTER_COLUMNS, [row(1), blank, row(2)])
    rows = roster.read_roster(spark, path)
    state = spark.createDataFrame(
        [
            (1, "studio-row-1", "completed", None, "link1"), (2, "studio-row-2", "failed_webhook", "x" * 500, None),
            (1, "other-1", "pending", None, None), (2, "other-2", "pending", None, None),
        ],
        "row_position long, event_id string, state string, last_error string, pdf_drive_link string",
    )
    out = reports.annotate(rows, state)
    found = {r["school"]: tuple(r[c] for c in S.ANNOTATION_COLUMNS) for r in out.collect()}
    assert found == {
        "s1": ("studio-row-1", "link1", "completed"),
        "s2": ("studio-row-2", "", "failed_webhook: " + "x" * 200),
    }
    print_ = fingerprint.table_fingerprint(rows)
    reports.write_annotated(out, f"{folder}/out", "csv", provenance_row=reports.provenance(path, print_))
    assert spark.read.csv(f"{folder}/out", header=True).count() == 2
    assert spark.read.json(f"{folder}/out_meta").first()["source_rows"] == 2


def test_annotation_of_unknown_rows_is_empty(spark):
    rows = spark.createDataFrame([(1, "s")], "row_position long, school string")
    state = spark.createDataFrame(
        [], "row_position long, event_id string, state string, last_error string, pdf_drive_link string"
    )
    assert tuple(reports.annotate(rows, state).select(*S.ANNOTATION_COLUMNS).first()) == ("", "", "")


@pytest.mark.parametrize("block, fan", [(7, 2), (64, 3), (1 << 16, 1 << 10)])
def test_file_fingerprint(spark, folder, monkeypatch, block, fan):
    """Of bytes, whatever they are: line breaks or none, at the end or not, long lines."""
    monkeypatch.setattr(fingerprint, "BLOCK", block)
    monkeypatch.setattr(fingerprint, "FAN", fan)
    files = {
        "a.csv": b"x,y\n1,2\n", "b.csv": b"x,y\r\n1,2", "c.bin": bytes(range(256)) * 3, "d.csv": b"", "e.csv": b"\n\n\n",
        "f.csv": ("é" * 100 + "\n").encode() * 5 + b"last", "g.csv": b"z" * 500,
    }
    wanted = {}
    for name, data in files.items():
        with open(f"{folder}/{name}", "wb") as file:
            file.write(data)
        level = [hashlib.sha256(data[k : k + block]).hexdigest() for k in range(0, len(data), block)]
        while len(level) > 1:
            level = [hashlib.sha256("".join(level[k : k + fan]).encode()).hexdigest() for k in range(0, len(level), fan)]
        if data:  # an empty file has no row
            wanted[name] = (len(data), level[0])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")  # several splits of a file
    try:
        rows = fingerprint.file_fingerprint(spark, folder).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.file.rsplit("/", 1)[1]: (r.length, r.sha256_tree) for r in rows} == wanted


def test_positions_over_splits_and_files(spark, folder):
    """Rows are numbered in file order over several files and splits, blank rows taking no
    number, and rows are not exchanged for it."""
    header = ",".join(S.ROSTER_COLUMNS)
    n = 0
    for name in ("a", "b", "c"):
        with open(f"{folder}/{name}.csv", "w") as file:
            file.write(header + "\n")
            for k in range(60):
                blank = k % 7 == 3
                n += not blank
                cells = [""] * len(S.ROSTER_COLUMNS) if blank else [f"r{n}"] * len(S.ROSTER_COLUMNS)
                file.write(",".join(cells) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        rows = roster.read_roster(spark, folder, "csv")
        found = [(r[S.POSITION], r.school) for r in rows.collect()]
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(found) == [(k, f"r{k}") for k in range(1, n + 1)]
    assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan
