"""Fingerprints of a source, for refusing to mix two rosters in one run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.ordering import running_start
from rollcall.operators.scratch import materialize

#: Bytes of a file that are hashed together, and hashes that are hashed together above.
BLOCK, FAN = 1 << 16, 1 << 10

# Hex digits of a row hash summed as one number; four sums hold the whole hash.
_LIMB = 16


def row_text(columns: list[str]) -> Column:
    """One text per row. Every cell goes with its length, and null is a mark of its own,
    so no two different rows have one text."""
    cells = []
    for c in columns:
        text = F.col(c).cast("string")
        cells.append(F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("N")))
    return F.concat_ws(",", *cells)


def table_fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: row count and an order-independent digest of all rows, by default over
    all columns.

    The digest is the sums of the four quarters of the row hashes, so it is a plain
    partial aggregation, does not depend on partitioning, and counts duplicates.
    """
    digest = F.sha2(row_text(columns or df.columns), 256)
    rows = df.select(digest.alias("h"))
    sums = []
    for k in range(0, 64, _LIMB):
        limb = F.conv(F.substring("h", k + 1, _LIMB), 16, 10).cast("decimal(20,0)").cast("decimal(38,0)")
        sums.append(F.coalesce(F.sum(limb), F.lit(0)).cast("decimal(38,0)").cast("string"))
    return rows.agg(F.count("*").alias("source_rows"), F.concat_ws("-", *sums).alias("source_digest"))


def file_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """(file, length, sha256_tree) of each file under a path, from its bytes.

    A file is cut into blocks of BLOCK bytes; the digest of a block is SHA-256, that of up
    to FAN neighbouring digests the SHA-256 of their hex texts end to end, level by level
    until one is left (an empty file is not read by Spark and has no row). So one file is hashed
    by as many tasks as it has splits, and no row holds more than a line or a block: only
    the pieces of lines that make up a block meet. Lines are the unit of reading; their
    places follow from the bytes of each split, as row positions do.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.select(F.col("path").alias("file"), "length")
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path).select(
        _plain_path(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("data"),
    )
    # Every line break belongs to the line before it; the last line of a file may have none.
    placed = running_start(lines, ["file"], ["split"], F.octet_length("data") + 1, "at").join(
        _same_files(files), "file"
    )
    ends = F.col("at") + F.octet_length("data") < F.col("length")
    data = F.when(ends, F.concat("data", F.lit(b"\n"))).otherwise(F.col("data"))
    placed = placed.select("file", "at", data.alias("data")).where(F.octet_length("data") > 0)
    first, last = F.floor(F.col("at") / BLOCK), F.floor((F.col("at") + F.octet_length("data") - 1) / BLOCK)
    pieces = placed.select("file", "at", "data", F.explode(F.sequence(first, last)).alias("block"))
    start = F.greatest(F.col("block") * BLOCK, F.col("at"))
    end = F.least((F.col("block") + 1) * BLOCK, F.col("at") + F.octet_length("data"))
    piece = F.substr("data", (start - F.col("at") + 1).cast("int"), (end - start).cast("int"))
    pieces = pieces.select("file", "block", start.alias("at"), piece.alias("data"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("at", F.hex("data").alias("hex")))), lambda x: x["hex"])
    whole = F.unhex(F.concat_ws("", in_order))
    level = pieces.groupBy("file", "block").agg(F.sha2(whole, 256).alias("digest"))
    blocks = _same_files(files).select("file", F.ceil(F.col("length") / BLOCK).alias("n"))
    level = materialize(level.join(blocks, "file"), "block-digests")
    while (level.agg(F.max("n")).first()[0] or 1) > 1:
        told = F.transform(F.sort_array(F.collect_list(F.struct("block", "digest"))), lambda x: x["digest"])
        joined = F.concat_ws("", told)
        level = materialize(
            level.groupBy("file", "n", F.floor(F.col("block") / FAN).alias("block")).agg(
                F.when(F.col("n") == 1, joined).otherwise(F.sha2(joined.cast("binary"), 256)).alias("digest")
            ).withColumn("n", F.ceil(F.col("n") / FAN)),
            "block-digests",
        )
    return _same_files(files).join(level.drop("block", "n"), "file").select(
        "file", "length", F.col("digest").alias("sha256_tree")
    )


def _same_files(files: DataFrame) -> DataFrame:
    """Files by name, however the readers spell the beginning of a path (file:/, file:///)."""
    return files.withColumn("file", _plain_path(F.col("file")))


def _plain_path(path: Column) -> Column:
    return F.regexp_replace(path, "^([a-zA-Z0-9]+:)/+", "$1/")
