"""Global numbering without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.operators.scratch import materialize, shuffle_partitions

# Bits monotonically_increasing_id() leaves for the row number in a partition.
_ROW_BITS = 33


def dense_index(
    df: DataFrame, order: Sequence[str], name: str, *, partitions: int | None = None
) -> DataFrame:
    """1-based dense position of every row in a total order over any columns.

    One range exchange spreads the rows evenly however the keys are distributed
    (the order is total, so no two rows share a key). Within the sorted partitions
    the id function numbers rows for free; the result is written once, because the
    sampled range bounds must not be drawn again. What remains is a running total
    over one count per partition, joined back by broadcast: its size is the number
    of partitions, not of rows.
    """
    n = partitions or shuffle_partitions(df.sparkSession)
    numbered = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    rows = materialize(numbered, "index")
    rows = rows.withColumn("_part", F.shiftright("_mid", _ROW_BITS)).withColumn(
        "_local", F.col("_mid").bitwiseAND((1 << _ROW_BITS) - 1)
    )
    counts = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    return (
        rows.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_local") + 1)
        .drop("_part", "_local", "_mid", "_start")
    )


def running_start(
    df: DataFrame, group: Sequence[str], split: Sequence[str], size: Column, name: str
) -> DataFrame:
    """Adds `name`: the sum of `size` over the rows of a group before this one, in the
    order in which a source is read.

    `group` and `split` say which part of the source a row comes from (its file, its
    place in it), and the split's order is the order of the parts of a group; a part is
    read by one task, and a task's rows stand in order. Rows are written where they are
    read, with the number of the scan; parts are added up in what was written, the rows
    of a part meet again in one task, as when they were read, and the starts of the
    parts, one row each, are joined to them.
    """
    part = F.xxhash64(*group, *split).alias("_part")
    rows = df.select("*", part, F.monotonically_increasing_id().alias("_mid"), size.cast("long").alias("_size"))
    rows = materialize(rows, "scanned")
    parts = rows.groupBy("_part", *group, *split).agg(F.sum("_size").alias("_n"))
    before = W.partitionBy(*group).orderBy(*split) if group else W.orderBy(*split)
    before = before.rowsBetween(W.unboundedPreceding, -1)
    starts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy("_part").orderBy("_mid").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    joined = rows.join(F.broadcast(starts), "_part")
    return joined.withColumn(name, F.col("_start") + F.col("_inside")).drop("_part", "_mid", "_size", "_inside", "_start")


def scan_index(df: DataFrame, split: Sequence[str], name: str) -> DataFrame:
    """1-based dense position of every row in the order in which a source is read.

    `split` says which part of the source a row comes from (file, place of the block),
    as columns whose order is the order of the parts; a part is read by one task, and a
    task's rows stand in order. Nothing is sorted or exchanged: rows are written where
    they are read with the number of the scan, parts are counted in what was written
    (so a part that is read again, or split otherwise by another session, does no harm),
    and a running total over the parts, one row each, is joined to the rows.
    """
    part = F.xxhash64(*split).alias("_part")
    rows = materialize(df.select("*", part, F.monotonically_increasing_id().alias("_mid")), "scanned")
    parts = rows.groupBy("_part", *split).agg(F.count("*").alias("_n"), F.min("_mid").alias("_first"))
    before = W.orderBy(*split).rowsBetween(W.unboundedPreceding, -1)
    starts = parts.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_mid") - F.col("_first") + 1
    return rows.join(F.broadcast(starts), "_part").withColumn(name, place).drop("_part", "_mid", "_first", "_start")


def dense_index_by_ordinal(
    df: DataFrame, ordinal: str, name: str, *, partitions: int | None = None
) -> DataFrame:
    """1-based dense position in the order of an integer column, without moving whole
    rows more than once.

    Only the ordinals are numbered (`dense_index`, however far apart they lie), and
    joined back. A null or repeated ordinal gives no position and is refused: the
    query fails with its value.
    """
    kind = df.schema[ordinal].dataType
    counted = df.groupBy(ordinal).agg(F.count("*").alias("_n"))
    value = F.coalesce(F.col(ordinal).cast("string"), F.lit("null"))
    fault = F.raise_error(F.concat(F.lit(f"{ordinal} must be unique and not null, not: "), value))
    checked = F.when(F.col(ordinal).isNull() | (F.col("_n") > 1), fault.cast(kind)).otherwise(F.col(ordinal))
    places = dense_index(counted.select(checked.alias(ordinal)), [ordinal], name, partitions=partitions)
    return df.join(places, ordinal)
