"""Gapless places within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.operators.scratch import materialize, shuffle_partitions


def place_in_group(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Adds `name`: the rows of a group numbered from 0 without gaps.

    A group may hold most rows, and rows may be alike in every column, so the rows are
    written once with a number of their own, and a group is cut by a hash of that number
    into as many lots as there are shuffle partitions; a row's place is its rank in its
    lot (by the order columns, then its number) plus the rows in the group's earlier
    lots. Two exchanges of narrow rows; the table of starts has at most groups x lots
    rows. Null is a group like any other.
    """
    lots = shuffle_partitions(df.sparkSession)
    keys = [*group, "_lot"]
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    cut = rows.withColumn("_lot", F.pmod(F.xxhash64("_row"), F.lit(lots)))
    earlier = W.partitionBy(*group).orderBy("_lot").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        cut.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order, "_row")) - 1
    ranked = cut.withColumn("_rank", rank)
    same = F.lit(True)
    for key in keys:
        same = same & ranked[key].eqNullSafe(starts[f"_of_{key}"])
    return (
        ranked.join(starts, same)
        .withColumn(name, (F.col("_start") + F.col("_rank")).cast("long"))
        .drop("_lot", "_rank", "_start", "_row", *[f"_of_{k}" for k in keys])
    )
