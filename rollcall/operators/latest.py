"""One row, or the first rows, per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The row with the greatest order values per key.

    Partial and final aggregation: at most one row per key and task is shuffled,
    so a key holding most of the table costs no more than any other. The order
    must be total within a key.
    """
    order_first = [*order, *[c for c in df.columns if c not in order and c != key]]
    best = df.groupBy(key).agg(F.max(F.struct(*order_first)).alias("_best"))
    return best.select(key, "_best.*").select(*df.columns)


def best_per_key(df: DataFrame, key: str, ranking: Sequence[Column], value: Column) -> DataFrame:
    """(key, best): `value` of the row with the smallest ranking per key."""
    return df.groupBy(key).agg(F.min_by(value, F.struct(*ranking)).alias("best"))


def first_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, salts: int = 32
) -> DataFrame:
    """The first n rows per key in the given total order, without moving a hot
    key to one task.

    Rows are first cut to n per (key, salt), where the salt is a hash of the whole
    order, then to n per key. The first cut bounds what the second one receives
    to `salts * n` rows per key, whatever the key held.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    pre = W.partitionBy(*keys, "_salt").orderBy(*order)
    cut = salted.withColumn("_rn", F.row_number().over(pre)).where(F.col("_rn") <= n)
    final = W.partitionBy(*keys).orderBy(*order)
    kept = cut.withColumn("_rn", F.row_number().over(final)).where(F.col("_rn") <= n)
    return kept.drop("_salt", "_rn")
