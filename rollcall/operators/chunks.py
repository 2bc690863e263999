"""Ordered work on groups of any size.

A window over `partitionBy(group)` puts each group in one task, which fails when one
group holds a third of the table. Here quantiles of (group, order) are drawn once, as
bounds between as many ranges as there are shuffle partitions; a group that several
bounds fall into is cut at them, and (group, chunk) takes its place in windows. What a
chunk needs from earlier ones (a running count, the last value) is carried over in a
small table. Rows stay where they are until the window deals them: nothing is sorted
by range or written.

There is one plan for all inputs. Where the bounds lie affects speed only: a chunk
number that grows with the order is all the callers rely on.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.operators.scratch import shuffle_partitions

#: Rows drawn for each range.
DRAWN = 16


@dataclass
class Chunked:
    """Rows with a `chunk` column, 0 for groups that are not cut; and (group, chunk) of
    the groups that are."""

    rows: DataFrame
    group: str
    cuts: DataFrame

    def spread(self, per_group: DataFrame) -> DataFrame:
        """Copy one-row-per-group data to every chunk, so that it can be joined on
        (group, chunk). Only the cut groups get more than one copy."""
        copies = self.cuts.select(F.col(self.group).alias("_group"), "chunk")
        joined = per_group.join(F.broadcast(copies), F.col(self.group) == F.col("_group"), "left")
        return joined.withColumn("chunk", F.coalesce("chunk", F.lit(0))).drop("_group")

    def window(self, *order: Column | str):
        """All rows of a chunk in order."""
        return W.partitionBy(self.group, "chunk").orderBy(*order)

    def carry(self, **summaries: Column) -> DataFrame:
        """Per chunk of the cut groups: the given aggregates of that chunk."""
        return (
            self.rows.where("chunk > 0").groupBy(self.group, "chunk")
            .agg(*[c.alias(name) for name, c in summaries.items()])
        )


def cut_hot_groups(
    df: DataFrame, group: str, order: list[str], *, partitions: int | None = None
) -> Chunked:
    """Draw bounds and cut the groups that two or more of them fall into.

    A group with fewer has less than three ranges' share of the rows, to the accuracy of
    the draw. `partitions` is the number of ranges, by default that of shuffle
    partitions; the bounds, one less, are what is broadcast, and DRAWN keys a range are
    what the driver sees. Null is a group like any other.
    """
    n = partitions or shuffle_partitions(df.sparkSession)
    bounds = _bounds(df.select(group, *order), n)
    of_group = {g: [b[1:] for b in found] for g, found in groupby(bounds, key=lambda b: b[0])}
    several = {g: found for g, found in of_group.items() if len(found) > 1}
    kinds = T.StructType([T.StructField(c, df.schema[c].dataType) for c in order])
    cut = df.sparkSession.createDataFrame(
        [(g, found[:: _width(found)], found, _width(found)) for g, found in several.items()],
        T.StructType([
            T.StructField("_group", df.schema[group].dataType), T.StructField("_heads", T.ArrayType(kinds)),
            T.StructField("_bounds", T.ArrayType(kinds)), T.StructField("_width", T.IntegerType()),
        ]),
    )
    cuts = df.sparkSession.createDataFrame(
        [(g, chunk) for g, found in several.items() for chunk in range(1, len(found) + 2)],
        T.StructType([T.StructField(group, df.schema[group].dataType), T.StructField("chunk", T.IntegerType())]),
    )
    key = F.struct(*order)
    # Bounds up to the row: first whole blocks of them by their heads, then inside one block.
    block = F.size(F.filter("_heads", lambda b: b <= key))
    before = F.greatest(block - 1, F.lit(0)) * F.col("_width")
    inside = F.size(F.filter(F.slice("_bounds", before + 1, F.col("_width")), lambda b: b <= key))
    chunk = F.when(F.col("_width").isNull(), 0).otherwise(before + inside + 1)
    rows = df.join(F.broadcast(cut), F.col(group).eqNullSafe(F.col("_group")), "left").withColumn("chunk", chunk)
    return Chunked(rows.select(*df.columns, "chunk"), group, cuts)


def _width(found: list) -> int:
    return math.isqrt(len(found)) + 1


def _bounds(keys: DataFrame, n: int) -> list[tuple]:
    """Quantiles of the keys, in Spark's order (nulls first)."""
    total = keys.count()
    if n < 2 or not total:
        return []
    drawn = keys.sample(min(1.0, DRAWN * n / total), seed=17).collect()
    ordered = sorted(map(tuple, drawn), key=lambda k: [(x is not None, x) if x is not None else (False,) for x in k])
    return [ordered[len(ordered) * k // n] for k in range(1, n)] if len(ordered) >= n else []


def with_previous(
    df: DataFrame, group: str, order: list[str], value: str, name: str, **cutting
) -> DataFrame:
    """`lag(value)` within the group, for groups of any size."""
    chunked = cut_hot_groups(df, group, order, **cutting)
    window = chunked.window(*order)
    rows = chunked.rows.withColumns(
        {name: F.lag(value).over(window), "_first": F.row_number().over(window) == 1}
    )
    last = chunked.carry(_last=F.max(F.struct(*order, F.col(value).alias("_v"))))
    before = W.partitionBy(group).orderBy("chunk")
    carried = last.select(
        F.col(group).alias("_group"), F.col("chunk").alias("_chunk"),
        F.lag(F.col("_last")["_v"]).over(before).alias("_carried"),
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("chunk") == F.col("_chunk"))
    return (
        rows.join(F.broadcast(carried), same, "left")
        .withColumn(name, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col(name)))
        .drop("_first", "_carried", "_group", "_chunk", "chunk")
    )
