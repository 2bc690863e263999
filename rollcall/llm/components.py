"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.scratch import materialize


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of edges (a, b), root being the smallest node of
    its component.

    Large and small stars in turn: each node's neighbours are hung on the smallest of
    them, larger ones first, then smaller ones, until nothing moves, some log(n) rounds.
    A round is a written table, so no plan grows and a lost executor costs one round.
    Minima are partial aggregations and are written before they are joined back, so
    that a node with very many neighbours is a join that adaptive execution can split.
    Null ends and loops are left out; no edges, no rows.
    """
    ends = [F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")]
    now = materialize(edges.where("a <> b").select(*ends).distinct(), "edges")
    before = None
    while (seen := _digest(now)) != before:
        before = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "large")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = least.select("u", F.col("m").alias("v"))
        now = materialize(small.unionByName(hung).distinct(), "small")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
