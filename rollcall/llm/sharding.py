"""Shards of near-equal size by longest-processing-time scheduling."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.numbering import place_in_group
from rollcall.operators.scratch import materialize

#: Small groups are scheduled in this many lots for each shard; a group larger than an
#: even lot goes alone.
LOTS = 1 << 12


def least_loaded(sizes: list[tuple], shards: int) -> dict:
    """Longest-processing-time: (key, size) by falling size, each to the shard with the
    least load so far (the lowest number among equals), through a heap."""
    loads = [(0, shard) for shard in range(shards)]
    chosen = {}
    for key, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(loads)
        chosen[key] = shard
        heapq.heappush(loads, (load + size, shard))
    return chosen


def shard_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = 16) -> DataFrame:
    """One row per row of `docs`: id, size, crc, digest, shard, slot.

    Rows of equal text (null counts as empty) are a group and stay together; size is
    the text's UTF-8 bytes plus one. What the heap sees is bounded whatever the
    input: with L = LOTS x shards, a group larger than total / L is an item of its own
    (fewer than L such groups exist), and all others go by hash into L lots, one item
    each. So at most 2 x L pairs of key and size reach the driver, a shard has
    thousands of items however many shards there are, and shards differ by no more than
    about the largest item. Items of one size are taken in order of digest or lot, groups
    of their own first. slot numbers a shard's rows from 0, repeated rows each of them,
    in any order among rows alike. A null id is an id like any other; an empty table
    gives no rows.
    """
    spark, lots = docs.sparkSession, LOTS * shards
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = materialize(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(data) + 1).cast("long").alias("size"),
            F.crc32(data).alias("crc"),
            F.sha2(data, 256).alias("digest"),
        ),
        "shard-rows",
    )
    groups = materialize(rows.groupBy("digest").agg(F.sum("size").alias("size")), "shard-groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    lot = F.pmod(F.xxhash64("digest"), F.lit(lots))
    alone = groups.where(F.col("size") * lots > F.lit(total))
    dealt = groups.where(F.col("size") * lots <= F.lit(total)).groupBy(lot.alias("lot")).agg(F.sum("size").alias("size"))
    items = [((0, r["digest"]), r["size"]) for r in alone.collect()] + [((1, r["lot"]), r["size"]) for r in dealt.collect()]
    chosen = least_loaded(items, shards)
    of_group = spark.createDataFrame(
        [(k[1], s) for k, s in chosen.items() if k[0] == 0], "digest string, group_shard int"
    )
    of_lot = spark.createDataFrame([(k[1], s) for k, s in chosen.items() if k[0] == 1], "lot long, lot_shard int")
    placed = (
        rows.withColumn("lot", lot)
        .join(F.broadcast(of_group), "digest", "left")
        .join(F.broadcast(of_lot), "lot", "left")
        .select("id", "size", "crc", "digest", F.coalesce("group_shard", "lot_shard").alias("shard"))
    )
    return place_in_group(placed, ["shard"], ["id", "digest"], "slot")
