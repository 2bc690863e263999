"""Mixing sources to target weights by Pareto order sampling.

What a source is to give is known in words. Each of its documents is taken as often as
goes into its rate for certain, and once more with the odds of the rest: documents are
ranked by their random odds divided by their inclusion odds, and taken in that order
until the words are reached. Ranks are never sorted as a whole: where the words are
reached is found by summing sizes per bucket of the rank, then inside one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.llm.numbering import place_in_group
from rollcall.operators.ordering import dense_index
from rollcall.operators.scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: A rank, between 0 and 1, is cut into so many buckets, and one of them into so many again.
BUCKETS = 1 << 13
#: Documents are drawn by falling size, in classes of more than target / bound words; the
#: rest come last. What a class misses or has too much of, the smaller ones make up for.
CLASSES = (4, 16, 64)


def targets(sources: DataFrame, weights: Sequence[float], share: float, limit: float) -> DataFrame:
    """Adds `weight` and `target` to (source, source_size): weights go round by code
    point of the source, null last, and share out `share` of all words; no target is
    above `limit` times its source, the excess being shared again by weight.

    The level at which words are shared rises until no further source is full; each
    turn is one row of sums over the table of sources."""
    by = sources.withColumn("_null", F.col("source").isNull().cast("int"))
    placed = dense_index(by, ["_null", "source"], "place").drop("_null")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights)).cast("int") + 1)
    table = materialize(placed.withColumn("weight", weight), "mix-sources")
    full = F.lit(False)
    found, level = -1, 0.0
    while True:
        total, taken, open_, n = table.agg(
            F.sum("source_size"), F.sum(F.when(full, limit * F.col("source_size")).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.count_if(full),
        ).first()
        if n == found or not open_:
            break
        found, level = n, ((total or 0) * share - taken) / open_
        full = level * F.col("weight") > limit * F.col("source_size")
    target = F.when(full, limit * F.col("source_size")).otherwise(level * F.col("weight"))
    return table.withColumn("target", target.cast("double"))


def _uniform(*parts: Column) -> Column:
    """A number between 0 and 1, both excluded, from 52 bits of a digest."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)


def _rank(p: Column) -> Column:
    """Random odds by inclusion odds, brought between 0 and 1; 1 where there are none."""
    u = F.col("u")
    ratio = (u / (1 - u)) / (p / (1 - p) * F.col("odds"))
    return F.when(p > 0, ratio / (1 + ratio)).otherwise(1.0)


def _reached(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """Of rows (place, v, size) and (place, budget): per place, `cut`, the lowest rank at
    which the sizes up to it go beyond the budget (none: all of them stay within),
    `before`, the sizes below it, and `next_size`, the size at it. Rows of one rank count
    together. Only sums per bucket are shuffled, and the rows of the last bucket."""
    first = F.least(F.floor(F.col("v") * BUCKETS), F.lit(BUCKETS - 1))
    inside = F.col("v") * BUCKETS - F.col("b1")
    second = F.least(F.floor(inside * BUCKETS), F.lit(BUCKETS - 1))

    def crossing(sums: DataFrame, by: list[str]) -> DataFrame:
        upto = F.sum("s").over(W.partitionBy("place").orderBy(by[-1]))
        held = sums.withColumn("after", F.col("base") + upto).withColumn("base", F.col("after") - F.col("s"))
        low = held.where("after > budget AND base <= budget")
        return low.select("place", "budget", "base", *by)

    sums = rows.withColumn("b1", first).groupBy("place", "b1").agg(F.sum("size").alias("s"))
    one = materialize(crossing(sums.join(budgets.withColumn("base", F.lit(0)), "place"), ["b1"]), "mix-bucket")
    inner = rows.withColumn("b1", first).join(one, ["place", "b1"]).withColumn("b2", second)
    inner = materialize(inner.select("place", "budget", "base", "b1", "b2", "v", "size"), "mix-inner")
    sums = inner.groupBy("place", "budget", "base", "b1", "b2").agg(F.sum("size").alias("s"))
    two = crossing(sums, ["b1", "b2"])
    last = inner.drop("budget", "base").join(two, ["place", "b1", "b2"])
    sums = last.groupBy("place", "budget", "base", "v").agg(F.sum("size").alias("s"))
    upto = F.sum("s").over(W.partitionBy("place").orderBy("v"))
    held = sums.withColumn("after", F.col("base") + upto).where("after > budget")
    at = F.min(F.struct("v", (F.col("after") - F.col("s")).alias("before"), F.col("s").alias("next_size")))
    found = held.groupBy("place").agg(at.alias("x"))
    return found.select("place", F.col("x.v").alias("cut"), F.col("x.before").alias("before"), "x.next_size")


def mix(
    docs: DataFrame, *, weights: Sequence[float] = (5, 2, 1), share: float = 1.0, limit: int = 3, seed: str = "mix",
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", odds_col: str | None = None,
) -> DataFrame:
    """One row per row of `docs`: id, source, size (words), source_size, target, copies,
    taken (copies x size).

    A source's documents are drawn in classes of falling size, so that a document as
    large as what is missing cannot spoil the result: a class takes its part of what is
    still to take, first the copies that are certain (the whole part of its rate), then
    its fixed number of words in Pareto order. The document that crosses that number is
    taken with the odds of the part that still fits, if the smaller classes can make up
    for it. At the end the document whose size is nearest to what is missing is taken
    once more, if that comes nearer. So a source's words come as near to its target as
    whole documents allow, and no document is taken more than `limit` times.

    Random numbers come from the seed, the id and the text, so that reruns agree
    whatever the partitions; rows alike in both are numbered. `odds_col` multiplies the
    inclusion odds of a document (positive; null: 1). Nothing about a source is
    gathered in one task but sums per bucket of rank, and a table of sources is joined,
    not collected. A null text has no words, is taken as often as others and adds
    nothing; null sources are one source, after the others; a null id is an id like any
    other; repeated rows are each drawn; an empty table gives no rows; other columns are
    not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    odds = F.lit(1.0) if odds_col is None else F.coalesce(F.col(odds_col).cast("double"), F.lit(1.0))
    rows = materialize(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            F.md5(text.cast("binary")).alias("digest"), odds.alias("odds"),
        ),
        "mix-rows",
    )
    alike = rows.groupBy("id", "digest").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("id").alias("_id"), F.col("digest").alias("_digest")
    )
    alike = materialize(alike, "mix-alike")
    same = rows["id"].eqNullSafe(alike["_id"]) & (rows["digest"] == alike["_digest"])
    again = place_in_group(rows.join(alike, same, "left_semi"), ["id", "digest"], ["source"], "k")
    once = rows.join(alike, same, "left_anti").withColumn("k", F.lit(0).cast("long"))
    name = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    u = _uniform(F.lit(seed), name, F.col("digest"), F.col("k").cast("string"))

    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, limit)
    sources = sources.withColumnRenamed("source", "_source")
    bounds = [F.col("size") * c > F.col("target") for c in CLASSES]
    group = F.lit(len(CLASSES))
    for k in reversed(range(len(CLASSES))):
        group = F.when(bounds[k], F.lit(k)).otherwise(group)
    every = once.unionByName(again)
    placed = materialize(
        every.join(sources, every["source"].eqNullSafe(sources["_source"]))
        .select("id", "digest", "k", "source", "size", "odds", "place", "source_size", "target", u.alias("u"), group.alias("class")),
        "mix-placed",
    )
    chosen, missing = _drawn(placed, seed, limit)
    best = F.struct(F.abs(F.col("missing") - F.col("size")).alias("d"), "v", "digest", "k", "id")
    left = chosen.where(F.col("copies") < limit).join(missing, "place")
    last = (
        left.where(F.abs(F.col("missing") - F.col("size")) < F.col("missing"))
        .groupBy("place").agg(F.min(best).alias("last")).select(F.col("place").alias("_place"), "last")
    )
    last = materialize(last, "mix-last")  # small where it is joined: no row is moved for it
    final = chosen.join(last, F.col("place") == F.col("_place"), "left")
    closing = (
        (F.col("v") == F.col("last.v")) & (F.col("digest") == F.col("last.digest"))
        & (F.col("k") == F.col("last.k")) & F.col("id").eqNullSafe(F.col("last.id"))
    )
    copies = F.col("copies") + F.when(F.coalesce(closing, F.lit(False)), 1).otherwise(0)
    return final.withColumn("copies", copies.cast("long")).select(
        "id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def _drawn(placed: DataFrame, seed: str, limit: int) -> tuple[DataFrame, DataFrame]:
    """The rows with `copies` and rank `v` after all classes, and what each source misses."""
    n = len(CLASSES) + 1
    parts = [F.sum(F.when(F.col("class") == c, F.col("size")).otherwise(0)).alias(f"s{c}") for c in range(n)]
    state = placed.groupBy("place", "target").agg(*parts).withColumn("missing", F.col("target"))
    state = materialize(state, "mix-state")
    drawn = []
    for c in range(n):
        rest = F.expr(" + ".join(f"s{k}" for k in range(c, n)))
        rate = F.when(rest > 0, F.least(F.lit(float(limit)), F.greatest(F.lit(0.0), F.col("missing") / rest))).otherwise(0.0)
        smaller = F.expr(" + ".join(["0", *[f"s{k}" for k in range(c + 1, n)]]))
        asked = (
            state.withColumn("rate", rate).withColumn("whole", F.floor("rate")).withColumn("p", F.col("rate") - F.col("whole"))
            .withColumn("budget", F.col("p") * F.col(f"s{c}")).withColumn("spare", F.col("rate") * smaller / 2)
        )
        rows = placed.where(F.col("class") == c).join(asked.select("place", "p"), "place")
        rows = rows.select("place", _rank(F.col("p")).alias("v"), "size")
        cuts = _reached(rows, asked.where("p > 0").select("place", "budget"))
        fits = F.col("budget") - F.col("before")
        lucky = _uniform(F.lit(seed), F.lit("source"), F.col("place").cast("string"), F.lit(str(c))) * F.col("next_size") < fits
        crossing = F.coalesce(lucky & (F.col("next_size") - fits <= F.col("spare")), F.lit(False))
        sampled = F.when(F.col("p") == 0, 0).when(F.col("cut").isNull(), F.col(f"s{c}")).otherwise(
            F.col("before") + F.when(F.col("crossing"), F.col("next_size")).otherwise(0)
        )
        state = materialize(
            asked.join(cuts, "place", "left").withColumn("crossing", crossing)
            .withColumn("missing", F.col("missing") - F.col("whole") * F.col(f"s{c}") - sampled), "mix-state",
        )
        drawn.append(state.select("place", F.lit(c).alias("class"), "whole", "p", "cut", "crossing"))
        state = state.select("place", "target", "missing", *[f"s{k}" for k in range(n)])
    of_class = drawn[0]
    for one in drawn[1:]:
        of_class = of_class.unionByName(one)
    within = F.when(F.col("p") == 0, False).when(F.col("cut").isNull(), True).otherwise(
        (F.col("v") < F.col("cut")) | (F.col("crossing") & (F.col("v") == F.col("cut")))
    )
    rows = placed.join(of_class, ["place", "class"]).withColumn("v", _rank(F.col("p")))
    rows = rows.withColumn("copies", F.col("whole") + F.when(within, 1).otherwise(0))
    return rows, state.where("missing > 0").select("place", "missing")
