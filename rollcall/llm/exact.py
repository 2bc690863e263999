"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Two texts are equal when identical after deleting every character of
[\\x20\\x09-\\x0D]; a null text counts as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.operators.scratch import materialize

SPACES = r"[\x20\x09-\x0D]+"
#: Bits of the filter that holds the surviving (length, prefix hash) pairs: 8 MB.
FILTER_BITS = 1 << 26


def squeezed(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "")


def _filter_bit() -> Column:
    return F.pmod(F.xxhash64("n", "p"), F.lit(FILTER_BITS)) + 1


def surviving_filter(probe: DataFrame) -> DataFrame:
    """Of rows (n, p), the lengths seen more than once, in them the prefix hashes seen
    more than once, as bitmaps: rows (bucket, bits), at most FILTER_BITS / 32768 of
    4096 bytes however many pairs there are. A wrong hit costs a hash, not a result."""
    pairs = materialize(probe.groupBy("n", "p").agg(F.count("*").alias("rows")), "dedup-pairs")
    lengths = pairs.groupBy("n").agg(F.sum("rows").alias("all")).where("all > 1").select("n")
    survivors = pairs.where("rows > 1").join(lengths, "n", "left_semi")
    return survivors.groupBy(F.bitmap_bucket_number(_filter_bit()).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(_filter_bit())).alias("bits")
    )


def _hit(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substr(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))


def exact_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64,
    digest_all: bool = False,
) -> DataFrame:
    """One row per row of `docs`: id, points (code points of the text), digest (SHA-256
    of the squeezed text), keep_id, group_size, kept.

    The first scan takes length and prefix hash only, and the pairs that occur more
    than once become a filter of fixed size. The second scan hashes whole texts that
    pass the filter; other texts are alone and their digest is null, unless
    `digest_all` asks for it. Only narrow rows are shuffled, never texts; a digest
    shared by a third of all rows is one row per task in the aggregation, and the
    join that brings its result back is one that adaptive execution splits.

    Of equal texts the one with most code points in the original, then the smallest
    id, stays; null ids come last. Exactly one row of a group stays: of rows that are
    alike in both (repeated rows, null ids) the first as their hashes were written.
    Rows repeated under one id are counted each in group_size. An empty table gives an
    empty result; other columns of `docs` are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = _found(rows, prefix_chars)
    wanted = F.lit(True) if digest_all else F.col("again")
    digest = F.when(wanted, F.sha2("squeezed", 256)).alias("digest")
    hashed = found.select("id", "points", "again", digest, F.monotonically_increasing_id().alias("row"))
    hashed = materialize(hashed, "dedup-hashed")
    again = hashed.where("again")
    groups = again.groupBy("digest").agg(F.count("*").alias("group_size"), F.min(_first("row")).alias("first"))
    groups = materialize(groups, "dedup-groups")  # apart from the join, so that the join can be split
    alone = hashed.where("NOT again").select(
        "id", "points", "digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    together = again.join(groups, "digest").select(
        "id", "points", "digest", F.col("first.id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept")
    )
    return alone.unionByName(together)


def one_of_each(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64
) -> DataFrame:
    """The rows of `docs` that stay, whole: of equal texts the one that exact_duplicates
    names, of rows alike in its id and length any one.

    Decided on narrow rows; texts of groups are hashed once more on the way out, instead
    of being written with their digests, and only they are shuffled. Which rows are alike
    is known from counts, so that nothing hangs on the order in which rows are read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct("*").alias("doc"))
    found = _found(rows, prefix_chars)
    digest = F.sha2("squeezed", 256).alias("digest")
    hashed = materialize(found.where("again").select("id", "points", digest), "dedup-hashed")
    alike = hashed.groupBy("digest", "points", "id").agg(F.count("*").alias("alike"))
    groups = materialize(alike.groupBy("digest").agg(F.min(_first("alike")).alias("first")), "dedup-groups")
    again = found.where("again").select("id", "points", digest, "doc")
    best = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("points") == -F.col("first.p"))
    alone = found.where("NOT again").select("doc")
    single = again.join(groups.where("first.alike = 1"), "digest").where(best).select("doc")
    kept = alone.unionByName(single)
    several = groups.where("first.alike > 1")
    if not several.isEmpty():
        one = again.join(several, "digest").where(best).groupBy("digest").agg(F.first("doc").alias("doc"))
        kept = kept.unionByName(one.select("doc"))
    return kept.select("doc.*")


def _found(rows: DataFrame, prefix_chars: int) -> DataFrame:
    """Rows with points, the squeezed text, and `again`, whether a text may occur twice."""
    text = squeezed(F.col("text"))
    probe = [F.char_length(text).alias("n"), F.xxhash64(F.substring(text, 1, prefix_chars)).alias("p")]
    filters = materialize(surviving_filter(rows.select(*probe)), "dedup-filter")
    own = [c for c in rows.columns if c != "text"]
    points = F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("points")
    found = rows.select(*own, points, text.alias("squeezed"), *probe).withColumn("bucket", F.bitmap_bucket_number(_filter_bit()))
    return found.join(F.broadcast(filters), "bucket", "left").withColumn(
        "again", _hit(F.col("bits"), F.bitmap_bit_position(_filter_bit()))
    )


def _first(last: str) -> Column:
    """What orders the rows of a group; the column `last` comes after the contract's order."""
    return F.struct((-F.col("points")).alias("p"), F.col("id").isNull().alias("nothing"), F.col("id").alias("id"), last)
