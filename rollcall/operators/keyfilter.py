"""A filter of keys, small enough to be everywhere, in front of a large table's scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits that a filter has at most (8 MB of them and their numbers).
WORDS = 1 << 19


def _mark(key: Column) -> list[Column]:
    """The word of a key, and its two bits."""
    code = F.xxhash64(key)
    places = [F.shiftright(code, by).bitwiseAND(F.lit(63)).cast("int") for by in (0, 6)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in places]
    word = F.pmod(F.shiftright(code, 12), F.lit(WORDS).cast("bigint"))
    return [word.alias("_word"), bits[0].bitwiseOR(bits[1]).alias("_mark")]


def passing(df: DataFrame, key: Column, keys: DataFrame, column: str) -> DataFrame:
    """The rows of `df` whose key (text) may be among `keys`; no exchange of rows.

    The filter is built by aggregation: a key belongs to one word and sets two of its
    bits. Only words with a bit are broadcast, one a key and WORDS at most, however many
    keys there are: up to two million keys one row in sixty passes that need not, beyond
    more do. No row that has one of the keys is ever dropped, so what follows has to be
    right without the filter.
    """
    marks = keys.where(F.col(column).isNotNull()).select(*_mark(F.col(column)))
    words = marks.groupBy("_word").agg(F.bit_or("_mark").alias("_bits"))
    marked = df.select("*", *_mark(key)).join(F.broadcast(words), "_word")
    return marked.where(F.col("_bits").bitwiseAND(F.col("_mark")) == F.col("_mark")).select(*df.columns)
