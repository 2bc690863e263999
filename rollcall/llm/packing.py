"""Best-fit packing by minimum bin slack.

Which combination of lengths fills a bin best depends only on how many items of each
length are left. So the search works on a table of lengths, at most `capacity` rows
whatever the input, and a combination found is used as often as its lengths last; the
items themselves are dealt to the bins by their rank within their length, in Spark.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm import bpe
from rollcall.llm.numbering import place_in_group
from rollcall.llm.tiles import text_chunks
from rollcall.operators.scratch import materialize

CAPACITY = 1024
#: Bytes of text that are cut into tokens at a time: a worker that has served other
#: operators before has little memory left.
TEXT_BYTES = 2 << 20
END_OF_DOCUMENT = 2


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Length -> how many, for the bin with the least slack that holds the longest item.

    Subset sums as the bits of an integer: bit s is set if s can be filled. Lengths
    are added from long to short, a length's items in powers of two; going back, long
    items are preferred, so that short ones are left for later bins.
    """
    longest = max(counts)
    steps, reach, full = [], 1 << longest, (1 << capacity + 1) - 1
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == longest), capacity // length)
        size = 1
        while left > 0:
            size = min(size, left)
            steps.append((length, size, reach))
            reach |= reach << length * size & full
            left -= size
            size *= 2
        if reach >> capacity & 1:
            break
    at = reach.bit_length() - 1
    chosen = {longest: 1}
    for length, size, before in reversed(steps):
        if not before >> at & 1:
            at -= length * size
            chosen[length] = chosen.get(length, 0) + size
    return chosen


def combinations(counts: dict[int, int], capacity: int) -> Iterator[tuple[dict[int, int], int]]:
    """(combination, how many bins of it) until no item is left. A combination lasts
    until one of its lengths runs short, so there are few of them."""
    counts = {k: n for k, n in counts.items() if n}
    while counts:
        chosen = fullest(counts, capacity)
        times = min(counts[k] // n for k, n in chosen.items())
        yield chosen, times
        for k, n in chosen.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]


def dealing_table(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, per bin, first bin, offset of the first) rows: the
    items of a length from `first rank` on fill bins from `first bin` on, `per bin` in
    each, beginning at the offset."""
    rows, bins = [], 0
    used = dict.fromkeys(counts, 0)
    for chosen, times in combinations(counts, capacity):
        offset = 0
        for length in sorted(chosen, reverse=True):
            rows.append((length, used[length], chosen[length], bins, offset))
            used[length] += chosen[length] * times
            offset += length * chosen[length]
        bins += times
    return rows


def pack(items: DataFrame, *, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to items with a `length` from 1 to `capacity`.

    The items of a sequence lie in it without gaps from 0. `items` should be a table:
    it is read for the counts and again for the ranks. The dealing table has a few
    rows per length and is bounded by `capacity`; it is joined by ranges of rank,
    through a sorted array per length, not by comparing all. Items alike in all order
    columns are still dealt one by one. No items, no rows.
    """
    spark = items.sparkSession
    counted = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if counted and not 1 <= min(counted) <= max(counted) <= capacity:
        raise ValueError(f"lengths from 1 to {capacity} can be packed")
    rows = dealing_table(counted, capacity)
    dealt = spark.createDataFrame(
        rows or [(0, 0, 1, 0, 0)], "length long, first long, per long, bin long, begin long"
    )
    by_length = dealt.groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("first", "per", "bin", "begin"))).alias("runs")
    )
    placed = place_in_group(items, ["length"], order, "rank").join(F.broadcast(by_length), "length")
    run = F.element_at(F.filter("runs", lambda r: r["first"] <= F.col("rank")), -1)
    nth = F.col("rank") - F.col("run.first")
    return (
        placed.withColumn("run", run)
        .withColumn("sequence_id", F.col("run.bin") + F.floor(nth / F.col("run.per")))
        .withColumn("offset", F.col("run.begin") + (nth % F.col("run.per")) * F.col("length"))
        .drop("rank", "runs", "run")
    )


def cut_points(n: int, capacity: int) -> list[int]:
    """Where the pieces of n tokens begin: all are full but the first."""
    first = n % capacity or capacity
    return [0, *range(first, n, capacity)]


def token_pieces(
    docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    end: int = END_OF_DOCUMENT, keep_ids: bool = False,
) -> DataFrame:
    """Pieces of at most `capacity` tokens: id, piece, start, length, crc and, with
    `keep_ids`, the ids. A text's ids are those of the library for the vocabulary at
    `path`, then `end`; a null text has the end only. Words are encoded once per
    chunk; a text is handled whole, in the memory its own tokens need. The id column
    is a long; rows repeated in `docs` give repeated pieces."""

    def work(batches):
        pairs = bpe.load(path)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, texts in text_chunks(batch.column(1), TEXT_BYTES):
                tiled = pairs.tiled(texts)
                ids, borders = tiled.expanded(pairs.ids_of(tiled.words), "<u4")
                yield _pieces(names[first : first + len(texts)], ids, borders, capacity, end, keep_ids)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    schema = "id long, piece int, start long, length long, crc long" + ", ids array<long>" * keep_ids
    return rows.mapInArrow(work, schema)


def _pieces(names, ids, borders, capacity, end, keep_ids) -> pa.RecordBatch:
    out = [[] for _ in range(6)]
    for k, name in enumerate(names):
        own = np.append(ids[borders[k] : borders[k + 1]], np.uint32(end)).astype("<u4", copy=False)
        data = own.tobytes()
        points = cut_points(len(own), capacity)
        for piece, (a, b) in enumerate(zip(points, [*points[1:], len(own)])):
            row = (name, piece, a, b - a, zlib.crc32(data[4 * a : 4 * b]), own[a:b] if keep_ids else None)
            for column, value in zip(out, row):
                column.append(value)
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    columns = ["id", "piece", "start", "length", "crc", "ids"][: 5 + keep_ids]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out[: len(columns)], kinds)], columns)


def pack_documents(docs: DataFrame, path: str, **options) -> DataFrame:
    """token_pieces() packed: its columns, sequence_id, offset. The pieces are written
    once, so that no text is encoded again for the counts, the ranks or a lost task."""
    pieces = materialize(token_pieces(docs, path, **options), "pieces")
    return pack(pieces, order=["id", "piece", "crc"], capacity=options.get("capacity", CAPACITY))
