"""SimHash near-duplicates by anchors of a covering code.

64 bits are cut into segments, so many that two fingerprints within the distance differ
in one bit or none in some segment. A segment's anchors are the words whose first 15
bits are a word of the Hamming code: it covers all 15-bit words within radius 1, so each
segment value has a home anchor that differs from it in one bit at most. A fingerprint is
replicated to every anchor within covering radius plus one: the other fingerprint's home
is among them. Fingerprints are compared within an anchor, whole, so what is linked is
exactly the pairs within the distance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.components import components
from rollcall.operators.scratch import materialize

SEED = 42
#: Bytes of a text split into words at a time.
BLOCK = 1 << 22
#: Rows an anchor may have before it is compared block by block in several tasks.
ANCHOR_ROWS = 20_000
#: Groups up to this size are compared pair by pair, larger ones around one home at a time.
SMALL = 16

_GAP = re.compile(rb"[\x20\x09-\x0D]")
_CODE = 15


def word_blocks(text: bytes, width: int) -> Iterator[list[bytes]]:
    """Lists of words whose windows of `width` words are those of the text, each once."""
    carry: list[bytes] = []
    at = 0
    while at < len(text):
        end = at + BLOCK
        if end < len(text):
            gap = _GAP.search(text, end)
            end = gap.start() if gap else len(text)
        words = carry + text[at:end].split()
        yield words
        carry = words[-(width - 1) :] if width > 1 else []
        at = end


def fingerprint(text: bytes, width: int) -> bytes:
    """Eight bytes, the highest bit first. Words are runs without [\\x20\\x09-\\x0D] after
    lower-casing A-Z; a text with fewer words than a shingle is one, without words zero."""
    votes, n, words = np.zeros(64, np.int64), 0, []
    for words in word_blocks(text.lower(), width):
        if len(words) >= width:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]) - 1
            begins = [0, *(ends[:-1] + 1).tolist()]
            digests = b"".join(
                [xxhash.xxh64_digest(joined[a:b], SEED) for a, b in zip(begins, ends[width - 1 :].tolist())]
            )
            n += len(digests) // 8
            votes += _ones(digests)
    if not n and words:
        n, votes = 1, _ones(xxhash.xxh64_digest(b" ".join(words), SEED))
    return np.packbits(2 * votes > n).tobytes()


def _ones(digests: bytes) -> np.ndarray:
    """How often each bit is set. Sums of 255 rows fit a byte."""
    rows = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    total = np.zeros(64, np.int64)
    for at in range(0, len(rows), 255 << 8):
        part = rows[at : at + (255 << 8)]
        bits = np.unpackbits(part, axis=1)
        whole = len(bits) // 255 * 255
        if whole:
            total += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        total += bits[whole:].sum(axis=0, dtype=np.uint8)
    return total


def fingerprints(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4
) -> DataFrame:
    """Rows (id, hash, fp): a 64-bit hash of every row's text, which with the id names the
    row, and the fingerprint of the whole text as a signed long."""

    def work(batches):
        for batch in batches:
            found = b"".join([fingerprint(t or b"", shingle) for t in batch.column(1).to_pylist()])
            fps = np.frombuffer(found, ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps)], ["id", "hash", "fp"])

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"),
        F.xxhash64(text_col).alias("hash"),
    )
    return rows.mapInArrow(work, "id long, hash long, fp long")


def _syndromes() -> np.ndarray:
    """Of every 15-bit word: 0 for a code word, else the bit, from 1, that leads to one."""
    words = np.arange(1 << _CODE)
    out = np.zeros(1 << _CODE, np.int64)
    for bit in range(_CODE):
        out ^= np.where(words >> bit & 1, bit + 1, 0)
    return out


def _pairs() -> np.ndarray:
    """For each syndrome but 0, the seven pairs of bits that lead to a code word."""
    table = np.zeros((_CODE + 1, 7), np.int64)
    for s in range(1, _CODE + 1):
        table[s] = [1 << i - 1 | 1 << (i ^ s) - 1 for i in range(1, _CODE + 1) if i < i ^ s]
    return table


def segments(bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of segments, one of which holds at most one of `bits` differences."""
    n = max(2, bits // 2 + 1)
    if not 0 <= bits <= 7:
        raise ValueError("distances from 0 to 7 bits can be covered")
    borders = [64 * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(borders, borders[1:])]


def replicas(fps: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(anchor keys, fingerprints, whether that is their home) for unsigned fingerprints."""
    syndromes, pairs, parts = _syndromes(), _pairs(), segments(bits)
    for k, (low, width) in enumerate(parts):
        value = (fps >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64)
        s = syndromes[value & (1 << _CODE) - 1]
        home = value ^ np.where(s, 1 << np.maximum(s - 1, 0), 0)
        base = k << 40
        yield base | home, fps, True
        if bits // len(parts):  # else some segment is the same
            off = s > 0  # a code word has no other within distance 2
            near = value[off, None] ^ pairs[s[off]]
            yield base | near.ravel(), np.repeat(fps[off], 7), False
            for bit in range(_CODE, width):
                yield base | home ^ (1 << bit), fps, False


def _replicated(distinct: DataFrame, bits: int) -> DataFrame:
    def work(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for keys, of, home in replicas(fps, bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(of.view(np.int64)), pa.array(np.full(len(keys), home))],
                    ["anchor", "fp", "home"],
                )

    return distinct.select("fp").mapInArrow(work, "anchor long, fp long, home boolean")


def _forest(fps: np.ndarray, homes: int, bits: int) -> np.ndarray:
    """Label of each of some fingerprints, the first `homes` being at home: the place of
    one that it is linked with, directly or not. Quick where most are close together."""
    label = np.arange(len(fps))
    for h in range(homes):
        near = label[np.bitwise_count(fps ^ fps[h]) <= bits]
        if (near != near[0]).any():
            roots = np.unique(near)
            label[np.isin(label, roots)] = roots[0]
            if not label.any():
                break
    return label


def linked(key: np.ndarray, fps: np.ndarray, home: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all fingerprints within the distance which share a key, of rows
    sorted by key, homes first. At most a few per row: large groups give a forest."""
    if not len(key):
        return fps, fps
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(key)]]))
    a, b = [], []
    end = np.repeat(np.where(sizes <= SMALL, starts + sizes, 0), sizes)
    at = np.flatnonzero(home & (end > 0))
    for step in range(1, SMALL):
        at = at[at + step < end[at]]
        hit = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= bits]
        a.append(fps[hit])
        b.append(fps[hit + step])
    for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        own = fps[start : start + size]
        label = _forest(own, int(home[start : start + size].sum()), bits)
        hung = np.flatnonzero(label != np.arange(size))
        a.append(own[hung])
        b.append(own[label[hung]])
    return np.concatenate(a), np.concatenate(b)


def near_links(distinct: DataFrame, *, bits: int = 4, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp`, whose components are those of all
    pairs within `bits`.

    A fingerprint has some 42 replicas at 4 bits. Anchors are compared in sorted
    partitions, batch by batch. An anchor with more than `anchor_rows` rows is cut into
    blocks, and each pair of blocks is a unit of its own in some task, so that no task
    holds more than two blocks whatever the anchor's size; no pair is left out. The
    list of such anchors is broadcast: there are at most 2^22 anchors in all.
    """
    spread = _replicated(distinct, bits)
    crowded = (
        spread.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > anchor_rows)
        .select("anchor", F.ceil(F.col("n") / anchor_rows).cast("int").alias("blocks"))
    )
    crowded = materialize(crowded, "crowded")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    unit = F.transform(others, lambda o: F.least(o, block) * F.col("blocks") + F.greatest(o, block))
    units = spread.join(F.broadcast(crowded), "anchor", "left").select(
        "anchor", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(unit)).alias("unit"), "fp", "home"
    )
    dealt = units.repartition("anchor", "unit").sortWithinPartitions("anchor", "unit", F.desc("home"))

    def work(batches):
        rest = None
        for batch in batches:
            key = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)])
            fps = batch.column(2).to_numpy().view(np.uint64)
            home = batch.column(3).to_numpy(zero_copy_only=False)
            if rest is not None:
                key = np.concatenate([rest[0], key], axis=1)
                fps, home = np.concatenate([rest[1], fps]), np.concatenate([rest[2], home])
            new = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
            cut = int(new[-1]) + 1 if len(new) else 0
            rest = key[:, cut:], fps[cut:], home[cut:]
            yield _link_batch(key[:, :cut], fps[:cut], home[:cut], bits)
        if rest is not None:
            yield _link_batch(*rest, bits)

    return dealt.mapInArrow(work, "a long, b long").distinct()


def _link_batch(key, fps, home, bits) -> pa.RecordBatch:
    group = np.zeros(key.shape[1], np.int64)
    if len(group):
        group[1:] = np.cumsum((key[:, 1:] != key[:, :-1]).any(axis=0))
    a, b = linked(group, fps, home, bits)
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, bits: int = 4,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """One row per row of `docs`: id, fp (a signed long), component (the smallest id that
    links lead to, its own included), kept.

    Rows of one fingerprint are one node from the start, whatever their number; the
    components are worked out over distinct fingerprints and joined back to narrow
    rows. A null text counts as empty and has fingerprint zero like any text without
    words. A null id links like others and is never a component's name unless all are
    null. Repeated rows share a component; exactly one row of a component is kept, one
    with the smallest id (of several the first as fingerprints were written). No rows,
    no result.
    """
    return _decided(docs, id_col, text_col, shingle, bits, anchor_rows).select("id", "fp", "component", "kept")


def _decided(docs, id_col, text_col, shingle, bits, anchor_rows) -> DataFrame:
    rows = fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle)
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    first = F.struct(F.col("id").isNull().alias("nothing"), "id", "row", "hash")
    nodes = materialize(rows.groupBy("fp").agg(F.min(first).alias("least")), "nodes")
    roots = components(near_links(nodes, bits=bits, anchor_rows=anchor_rows))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = materialize(rooted, "rooted")
    names = materialize(rooted.groupBy("root").agg(F.min("least").alias("first")), "names")
    named = materialize(rooted.join(names, "root").select("fp", "first"), "named")
    return rows.join(named, "fp").select(
        "id", "hash", "fp", F.col("first.id").alias("component"), (F.col("row") == F.col("first.row")).alias("kept")
    )


def one_of_each(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, bits: int = 4,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """The rows of `docs` that stay, whole: one of each component, as near_duplicates keeps
    them. Rows are found again by id and text hash; of rows alike in both any one stays,
    which is decided by counts and not by the order in which rows are read."""
    decided = materialize(_decided(docs, id_col, text_col, shingle, bits, anchor_rows), "decided")
    alike = decided.groupBy("id", "hash").agg(F.count("*").alias("alike"), F.max("kept").alias("kept"))
    wanted = materialize(alike.where("kept").select(F.col("id").alias("_id"), F.col("hash").alias("_hash"), "alike"), "wanted")
    whole = docs.select(
        F.struct("*").alias("doc"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("hash")
    )
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    kept = whole.join(wanted.where("alike = 1"), same, "left_semi").select("doc")
    several = wanted.where("alike > 1")
    if not several.isEmpty():
        one = whole.join(several, same, "left_semi").groupBy("id", "hash").agg(F.first("doc").alias("doc"))
        kept = kept.unionByName(one.select("doc"))
    return kept.select("doc.*")
