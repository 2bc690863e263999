"""Which sources of a language differ, and in which terms.

Terms that enough documents of a language hold are found by iceberg prefix refinement:
byte prefixes of growing length are counted by distinct documents, those below the
threshold are discarded with all that begins with them, and what is left in the end are
complete terms. Every count is exact; arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.llm.tiles import taken, text_chunks
from rollcall.operators.scratch import materialize

#: Shares are counted in billionths.
UNIT = 1_000_000_000
#: Bytes of the prefixes that are counted, before whole terms are.
LEVELS = (3, 8)
#: Bytes of text, bytes of documents' terms, and pairs of sources, that a task works out together.
CHUNK_BYTES, CHUNK_TERMS, PAIRS = 4 << 20, 5 << 20, 1 << 19
#: First prefixes that a task holds counts of before it hands them on.
MOST_HEADS = 1 << 18
#: The filter of surviving prefixes has so many bits for each, and at most MOST_BITS (16 MB).
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 15, 1 << 27
#: Parts into which what belongs to one language is dealt where sources meet each other.
SALTS = 16

_LETTER = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)], bool)
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


# ---- terms of documents -----------------------------------------------------------------
@dataclass
class DocumentTerms:
    """Of each text its distinct terms, in the order of their bytes, each with a line break
    behind it; and how often each occurs, as unsigned 32-bit numbers. Per item (a term of
    a text, in order) its text and its place in `words`, which is in order."""

    terms: pa.BinaryArray
    times: pa.BinaryArray
    document: np.ndarray
    rank: np.ndarray
    words: pa.BinaryArray


def document_terms(texts: list[bytes]) -> DocumentTerms:
    """Terms are runs of ASCII letters and of bytes beyond ASCII, A-Z in lower case."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    letter = _LETTER[raw]
    starts = letter.copy()
    starts[1:] &= ~letter[:-1]
    where = np.flatnonzero(starts)
    begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
    document = np.searchsorted(begins, where, side="right") - 1
    data = _LOWER[raw[letter]]
    borders = np.append((np.cumsum(letter) - 1)[where], len(data)).astype(np.int32)
    words = _binary(borders, data).dictionary_encode()
    order = pc.sort_indices(words.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    both, times = np.unique((document << 32) | rank[words.indices.to_numpy()], return_counts=True)
    lists = np.searchsorted(both >> 32, np.arange(len(texts) + 1))
    ordered = words.dictionary.take(pa.array(order))
    lines = pc.binary_join_element_wise(ordered, pa.scalar(b"", pa.binary()), b"\n")
    ends = np.frombuffer(lines.buffers()[1], np.int32)[: len(lines) + 1].astype(np.int64)
    flat, at = taken(np.frombuffer(lines.buffers()[2] or b"", np.uint8), ends[:-1], np.diff(ends), both & 0xFFFFFFFF)
    return DocumentTerms(
        _binary(at[lists].astype(np.int32), flat), _binary((4 * lists).astype(np.int32), times.astype("<u4")),
        both >> 32, both & 0xFFFFFFFF, ordered,
    )


def _binary(borders: np.ndarray, data: np.ndarray) -> pa.BinaryArray:
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(borders) - 1, [None, pa.py_buffer(borders), pa.py_buffer(np.ascontiguousarray(data))]
    )


_TERMS = "lang string, source string, terms binary, times binary, docs long"


def _write_terms(length: int | None):
    """Documents with their terms; and, where `length` is given, rows (terms: a key, docs)
    that count the first prefixes, so that no level has to read the terms for them."""

    def work(batches):
        heads: Counter[bytes] = Counter()

        def counted():
            columns = [pa.nulls(len(heads), pa.string())] * 2
            columns += [pa.array(heads.keys(), pa.binary()), pa.nulls(len(heads), pa.binary()), pa.array(heads.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, _TERM_COLUMNS)

        for batch in batches:
            for first, texts in text_chunks(batch.column(2), CHUNK_BYTES):
                found = document_terms(texts)
                keys = [batch.column(k).slice(first, len(texts)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*keys, found.terms, found.times, pa.nulls(len(texts), pa.int64())], _TERM_COLUMNS
                )
                if length is not None:
                    heads.update(_heads(found, keys[0], length))
                if len(heads) > MOST_HEADS:
                    yield counted()
                    heads.clear()
        if heads:
            yield counted()

    return work


_TERM_COLUMNS = [x.split(" ")[0] for x in _TERMS.split(", ")]


def _heads(found: DocumentTerms, lang: pa.Array, length: int) -> dict[bytes, int]:
    """Documents by key of the first prefixes. A document's terms are in order, so those of
    one prefix are neighbours."""
    langs = lang.dictionary_encode()
    n = max(1, len(langs.dictionary))
    parts = pc.binary_slice(found.words, 0, length).dictionary_encode()
    done = pc.binary_length(found.words).to_numpy(zero_copy_only=False) <= length
    code = (parts.indices.to_numpy().astype(np.int64) * 2 + done)[found.rank]
    once = np.ones(len(code), bool)
    once[1:] = (code[1:] != code[:-1]) | (found.document[1:] != found.document[:-1])
    code = code[once] * n + langs.indices.to_numpy()[found.document[once]]
    codes, at = _compact(code, 2 * n * len(parts.dictionary))
    names, of_lang = parts.dictionary.to_pylist(), [x.encode() for x in langs.dictionary.to_pylist()]
    keys = [_key(DONE if c // n % 2 else OPEN, names[c // n // 2], of_lang[c % n]) for c in codes.tolist()]
    return dict(zip(keys, np.bincount(at, minlength=len(codes)).tolist()))


class _Chunk:
    """Some documents' terms. Items are terms of documents, in order; `pair` is the
    distinct (group, term) of each."""

    def __init__(self, groups: list[pa.Array], terms: list[bytes]):
        code = np.zeros(len(terms), np.int64)
        for one in (g.dictionary_encode() for g in groups):
            code = code * max(1, len(one.dictionary)) + one.indices.to_numpy()
        _, at, of_document = np.unique(code, return_index=True, return_inverse=True)
        self.names = [tuple(g[k].as_py() for g in groups) for k in at.tolist()]
        data = np.frombuffer(b"".join(terms), np.uint8)
        ends = np.flatnonzero(data == 10)
        borders = np.append([0], ends - np.arange(len(ends))).astype(np.int32)
        words = _binary(borders, data[data != 10]).dictionary_encode()
        sizes = np.diff(np.searchsorted(ends, np.cumsum([0, *map(len, terms)])))
        self.document = np.repeat(np.arange(len(terms)), sizes)
        self.terms, n = words.dictionary, max(1, len(at))
        both, self.pair = _compact(words.indices.to_numpy() * n + of_document[self.document], n * len(words.dictionary))
        self.term, self.group = both // n, both % n


def _compact(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes below `size`, ascending, and the place of each among them."""
    if size > 1 << 23:
        return np.unique(codes, return_inverse=True)
    seen = np.zeros(size, bool)
    seen[codes] = True
    place = np.cumsum(seen, dtype=np.int32) - 1
    return np.flatnonzero(seen), place[codes]


def _chunks(batches, groups: int) -> Iterator[tuple[_Chunk, pa.Table]]:
    """Chunks of batches (group columns, terms, ...) of about CHUNK_TERMS bytes of terms."""
    held, n = [], 0

    def done():
        table = pa.Table.from_batches(held).combine_chunks()
        return _Chunk([table.column(k).chunk(0) for k in range(groups)], table.column(groups).to_pylist()), table

    for batch in batches:
        held.append(batch)
        n += batch.column(groups).nbytes
        if n >= CHUNK_TERMS:
            yield done()
            held, n = [], 0
    if sum(len(b) for b in held):
        yield done()


# ---- a filter of what has survived -------------------------------------------------------
OPEN, DONE = b"0", b"1"


def _key(kind: bytes, part: bytes, lang: bytes) -> bytes:
    """What prefixes (open) and terms (done) of a language are counted by; a part holds no
    line break."""
    return kind + part + b"\n" + lang


def _places(keys: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32)
    return (low % np.uint64(bits)).astype(np.int64), (high % np.uint64(bits)).astype(np.int64)


class Filter:
    """Says of a key whether it may be among the written ones; never no for one that is.
    Its size follows their number up to MOST_BITS; beyond, more of what has not survived
    passes, and is counted and discarded a level later."""

    def __init__(self, survivors: DataFrame, n: int):
        self.bits = bits = LEAST_BITS
        while self.bits < min(BITS_EACH * n, MOST_BITS):
            self.bits = bits = bits * 2

        def place(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_places(batch.column(0).to_pylist(), bits)))], ["at"])

        placed = survivors.select("key").mapInArrow(place, "at long")
        # bitmap positions count from 1 in Spark
        rows = placed.groupBy(F.bitmap_bucket_number(F.col("at") + 1).alias("b")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("bits")
        )
        self.bytes = np.zeros(self.bits // 8, np.uint8)
        for row in rows.toLocalIterator():  # at most MOST_BITS / 32768 rows of 4 KB
            self.bytes[(row["b"] - 1) * 4096 : row["b"] * 4096] = np.frombuffer(row["bits"], np.uint8)

    def may_hold(self, keys: list[bytes]) -> np.ndarray:
        hit = np.ones(len(keys), bool)
        for at in _places(keys, self.bits):
            hit &= (self.bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return hit


# ---- refinement ------------------------------------------------------------------------------
def surviving(terms: DataFrame, threshold: int, levels: Sequence[int] = LEVELS) -> Filter | None:
    """What may be a term of at least `threshold` documents of its language: a filter of
    the whole terms up to the last length, and of the prefixes of longer ones. `terms` is
    a written table as _write_terms makes it for the first length.

    At each length a term that is longer counts for its prefix, one that ends for itself,
    both once a document; the next length looks only at longer terms whose prefix has
    survived. So a rare term is dropped with its first rare prefix and not counted at
    any later length. Partial counts are summed per task before they are shuffled."""
    kept, found, total, before = None, None, 0, 0
    for length in levels:
        if found is None:
            counted = terms.where("docs IS NOT NULL").select(F.col("terms").alias("key"), "docs")
        else:
            rows = terms.where("docs IS NULL").select("lang", "terms")
            counted = rows.mapInArrow(_counted(before, length, found), "key binary, docs long")
        survivors = counted.groupBy("key").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= threshold)
        survivors = materialize(survivors.withColumn("done", F.expr("substring(key, 1, 1) = X'31'")), "prefixes")
        counts = {r["done"]: r["n"] for r in survivors.groupBy("done").agg(F.count("*").alias("n")).collect()}
        total += counts.get(True, 0)
        done = survivors.where("done").select("key")
        kept = done if kept is None else kept.unionByName(done)
        found = Filter(kept.unionByName(survivors.where("NOT done").select("key")), total + counts.get(False, 0))
        before = length
        if not counts.get(False):
            break
    return found


class _Terms:
    """The distinct (language, term) pairs of a chunk that a filter lets pass: all of them,
    or the terms longer than `before` whose prefix of that length survives."""

    def __init__(self, chunk: _Chunk, langs: list[bytes], lang: np.ndarray, before: int, alive: Filter | None, short: bool):
        n = max(1, len(langs))
        both, self.of_pair = _compact(chunk.term * n + lang, n * len(chunk.terms))
        term, self.lang = both // n, both % n
        sizes = pc.binary_length(chunk.terms).to_numpy(zero_copy_only=False)[term]
        self.words = chunk.terms.take(pa.array(term))
        self.passes = (sizes > before) | short
        if alive is not None and before:
            heads = pc.binary_slice(self.words, 0, before).dictionary_encode()
            code = (heads.indices.to_numpy().astype(np.int64) * n + self.lang) * 2 + (sizes > before)
            code[~self.passes] = -1
            found, at = _compact(code + 1, 2 * n * len(heads.dictionary) + 1)
            names = heads.dictionary.to_pylist()
            keys = [
                _key(OPEN if c % 2 else DONE, names[c // 2 // n], langs[c // 2 % n]) for c in (found - 1).tolist() if c >= 0
            ]
            hit = alive.may_hold(keys)
            self.passes &= np.concatenate([np.zeros(len(found) - len(keys), bool), hit])[at]
        self.sizes = sizes


def _counted(before: int, length: int, alive: Filter | None):
    def work(batches):
        for chunk, _ in _chunks(batches, 1):
            langs = [x.encode() for x, in chunk.names]
            own = _Terms(chunk, langs, chunk.group, before, alive, False)
            longer = np.flatnonzero(own.passes)
            done, n = own.sizes[longer] <= length, max(1, len(langs))
            parts = pc.binary_slice(own.words.take(pa.array(longer)), 0, length).dictionary_encode()
            code = (parts.indices.to_numpy().astype(np.int64) * 2 + done) * n + own.lang[longer]
            found, of_pair = _compact(code, 2 * n * len(parts.dictionary))
            key = np.full(len(own.passes), -1, np.int64)
            key[longer] = of_pair
            of_item = key[own.of_pair][chunk.pair]
            chosen = of_item >= 0
            of_item, document = of_item[chosen], chunk.document[chosen]
            # A document's terms are in order, so those of one prefix are neighbours.
            once = np.ones(len(of_item), bool)
            once[1:] = (of_item[1:] != of_item[:-1]) | (document[1:] != document[:-1])
            docs = np.bincount(of_item[once], minlength=len(found)).astype(np.int64)
            names = parts.dictionary.to_pylist()
            keys = [_key(DONE if x // n % 2 else OPEN, names[x // n // 2], langs[x % n]) for x in found.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(docs)], ["key", "docs"])

    return work


def term_counts(
    terms: DataFrame, threshold: int, levels: Sequence[int] = LEVELS
) -> DataFrame:
    """(lang, part, source, n, first): how often each term that at least `threshold`
    documents of its language hold occurs in each source; `first` marks one row a term.

    The last refinement, of complete terms: those that the prefixes leave are counted by
    document and by occurrence in one pass, and those with too few documents dropped. A
    document has one source, so documents add up over sources. One exchange, by term."""
    may = surviving(terms, threshold, levels)
    last = levels[-1] if levels else 0

    def work(batches):
        for chunk, table in _chunks(batches, 2):
            langs = sorted({x for x, _ in chunk.names})
            of_group = np.array([langs.index(x) for x, _ in chunk.names], np.int64)
            own = _Terms(chunk, [x.encode() for x in langs], of_group[chunk.group], last, may, True)
            names = [x.encode() for x in langs]
            keys = pa.array([_key(b"", w, names[g]) for w, g in zip(own.words.to_pylist(), own.lang.tolist())], pa.binary())
            times = np.frombuffer(b"".join(table.column(3).to_pylist()), "<u4").astype(np.int64)
            n = np.zeros(len(chunk.term), np.int64)
            np.add.at(n, chunk.pair, times)
            docs = np.bincount(chunk.pair, minlength=len(n)).astype(np.int64)
            hit = own.passes[own.of_pair]
            sources = pa.array([x for _, x in chunk.names], pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    keys.take(pa.array(own.of_pair[hit])), sources.take(pa.array(chunk.group[hit])),
                    pa.array(n[hit]), pa.array(docs[hit]),
                ],
                ["key", "source", "n", "docs"],
            )

    rows = terms.where("docs IS NULL").select("lang", "source", "terms", "times")
    found = rows.mapInArrow(work, "key binary, source string, n long, docs long").repartition("key")
    summed = found.groupBy("key", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = summed.groupBy("key").agg(
        F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("here")
    ).where(F.col("docs") >= threshold)
    text = F.decode("key", "UTF-8")
    part = F.substring_index(text, "\n", 1)
    lang = F.substr(text, (F.char_length(part) + 2).cast("int"))
    each = of_term.select(lang.alias("lang"), part.alias("part"), F.posexplode("here").alias("place", "x"))
    return each.select("lang", "part", "x.source", "x.n", (F.col("place") == 0).alias("first"))


# ---- divergence -------------------------------------------------------------------------------
def _share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + v)), exact for any counts; null without terms."""
    top = (F.lit(UNIT).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")).alias("t")
    return F.when(v > 0, F.call_function("div", top, (total + v).cast("decimal(20,0)")) + 1).cast("long")


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def audit(
    docs: DataFrame, *, threshold: int = 3, top: int = 200, levels: Sequence[int] = LEVELS,
    text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from
    each other one (part `pair`), and the terms it has more of than its language
    (part `term`, the first `top`).

    p = 1 + floor(UNIT * (count + 1) / (N + V)) is the share of a kept term, V their
    number in the language, N all their occurrences in the group; the value is the sum of
    floor((p - q)^2 / q) over all kept terms (pair), or that of one term. Ranks go by
    falling value, then by the item's bytes.

    Texts are read once; each document's distinct terms are written, and every level
    reads them. Shuffled are counts summed per task, never documents; a frequent term is
    a row per task. A pair of sources is summed over the terms both hold; terms that one
    of them lacks have one share there, and are counted by the other's share. What belongs
    to a language is dealt into parts where sources meet. The result has a row per pair
    of sources of a language, as asked.

    Null texts, languages and sources count as ''. A source without kept terms is compared
    like any other, in a language without any the value is 0; a single source has
    no pairs. Repeated rows are documents of their own; an empty table gives no rows;
    other columns are not looked at.
    """
    blank = F.lit("")
    rows = docs.select(
        F.coalesce(F.col(lang_col), blank).alias("lang"), F.coalesce(F.col(source_col), blank).alias("source"),
        F.coalesce(F.col(text_col), blank).cast("binary").alias("text"),
    )
    terms = materialize(rows.mapInArrow(_write_terms(levels[0] if levels else None), _TERMS), "terms")
    counts = materialize(term_counts(terms, threshold, levels), "term-counts")

    of_lang = counts.where("first").groupBy("lang").agg(F.count("*").alias("v"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    groups = terms.where("docs IS NULL").select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = groups.na.fill(0, ["total", "own", "v"]).withColumn("zero", _share(F.lit(0), F.col("total"), F.col("v")))
    groups = materialize(groups, "term-groups")
    shares = counts.join(groups.select("lang", "source", "total", "v", "zero"), ["lang", "source"])
    shares = shares.withColumn("p", _share(F.col("n"), F.col("total"), F.col("v")))
    here = F.collect_list(F.struct("source", "n", "p", "zero")).alias("here")
    by_term = materialize(shares.groupBy("lang", "part", "v").agg(F.sum("n").alias("n"), here), "term-shares")
    return _pairs(groups, by_term).unionByName(_terms(groups, by_term, top))


def _ranked(rows: DataFrame) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def _terms(groups: DataFrame, by_term: DataFrame, top: int) -> DataFrame:
    whole = groups.groupBy("lang").agg(F.sum("total").alias("total"))
    rows = by_term.join(whole, "lang").withColumn("q", _share(F.col("n"), F.col("total"), F.col("v")))
    each = rows.select("lang", "part", "q", F.explode("here").alias("x")).where("x.p > q").select(
        "lang", F.col("x.source").alias("source"), F.lit("term").alias("part"),
        F.col("part").alias("item"), _f(F.col("x.p"), F.col("q")).alias("value"),
    )
    return _ranked(each).where(F.col("rank") <= top)


def _pairs(groups: DataFrame, by_term: DataFrame) -> DataFrame:
    # Terms that both hold, less what is counted for them below as if one lacked them.
    both = by_term.select("lang", "here").mapInArrow(_both, "lang string, source string, item string, value long")
    both = both.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    # Terms of one source by their share, against what any other source gives a term it lacks.
    one = by_term.select("lang", F.explode("here").alias("x")).groupBy("lang", "x.source", "x.p").agg(F.count("*").alias("n"))
    salted = groups.select(
        "lang", F.col("source").alias("other"), "zero", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    one = one.withColumn("salt", F.pmod(F.hash("source", "p"), F.lit(SALTS))).join(salted, ["lang", "salt"])
    one = one.where("source <> other")
    one = one.select("lang", F.explode(F.array(
        F.struct(F.col("source").alias("source"), F.col("other").alias("item"), (F.col("n") * _f(F.col("p"), F.col("zero"))).alias("value")),
        F.struct(F.col("other").alias("source"), F.col("source").alias("item"), (F.col("n") * _f(F.col("zero"), F.col("p"))).alias("value")),
    )).alias("x")).groupBy("lang", "x.source", "x.item").agg(F.sum("x.value").alias("value"))

    # Terms that neither holds; this also names every pair.
    other = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("q"), F.col("own").alias("theirs"))
    salt = F.pmod(F.hash("source"), F.lit(SALTS))
    other = other.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    none = groups.withColumn("salt", salt).join(other, ["lang", "salt"]).where("source <> item").select(
        "lang", "source", "item",
        F.when(F.col("v") > 0, (F.col("v") - F.col("own") - F.col("theirs")) * _f(F.col("zero"), F.col("q"))).otherwise(0).alias("value"),
    )
    every = none.unionByName(one).unionByName(both)
    summed = every.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    return _ranked(summed.withColumn("part", F.lit("pair"))).select("lang", "source", "part", "item", "value", "rank")


def _both(batches):
    """For each pair of sources the sum over terms that both hold, a block of pairs at a
    time: each source of a term meets the others, and sums per pair are what goes on."""
    for batch in batches:
        here = batch.column(1)
        langs = batch.column(0).dictionary_encode()
        flat = here.flatten()
        sources = flat.field("source").dictionary_encode()
        p, zero = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("p", "zero"))
        sizes = pc.list_value_length(here).to_numpy(zero_copy_only=False).astype(np.int64)
        begin = np.repeat(np.cumsum(sizes) - sizes, sizes)  # per item: its term's first item
        size = np.repeat(sizes, sizes)
        lang = np.repeat(langs.indices.to_numpy(), sizes).astype(np.int64)
        source, n = sources.indices.to_numpy().astype(np.int64), max(1, len(sources.dictionary))
        block = np.cumsum(size) // PAIRS
        codes, values = [], []
        for cut in np.split(np.arange(len(size)), np.flatnonzero(np.diff(block)) + 1):
            a = np.repeat(cut, size[cut])
            upto = np.cumsum(size[cut])
            b = begin[a] + np.arange(len(a)) - np.repeat(upto - size[cut], size[cut])
            a, b = a[a != b], b[a != b]
            found = (p[a] - p[b]) ** 2 // p[b] - (p[a] - zero[b]) ** 2 // zero[b]
            found += (zero[a] - zero[b]) ** 2 // zero[b] - (zero[a] - p[b]) ** 2 // p[b]
            code, at = _compact((lang[a] * n + source[a]) * n + source[b], max(1, len(langs.dictionary)) * n * n)
            total = np.zeros(len(code), np.int64)
            np.add.at(total, at, found)
            codes.append(code)
            values.append(total)
        code = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                langs.dictionary.take(pa.array(code // n // n)), sources.dictionary.take(pa.array(code // n % n)),
                sources.dictionary.take(pa.array(code % n)), pa.array(np.concatenate(values) if values else code),
            ],
            ["lang", "source", "item", "value"],
        )
