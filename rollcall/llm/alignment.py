"""Cross-tokenizer alignment: where the tokens of two vocabularies end together.

A is a byte-level vocabulary, B a `sentencepiece` model that puts a space first; both are
encoded by libraries. Both begin anew at a space that follows something else, whatever stands on either
side, so a text is a row of units, each of which begins with such a space and is encoded
and aligned by itself; distinct units are worked out once per chunk of texts.

A range of a text's bytes is a fragment: an open prefix (before the first border in
it), closed groups (the whole units between its borders) and an open suffix (from the last
border on). Fragments compose: what one leaves open on the right meets what the next
leaves open on the left, and a unit that is whole is closed. The composition is
associative, so the ranges of a very long text are worked out by different tasks and put
together by a tree.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from functools import lru_cache, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm import bpe
from rollcall.llm.tiles import SPACE, Spans, Tiled, kinds, taken, text_chunks
from rollcall.operators.scratch import materialize, shuffle_partitions

MARK = "▁"

#: Longer texts are cut into ranges of about this many bytes.
RANGE_BYTES = 1 << 16
#: Bytes of texts whose distinct units are worked out together.
CHUNK_BYTES = 2 << 20
#: Fragments composed by one task in a round of the tree.
FAN = 16


def unit_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A unit begins at a space that follows neither white space nor a mark."""
    before = np.concatenate([codes[:1], codes[:-1]]) if len(codes) else codes
    return first | ((codes == 0x20) & (kinds()[before] != SPACE) & (before != ord(MARK)))


class Aligner:
    """Two vocabularies, and the pairs of their entries that can end together."""

    def __init__(self, path_a: str, path_b: str):
        self.a = bpe.load(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = self.a.token
        self.bytes_b = {}
        for k in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(k)
            if self.b.is_byte(k):
                self.bytes_b[k] = bytes([int(piece[1:-1], 16)])
            elif not (self.b.is_control(k) or self.b.is_unknown(k) or self.b.is_unused(k)):
                if MARK in piece.lstrip(MARK):
                    raise ValueError("a piece goes beyond a word")
                self.bytes_b[k] = piece.replace(MARK, " ").encode()
        self.size_b, self.lone = self.b.get_piece_size(), self.b.piece_to_id(MARK)
        self.pairs = self._pairs()
        # Bytes of the entries of A, then of B; and how a digest spells them: an id, and what
        # follows it within a group, or at its side's end.
        self.first_b = max(self.bytes_a) + 1
        entries = [self.bytes_a.get(k, b"") for k in range(self.first_b)]
        entries += [self.bytes_b.get(k, b"") for k in range(self.size_b)]
        self.entries = Spans(entries)
        inner = [b"%d," % k for k in (*range(self.first_b), *range(self.size_b))]
        ends = [b"%d|" % k for k in range(self.first_b)] + [b"%d;" % k for k in range(self.size_b)]
        self.spelled = Spans(inner + ends)

    def _pairs(self) -> np.ndarray:
        """Codes of all pairs that can end together, ascending: one entry's bytes end the
        other's. There are at most as many as the two vocabularies' entries have bytes,
        times the entries that share the same bytes, whatever the corpus is."""
        of_a: dict[bytes, list[int]] = {}
        of_b: dict[bytes, list[int]] = {}
        for found, entries in ((of_a, self.bytes_a), (of_b, self.bytes_b)):
            for k, data in entries.items():
                found.setdefault(data, []).append(k)
        codes = set()
        for a, data in self.bytes_a.items():
            for k in range(len(data)):
                codes.update(a * self.size_b + b for b in of_b.get(data[k:], ()))
        for b, data in self.bytes_b.items():
            for k in range(len(data)):
                codes.update(a * self.size_b + b for a in of_a.get(data[k:], ()))
        return np.array(sorted(codes), np.int64)

    def ids_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of A, special strings being plain text. Most units go as lines of one text,
        in which the line breaks are words and tokens of their own."""
        out: list[list[int]] = [[]] * len(texts)
        lines = [
            k for k, t in enumerate(texts)
            if len(t) > 1 and not t[1].isspace() and not t[-1].isspace() and "\n" not in t
        ]
        break_ = self.a.ids[b"\n"]
        joined = np.array(self.a.library.encode_ordinary("\n".join([texts[k] for k in lines])), np.int64)
        cuts = np.flatnonzero(joined == break_)
        if len(cuts) + 1 != max(1, len(lines)):
            raise ValueError("a unit holds the token of a line break")
        flat = joined.tolist()
        for k, start, end in zip(lines, [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(flat)]):
            out[k] = flat[start:end]
        for k in set(range(len(texts))).difference(lines):
            out[k] = self.a.library.encode_ordinary(texts[k])
        return out

    def units(self, found: list[bytes]) -> "Units":
        """Distinct units, aligned; all begin with a space, which B adds by itself."""
        texts = [u.decode() for u in found]
        ids_a = self.ids_a(texts)
        ids_b = self.b.encode([t[1:] for t in texts], num_threads=1) if texts else []
        ids_b = [ids or [self.lone] for ids in ids_b]  # a space at the end of a text
        flat_a, of_a = _flat(ids_a)
        flat_b, of_b = _flat(ids_b)
        flat_b += self.first_b
        given = Spans(found)
        good = np.ones(len(found), bool)
        for flat, of in ((flat_a, of_a), (flat_b, of_b)):
            good &= np.bincount(of, self.entries.sizes[flat], len(found)) == given.sizes
        for flat, of in ((flat_a, of_a), (flat_b, of_b)):
            own = np.flatnonzero(good)
            back, wanted = self.entries.take(flat[good[of]])[0], given.take(own)[0]
            owner = np.repeat(own, given.sizes[own])
            good[owner[back != wanted]] = False
        flat_a, of_a, flat_b, of_b = flat_a[good[of_a]], of_a[good[of_a]], flat_b[good[of_b]], of_b[good[of_b]]
        end_a, end_b = (np.cumsum(self.entries.sizes[x]) for x in (flat_a, flat_b))
        marks = np.zeros((2, int(end_a[-1]) + 1 if len(end_a) else 1), bool)
        marks[0, end_a], marks[1, end_b] = True, True
        last_a, last_b = marks[1, end_a], marks[0, end_b]  # tokens that end a group
        group_a, group_b = (np.cumsum(x) - x for x in (last_a, last_b))
        links = np.searchsorted(self.pairs, flat_a[last_a] * self.size_b + flat_b[last_b] - self.first_b)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        size = self.first_b + self.size_b
        spelled = np.concatenate([flat_a + size * last_a, flat_b + size * last_b])[order]
        data, at = self.spelled.take(spelled)
        owner = np.concatenate([of_a, of_b])[order]
        borders = at[np.searchsorted(owner, np.arange(len(found) + 1))].tolist()
        data = data.tobytes()
        return Units(
            *(np.bincount(x, minlength=len(found)) for x in (of_a, of_b, of_a[last_a])), good,
            [data[a:b] for a, b in zip(borders, borders[1:])], links.astype(np.int32),
        )


@dataclass
class Units:
    """Per unit: tokens of A and B, groups, whether both vocabularies give its bytes back
    (if not, the rest is empty), its digest text with a `;` after each group; and the links
    of all units in order, as places in Aligner.pairs."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    good: np.ndarray
    told: list[bytes]
    links: np.ndarray


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All items, and the list each comes from."""
    sizes = np.array([len(x) for x in lists], np.int64)
    flat = np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))
    return flat, np.repeat(np.arange(len(lists)), sizes)


@lru_cache(maxsize=2)
def load(path_a: str, path_b: str) -> Aligner:
    """One per worker process and pair of vocabularies."""
    return Aligner(path_a, path_b)


# ---- several texts, or the closed groups of several fragments --------------------------
@dataclass
class Told:
    """Per text: tokens of A and B, groups, digest text (None: bytes differ), and its
    linked pairs, as places in Aligner.pairs, with how often each occurs."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    told: list[bytes | None]
    links: pa.ListArray
    times: pa.ListArray


def tell(aligner: Aligner, texts: list[bytes]) -> Told:
    """Texts that are rows of whole units (empty ones have no tokens)."""
    return _told(aligner, Tiled(texts, unit_starts))


def _told(aligner: Aligner, tiled: Tiled) -> Told:
    units = aligner.units(tiled.words)
    index, offsets, n = tiled.index, tiled.offsets, len(tiled.offsets) - 1
    broken = tiled.sums((~units.good).astype(np.int64)) > 0
    sums = [tiled.sums(x) for x in (units.n_a, units.n_b, units.n_groups)]
    told = [
        None if broken[k] else b"".join([units.told[i] for i in index[offsets[k] : offsets[k + 1]].tolist()])[:-1]
        for k in range(n)
    ]
    flat, at = taken(units.links, np.cumsum(units.n_groups) - units.n_groups, units.n_groups, index)
    owner = np.repeat(np.arange(n), np.diff(at[offsets]))
    both, times = np.unique((owner << 32) | flat, return_counts=True)
    both, times = both[~broken[both >> 32]], times[~broken[both >> 32]]
    borders = np.searchsorted(both >> 32, np.arange(n + 1)).astype(np.int32)
    for one in sums:
        one[broken] = 0
    return Told(
        *sums, told,
        pa.ListArray.from_arrays(borders, pa.array((both & 0xFFFFFFFF).astype(np.int32))),
        pa.ListArray.from_arrays(borders, pa.array(times.astype(np.int64))),
    )


# ---- fragments of one text ---------------------------------------------------------------
@dataclass
class Fragment:
    """`left` is open to the left, `right` to the right; without a border all is `left`.
    `closed` holds (place of the first byte, whole units) for units closed on the way."""

    left: bytes
    left_at: int
    border: bool = False
    right: bytes = b""
    right_at: int = 0
    closed: list[tuple[int, bytes]] = field(default_factory=list)


def fragment(data: bytes, at: int) -> Fragment:
    """A range of a text's bytes that begins at byte `at`; 0 is a border, and `closed` is
    one item at most."""
    words = _cut(data)
    if at == 0:
        words = [b"", *words]
    if len(words) == 1:
        return Fragment(data, at)
    left, right = words[0], words[-1]
    middle = data[len(left) : len(data) - len(right)]
    closed = [(at + len(left), middle)] if middle else []
    return Fragment(left, at, True, right, at + len(data) - len(right), closed)


def _cut(data: bytes) -> list[bytes]:
    tiled = Tiled([data], unit_starts)
    return [tiled.words[k] for k in tiled.index.tolist()]


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges, x before y."""
    tail, tail_at = (x.right, x.right_at) if x.border else (x.left, x.left_at)
    closed = x.closed + y.closed
    # What meets is cut again at the seam only: borders inside each side are known.
    at_seam = y.left[:1] == b" " and len(_cut(tail[-4:].decode("utf-8", "ignore")[-1:].encode() + b" ")) == 2
    pieces = [(tail_at, tail), (y.left_at, y.left)] if at_seam else [(tail_at, tail + y.left)]
    if x.border:
        left, left_at = x.left, x.left_at
    else:
        left_at, left = pieces.pop(0)
    border = x.border or y.border or at_seam
    right_at, right = y.right_at, y.right
    if border and not y.border:
        right_at, right = pieces.pop()
    return Fragment(left, left_at, border, right, right_at, closed + pieces)


def ranges(data: bytes, size: int) -> list[tuple[int, bytes]]:
    """A text in ranges of about `size` bytes that cut no code point."""
    cuts, at = [0], size
    while at < len(data):
        if data[at] & 0xC0 == 0x80:
            at += 1
        else:
            cuts.append(at)
            at += size
    return [(a, data[a:b]) for a, b in zip(cuts, [*cuts[1:], len(data)])]


# ---- Spark ----------------------------------------------------------------------------------
_NUMBERS = "n_a long, n_b long, n_groups long"
_LINKS = "links array<int>, times array<long>"
_TEXTS = f"id long, row long, at long, raw binary, {_NUMBERS}, groups_sha256 string, {_LINKS}"
_NODES = "id long, row long, node int, at long, raw binary, border boolean, right_at long, right binary"
_PARTS = f"id long, row long, at long, {_NUMBERS}, told binary, {_LINKS}"
_DOCS = f"id long, {_NUMBERS}, groups_sha256 string, {_LINKS}"


def _batch(schema: str, columns: dict) -> pa.RecordBatch:
    """Columns in the order of a schema; those not given are null."""
    n = len(next(iter(columns.values())))
    kinds_ = {
        "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
        "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()),
    }
    names, arrays = [], []
    for item in schema.split(", "):
        name, kind = item.split(" ")
        value = columns.get(name)
        names.append(name)
        arrays.append(
            pa.nulls(n, kinds_[kind]) if value is None
            else value.cast(kinds_[kind]) if isinstance(value, pa.Array) else pa.array(value, kinds_[kind])
        )
    return pa.RecordBatch.from_arrays(arrays, names)


def _digest(told: bytes | None) -> str:
    return hashlib.sha256(told).hexdigest() if told else ""


def align(
    docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text",
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """One row per row of `docs`: id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256.

    A link is a token of A and one of B that end at the same byte, so each group has one.
    Its count is how many links of the whole table hold the same pair of ids; it is best
    if its B id is in no pair with a higher count (ties are all best).

    Texts that are null, empty, or that a vocabulary does not give back byte for byte
    have no tokens, zeros and an empty digest. Texts up to `range_bytes` are worked out
    where they are read, nothing of them is shuffled; longer ones are cut into ranges
    that are spread over the tasks and composed by a tree, a range without a border
    growing until one is found (a word has to be encoded whole). Their digest is taken
    from the closed groups in order, a batch at a time. What is shared with every task
    is a count per pair of ids, and pairs are bounded by the vocabularies (see
    Aligner._pairs). Rows repeated in `docs` are repeated here, null ids are ids like any
    other, an empty table gives no rows, and other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))

    def first(batches):
        aligner, seen = load(path_a, path_b), 0
        base = TaskContext.get().partitionId() << 33
        for batch in batches:
            names = batch.column(0)
            for start, texts in text_chunks(batch.column(1), CHUNK_BYTES):
                whole = [b" " + t if t else b"" for t in texts]
                short = [k for k, t in enumerate(whole) if len(t) <= range_bytes]
                if short:
                    found = tell(aligner, [whole[k] for k in short])
                    yield _batch(_TEXTS, {
                        "id": names.take(pa.array([start + k for k in short], pa.int64())),
                        "n_a": found.n_a, "n_b": found.n_b, "n_groups": found.n_groups,
                        "groups_sha256": [_digest(t) for t in found.told], "links": found.links, "times": found.times,
                    })
                for k in sorted(set(range(len(whole))).difference(short)):
                    cut = ranges(whole[k], range_bytes)
                    seen += 1
                    yield _batch(_TEXTS, {
                        "id": [names[start + k].as_py()] * len(cut), "row": [base + seen] * len(cut),
                        "at": [at for at, _ in cut], "raw": [data for _, data in cut],
                    })

    texts = materialize(rows.mapInArrow(first, _TEXTS), "alignment")
    short = texts.where("row IS NULL").select("id", "n_a", "n_b", "n_groups", "groups_sha256", "links", "times")
    per_doc = short.unionByName(_long_texts(texts.where("row IS NOT NULL"), path_a, path_b, range_bytes))
    return _with_counts(per_doc, path_a, path_b)


def _long_texts(cut: DataFrame, path_a: str, path_b: str, range_bytes: int) -> DataFrame:
    """Ranges of long texts to one row per text."""
    n = shuffle_partitions(cut.sparkSession)
    both = _NODES + ", " + ", ".join(x for x in _PARTS.split(", ") if x.split(" ")[0] not in ("id", "row", "at"))

    def fragments(batches):
        aligner = load(path_a, path_b)
        for batch in batches:
            table = pa.Table.from_batches([batch]).to_pylist()
            made = [fragment(r["raw"], r["at"]) for r in table]
            yield _batch(both, {
                "id": [r["id"] for r in table], "row": [r["row"] for r in table],
                "node": [r["at"] // range_bytes for r in table], "at": [f.left_at for f in made],
                "raw": [f.left for f in made], "border": [f.border for f in made],
                "right_at": [f.right_at for f in made], "right": [f.right for f in made],
            })
            inner = [(r, f.closed[0]) for r, f in zip(table, made) if f.closed]
            if inner:
                yield _parts(both, aligner, [r for r, _ in inner], [c for _, c in inner])

    ranged = cut.select("id", "row", "at", "raw").repartition(n, "row", "at")
    made = materialize(ranged.mapInArrow(fragments, both), "fragments")
    nodes = made.where("node IS NOT NULL").select(*[x.split(" ")[0] for x in _NODES.split(", ")])
    parts = [made.where("node IS NULL").select(*[x.split(" ")[0] for x in _PARTS.split(", ")])]
    most = nodes.agg(F.max("node")).first()[0] or 0
    last = False
    while not last:
        last = most < FAN
        nodes = materialize(
            nodes.withColumn("parent", F.floor(F.col("node") / FAN).cast("int"))
            .groupBy("row", "parent").applyInArrow(_composed(last), _NODES), "composed",
        )
        parts.append(nodes.where("node IS NULL").mapInArrow(_closing(path_a, path_b), _PARTS))
        nodes = nodes.where("node IS NOT NULL")
        most //= FAN
    every = reduce(DataFrame.unionByName, parts)
    texts = every.repartition(n, "row").sortWithinPartitions("row", "at").mapInArrow(_joined, _DOCS)
    return materialize(texts, "alignment-long")


def _parts(schema: str, aligner: Aligner, rows: list[dict], closed: list[tuple[int, bytes]]) -> pa.RecordBatch:
    found = tell(aligner, [data for _, data in closed])
    return _batch(schema, {
        "id": [r["id"] for r in rows], "row": [r["row"] for r in rows], "at": [at for at, _ in closed],
        "n_a": found.n_a, "n_b": found.n_b, "n_groups": found.n_groups, "told": found.told,
        "links": found.links, "times": found.times,
    })


def _composed(last: bool):
    """Composes up to FAN neighbouring fragments of a text. A row without a node is a
    unit closed on the way; in the last round the text's end closes what is open."""

    def work(table: pa.Table) -> pa.Table:
        given = sorted(table.to_pylist(), key=lambda r: r["node"])
        whole = reduce(
            compose, [Fragment(r["raw"], r["at"], r["border"], r["right"], r["right_at"]) for r in given]
        )
        closed = list(whole.closed)
        one = given[0]
        if last:
            closed.append((whole.right_at, whole.right))
        out = {
            "id": [one["id"]] * len(closed), "row": [one["row"]] * len(closed),
            "at": [at for at, _ in closed], "raw": [data for _, data in closed],
        }
        batches = [_batch(_NODES, out)] if closed else []
        if not last:
            batches.append(_batch(_NODES, {
                "id": [one["id"]], "row": [one["row"]], "node": [one["parent"]], "at": [whole.left_at],
                "raw": [whole.left], "border": [whole.border], "right_at": [whole.right_at], "right": [whole.right],
            }))
        return pa.Table.from_batches(batches)

    return work


def _closing(path_a: str, path_b: str):
    def work(batches):
        aligner = load(path_a, path_b)
        for batch in batches:
            rows = batch.select(["id", "row", "at", "raw"]).to_pylist()
            if rows:
                yield _parts(_PARTS, aligner, rows, [(r["at"], r["raw"]) for r in rows])

    return work


def _joined(batches):
    """Closed groups of long texts in order, to a row per text; one text is open at a time,
    and it holds a running digest and its distinct pairs."""
    now = None

    def done():
        good = not now["bad"]
        held = sorted(now["links"].items()) if good else []
        return _batch(_DOCS, {
            "id": [now["id"]], **{k: [now[k] if good else 0] for k in ("n_a", "n_b", "n_groups")},
            "groups_sha256": [now["sha"].hexdigest() if good else ""],
            "links": [[k for k, _ in held]], "times": [[v for _, v in held]],
        })

    for batch in batches:
        for r in batch.to_pylist():
            if now is None or now["row"] != r["row"]:
                if now is not None:
                    yield done()
                now = {"id": r["id"], "row": r["row"], "n_a": 0, "n_b": 0, "n_groups": 0, "links": {},
                       "sha": hashlib.sha256(), "bad": False, "begun": False}
            if r["told"] is None:
                now["bad"] = True
                continue
            now["sha"].update((b";" if now["begun"] else b"") + r["told"])
            now["begun"] = True
            for k in ("n_a", "n_b", "n_groups"):
                now[k] += r[k]
            for k, times in zip(r["links"], r["times"]):
                now["links"][k] = now["links"].get(k, 0) + times
    if now is not None:
        yield done()


def _with_counts(per_doc: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Counts of linked pairs over all documents, and what they say about each."""

    def count(batches):
        total = np.zeros(len(load(path_a, path_b).pairs), np.int64)
        for batch in batches:
            links, times = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (0, 1))
            np.add.at(total, links, times)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], ["pair", "n"])

    counted = per_doc.select("links", "times").mapInArrow(count, "pair int, n long")
    table = counted.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()  # bounded by the vocabularies
    places, counts = (table.column(k).to_numpy() for k in ("pair", "n"))

    def read(batches):
        pairs = load(path_a, path_b)
        of_pair = np.zeros(len(pairs.pairs), np.int64)
        of_pair[places] = counts
        of_b = pairs.pairs % pairs.size_b
        highest = np.zeros(pairs.size_b, np.int64)
        np.maximum.at(highest, of_b, of_pair)
        best = of_pair == highest[of_b]
        for batch in batches:
            links, times = (batch.column(k) for k in ("links", "times"))
            at = np.concatenate([[0], np.cumsum(links.value_lengths().to_numpy(zero_copy_only=False))])
            k, n = (x.flatten().to_numpy(zero_copy_only=False) for x in (links, times))
            each = [np.concatenate([[0], np.cumsum(x)])[at] for x in (n, n * best[k], n * of_pair[k])]
            columns = {name: batch.column(name) for name in ("id", "n_a", "n_b", "n_groups", "groups_sha256")}
            columns |= dict(zip(("n_links", "n_best", "count_sum"), (np.diff(x) for x in each)))
            yield _batch(_RESULT, columns)

    return per_doc.mapInArrow(read, _RESULT)


_RESULT = f"id long, {_NUMBERS}, n_links long, n_best long, count_sum long, groups_sha256 string"
