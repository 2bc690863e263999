"""SentencePiece encoding and decoding, sharing the work of common prefixes.

Words are marked (a space is written as the mark and begins a word), sorted and walked
depth first as a trie: what has been worked out for a prefix serves every word that
begins with it. For a unigram model the forward state of a prefix is its best score and
the last piece of the path that has it (Viterbi). For a BPE model the best-scored path
is not the encoding, and the state is the one piece that ends the prefix's encoding and
fits what stands before. Which it is, the model's file says; other kinds are refused.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.tiles import Tiled, gathered, text_chunks

MARK = "▁"
_MARK_BYTES = MARK.encode()

#: Distinct words whose ids a worker keeps at hand.
CACHE_WORDS = 300_000


def word_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A word is a run of marks and what follows up to the next mark."""
    mark = codes == ord(MARK)
    starts = mark & ~np.concatenate([[False], mark[:-1]]) if len(mark) else mark
    return starts | first


#: Kinds of model and of piece, as the model's file numbers them (fixed values).
UNIGRAM, BPE = 1, 2
UNKNOWN_PIECE, CONTROL_PIECE, USER_PIECE, UNUSED_PIECE, BYTE_PIECE = 2, 3, 4, 5, 6
#: How far below the least score of a piece an unknown character counts (fixed value).
UNKNOWN_PENALTY = 10.0


def _fields(data: bytes):
    """(number, value) of a message's fields: integers, or bytes for what has a length."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        else:
            size, at = {1: (8, at), 5: (4, at)}.get(tag & 7) or varint(at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def model_kind(data: bytes) -> tuple[int, set[int]]:
    """The kind of a model, and the kinds of pieces it has, from its file."""
    kind, pieces = UNIGRAM, set()
    for number, value in _fields(data):
        if number == 1:
            pieces.add(dict(_fields(value)).get(3, 1))
        elif number == 2:
            kind = dict(_fields(value)).get(3, UNIGRAM)
    return kind, pieces


class Pieces:
    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = file.read()
        self.kind, kinds = model_kind(data)
        if self.kind not in (UNIGRAM, BPE) or USER_PIECE in kinds:
            raise ValueError("only unigram and BPE models without pieces of the user's are supported")
        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.unknown = model.unk_id()
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte: list[int] = [0] * 256
        self.data: list[bytes] = []
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                self.byte[int(piece[1:-1], 16)] = k
                self.data.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                self.data.append(b"")
            else:
                if MARK in piece.lstrip(MARK):
                    raise ValueError("a piece goes beyond a word")
                self.ids[piece], self.score[piece] = k, model.get_score(k)
                self.data.append(piece.replace(MARK, " ").encode())
        tails: dict[str, set[int]] = {}
        for piece in self.ids:
            if len(piece) > 1:
                tails.setdefault(piece[-2:], set()).add(len(piece))
        self.tails = {k: (*sorted(v, reverse=True), 1) for k, v in tails.items()}
        self.no_piece = min(self.score.values(), default=0.0) - UNKNOWN_PENALTY
        self.spelled = BYTE_PIECE in kinds
        self._fits: dict[tuple[str, str], bool] = {}
        self._known: dict[bytes, bytes] = {}

    def merged(self, word: str) -> list[str]:
        """The encoding by its definition: join the neighbours that make the best piece,
        the leftmost of equals, until none do."""
        parts, score = list(word), self.score
        while len(parts) > 1:
            found = [(-score[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score]
            if not found:
                break
            _, k = min(found)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _follows(self, a: str, t: str) -> bool:
        if len(self._fits) > 1_000_000:
            self._fits.clear()
        good = self._fits[a, t] = self.merged(a + t) == ([a, t] if a else [t])
        return good

    def walk(self, words: list[str]):
        """For sorted words, the last piece of every prefix; the list is reused."""
        return self._best_paths(words) if self.kind == UNIGRAM else self._merges(words)

    def _best_paths(self, words: list[str]):
        """By best score: of paths alike the one whose last piece is longest. Sums of the
        model's single-precision scores are exact here; the library rounds them as it goes
        along a text, so of paths with one score it may take another."""
        score, tails = self.score, self.tails
        last, best, before = [""], [0.0], ""
        for word in words:
            same = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                same += 1
            del last[same + 1 :], best[same + 1 :]
            before = word
            for end in range(same + 1, len(word) + 1):
                found, piece = None, ""
                for size in tails.get(word[end - 2 : end], (1,)) if end > 1 else (1,):
                    if size > end:
                        continue
                    t = word[end - size : end]
                    own = score.get(t)
                    if own is None:
                        if size > 1:
                            continue
                        own = self.no_piece
                    total = best[end - size] + own
                    if found is None or total > found:
                        found, piece = total, t
                last.append(piece)
                best.append(found)
            yield last

    def _merges(self, words: list[str]):
        ids, tails, fits = self.ids, self.tails, self._fits
        last, before = [""], ""
        for word in words:
            same = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                same += 1
            del last[same + 1 :]
            before = word
            for end in range(same + 1, len(word) + 1):
                for size in tails.get(word[end - 2 : end], (1,)) if end > 1 else (1,):
                    start = end - size
                    if start < 0:
                        continue
                    t = word[start:end]
                    if size > 1 and t not in ids:
                        continue
                    good = fits.get((last[start], t))
                    if good is None:
                        good = self._follows(last[start], t)
                    if good:
                        last.append(t)
                        break
            yield last

    def ids_of(self, words: list[bytes]) -> list[bytes]:
        """Ids of each distinct marked word, as little-endian unsigned 32-bit integers."""
        known = self._known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = words
        texts = sorted(w.decode() for w in new)
        for word, last in zip(texts, self.walk(texts)):
            out, end = [], len(word)
            while end:
                piece = last[end]
                end -= len(piece)
                if piece in self.ids:
                    out.append(self.ids[piece])
                elif self.spelled:  # a character without a piece is spelled in bytes
                    out += [self.byte[b] for b in reversed(piece.encode())]
                elif not out or out[-1] != self.unknown:  # or is unknown, together with its neighbours
                    out.append(self.unknown)
            known[word.encode()] = np.array(out[::-1], "<u4").tobytes()
        return [known[w] for w in words]

    def encoded(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        marked = [_MARK_BYTES + t.replace(b" ", _MARK_BYTES) if t else b"" for t in texts]
        tiled = Tiled(marked, word_starts)
        return tiled.expanded(self.ids_of(tiled.words), "<u4")

    def decoded(self, ids: np.ndarray, borders: np.ndarray) -> list[bytes]:
        """Texts of ids; the space that encoding puts first is taken away. An id that the
        model does not have is an error that names it."""
        outside = ids[(ids < 0) | (ids >= len(self.data))]
        if len(outside):
            raise ValueError(f"the model has no piece {outside[0]}")
        data, at = gathered(self.data, ids, np.uint8)
        data, at = data.tobytes(), at[borders]
        return [data[a + (data[a : a + 1] == b" ") : b] for a, b in zip(at, at[1:])]


@lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    """One per worker process and model."""
    return Pieces(path)


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id and the model's ids of the text, a null text having
    none. A map over partitions; long texts are whole, words worked out once a chunk.
    Repeated rows are repeated, null ids are ids like any other; no rows, no result."""

    def work(batches):
        pieces = load(path)
        for batch in batches:
            for first, texts in text_chunks(batch.column(1)):
                ids, borders = pieces.encoded(texts)
                lists = pa.LargeListArray.from_arrays(pa.array(borders, pa.int64()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), lists.cast(pa.list_(pa.int32()))], ["id", "ids"]
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(work, "id long, ids array<int>")


def decode(rows: DataFrame, path: str, *, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """One row per row: id and text. Null ids give an empty text; marks come back as
    spaces, and bytes that make no character as the replacement character."""

    def work(batches):
        pieces = load(path)
        for batch in batches:
            lists = [x or [] for x in batch.column(1).to_pylist()]
            borders = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            flat = np.array([i for x in lists for i in x], np.int64)
            texts = [t.decode("utf-8", "replace") for t in pieces.decoded(flat, borders)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    chosen = rows.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return chosen.mapInArrow(work, "id long, text string")


def round_trip(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`, encoded and decoded again in one pass: id, n_pieces,
    ids_crc (over unsigned 32-bit ids), text_crc (of the decoded text) and same, whether
    the decoded text is the original but for marks that were written in it."""

    def work(batches):
        pieces = load(path)
        for batch in batches:
            for first, texts in text_chunks(batch.column(1)):
                ids, borders = pieces.encoded(texts)
                back = pieces.decoded(ids, borders)
                data = np.ascontiguousarray(ids, "<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array(np.diff(borders)),
                        pa.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(borders, borders[1:])], pa.int64()),
                        pa.array([zlib.crc32(t) for t in back], pa.int64()),
                        pa.array([a.replace(_MARK_BYTES, b" ") == b for a, b in zip(texts, back)]),
                    ],
                    ["id", "n_pieces", "ids_crc", "text_crc", "same"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(work, "id long, n_pieces long, ids_crc long, text_crc long, same boolean")
