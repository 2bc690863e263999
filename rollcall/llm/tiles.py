"""Texts of an Arrow batch cut into words that tile them, each distinct word once.

The words share the batch's own bytes, so nothing is copied per word; what is done
per word in Python is done once per distinct word of a chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

#: Bytes of text handled at a time; a longer text is a chunk of its own.
CHUNK_BYTES = 8 << 20

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """SPACE, LETTER, NUMBER or OTHER for every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for start, end in ((0, 0xD800), (0xE000, 0x110000)):
        text = "".join(map(chr, range(start, end)))
        for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
            for found in regex.finditer(pattern, text):
                table[start + found.start() : start + found.end()] = kind
    return table


def text_chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of a binary column in chunks of bounded bytes; null is empty."""
    first, texts, held = 0, [], 0
    for row, text in enumerate(column.to_pylist()):
        text = text or b""
        if texts and held + len(text) > size:
            yield first, texts
            first, texts, held = row, [], 0
        texts.append(text)
        held += len(text)
    if texts:
        yield first, texts


class Tiled:
    """Words of some texts: `words[index[k]]` is the k-th word, and text i has the words
    from offsets[i] to offsets[i + 1]."""

    def __init__(self, texts: list[bytes], starts: Callable[[np.ndarray, np.ndarray], np.ndarray]):
        """starts(codes, first) -> flags where a word begins, given the code points of all
        texts and flags at each text's first one."""
        data = b"".join(texts)
        whole = data.decode("utf-8", "replace")
        if len(data) != len(whole) and "�" in whole:  # also repairs bytes that are not UTF-8
            texts = [t.decode("utf-8", "replace").encode() for t in texts]
            data = b"".join(texts)
            whole = data.decode()
        codes = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        at = None
        if len(codes) != len(data):
            width = np.ones(len(codes), np.uint8)
            for limit in (0x80, 0x800, 0x10000):
                width += codes >= limit
            at = np.zeros(len(codes) + 1, np.int64 if len(data) >= 1 << 31 else np.int32)
            np.cumsum(width, out=at[1:])
            begins = np.searchsorted(at, begins)
        first = np.zeros(len(codes) + 1, bool)
        first[begins] = True
        flags = starts(codes, first[:-1])
        where = np.flatnonzero(flags)
        borders = np.zeros(len(where) + 1, np.int32)
        if len(where):
            borders[:-1], borders[-1] = where if at is None else at[where], len(data)
        array = pa.BinaryArray.from_buffers(
            pa.binary(), len(where), [None, pa.py_buffer(borders), pa.py_buffer(data)]
        ).dictionary_encode()
        self.index = array.indices.to_numpy(zero_copy_only=False)
        self.words: list[bytes] = array.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.offsets = np.concatenate([np.searchsorted(where, begins), [len(where)]])

    def sums(self, of_word: np.ndarray) -> np.ndarray:
        """Per text, the sum of a number per distinct word."""
        total = np.concatenate([[0], np.cumsum(of_word[self.index], dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def expanded(self, of_word: list[bytes], dtype) -> tuple[np.ndarray, np.ndarray]:
        """Items of all texts in order, given the items of each distinct word as bytes;
        and where each text's items start and end."""
        flat, total = gathered(of_word, self.index, dtype)
        return flat, total[self.offsets]


def gathered(parts: list[bytes], index: np.ndarray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """parts[k] for each k of index, end to end, and where each begins and the last ends."""
    size = np.dtype(dtype).itemsize
    sizes = np.array([len(x) for x in parts], np.int64) // size
    flat = np.frombuffer(b"".join(parts), dtype)
    begins = np.cumsum(sizes) - sizes
    n = sizes[index]
    total = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=total[1:])
    take = np.repeat(begins[index] - total[:-1], n) + np.arange(total[-1])
    return flat[take], total


class Spans:
    """Byte strings end to end."""

    def __init__(self, parts: list[bytes]):
        self.flat = np.frombuffer(b"".join(parts), np.uint8)
        self.sizes = np.array([len(x) for x in parts], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def take(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the chosen strings, and where each begins and the last ends."""
        return taken(self.flat, self.begins, self.sizes, index)


def taken(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray, index: np.ndarray):
    """Spans of `flat`, and where each begins and the last ends."""
    n = sizes[index]
    at = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=at[1:])
    return flat[np.repeat(begins[index] - at[:-1], n) + np.arange(at[-1])], at
