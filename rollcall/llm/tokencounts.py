"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

`token_index` is made once. How many tokens a truncated text has, and how much of a text
fits a budget, is then read from its table without encoding anything again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm import bpe
from rollcall.llm.tiles import SPACE, Tiled, gathered, kinds, text_chunks


def token_index(
    docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", prefixes: bool = True
) -> DataFrame:
    """One row per row of `docs`: id, n_bytes, n_tokens and, with `prefixes`, the table
    `counts`: its k-th element is the token count of the first k code points.

    Counts are those of the library for the byte-level vocabulary at `path`, nothing
    added, special strings in a text as one token; a cut inside one makes it plain text.
    A null text counts as empty and has an empty table. A map over partitions,
    nothing is shuffled; distinct words are worked out once per chunk of bounded
    bytes, a longer text being a chunk of its own. The id column is a long; repeated
    rows are repeated. The table takes four bytes a code point.
    """

    def work(batches):
        pairs = bpe.load(path)
        for batch in batches:
            names = batch.column(0)
            for first, texts in text_chunks(batch.column(1)):
                tiled = pairs.tiled(texts)
                counts = pairs.counts_of(tiled.words)
                last = np.array([int.from_bytes(c[-4:], "little") for c in counts], np.int64)
                columns = [
                    names.slice(first, len(texts)),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(tiled.sums(last)),
                ]
                if prefixes:
                    columns.append(_tables(tiled, counts, last, pairs))
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_tokens", "counts"][: len(columns)])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(work, "id long, n_bytes long, n_tokens long" + ", counts array<int>" * prefixes)


def _tables(tiled: Tiled, counts, last, pairs) -> pa.ListArray:
    """Per text: tokens before a word, plus those of the word's prefix, at the end of
    every code point."""
    index = tiled.index
    first = np.zeros(len(index) + 1, bool)
    first[tiled.offsets] = True
    ends = np.cumsum(last[index])  # tokens up to the end of each word, over all texts
    before = np.concatenate([[0], ends])
    of_text = np.repeat(before[tiled.offsets[:-1]], np.diff(tiled.offsets))
    table, at = gathered(counts, index, "<u4")
    table = table.astype(np.int32)
    table += np.repeat((before[:-1] - of_text).astype(np.int32), np.diff(at))
    # A cut after white space ends the text with it, so all of it is one word.
    heads = [_first_point(w) for w in tiled.words]
    blank_heads = {h for h in set(heads) if _blank(h)}
    begins = np.array([h in blank_heads for h in heads], bool)
    blank = np.array([h in blank_heads and _blank(w) for w, h in zip(tiled.words, heads)], bool)
    after = np.flatnonzero(blank[index[:-1]] & begins[index[1:]] & ~first[1 : len(index)]) + 1 if len(index) else []
    runs = [tiled.words[index[j - 1]] + heads[index[j]] for j in after]
    distinct = sorted(set(runs))
    of_run = dict(zip(distinct, [int.from_bytes(c[-4:], "little") for c in pairs.counts_of(distinct)]))
    for j, run in zip(after, runs):
        table[at[j] + len(heads[index[j]]) - 1] = before[j - 1] - of_text[j] + of_run[run]
    _cut_specials(table, at, tiled, first, before, of_text, pairs)
    inside = gathered(tiled.words, index, np.uint8)[0] & 0xC0 == 0x80
    whole = np.ones(len(inside), bool)
    whole[:-1] = ~inside[1:]
    points = np.concatenate([[0], np.cumsum(whole)])[at[tiled.offsets]]
    return pa.ListArray.from_arrays(pa.array(points.astype(np.int32)), pa.array(table[whole]))


def _cut_specials(table, at, tiled: Tiled, first, before, of_text, pairs) -> None:
    """A special string that is cut is plain text, and what stands before may run into it:
    its prefixes are encoded together with the word before, if the text has one."""
    whole = np.array([w in pairs.special for w in tiled.words], bool)
    known: dict[tuple[bytes, bytes], list[int]] = {}
    for j in np.flatnonzero(whole[tiled.index]).tolist():
        mark = tiled.words[tiled.index[j]]
        word, base = b"", before[j]
        if j and not first[j] and not whole[tiled.index[j - 1]]:
            word, base = tiled.words[tiled.index[j - 1]], before[j - 1]
        if (word, mark) not in known:
            cuts = [(word + mark[:k]).decode("utf-8", "ignore") for k in range(1, len(mark))]
            known[word, mark] = [len(pairs.library.encode(t, allowed_special="all")) for t in cuts]
        table[at[j] : at[j] + len(mark) - 1] = known[word, mark] + (base - of_text[j])


def _first_point(word: bytes) -> bytes:
    """The bytes of a word's first code point."""
    size = 1
    while word[size : size + 1] and word[size] & 0xC0 == 0x80:
        size += 1
    return word[:size]


def _blank(word: bytes) -> bool:
    return all(kinds()[ord(c)] == SPACE for c in word.decode("utf-8", "replace"))


def tokens_of_prefix(counts: Column, points: Column) -> Column:
    """Tokens of a text cut to its first `points` code points; 0 for an empty text."""
    last = F.least(points, F.size(counts)).cast("int") - 1
    return F.when(last < 0, F.lit(0)).otherwise(F.get(counts, last))


def longest_prefix(counts: Column, budget: Column) -> Column:
    """Code points of the longest prefix of at most `budget` tokens. Counts can fall as a
    word goes on, so it is the last place within the budget, not the first beyond."""
    last = F.array_position(F.reverse(F.transform(counts, lambda c: c <= budget)), F.lit(True))
    return F.when(last > 0, F.size(counts) - last + 1).otherwise(F.lit(0))
