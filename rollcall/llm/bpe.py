"""Byte-level BPE by dynamic programming over prefixes.

The encoding of a prefix ends in exactly one token t, and what stands before t is the
encoding of the shorter prefix; a sequence of tokens is an encoding if and only if each
pair of neighbours is, taken alone. So the last token of every prefix follows from the
last tokens of shorter ones, and the token count of each prefix comes with it.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import tiktoken

from rollcall.llm.tiles import SPACE, Tiled, kinds

#: Distinct words whose ids a worker keeps at hand.
CACHE_WORDS = 300_000

#: The vocabulary's pattern of words (a fixed value); word_starts() is the same over arrays.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Letters that, after an apostrophe, end a word of their own (fixed by the vocabulary's pattern).
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")


def word_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where words begin: runs of letters, of digits or of other signs, with one space
    before them if there is one; of a run of white space all but the last character,
    unless the text ends with it; an apostrophe with a contraction's letters."""
    if not len(codes):
        return np.zeros(0, bool)
    kind = kinds()[codes]
    starts = np.ones(len(codes), bool)
    np.not_equal(kind[1:], kind[:-1], out=starts[1:])
    blank = np.flatnonzero(kind == SPACE)
    size = len(codes)
    # A run of white space is not cut inside, but before its last character if a text goes on.
    follows = np.minimum(blank + 1, size - 1)
    ends_run = (blank + 1 < size) & ~first[follows] & (kind[follows] != SPACE)
    starts[blank[ends_run]] = True
    starts[follows[ends_run & (codes[blank] == 0x20)]] = False
    starts |= first
    marks = np.flatnonzero((codes == 0x27) & starts)
    for letters in CONTRACTIONS:
        hit = marks[marks + len(letters) < size]
        for k, letter in enumerate(letters, 1):
            hit = hit[(codes[hit + k] == ord(letter)) & ~first[hit + k]]
        starts[hit + 1] = False
        end = hit + 1 + len(letters)
        end = end[end < size]
        # What follows a contraction begins a word, unless white space has decided that already.
        starts[end[kind[end] != SPACE]] = True
    return starts


class BytePairs:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in plain]
        sign = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
        added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        vocab = {bytes(sign[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        self.ids = vocab
        self.special = {k.encode(): v for k, v in added.items()}
        self.token = {i: t for t, i in vocab.items()}
        self.pairs = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            a, b = (bytes(sign[c] for c in x) for x in (a, b))
            self.pairs[vocab[a], vocab[b]] = (rank, vocab[a + b])
        tails: dict[bytes, set[int]] = {}
        for t in vocab:
            if len(t) > 1:
                tails.setdefault(t[-2:], set()).add(len(t))
        self.tails = {k: (*sorted(v, reverse=True), 1) for k, v in tails.items()}
        self.library = tiktoken.Encoding(
            "byte_bpe", pat_str=PATTERN, mergeable_ranks=vocab,
            special_tokens={x["content"]: x["id"] for x in spec["added_tokens"]},
        )
        self._known: dict[bytes, bytes] = {}
        self._counted: dict[bytes, bytes] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        self._guesses: dict[tuple[int, int], tuple[int, int]] = {}

    def merged(self, data: bytes) -> list[int]:
        """The encoding by its definition: merge the pair of lowest rank until none is left."""
        ids = [self.ids[data[k : k + 1]] for k in range(len(data))]
        while len(ids) > 1:
            found = [(self.pairs[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.pairs]
            if not found:
                break
            _, k = min(found)
            ids[k : k + 2] = [self.pairs[ids[k], ids[k + 1]][1]]
        return ids

    def _follows(self, a: int, t: int) -> bool:
        """Whether token t may follow token a, or begin a word (a = -1)."""
        if len(self._fits) > 2_000_000:
            self._fits.clear()
        if a < 0:
            good = self.merged(self.token[t]) == [t]
        else:
            good = self.merged(self.token[a] + self.token[t]) == [a, t]
        self._fits[a, t] = good
        return good

    def prefixes(self, words: list[bytes]):
        """For sorted words: per word the last token of every prefix's encoding, and how
        many tokens it has. What a word shares with the one before it is not done again.
        The lists are reused: take from them before asking for the next word."""
        ids, tails, fits, guesses = self.ids, self.tails, self._fits, self._guesses
        last, count, before = [-1], [0], b""
        for word in words:
            same = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                same += 1
            del last[same + 1 :], count[same + 1 :]
            before = word
            for end in range(same + 1, len(word) + 1):
                # Any token that ends the prefix and fits is the one; that which came
                # last after the same token and byte is tried first.
                key = (last[-1], word[end - 1])
                guess = guesses.get(key)
                if guess is not None:
                    start = end - guess[1]
                    if start >= 0 and ids.get(word[start:end]) == guess[0] and fits.get((last[start], guess[0])):
                        last.append(guess[0])
                        count.append(count[start] + 1)
                        continue
                for size in tails.get(word[end - 2 : end], (1,)) if end > 1 else (1,):
                    start = end - size
                    t = ids.get(word[start:end]) if start >= 0 else None
                    if t is None:
                        continue
                    good = fits.get((last[start], t))
                    if good is None:
                        good = self._follows(last[start], t)
                    if good:
                        guesses[key] = (t, size)
                        last.append(t)
                        count.append(count[start] + 1)
                        break
            yield last, count

    def ids_of(self, words: list[bytes]) -> list[bytes]:
        """Ids of each distinct word as little-endian unsigned 32-bit integers, by the
        library; a worker keeps those of CACHE_WORDS words."""
        known = self._known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = words
        known.update(zip(new, self._encoded(new)))
        return [known[w] for w in words]

    def counts_of(self, words: list[bytes]) -> list[bytes]:
        """Token counts of every prefix of each distinct word, byte by byte, as
        little-endian unsigned 32-bit integers. A special string counts one wherever it
        is cut, as a word does not know what stands before it (tokencounts sees to that);
        a cut contraction is an apostrophe and a letter."""
        known = self._counted
        new = [w for w in words if w not in known]
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = words
        plain = sorted(w for w in new if w not in self.special)
        for word, (_, count) in zip(plain, self.prefixes(plain)):
            known[word] = np.array(count[1:], "<u4").tobytes()
        for word in set(new).difference(plain):
            known[word] = np.ones(len(word), "<u4").tobytes()
        for letters in CONTRACTIONS:
            word = b"'" + letters.encode()
            if len(letters) == 2 and word in known:
                known[word] = np.array([1, 2, len(self.merged(word))], "<u4").tobytes()
        return [known[w] for w in words]

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        """Words without line breaks go as lines of one text: a line break between two
        of them is a word and a token of its own, where the ids are cut again."""
        lines = [k for k, w in enumerate(words) if w not in self.special and not _ends_blank(w) and b"\n" not in w]
        text = b"\n".join([words[k] for k in lines]).decode("utf-8", "replace")
        out: list[bytes] = [b""] * len(words)
        joined = np.array(self.library.encode_ordinary(text), "<u4")
        cuts = np.flatnonzero(joined == self.ids[b"\n"])
        if len(cuts) + 1 != max(1, len(lines)):
            raise ValueError("a word holds the token of a line break")
        data = joined.tobytes()
        for k, start, end in zip(lines, [0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), len(data)]):
            out[k] = data[start:end]
        for k in set(range(len(words))).difference(lines):
            one = self.library.encode(words[k].decode("utf-8", "replace"), allowed_special="all")
            out[k] = np.array(one, "<u4").tobytes()
        return out

    def split_special(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """Texts cut around special strings, and how many parts each text has."""
        marks = list(self.special)
        parts, sizes = [], []
        for text in texts:
            own = [text]
            for mark in marks:
                if mark in text:
                    own = [y for x in own for y in _around(x, mark, marks)]
            parts += own
            sizes.append(len(own))
        return parts, np.array(sizes, np.int64)

    def tiled(self, texts: list[bytes]) -> Tiled:
        """The words of each text; a special string is one word."""
        if not any(mark in text for mark in self.special for text in texts):
            return Tiled(texts, word_starts)
        parts, sizes = self.split_special(texts)
        whole = np.array([p in self.special for p in parts])
        begins = np.concatenate([[0], np.cumsum([len(p.decode("utf-8", "replace")) for p in parts])])

        def starts(codes, first):
            flags = word_starts(codes, first)
            for k in np.flatnonzero(whole):
                flags[begins[k] + 1 : begins[k + 1]] = False
            return flags

        tiled = Tiled(parts, starts)
        tiled.offsets = tiled.offsets[np.concatenate([[0], np.cumsum(sizes)])]
        return tiled


def _ends_blank(word: bytes) -> bool:
    """Whether a word's last character is white space, of any script."""
    last = word[-1:]
    return last.isspace() if last < b"\x80" else word.decode("utf-8", "replace")[-1:].isspace()


def _around(text: bytes, mark: bytes, marks: list[bytes]) -> list[bytes]:
    if text in marks:
        return [text]
    out = []
    for k, part in enumerate(text.split(mark)):
        out += [mark] * (k > 0) + [part] * bool(part)
    return out


@lru_cache(maxsize=4)
def load(path: str) -> BytePairs:
    """One per worker process and vocabulary."""
    return BytePairs(path)


