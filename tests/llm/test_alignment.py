"""Alignment of two vocabularies against their libraries over whole texts."""

import hashlib
import random
from collections import Counter, defaultdict
from functools import reduce

import pytest
import sentencepiece
from tokenizers import Tokenizer

from rollcall.llm import alignment, prepare, queries
from tests.llm.data import documents, given, nothing, prose, texts

A = queries.vocabulary("byte_bpe_50k.json")
B = queries.vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module", autouse=True)
def _prepared(spark):
    prepare(spark)


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def token_bytes(libraries):
    a, b = libraries
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    sign, more = {chr(x): x for x in plain}, 256
    for x in range(256):
        if x not in plain:
            sign[chr(more)] = x
            more += 1
    return (
        lambda k: bytes(sign[c] for c in a.id_to_token(k)),
        lambda k: bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode(),
    )


def plain_groups(libraries, text):
    """Groups of ids of a text by the libraries, or None."""
    if not text:
        return None
    a, b = libraries
    of_a, of_b = token_bytes(libraries)
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    whole = (" " + text).encode()
    if b"".join(map(of_a, ids_a)) != whole or b"".join(map(of_b, ids_b)) != whole:
        return None
    ends = []
    for ids, data in ((ids_a, of_a), (ids_b, of_b)):
        at, own = 0, []
        for k in ids:
            at += len(data(k))
            own.append(at)
        ends.append(own)
    cuts = sorted(set(ends[0]) & set(ends[1]))
    group = defaultdict(lambda: ([], []))
    for side, ids in ((0, ids_a), (1, ids_b)):
        for k, end in zip(ids, ends[side]):
            group[next(c for c in cuts if c >= end) if len(cuts) < 50 else cuts[_first(cuts, end)]][side].append(k)
    return [group[c] for c in cuts]


def _first(cuts, end):
    from bisect import bisect_left

    return bisect_left(cuts, end)


def plain(libraries, rows):
    """The contract's columns for (id, text) rows."""
    groups = [plain_groups(libraries, t) for _, t in rows]
    count = Counter((a[-1], b[-1]) for g in groups if g for a, b in g)
    highest = defaultdict(int)
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    out = Counter()
    for (name, _), g in zip(rows, groups):
        if not g:
            out[name, 0, 0, 0, 0, 0, 0, ""] += 1
            continue
        told = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        links = [(a[-1], b[-1]) for a, b in g]
        out[
            name, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
            sum(count[x] == highest[x[1]] for x in links), sum(count[x] for x in links),
            hashlib.sha256(told.encode()).hexdigest(),
        ] += 1
    return out


SHOWN = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def odd_texts():
    r = random.Random(5)
    parts = [" ", "  ", "\n", "\t", " ", "　", "it's", "x", "12", "日本", "é", "🎉", "<|endoftext|>", "</s>", "!!", "\x1c", "\x85"]
    made = [(100 + k, "".join(r.choice(parts) for _ in range(r.randint(1, 60)))) for k in range(150)]
    return [*made, (300, "a ▁b"), (301, "plain " * 3), (301, "plain " * 3), (302, " "), (303, "▁"), (304, "a\0b c")]


def test_query_like_the_libraries(spark, tmp_path, libraries):
    frame = documents(spark)
    more = spark.createDataFrame(odd_texts(), "doc_id long, text string")
    rows = [*texts(), *odd_texts()]
    folder = given(spark, tmp_path, frame.unionByName(more, allowMissingColumns=True))
    found = queries.QUERIES["op12_tokenizer_alignment"](spark, folder).collect()
    assert Counter(tuple(r[c] for c in SHOWN) for r in found) == plain(libraries, rows)
    by_id = {r.doc_id: r for r in found}
    assert by_id[300].n_a == by_id[303].n_links == 0  # a mark in the text does not come back
    assert by_id[12].n_a and by_id[11].n_groups > 20_000  # one very long word, one very long text


@pytest.mark.parametrize("size", [1, 2, 7, 40, 1000])
def test_ranges_of_any_size(spark, libraries, size):
    """Long texts by small ranges: many rounds, ranges without a border, seams at borders."""
    rows = [(k, t[:1500]) for k, t in odd_texts()[:40]] + [(7, prose(9, 60)), (8, "y" * 500), (9, "q ▁" + prose(1, 20)), (None, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = alignment.align(docs, A, B, range_bytes=size).collect()
    assert Counter(tuple(r[c] for c in ("id", *SHOWN[1:])) for r in found) == plain(libraries, rows)


def test_fragments_are_a_monoid():
    """Any way of putting neighbouring ranges together gives the same fragment."""
    r = random.Random(3)
    for _ in range(300):
        data = (" " + "".join(r.choice([" ", "ab", "é", "\n", "日", "c"]) for _ in range(r.randint(1, 40)))).encode()
        parts = [alignment.fragment(d, at) for at, d in alignment.ranges(data, r.randint(1, 9))]
        once = reduce(alignment.compose, parts)
        while len(parts) > 1:
            k = r.randrange(len(parts) - 1)
            parts[k : k + 2] = [alignment.compose(*parts[k : k + 2])]
        key = lambda f: (f.left, f.border, f.right, f.right_at, sorted(f.closed))
        units = alignment._cut(data)
        assert key(parts[0]) == key(once)
        assert b"".join([x for _, x in sorted(once.closed)]) == b"".join(units[:-1]) and once.right == units[-1]
        assert alignment._cut(b"".join(x for _, x in sorted(once.closed))) == units[:-1] or len(units) == 1


def test_pairs_are_bounded_by_the_vocabularies():
    aligner = alignment.load(A, B)
    entries = [*aligner.bytes_a.values(), *aligner.bytes_b.values()]
    assert len(aligner.pairs) <= 2 * sum(map(len, entries))


def test_nothing(spark):
    assert alignment.align(nothing(spark), A, B).collect() == []


def test_byte_pairs_with_any_white_space():
    """White space beyond ASCII next to line breaks, special strings and contractions."""
    import numpy as np

    from rollcall.llm import bpe

    pairs, library = bpe.load(A), Tokenizer.from_file(A)
    for _, text in odd_texts():
        tiled = pairs.tiled([text.encode()])
        ids = pairs.ids_of(tiled.words)
        got = [i for k in tiled.index for i in np.frombuffer(ids[k], "<u4").tolist()]
        assert got == library.encode(text, add_special_tokens=False).ids, repr(text)
