"""The audit against SQL over all sources and terms, and its refinement against plain counts."""

import re
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest

from rollcall.llm import divergence, prepare, queries
from rollcall.operators.scratch import materialize
from tests.llm.data import documents, given, nothing, prose

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


@pytest.fixture(scope="module", autouse=True)
def _prepared(spark):
    prepare(spark)


def many(spark):
    rows = [(prose(k % 25, 30 + k % 40), ("aa", "bb", None)[k % 3], (f"s{k % 7}", None, "big")[k % 4 % 3]) for k in range(150)]
    rows += [("Straße STRASSE ÄÖ äö été-Été x1y2\0z _q_", "aa", "s1")] * 4 + [("é" * 3000 + " " + "long" * 500, "bb", "big")] * 3
    rows += [(None, "only", "one"), ("rare", "few", "p"), ("rare", "few", "q"), ("a b c", "few", ""), ("12 34", None, "s1")]
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string")


def test_query_like_sql(spark, tmp_path):
    folder = given(spark, tmp_path, documents(spark).unionByName(many(spark), allowMissingColumns=True))
    rows = queries.QUERIES["op13_source_divergence"](spark, folder).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    wanted = con.execute(queries.CHECKS["op13_source_divergence"])
    names = [d[0] for d in wanted.description]
    wanted = Counter(tuple(dict(zip(names, r))[c] for c in rows[0].__fields__) for r in wanted.fetchall())
    assert Counter(tuple(r) for r in rows) == wanted
    assert {r.value for r in rows if r.lang == "few"} == {0} and not [r for r in rows if r.lang == "only"]


@pytest.mark.parametrize("levels, most", [((1,), 1 << 15), ((1, 2, 3, 7), 1 << 27), ((), 1 << 27), ((5000,), 1 << 27)])
def test_kept_terms(spark, levels, most, monkeypatch):
    """Whatever the levels are and however full the filter is: terms in three documents."""
    monkeypatch.setattr(divergence, "MOST_BITS", most)
    monkeypatch.setattr(divergence, "CHUNK_TERMS", 200)
    monkeypatch.setattr(divergence, "MOST_HEADS", 50)
    docs = many(spark)
    wanted = defaultdict(set)
    for r in docs.collect():
        for term in TERM.findall(r.text or ""):
            wanted[r.lang or "", re.sub("[A-Z]", lambda m: m.group().lower(), term)].add(r.doc_id)
    wanted = {k for k, v in wanted.items() if len(v) >= 3}
    rows = docs.na.fill("").selectExpr("lang", "source", "cast(text AS binary) AS text")
    terms = materialize(
        rows.mapInArrow(divergence._write_terms(levels[0] if levels else None), divergence._TERMS), "t"
    )
    counts = divergence.term_counts(terms, 3, levels).collect()
    found = [(r.lang, r.part) for r in counts if r.first]
    assert len(found) == len(set(found)) and set(found) == {(r.lang, r.part) for r in counts} == wanted


def test_refinement_discards(spark):
    """Of longer terms, only those whose prefix has survived are counted at a level."""
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["l", "m"]), pa.array([b"ab\nabc\nabd\nac\nacd\n", b"abc\n"], pa.binary())], ["lang", "terms"]
    )
    alive = divergence.Filter(spark.createDataFrame([(b"0ab\nl",)], "key binary"), 1)
    rows = [r for b in divergence._counted(2, 3, alive)(iter([batch])) for r in b.to_pylist()]
    assert {r["key"]: r["docs"] for r in rows} == {b"1abc\nl": 1, b"1abd\nl": 1}
    found = divergence.document_terms([b"ab abc abd AC acd", b"abc", b"abc b"])
    assert divergence._heads(found, pa.array(["l", "m", "l"]), 1) == {b"0a\nl": 2, b"0a\nm": 1, b"1b\nl": 1}
    assert divergence._heads(found, pa.array(["l", "m", "l"]), 2) == {
        b"0ab\nl": 2, b"1ab\nl": 1, b"0ab\nm": 1, b"1ac\nl": 1, b"0ac\nl": 1, b"1b\nl": 1
    }


def test_filter_holds_all(spark):
    rows = [(b"1%d\nl%d" % (k, k % 3),) for k in range(5000)]
    alive = divergence.Filter(spark.createDataFrame(rows, "key binary"), len(rows))
    assert alive.may_hold([k for k, in rows]).all()
    others = alive.may_hold([b"1x%d\nl0" % k for k in range(5000)])
    assert others.mean() < 0.05 and alive.bits <= 2 * divergence.BITS_EACH * len(rows)


@pytest.mark.parametrize("pairs", [3, 1 << 20])
def test_pairs_by_blocks(pairs, monkeypatch):
    monkeypatch.setattr(divergence, "PAIRS", pairs)
    terms = [("l", [("a", 5, 1), ("b", 7, 2), ("c", 1, 1)]), ("m", [("a", 9, 3)]), ("l", [("c", 8, 1), ("a", 2, 1)])]
    kind = pa.list_(pa.struct([("source", pa.string()), ("p", pa.int64()), ("zero", pa.int64())]))
    here = [[dict(zip(("source", "p", "zero"), x)) for x in h] for _, h in terms]
    batch = pa.RecordBatch.from_arrays([pa.array([x for x, _ in terms]), pa.array(here, kind)], ["lang", "here"])
    wanted = Counter()
    f = lambda x, y: (x - y) ** 2 // y
    for lang, h in terms:
        for s, p, p0 in h:
            for i, q, q0 in h:
                if s != i:
                    wanted[lang, s, i] += f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)
    found = Counter()
    for b in divergence._both(iter([batch])):
        for r in b.to_pylist():
            found[r["lang"], r["source"], r["item"]] += r["value"]
    assert found == wanted


def test_shares_are_exact(spark):
    rows = [(0, 0, 1), (9_000_000_000_000, 9_000_000_000_000, 5), (3, 7, 2), (0, 0, 0), (10**15, 10**15 + 7, 11)]
    frame = spark.createDataFrame(rows, "n long, total long, v long")
    got = frame.select(divergence._share(frame.n, frame.total, frame.v).alias("p")).collect()
    assert [r.p for r in got] == [None if not v else 1 + 10**9 * (n + 1) // (t + v) for n, t, v in rows]


def test_nothing(spark):
    assert divergence.audit(nothing(spark)).collect() == []
