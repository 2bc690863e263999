"""The mix of sources against SQL that sorts whole sources, and what a mix promises."""

from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from rollcall.llm import mixing, mixsql, numbering, prepare, queries
from tests.llm.data import documents, given, nothing, prose

SHOWN = ("doc_id", "size", "source_size", "target", "taken", "copies")


@pytest.fixture(scope="module", autouse=True)
def _prepared(spark):
    prepare(spark)


def by_sql(folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    rows = con.execute(queries.CHECKS["op11_pareto_mix"])
    names = [d[0] for d in rows.description]
    return Counter(tuple(round(dict(zip(names, r))[c], 6) if c == "target" else dict(zip(names, r))[c] for c in SHOWN) for r in rows.fetchall())


def found(rows):
    return Counter(tuple(round(r[c], 6) if c == "target" else r[c] for c in SHOWN) for r in rows)


def many(spark):
    """Sources of any size, one with most words, a null one, an empty one, copies."""
    rows = [(k, prose(k, 1 + k * 7 % 90), "big" if k % 3 else f"s{k % 8}") for k in range(240)]
    rows += [(500 + k, None, "nothing") for k in range(3)] + [(600, "", None), (601, prose(3, 50), None), (602, "one", None)]
    rows += [(700, "again and again", "copies")] * 40 + [(None, "no id", "copies")] * 9 + [(None, "other text", "big")]
    rows += [(800, prose(8, 20_000), "long"), (801, "a b c d e", "long"), (802, prose(9, 300), "long")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_query_like_sql(spark, tmp_path):
    frame = documents(spark).unionByName(many(spark), allowMissingColumns=True)
    folder = given(spark, tmp_path, frame)
    rows = queries.QUERIES["op11_pareto_mix"](spark, folder).collect()
    assert found(rows) == by_sql(folder)


def test_same_whatever_the_partitions(spark):
    first = mixing.mix(many(spark)).drop("source").withColumnRenamed("id", "doc_id").collect()
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        again = mixing.mix(many(spark).repartition(5)).drop("source").withColumnRenamed("id", "doc_id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found(first) == found(again)


def test_words_come_near_their_targets(spark):
    rows = mixing.mix(many(spark)).collect()
    of_source = defaultdict(list)
    for r in rows:
        of_source[r.source].append(r)
        assert r.taken == r.copies * r.size <= 3 * r.size
    total = sum(r.size for r in rows)
    assert sum(x[0].target for x in of_source.values()) == pytest.approx(total)
    for source, own in of_source.items():
        assert sum(r.size for r in own) == own[0].source_size
        assert own[0].target <= 3 * own[0].source_size + 1e-6
        taken, smallest = sum(r.taken for r in own), min(r.size for r in own)
        if source != "long":  # its one long document is more than it may give
            assert abs(taken - own[0].target) <= max(0.02 * own[0].target, smallest)
    assert len({len({r.target for r in own}) for own in of_source.values()}) == 1


def test_targets(spark):
    rows = [("a", 100), ("b", 10), ("c", 1000), (None, 5), ("d", 0)]
    frame = spark.createDataFrame(rows, "source string, source_size long")
    got = {r.source: (r.weight, r.target) for r in mixing.targets(frame, (5, 2, 1), 1.0, 3.0).collect()}
    # 1115 words; b stops at 30, null at 15, d at 0, a at 300; c takes the rest.
    assert got == {"a": (5.0, 300.0), "b": (2.0, 30.0), "c": (1.0, 770.0), "d": (5.0, 0.0), None: (2.0, 15.0)}
    none = mixing.targets(frame.where("source = 'd'"), (1,), 1.0, 3.0).collect()
    assert [r.target for r in none] == [0.0]


def test_odds_and_inclusion(spark):
    """Over many seeds a document is taken as often as its rate says, one with greater
    odds more often."""
    rows = [(k, " ".join(["w"] * (5 + k % 3)), "a" if k < 60 else "b", 4.0 if k % 2 else None) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, odds double").coalesce(1).cache()
    taken, favoured = Counter(), Counter()
    for seed in range(3):
        for r in mixing.mix(docs, weights=(1, 3), share=0.6, seed=str(seed)).collect():
            taken[r.source, r.id % 2] += r.copies
        for r in mixing.mix(docs, weights=(1, 3), share=0.6, seed=str(seed), odds_col="odds").collect():
            favoured[r.source, r.id % 2] += r.copies
    # Rates are 0.3 and 0.9; 30 documents of each kind, three seeds.
    for parity in (0, 1):
        assert taken["a", parity] == pytest.approx(0.3 * 90, abs=12) and taken["b", parity] == pytest.approx(0.9 * 90, abs=12)
    assert favoured["a", 1] > 1.5 * favoured["a", 0]


def test_nothing(spark):
    assert mixing.mix(nothing(spark)).collect() == []


def test_places_of_rows_alike(spark):
    """Rows alike in every column are spread over the lots, and numbered without gaps."""
    rows = spark.range(4000).select(F.lit(1).alias("g"), F.lit(None).cast("string").alias("k"))
    placed = numbering.place_in_group(rows, ["g"], ["k"], "place")
    assert sorted(r.place for r in placed.collect()) == list(range(4000))
    nulls = numbering.place_in_group(rows.withColumn("g", F.lit(None).cast("int")), ["g"], ["k"], "place")
    assert sorted(r.place for r in nulls.collect()) == list(range(4000))
