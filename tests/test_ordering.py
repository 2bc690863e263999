"""Numbering, first rows per key, latest rows."""

import random

import pytest
from pyspark.sql import functions as F

from rollcall.operators.latest import first_n_per_key, latest_per_key
from rollcall.operators.ordering import dense_index, dense_index_by_ordinal


def test_dense_index_over_skewed_text(spark):
    rng = random.Random(1)
    keys = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(50)}", i) for i in range(3000)]
    rng.shuffle(keys)
    df = spark.createDataFrame(keys, "k string, i int").repartition(5)
    found = {(r["k"], r["i"]): r["n"] for r in dense_index(df, ["k", "i"], "n", partitions=7).collect()}
    assert found == {key: n for n, key in enumerate(sorted(keys), 1)}


def test_dense_index_of_nothing(spark):
    df = spark.createDataFrame([], "k string, i int")
    assert dense_index(df, ["k", "i"], "n").count() == 0


def test_ordinal_index(spark):
    rng = random.Random(2)
    ordinals = sorted(rng.sample(range(-500, 100_000), 4000)) + [10**12, 10**12 + 5]
    df = spark.createDataFrame([(o,) for o in ordinals], "o long").repartition(6)
    found = dense_index_by_ordinal(df, "o", "n", partitions=7)
    assert {r["o"]: r["n"] for r in found.collect()} == {o: n for n, o in enumerate(ordinals, 1)}


def test_ordinal_index_never_gathers_rows(spark):
    df = spark.range(10_000).withColumnRenamed("id", "o")
    plan = dense_index_by_ordinal(df, "o", "n")._jdf.queryExecution().executedPlan().toString()
    # The only single-partition step is the running total over counts of ranges.
    single = [i for i, line in enumerate(plan.splitlines()) if "SinglePartition" in line]
    assert len(single) == 1
    below = plan.splitlines()[single[0] + 1]
    assert "HashAggregate" in below


@pytest.mark.parametrize("ordinals, said", [([1, None, 3], "null"), ([1, 2, 2, 3], "not: 2")])
def test_ordinals_that_give_no_position_are_refused(spark, ordinals, said):
    df = spark.createDataFrame([(o,) for o in ordinals], "o long")
    with pytest.raises(Exception, match=said):
        dense_index_by_ordinal(df, "o", "n").collect()


def test_first_n_per_key(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.7 else rng.choice("abc"), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, i int").repartition(4)
    found = first_n_per_key(df, ["k"], [F.col("i")], 5).collect()
    wanted = {(k, i) for key in {k for k, _ in rows} for k, i in sorted(r for r in rows if r[0] == key)[:5]}
    assert {(r["k"], r["i"]) for r in found} == wanted


def test_latest_per_key(spark):
    rows = [("a", 1, 5, "x"), ("a", 2, 1, "y"), ("a", 2, 0, "z"), ("b", 0, 0, None)]
    df = spark.createDataFrame(rows, "k string, ts int, seq int, v string")
    found = latest_per_key(df, "k", ["ts", "seq"])
    assert found.columns == df.columns
    assert sorted(map(tuple, found.collect())) == [("a", 2, 1, "y"), ("b", 0, 0, None)]
