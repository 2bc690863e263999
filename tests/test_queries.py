"""Every registered query against its check SQL, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as entry
import workload
from workload import check

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")

REGISTERED = workload.load()
STREAMS = {name for name in REGISTERED.QUERIES if name.startswith("stream_")}
PLAIN = sorted(set(REGISTERED.QUERIES) - STREAMS)


@pytest.fixture(scope="module")
def duck():
    return check.duck(FOLDER)


def test_every_query_has_a_check():
    assert set(REGISTERED.QUERIES) == set(REGISTERED.CHECKS)
    assert set(REGISTERED.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", PLAIN)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert not any(node in line for line in lines), node
    # One task sees only what an aggregation has left, never rows.
    for line, below in zip(lines, lines[1:]):
        if "SinglePartition" in line:
            assert "Aggregate" in below, below
    good, text = check.compare(spark, duck, FOLDER, name, df)
    assert good, text


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["drive_case", "n"]
    assert {r["drive_case"] for r in df.collect()} == {"A", "B", "C", "D1", "D2", "D3", "E", "F"}
