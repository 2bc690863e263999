"""What grows with the input is moved and written once, by all tasks."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.operators.scratch import shuffle_partitions
from rollcall.plans import submit
from workload import classification, streams
from workload.registry import Tables

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def tables(spark, folder):
    """A few orders with their customers, lines, documents and events."""
    n = F.col("id")
    made = {
        "region": spark.range(1).select(n.alias("r_regionkey"), F.lit("R").alias("r_name")),
        "nation": spark.range(1).select(n.alias("n_nationkey"), F.lit("N").alias("n_name"), F.lit(0).alias("n_regionkey")),
        "customer": spark.range(5).select(
            n.alias("c_custkey"), F.lit("c").alias("c_name"), F.lit(0).alias("c_nationkey"), F.lit("m").alias("c_mktsegment")
        ),
        "orders": spark.range(990, 1010).select(
            n.alias("o_orderkey"), (n % 5).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
            F.lit(5e4).alias("o_totalprice"), F.lit("1-URGENT").alias("o_orderpriority"),
        ),
        "lineitem": spark.range(990, 1010).select(
            n.alias("l_orderkey"), F.lit(1).alias("l_linenumber"), n.alias("l_partkey"), n.alias("l_suppkey"),
            F.lit("N").alias("l_returnflag"),
        ),
        "events": spark.range(60).select(
            n.alias("event_id"), F.lit(T0).cast("timestamp_ntz").alias("ts"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value")
        ),
    }
    for name, rows in made.items():
        rows.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return Tables(spark, folder)


def test_a_publication_holds_each_text_once(spark, folder):
    rows = spark.range(50).select(
        F.concat(F.lit("e"), "id").alias("event_id"), F.lit(submit.ELIGIBLE).alias("outcome"),
        F.lit(S.PLAIN_TEXT).alias("asset_mime"), F.when(F.col("id") < 40, 1).when(F.col("id") < 49, 2).alias("content_id"),
    )
    texts = spark.createDataFrame([(1, "one"), (1, "other"), (2, None), (3, "not asked for")], "content_id int, content string")
    submit.write_transcripts(rows, texts, f"{folder}/blobs", "p", "run", T0)
    stored = spark.read.parquet(f"{folder}/blobs/texts").collect()
    assert sorted((r.text_key, r.content) for r in stored) == [("1", "one"), ("2", None)]
    got = {r.event_id: r.content for r in submit.published_transcripts(spark, f"{folder}/blobs").collect()}
    assert got == {f"e{k}": "one" if k < 40 else None for k in range(49)}
    sizes = submit.published_transcripts(spark, f"{folder}/blobs", size=F.length("content"))
    assert sizes.columns == ["event_id", "blob_path", "extension", "size", "run"]
    assert sizes.where("size = 3").count() == 40


def test_views_by_row_are_read_in_place(tables):
    def read(name):
        return {os.path.basename(os.path.dirname(f)) for f in tables(name).inputFiles()}

    assert read("asset_catalog") == {"orders.parquet", "lineitem.parquet"}
    assert not read("roster") & {"orders.parquet", "customer.parquet"}


def test_only_folder_links_are_joined(tables):
    found = classification.link_diagnostics(tables)
    assert found.count() == 20
    assert "Union" in found._jdf.queryExecution().optimizedPlan().toString()


def test_parts_of_the_response_log_are_many_files(spark, tables):
    path, files = streams.response_files(tables, 2)
    assert files == shuffle_partitions(spark)
    assert len(spark.read.parquet(path).inputFiles()) > 2
    assert spark.read.parquet(path).select("seq").distinct().count() == 60
