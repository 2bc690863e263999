"""The functions for users of SQL against the column functions, on odd inputs."""

from pyspark.sql import functions as F

from rollcall import sql
from rollcall.functions import links, responses
from tests.test_reconcile import BODIES

LINKS = [
    None, "", "  ", "Sin Dato", " sin dato ", "https://docs.google.com/document/d/a_B-1/edit", "http://drive.google.com/file/u/3/d/X/view",
    "https://drive.google.com/drive/folders/F", " https://drive.google.com/file/d/X ", "https://docs.google.com/spreadsheets/d/1",
    "https://www.google.com/url?q=1", "ftp://x", "it's 'quoted' \\  ",
]


def test_links(spark):
    sql.register(spark)
    rows = spark.createDataFrame([(a, b) for a in LINKS for b in LINKS], "t string, v string")
    wanted = links.with_link(rows, "t", "v").select("t", "v", "link.case")
    found = rows.selectExpr("t", "v", "rollcall_link_case(t, v) AS case")
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    kinds = rows.selectExpr("rollcall_display(t) AS u").selectExpr("u", "rollcall_link_kind(u) AS kind", "rollcall_link_id(u) AS id").distinct()
    plain = rows.selectExpr("rollcall_display(t) AS u").distinct().withColumn("k", links.url_kind(F.col("u"))).select("u", "k.kind", "k.id")
    assert sorted(map(str, kinds.collect())) == sorted(map(str, plain.collect()))


def test_responses(spark):
    sql.register(spark)
    bodies = {b for own in BODIES.values() for b in own} | {'{"url": 5}', '"text"', "7", "null", '{"detail": null}', '{"url":"a","x":', ""}
    rows = spark.createDataFrame(
        [(s, b, d) for s in [*BODIES, 201] for b in bodies for d in (True, False, None)], "status int, body string, delivery_failed boolean"
    )
    wanted = rows.withColumn("o", responses.response_outcome(F.col("status"), F.col("body"), F.col("delivery_failed")))
    found = rows.selectExpr("*", "rollcall_response(status, body, delivery_failed) AS o")
    assert sorted(map(str, found.select("*", "o.*").drop("o").collect())) == sorted(map(str, wanted.select("*", "o.*").drop("o").collect()))


def test_a_body_is_parsed_once(spark):
    from rollcall.sources.responses import RESPONSE_SCHEMA, with_outcome

    rows = spark.createDataFrame([], RESPONSE_SCHEMA).union(spark.createDataFrame([(1, None, "e", 200, "{}", False)], RESPONSE_SCHEMA))
    plan = with_outcome(rows.repartition(2))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and "get_json_object" not in plan
