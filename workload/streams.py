"""Streaming jobs run to the end over the whole response log or roster."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.operators.scratch import new_path, shuffle_partitions
from rollcall.plans import submit
from rollcall.plans.transitions import collect_pool
from rollcall.sources import responses as R
from rollcall.sources import roster, statelog
from rollcall.streaming import collect, ingest
from workload import sqltext as Q
from workload.fixtures import AS_OF
from workload.ingestion import prepared
from workload.registry import query

AT = dt.datetime.fromisoformat(AS_OF)
BEGIN = dt.datetime(2023, 12, 1)


def seeded_log(t) -> statelog.StateLog:
    """A state log that holds the polled events as they were submitted."""
    log = statelog.StateLog(t.spark, new_path(t.spark, "state"))
    polled = t("poll_state")
    blank = submit.pending_images(
        polled.select(S.POSITION, "event_id"), [], BEGIN
    ).drop("state", "last_error", "attempts", "webhook_submitted_at")
    start = polled.select("event_id", "state", "last_error", "attempts", "webhook_submitted_at")
    log.append(blank.join(start, "event_id"), "submit", 1)
    return log


def response_files(t, parts: int) -> tuple[str, int]:
    """The response log in parts of consecutive responses, written one after the other;
    and how many files a part has, at most."""
    path, files = new_path(t.spark, "response-files"), shuffle_partitions(t.spark)
    log = t("response_log")
    shares = [k / parts for k in range(1, parts)]
    bounds = log.agg(F.percentile_approx("seq", shares, F.lit(10_000)).alias("b")).first()["b"] or []
    part = sum((F.coalesce(F.col("seq") > b, F.lit(False)).cast("int") for b in bounds), F.lit(0))
    for k in range(parts):
        log.where(part == k).repartition(files).write.mode("append").parquet(path)
    return path, files


def collected(t, parts: int, drain: bool = False) -> statelog.StateLog:
    """The state log after all responses, in about as many micro-batches as parts."""
    log = seeded_log(t)
    work = new_path(t.spark, "collect")
    collector = collect.Collector(log, f"{work}/history")
    path, files = response_files(t, parts)
    stream = R.stream_responses(t.spark, path, files_per_batch=files)
    query_ = collector.start(stream, f"{work}/checkpoint", once=True)
    if drain:
        collector.run_until_drained(query_)
    else:
        query_.awaitTermination()
    return log


_CLOSED = f"""{Q.FOLD},
clock AS (SELECT max(ts) AS now FROM response_log),
ended AS (
  SELECT p.event_id, coalesce(f.state, p.state) AS state, coalesce(f.attempts, p.attempts) AS attempts,
    CASE WHEN f.event_id IS NULL THEN p.last_error ELSE f.last_error END AS last_error,
    p.webhook_submitted_at
  FROM poll_state p LEFT JOIN folded f ON f.event_id = p.event_id),
closed AS (
  SELECT event_id, attempts,
    CASE WHEN late THEN 'failed_timeout_pending_analysis' ELSE state END AS state,
    CASE WHEN late THEN 'timeout after 48h in submitted' ELSE last_error END AS last_error
  FROM (SELECT *, state = 'submitted' AND webhook_submitted_at < (SELECT now FROM clock) - INTERVAL 48 HOURS AS late
    FROM ended) x)"""


@query("stream_collect", f"WITH {_CLOSED} SELECT event_id, state, attempts, last_error FROM closed")
def stream_collect(t):
    return collected(t, 3).current(["event_id", "state", "attempts", "last_error"])


@query(
    "stream_timeout",
    f"""WITH {_CLOSED} SELECT event_id, last_error FROM closed
    WHERE state = 'failed_timeout_pending_analysis'""",
)
def stream_timeout(t):
    state = collected(t, 2).current(["event_id", "state", "last_error"])
    return state.where(F.col("state") == S.FAILED_TIMEOUT).drop("state")


@query(
    "stream_drain",
    f"""WITH {_CLOSED} SELECT event_id, state, attempts FROM closed
    WHERE state IN ('submitted', 'failed_pdf_404') OR (state = 'failed_pdf_fetch' AND attempts < 5)""",
)
def stream_drain(t):
    """Collects until nothing is polled or nothing more comes; what is still polled."""
    log = collected(t, 2, drain=True)
    return collect_pool(log.current(["event_id", "state", "attempts"]))


@query(
    "stream_ingest",
    f"""SELECT row_position, 'studio-row-' || CAST(row_position AS STRING) AS event_id,
    'pending' AS state, {Q.denumbered('infrastructureCode')} AS infrastructureCode,
    {Q.denumbered('grade')} AS grade, {Q.CELLS} FROM roster""",
)
def stream_ingest(t):
    """The roster arrives twice, and once with another grade in the same files; every
    event is registered once, as its first row has it (grades come first in the order)."""
    path = new_path(t.spark, "roster-files")
    rows = prepared(t).select(*roster.roster_schema().names)
    other = rows.withColumn("transcriptLink", F.lit("~ later"))
    parts = max(3, shuffle_partitions(t.spark))
    both = rows.unionByName(other).repartition(parts, S.POSITION)
    both.write.parquet(f"{path}/first")
    both.write.parquet(f"{path}/second")
    log = statelog.StateLog(t.spark, new_path(t.spark, "state"))
    stream = t.spark.readStream.schema(roster.roster_schema()).option("maxFilesPerTrigger", parts + 1).parquet(f"{path}/*")
    ingest.Ingestor(log, AT).start(stream, f"{path}-checkpoint").awaitTermination()
    cells = [F.get_json_object("excel_row_json", f"$.{c}").alias(c) for c in S.ROSTER_COLUMNS]
    return log.log().select(S.POSITION, "event_id", "state", *cells)


@query("stream_dedup", "SELECT seq, event_id, status FROM response_log")
def stream_dedup(t):
    """Every response is delivered three times: twice in one file, and once more after all
    others have come; one of each is kept."""
    path = new_path(t.spark, "repeated")
    rows = t("response_log").withColumn("turn", F.explode(F.array(F.lit(0), F.lit(0), F.lit(1))))
    rows.repartitionByRange(4, "turn", "seq").drop("turn").write.parquet(f"{path}/in")
    once = collect.Deduplicator(t.spark, path)
    once.start(R.stream_responses(t.spark, f"{path}/in", files_per_batch=1), f"{path}/checkpoint").awaitTermination()
    return once.responses().select("seq", "event_id", "status")
