"""Streaming jobs: any cut of the responses into batches gives the batch result."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.plans import submit, transitions
from rollcall.plans.reconcile import reconcile
from rollcall.sources import responses as R
from rollcall.sources import roster, statelog
from rollcall.streaming import collect, ingest
from tests.model import fold
from tests.test_reconcile import T0, scenario

LONG_AGO = T0 - dt.timedelta(days=30)


def seeded(spark, folder, states):
    log = statelog.StateLog(spark, f"{folder}/state")
    rows = [(int(e.rsplit("-", 1)[1]), e, s, a, err, at) for e, (s, a, err, at) in states.items()]
    start = spark.createDataFrame(
        rows, "row_position long, event_id string, state string, attempts int, last_error string, webhook_submitted_at timestamp_ntz"
    )
    blank = submit.pending_images(start, [], LONG_AGO).drop("state", "attempts", "last_error", "webhook_submitted_at")
    log.append(blank.join(start.drop("row_position"), "event_id"), "submit", 1)
    return log


def expected(states, rows, hours=48):
    """The batch result with a closing sweep at the newest response."""
    now = max(r[1] for r in rows)
    done = {e: (s, a, err) for e, (s, a, err, _) in states.items()} | {
        e: r[:3] for e, r in fold(states, rows).items()
    }
    for event, (state, attempts, _) in done.items():
        submitted = states[event][3]
        if state == "submitted" and submitted and submitted < now - dt.timedelta(hours=hours):
            done[event] = ("failed_timeout_pending_analysis", attempts, f"timeout after {hours}h in submitted")
    return done


def found(log):
    return {r["event_id"]: (r["state"], r["attempts"], r["last_error"]) for r in log.current().collect()}


def batches(spark, rows, cut):
    return [spark.createDataFrame(part, R.RESPONSE_SCHEMA) for part in cut(rows)]


def in_order(rows):
    rows = sorted(rows, key=lambda r: (r[1], r[0]))
    return [rows[i::1][:len(rows) // 3 + 1] for i in range(0, len(rows), len(rows) // 3 + 1)]


def shuffled(rows):
    rows = random.Random(4).sample(rows, len(rows))
    return [rows[i:i + len(rows) // 3 + 1] for i in range(0, len(rows), len(rows) // 3 + 1)]


def backwards(rows):
    return list(reversed(in_order(rows)))


@pytest.mark.parametrize("cut", [in_order, shuffled, backwards])
def test_any_cut_gives_the_batch_result(spark, folder, cut):
    states, rows = scenario(21, events=50)
    log = seeded(spark, folder, states)
    collector = collect.Collector(log, f"{folder}/history", compact_every=2 if cut is shuffled else None)
    for number, part in enumerate(batches(spark, rows, cut)):
        collector.apply(part, number)
    assert found(log) == expected(states, rows)


def test_repeated_batch_changes_nothing(spark, folder):
    states, rows = scenario(22, events=30)
    log = seeded(spark, folder, states)
    collector = collect.Collector(log, f"{folder}/history")
    parts = batches(spark, rows, shuffled)
    for number in (0, 1, 1, 2, 2):  # as after a crash between two batches
        collector.apply(parts[number], number)
    assert found(log) == expected(states, rows)
    assert log.log().groupBy("event_id", "writer", "batch").count().where("count > 1").count() == 0


@pytest.mark.parametrize("empty", [0, 1, 3])
def test_empty_batches(spark, folder, empty):
    states, rows = scenario(26, events=20)
    log = seeded(spark, folder, states)
    collector = collect.Collector(log, f"{folder}/history")
    parts = batches(spark, rows, in_order)
    parts.insert(empty, spark.createDataFrame([], R.RESPONSE_SCHEMA))
    for number, part in enumerate(parts):
        collector.apply(part, number)
    assert found(log) == expected(states, rows)


def test_late_and_repeated_responses_are_kept_once(spark, folder):
    """Nothing is too late, weeks after the first delivery, and the stream keeps no keys."""
    days = [40, 0, 39, 1, 40, 0, None, None]
    for i, day in enumerate(days):
        event = None if day is None else "studio-row-1"
        row = (day, T0 + dt.timedelta(days=day or 0), event, 404 + i, None, False)
        spark.createDataFrame([row, row], R.RESPONSE_SCHEMA).coalesce(1).write.parquet(f"{folder}/in/{i}")
    once = collect.Deduplicator(spark, f"{folder}/out")
    stream = R.stream_responses(spark, f"{folder}/in/*", files_per_batch=1)
    query = once.start(stream, f"{folder}/check")
    query.awaitTermination()
    rows = once.responses().collect()
    assert sorted((r["seq"] is None, r["seq"], r["status"]) for r in rows if r["seq"] is not None) == [
        (False, 0, 405), (False, 1, 407), (False, 39, 406), (False, 40, 404)
    ]
    assert all(not p["stateOperators"] for p in query.recentProgress)
    again = spark.createDataFrame([(39, T0, "studio-row-1", 1, None, False), (41, T0, "studio-row-1", 2, None, False)], R.RESPONSE_SCHEMA)
    assert [once.apply(again, 50), once.apply(again, 50), once.apply(again.limit(0), 51)] == [1, 1, 0]
    assert once.responses().where("seq IN (39, 41)").count() == 2


def test_the_watermark_forgets(spark, folder):
    """With a lateness the state is bounded by it, and what is later still is dropped."""
    for i, day in enumerate([0, 0, 40, 80, 1]):
        row = (day, T0 + dt.timedelta(days=day), "studio-row-1", 404, None, False)
        spark.createDataFrame([row], R.RESPONSE_SCHEMA).coalesce(1).write.parquet(f"{folder}/in/{i}")
    once = collect.deduplicated(R.stream_responses(spark, f"{folder}/in/*", files_per_batch=1), "1 day")
    sink = once.writeStream.format("parquet").option("checkpointLocation", f"{folder}/check")
    sink.trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    assert sorted(r["seq"] for r in spark.read.parquet(f"{folder}/out").collect()) == [0, 40, 80]


def test_deliveries_that_differ(spark, folder):
    """The first delivery counts, whichever way the batches are cut."""
    states = {"studio-row-1": ("submitted", 0, None, T0)}
    first = (1, T0, "studio-row-1", 404, None, False)
    other = (1, T0, "studio-row-1", 500, "late", False)
    for k, parts in enumerate([[[first, other]], [[first], [other]], [[other, first]]]):
        log = seeded(spark, f"{folder}/{k}", states)
        collector = collect.Collector(log, f"{folder}/{k}/history")
        for number, part in enumerate(parts):
            collector.apply(spark.createDataFrame(part, R.RESPONSE_SCHEMA), number)
        assert found(log) == {"studio-row-1": ("failed_pdf_404", 0, "not in BQ yet")}


def test_repeated_responses_count_once(spark, folder):
    """The same responses arrive in every batch."""
    states, rows = scenario(25, events=25)
    log = seeded(spark, folder, states)
    collector = collect.Collector(log, f"{folder}/history")
    parts = batches(spark, rows, shuffled)
    for number, part in enumerate([parts[0], parts[1].union(parts[0]), parts[2].union(parts[1])]):
        collector.apply(part, number)
    assert found(log) == expected(states, rows)


def test_stream_until_drained(spark, folder):
    states, rows = scenario(23, events=25)
    rows.append((999_999, T0 + dt.timedelta(days=60), "studio-row-unknown", 404, None, False))
    states = {e: ("submitted", a, err, T0) for e, (_, a, err, _) in states.items()}
    rows = [r for r in rows if r[3] in (422, 429) or r[4] == '{"url":"https://x/1"}'] + [rows[-1]]
    log = seeded(spark, folder, states)
    for i, part in enumerate(batches(spark, rows, in_order)):
        part.coalesce(1).write.parquet(f"{folder}/in/{i}")
    stream = R.stream_responses(spark, f"{folder}/in/*", files_per_batch=1)
    collector = collect.Collector(log, f"{folder}/history")
    query = collector.start(stream, f"{folder}/checkpoint", poll_seconds=0)
    assert collector.run_until_drained(query, check_seconds=0.2, at_most_seconds=60)
    assert not query.isActive and collector.remaining() == 0
    assert {s for s, _, _ in found(log).values()}.isdisjoint({"submitted", "failed_pdf_404"})


def test_what_a_batch_reads_does_not_grow(spark, folder):
    """Twenty batches of the same size: the tables of a batch that are read again hold as
    much at the end as after the first few."""
    events = {f"studio-row-{k}": ("submitted", 0, None, T0) for k in range(12)}
    log = seeded(spark, folder, events)
    collector = collect.Collector(log, f"{folder}/history", compact_every=4)
    reads = []

    def counted(df):
        return df.count()

    for number in range(20):
        rows = [
            (number * 100 + k, T0 + dt.timedelta(minutes=number * 10 + k), e, 429, None, False)
            for k, e in enumerate(events)
        ]
        collector.apply(spark.createDataFrame(rows, R.RESPONSE_SCHEMA), number)
        if number % 4 == 3:
            generation, facts = log._facts_now()
            tail = log._uncovered(generation, facts.get("snapshot"))
            clock = spark.read.parquet(f"{folder}/history/clock/batch={number}")
            reads.append((counted(tail), counted(collector._starts(number + 1)), counted(clock)))
        touched = spark.read.parquet(f"{folder}/history/touched/batch={number}")
        assert touched.count() == len(events) and "excel_row_json" not in touched.columns
        # Everything came in order: no batch has looked at the history of responses.
        assert not os.path.exists(f"{folder}/history/again")
    assert len(set(reads[1:])) == 1 and reads[-1][1:] == (len(events), 1)
    assert found(log) == expected(events, [(1, T0 + dt.timedelta(minutes=201), "studio-row-0", 429, None, False)])


def test_late_responses_are_folded_from_the_last_mark(spark, folder, monkeypatch):
    """A late response reads what came after the midnight before it, not the whole history;
    one from before a mark goes back to an earlier one, and repeats count once."""
    events = {f"studio-row-{k}": ("submitted", 0, None, None) for k in range(4)}
    log = seeded(spark, folder, events)
    collector = collect.Collector(log, f"{folder}/history", compact_every=None)
    seen = []
    monkeypatch.setattr(collect, "reconcile", lambda state, rows, **kw: seen.append(rows.count()) or reconcile(state, rows, **kw))
    rows, seq = [], 0

    def batch(number, *parts):
        nonlocal seq
        own = []
        for event, day, hour, status in parts:
            seq += 1
            own.append((seq, T0 + dt.timedelta(days=day, hours=hour), event, status, "x" * 300 if status == 500 else None, False))
        rows.extend(own)
        collector.apply(spark.createDataFrame(own, R.RESPONSE_SCHEMA), number)
        return own

    for day in range(6):
        batch(day, *[(e, day, hour, 404 if hour else 429) for e in events for hour in (0, 6)])
    assert seen == [8] * 6
    a = "studio-row-1"
    batch(6, (a, 5, 1, 500))  # late within the last day: from its midnight on
    assert seen[-1] == 3
    again = batch(7, (a, 2, 3, 500))  # from the midnight of the third day on: the later marks are broken
    assert seen[-1] == 2 * 4 + 2
    batch(8, (a, 5, 2, 429))  # no mark after the third day holds
    assert seen[-1] == 2 * 4 + 3
    collector.apply(spark.createDataFrame([*again, *again], R.RESPONSE_SCHEMA), 9)
    assert found(log) == expected(events, rows)
    # A response that a mark holds, delivered again with a later time, is the first one.
    held = rows[2]
    moved = (held[0], T0 + dt.timedelta(days=5, hours=1), *held[2:])
    collector.apply(spark.createDataFrame([moved, (9_999, T0 + dt.timedelta(days=5, hours=3), held[2], 429, None, False)], R.RESPONSE_SCHEMA), 10)
    rows.append((9_999, T0 + dt.timedelta(days=5, hours=3), held[2], 429, None, False))
    assert found(log) == expected(events, rows)


def test_counts_while_writing(spark, folder):
    """What is swept is counted where it is written."""
    events = {f"studio-row-{k}": ("submitted", 0, None, T0 if k % 3 else None) for k in range(9)}
    log = seeded(spark, folder, events)
    swept = transitions.timeout_sweep(log.current(), T0 + dt.timedelta(hours=49))
    open_ = F.count_if(transitions.polled())
    assert log.append(swept, "sweep", 1, open=open_) == {"rows": 6, "open": 0}
    assert log.append(swept.limit(0), "sweep", 2, open=open_) == {"rows": 0, "open": 0}


def test_once(spark, folder):
    states, rows = scenario(24, events=20)
    log = seeded(spark, folder, states)
    spark.createDataFrame(rows, R.RESPONSE_SCHEMA).coalesce(1).write.parquet(f"{folder}/in")
    collector = collect.Collector(log, f"{folder}/history")
    stream = R.stream_responses(spark, f"{folder}/in")
    collector.start(stream, f"{folder}/checkpoint", once=True).awaitTermination()
    assert found(log) == expected(states, rows)


def test_ingest_registers_each_event_once(spark, folder):
    schema = roster.roster_schema()
    rows = spark.range(1, 41).select(
        F.col("id").alias(S.POSITION), *[F.lit("x").alias(c) for c in S.ROSTER_COLUMNS]
    )
    rows.write.parquet(f"{folder}/in/a")
    rows.where("row_position > 20").withColumn(S.POSITION, F.col(S.POSITION) + 20).union(rows).write.parquet(f"{folder}/in/b")
    log = statelog.StateLog(spark, f"{folder}/state")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")
    ingest.Ingestor(log, T0).start(stream, f"{folder}/checkpoint").awaitTermination()
    events = [r["event_id"] for r in log.log().select("event_id").collect()]
    assert sorted(events) == sorted(f"studio-row-{i}" for i in range(1, 61))
