"""The window fold against the row-at-a-time model, with and without hot events."""

import datetime as dt
import random

import pytest

from rollcall.operators.chunks import cut_hot_groups, with_previous
from rollcall.plans.reconcile import reconcile
from rollcall.sources.responses import RESPONSE_SCHEMA
from tests.model import fold

T0 = dt.datetime(2024, 1, 1)
STATE_SCHEMA = (
    "event_id string, state string, attempts int, last_error string, webhook_submitted_at timestamp_ntz"
)
BODIES = {
    200: ['{"url":"https://x/1"}', "{}", '{"url":""}', "oops", None, "[1]"],
    422: [
        '{"detail":{"pipeline_status":"processing"}}', '{"detail":{"pipeline_status":"failed"}}',
        '{"detail":{"session_status":"failed"}}', '{"detail":{"reason":"data_incomplete"}}',
        '{"detail":"failed"}', '{"detail":[{"reason":"data_incomplete"}]}', "[]", "junk", None,
    ],
    404: [None], 429: [None], 500: ["x" * 300], 503: ["ñ" * 250], 302: [None], None: [None],
}


def scenario(seed, events=60, hot=0, quiet=False):
    rng = random.Random(seed)
    states, rows, seq = {}, [], 0
    for e in range(events):
        event = f"studio-row-{e}"
        first = rng.choice(["submitted"] * 5 + ["failed_pdf_404", "failed_pdf_fetch", "completed", "pending"])
        submitted = rng.choice([T0, T0 + dt.timedelta(hours=rng.randrange(200)), None])
        states[event] = (first, rng.randrange(7), rng.choice([None, "old"]), submitted)
        many = hot if e == 0 and hot else rng.randrange(12)
        if e == 0 and hot:
            states[event] = ("submitted", 0, None, T0)
        for _ in range(many):
            seq += 1
            common = [404, 429, 422] if quiet and e == 0 else [404, 429, 422, 200, 500, 503, 302, None]
            status = rng.choice(common)
            bodies = BODIES[status][:1] if status == 422 and rng.random() < 0.8 else BODIES[status]
            minutes = rng.randrange(60 * 40 if quiet and e == 0 else 60 * 150)
            rows.append((seq, T0 + dt.timedelta(minutes=minutes), event, status, rng.choice(bodies), rng.random() < 0.2))
    rows.append((seq + 1, T0, "studio-row-unknown", 200, BODIES[200][0], False))
    rng.shuffle(rows)
    return states, rows


def frames(spark, states, rows):
    state = spark.createDataFrame([(e, s, a, err, at) for e, (s, a, err, at) in states.items()], STATE_SCHEMA)
    return state, spark.createDataFrame(rows, RESPONSE_SCHEMA).repartition(3)


def folded(df):
    return {
        r["event_id"]: (r["state"], r["attempts"], r["last_error"], r["pdf_url"], r["polls"])
        for r in df.collect()
    }


@pytest.mark.parametrize("seed", range(4))
def test_fold(spark, seed):
    states, rows = scenario(seed)
    assert folded(reconcile(*frames(spark, states, rows))) == fold(states, rows)


@pytest.mark.parametrize("most, hours", [(1, 10), (2, 48), (20, 1)])
def test_fold_parameters(spark, most, hours):
    states, rows = scenario(99)
    df = reconcile(*frames(spark, states, rows), max_attempts=most, timeout_hours=hours)
    assert folded(df) == fold(states, rows, most, hours)


@pytest.mark.parametrize("seed, quiet", [(11, True), (12, True), (13, False), (14, False)])
def test_fold_with_a_hot_event(spark, seed, quiet):
    """One event holds most rows. It lies in several ranges; the result is the same."""
    states, rows = scenario(seed, events=40, hot=600, quiet=quiet)
    if quiet:  # many kept rows, and an end far into the history
        end = T0 + dt.timedelta(hours=45)
        rows.append((10_000_000, end, "studio-row-0", 200, BODIES[200][0], False))
        rows += [
            (10_000_001 + i, end + dt.timedelta(minutes=i), "studio-row-0", 500, "late", False) for i in range(1, 200)
        ]
    state, responses = frames(spark, states, rows)
    cutting = {"partitions": 12}
    chunked = cut_hot_groups(responses, "event_id", ["ts", "seq"], **cutting)
    sizes = [r["count"] for r in chunked.rows.where("event_id = 'studio-row-0'").groupBy("chunk").count().collect()]
    assert len(sizes) > 4 and max(sizes) < sum(sizes) / 2
    assert folded(reconcile(state, responses, **cutting)) == fold(states, rows)


def test_hot_event_of_one_instant(spark):
    """Equal timestamps are cut by sequence number."""
    states = {"studio-row-0": ("submitted", 0, None, T0), "studio-row-1": ("submitted", 0, None, T0)}
    rows = [(i, T0, "studio-row-0", 404 if i < 300 else 500, None, False) for i in range(500)]
    rows.append((1000, T0, "studio-row-1", 404, None, False))
    cutting = {"partitions": 5}
    state, responses = frames(spark, states, rows)
    chunked = cut_hot_groups(responses, "event_id", ["ts", "seq"], **cutting)
    assert chunked.rows.where("event_id = 'studio-row-0'").select("chunk").distinct().count() > 2
    assert folded(reconcile(state, responses, **cutting)) == fold(states, rows)


@pytest.mark.parametrize("partitions", [1, 9])
def test_previous_state(spark, partitions):
    _, rows = scenario(5, events=30, hot=400)
    log = spark.createDataFrame(rows, RESPONSE_SCHEMA).repartition(3)
    found = with_previous(log, "event_id", ["ts", "seq"], "status", "before", partitions=partitions)
    assert "chunk" not in found.columns
    got = {r["seq"]: r["before"] for r in found.collect()}
    last, wanted = {}, {}
    for seq, ts, event, status, *_ in sorted(rows, key=lambda r: (r[1], r[0])):
        wanted[seq] = last.get(event)
        last[event] = status
    assert got == wanted


def test_rows_are_dealt_once_after_the_ranges(spark):
    states, rows = scenario(1)
    df = reconcile(*frames(spark, states, rows))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SinglePartition" not in plan
    dealt = [line for line in plan.splitlines() if "hashpartitioning(event_id" in line and ", chunk" in line]
    assert len(dealt) <= 4  # the two join sides and the carried values, not once per window


def test_null_event_in_several_ranges(spark):
    rows = [(i, T0 + dt.timedelta(minutes=i), None, 400 + i, None, False) for i in range(300)]
    log = spark.createDataFrame(rows, RESPONSE_SCHEMA)
    found = with_previous(log, "event_id", ["ts", "seq"], "status", "before", partitions=6)
    assert {r["seq"]: r["before"] for r in found.collect()} == {i: 399 + i if i else None for i in range(300)}


def test_wide_rows_do_not_travel(spark):
    states, rows = scenario(1)
    plan = reconcile(*frames(spark, states, rows))._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line]
    assert windows and not any("body" in line for line in windows)


def test_empty_log(spark):
    states, _ = scenario(1)
    state, responses = frames(spark, states, [])
    assert reconcile(state, responses).count() == 0
