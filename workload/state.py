"""State selections, transitions, listings and the annotated roster."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.functions import ids
from rollcall.operators.scratch import new_path
from rollcall.plans import reports, submit, transitions
from rollcall.sources import roster as R
from rollcall.sources.statelog import LOG_COLUMNS, STATE_COLUMNS, StateLog, current_where
from workload import sqltext as Q
from workload.fixtures import AS_OF
from workload.ingestion import compacted_log, prepared, state_now
from workload.registry import query

AT = dt.datetime.fromisoformat(AS_OF)
_RETRYABLE = "('failed_drive_read', 'failed_gcs_upload', 'failed_webhook', 'failed_phase1')"


def log_of(t):
    return t("state_log").select(*LOG_COLUMNS)


@query(
    "select_retryable",
    f"""SELECT event_id, state, attempts, row_position,
      json_extract_string(excel_row_json, '$.teacher') AS teacher,
      json_extract_string(excel_row_json, '$.grade') AS grade,
      json_extract_string(excel_row_json, '$.section') AS section
    FROM state_now WHERE state IN {_RETRYABLE}""",
)
def select_retryable(t):
    state = state_now(t, "event_id", "state", "attempts", "excel_row_json")
    rows = transitions.select_retryable(state, R.roster_schema())
    return rows.select("event_id", "state", "attempts", S.POSITION, "teacher", "grade", "section")


@query(
    "fetch_by_state",
    """SELECT row_position, event_id, state, attempts FROM state_now
    WHERE state IN ('failed_pdf_fetch', 'failed_webhook') AND attempts < 5""",
)
def fetch_by_state(t):
    state = state_now(t, S.POSITION, "event_id", "state", "attempts")
    return transitions.fetch_by_state(state, [S.FAILED_FETCH, S.FAILED_WEBHOOK], 5)


@query(
    "failures_listing",
    """SELECT row_position, event_id, state, attempts, left(coalesce(last_error, ''), 80) AS last_error,
      state = 'failed_pdf_fetch' AND attempts >= 5 AS exhausted
    FROM state_now WHERE starts_with(state, 'failed_')""",
)
def failures_listing(t):
    return reports.failures_listing(
        state_now(t, S.POSITION, "event_id", "state", "attempts", "last_error")
    )


@query(
    "inspect_row",
    """SELECT * EXCLUDE (log_ts, log_seq), json_extract_string(excel_row_json, '$.teacher') AS teacher,
      json_extract_string(excel_row_json, '$.grade') AS grade
    FROM state_now WHERE event_id = 'studio-row-42'""",
)
def inspect_row(t):
    row = reports.inspect(state_now(t), "studio-row-42")
    source = R.from_snapshot(F.col("excel_row_json"), R.roster_schema())
    return row.withColumn("r", source).select(*STATE_COLUMNS, "r.teacher", "r.grade")


@query(
    "status_summary",
    """SELECT state, count(*) AS n,
      round(count(*) * 100.0 / (SELECT count(*) FROM state_now), 1) AS percent
    FROM state_now GROUP BY state""",
)
def status_summary(t):
    return reports.status_summary(state_now(t, "state"))


@query(
    "ordered_listings",
    """SELECT state, row_position, event_id, log_seq FROM state_now
    ORDER BY log_ts DESC, log_seq DESC LIMIT 20""",
)
def ordered_listings(t):
    state = state_now(t, "state", S.POSITION, "event_id", "log_seq", "log_ts")
    return state.orderBy(F.desc("log_ts"), F.desc("log_seq")).limit(20).drop("log_ts")


_POOL = """state IN ('submitted', 'failed_pdf_404') OR (state = 'failed_pdf_fetch' AND attempts < 5)"""


@query(
    "collect_pool",
    """SELECT event_id, state, attempts FROM state_now WHERE state IN ('submitted', 'failed_pdf_404')
    UNION ALL SELECT event_id, state, attempts FROM state_now
    WHERE state = 'failed_pdf_fetch' AND attempts < 5""",
)
def collect_pool(t):
    return transitions.collect_pool(state_now(t, "event_id", "state", "attempts"))


@query("pending_remaining", f"SELECT count(*) AS remaining FROM state_now WHERE {_POOL}")
def pending_remaining(t):
    return transitions.pending_remaining(state_now(t, "state", "attempts"))


@query(
    "state_retry_class",
    """WITH classes(state, retry_class) AS (VALUES """
    + ", ".join(f"('{s}', '{c}')" for s, c in S.RETRY_CLASS)
    + """) SELECT coalesce(retry_class, 'unknown') AS retry_class, s.state, count(*) AS n
    FROM state_now s LEFT JOIN classes c ON c.state = s.state GROUP BY ALL""",
)
def state_retry_class(t):
    return reports.retry_classes(state_now(t, "state"))


# ---- transitions ------------------------------------------------------------------
_NULL = "CAST(NULL AS STRING)"


@query(
    "timeout_sweep",
    f"""SELECT {Q.image(state="'failed_timeout_pending_analysis'", last_error="'timeout after 48h in submitted'")}
    FROM state_now WHERE state = 'submitted'
      AND webhook_submitted_at < TIMESTAMP '{AS_OF}' - INTERVAL 48 HOURS""",
)
def timeout_sweep(t):
    late = current_where(log_of(t), ["state", "webhook_submitted_at"], transitions.overdue(AT))
    return transitions.timeout_sweep(late, AT)


@query(
    "retry_failed",
    f"""SELECT {Q.image(state="'pending'", last_error=_NULL)} FROM state_now WHERE state IN {_RETRYABLE}""",
)
def retry_failed(t):
    failed = current_where(log_of(t), ["state"], transitions.retryable())
    return transitions.retry_failed(failed, AT)


_LISTED = "SELECT DISTINCT 'studio-row-' || CAST(user_id * 3 AS STRING) AS event_id FROM events WHERE event_type = 'error'"


def listed_events(t):
    rows = t("events").where(F.col("event_type") == "error")
    return rows.select(ids.event_id(F.col("user_id") * 3).alias("event_id")).distinct()


@query(
    "retry_rows",
    f"""SELECT {Q.image(state="'pending'", last_error=_NULL, attempts="0")} FROM state_now
    WHERE event_id IN ({_LISTED})""",
)
def retry_rows(t):
    listed = listed_events(t)
    log = log_of(t).join(listed, "event_id", "left_semi")
    return transitions.retry_rows(current_where(log, ["state"], F.lit(True)), listed, AT)


_CHANGED = """SELECT 'studio-row-' || CAST(user_id * 3 AS STRING) AS event_id, 'change ' || CAST(event_id AS STRING) AS drive_case,
      CASE WHEN event_id % 2 = 0 THEN 'said at ' || CAST(event_id AS STRING) END AS last_error,
      row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n
    FROM events WHERE event_type = 'error'"""


@query(
    "state_append",
    f"""SELECT {Q.image("s.", state="'failed_phase1'", last_error="c.last_error", drive_case="c.drive_case")}
    FROM state_now s JOIN ({_CHANGED}) c ON c.event_id = s.event_id WHERE c.n = 1""",
)
def state_append(t):
    """Many changes of an event in one table, over a compacted log: the last one makes its
    image."""
    seq = F.col("event_id")
    changes = t("events").where(F.col("event_type") == "error").select(
        ids.event_id(F.col("user_id") * 3).alias("event_id"),
        F.lit(S.FAILED_PHASE_1).alias("state"),
        F.concat(F.lit("change "), seq.cast("string")).alias("drive_case"),
        F.when(seq % 2 == 0, F.concat(F.lit("said at "), seq.cast("string"))).alias("last_error"),
        "ts", seq.alias("change"),
    )
    state = compacted_log(t).current_of(changes)
    return transitions.patch_images(state, changes, AT, order=["ts", "change"])


@query(
    "state_history",
    """SELECT event_id, state, attempts, log_ts, log_seq,
      lag(state) OVER (PARTITION BY event_id ORDER BY log_ts, log_seq) AS previous_state
    FROM state_log""",
)
def state_history(t):
    return transitions.state_history(t("state_log"))


@query(
    "attempts_accounting",
    """SELECT event_id, CAST(sum(greatest(attempts - before, 0)) AS INT) AS spent,
      last(attempts ORDER BY log_ts, log_seq) AS attempts
    FROM (SELECT *, coalesce(lag(attempts) OVER (PARTITION BY event_id ORDER BY log_ts, log_seq), 0) AS before
      FROM state_log) x GROUP BY event_id""",
)
def attempts_accounting(t):
    """Over a log that the library has written."""
    log = StateLog(t.spark, new_path(t.spark, "state"))
    log.append(log_of(t), "submit", 1)
    return transitions.attempts_spent(log.log())


# ---- phase 3 ------------------------------------------------------------------------
_ANNOTATED = [S.POSITION, "event_id", "state", "last_error", "pdf_drive_link"]
_STATUS = """CASE WHEN state = 'completed' OR starts_with(state, 'skipped_') THEN state
      ELSE state || ': ' || left(coalesce(last_error, ''), 200) END"""


@query(
    "annotation_status",
    f"""SELECT row_position, event_id AS event_id_xai,
      CASE WHEN state = 'completed' THEN coalesce(pdf_drive_link, '') ELSE '' END AS pdf_drive_link,
      {_STATUS} AS backfill_status FROM state_now""",
)
def annotation_status(t):
    return reports.annotations(state_now(t, *_ANNOTATED))


@query(
    "annotated_roster",
    f"""SELECT r.row_position, {Q.denumbered('infrastructureCode')} AS infrastructureCode,
      {Q.denumbered('grade')} AS grade, {Q.CELLS}, coalesce(event_id, '') AS event_id_xai,
      CASE WHEN state = 'completed' THEN coalesce(pdf_drive_link, '') ELSE '' END AS pdf_drive_link,
      coalesce({_STATUS}, '') AS backfill_status
    FROM roster r LEFT JOIN state_now s ON s.row_position = r.row_position""",
)
def annotated_roster(t):
    """The state also holds events of another prefix for the same rows."""
    return reports.annotate(prepared(t), two_prefixes(t, *_ANNOTATED))


def two_prefixes(t, *columns):
    state = state_now(t, *columns)
    other = state.withColumns(
        {"event_id": ids.event_id(F.col(S.POSITION), "second-row"), "state": F.lit(S.PENDING)}
    )
    return state.unionByName(other)


@query(
    "roster_state_join",
    """SELECT r.row_position, r.school, s.event_id, s.state
    FROM roster r LEFT JOIN state_now s ON s.row_position = r.row_position""",
)
def roster_state_join(t):
    state = two_prefixes(t, S.POSITION, "event_id", "state").select(F.col("event_id").alias("_event"), "event_id", "state")
    rows = submit.with_event_id(t("roster").select(S.POSITION, "school")).withColumnRenamed("event_id", "_event")
    return rows.join(state, "_event", "left").drop("_event")
