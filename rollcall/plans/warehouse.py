"""Diagnostics over the warehouse star and the operational tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.functions.text import full_name

EVENT = "scheduling_app_event_id"


def of_prefix(prefix: str = S.EVENT_ID_PREFIX, column: str = EVENT) -> Column:
    """Literal prefix match; reaches the scan as a starts-with filter."""
    return F.col(column).startswith(f"{prefix}-")


def session_by_event(sessions: DataFrame, event: str) -> DataFrame:
    return sessions.where(F.col(EVENT) == event).select(
        EVENT, "school_code", "teacher_code", "coach_code", "pipeline_status",
        "session_status", "is_deleted",
    )


OPERATIONAL_COLUMNS = [
    "id", EVENT, "school_code", "teacher_code", "coach_code", "grade", "subject",
    "pipeline_status", "status", "recorded_at", "created_at",
]


def operational_session(sessions: DataFrame, event: str) -> DataFrame:
    """The operational copy of one session; the key filter reaches the scan."""
    return sessions.where(F.col(EVENT) == event).select(*OPERATIONAL_COLUMNS)


def dims_by_prefix(dim: DataFrame, code: str, prefix: str) -> DataFrame:
    return dim.where(F.col(code).startswith(prefix))


def status_counts(sessions: DataFrame, prefix: str = S.EVENT_ID_PREFIX) -> DataFrame:
    rows = sessions.where(of_prefix(prefix))
    counts = rows.groupBy("pipeline_status").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "pipeline_status")


def failed_sessions(sessions: DataFrame, prefix: str = S.EVENT_ID_PREFIX) -> DataFrame:
    """Sessions that failed in either status, newest first."""
    failed = (F.col("pipeline_status") == "failed") | (F.col("session_status") == "failed")
    rows = sessions.where(of_prefix(prefix) & failed)
    return rows.select(EVENT, "pipeline_status", "session_status", "error_message", "updated_at").orderBy(
        F.desc("updated_at"), EVENT
    )


def total_sessions(sessions: DataFrame, prefix: str = S.EVENT_ID_PREFIX) -> DataFrame:
    return sessions.where(of_prefix(prefix)).agg(F.count("*").alias("total_sessions"))


def newest(df: DataFrame, code: str, prefix: str, limit: int | None = None) -> DataFrame:
    """Rows whose code has a prefix, newest first; a limit makes it a top-k."""
    rows = df.where(F.col(code).startswith(prefix)).orderBy(F.desc("created_at"), code)
    return rows if limit is None else rows.limit(limit)


def users_to_dim(users: DataFrame) -> DataFrame:
    """Operational users as the user dimension."""
    return users.select(
        F.col("code").alias("user_code"),
        full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        "role",
    )


def latest_runs(runs: DataFrame) -> DataFrame:
    """Latest run per session: latest completion first, unfinished runs last, ties
    by id. Partial and final aggregation, so a session of any size is cheap."""
    done = F.col("completed_at").isNotNull()
    best = F.max(F.struct(done, "completed_at", "analysis_run_id", "status"))
    return runs.groupBy("session_id").agg(best.alias("r")).select(
        "session_id", "r.analysis_run_id", "r.status", "r.completed_at"
    )


def session_report(
    sessions: DataFrame, users: DataFrame, schools: DataFrame, runs: DataFrame, results: DataFrame
) -> DataFrame:
    """What a report shows per session: names, school, latest analysis.

    The latest run is picked before any join, so runs are never multiplied out.
    The dimensions are not hinted: small ones are broadcast by size.
    """

    def named(role):
        return users.select(
            F.col("user_code").alias(f"{role}_code"),
            F.nullif(F.trim("full_name"), F.lit("")).alias(f"{role}_name"),
        )

    latest = latest_runs(runs).select(
        "session_id", "analysis_run_id", F.col("status").alias("analysis_status")
    )
    scored = latest.join(results.select("analysis_run_id", "overall_score"), "analysis_run_id", "left")
    return (
        sessions.join(scored, "session_id", "left")
        .join(schools, "school_code", "left")
        .join(named("teacher"), "teacher_code", "left")
        .join(named("coach"), "coach_code", "left")
        .select(
            "session_id", "pipeline_status", "session_status", "teacher_name", "coach_name",
            "school_name", "department", "district", "grade", "section", "subject", "shift",
            "analysis_status", "overall_score",
        )
    )


def analysis_coverage(
    sessions: DataFrame, runs: DataFrame, results: DataFrame, prefix: str = S.EVENT_ID_PREFIX
) -> DataFrame:
    """How many sessions have a score. Counts session-run pairs, a session without
    runs once; `distinct_sessions` counts sessions.

    Runs are counted per session before meeting the sessions: a session with many
    runs is one row in the join.
    """
    scored = runs.select("session_id", "analysis_run_id").join(
        results.select("analysis_run_id", "overall_score"), "analysis_run_id", "left"
    )
    per_session = scored.groupBy("session_id").agg(
        F.count("*").alias("runs"), F.count("overall_score").alias("with_score")
    )
    rows = sessions.where(of_prefix(prefix)).select("session_id").join(per_session, "session_id", "left")
    pairs, with_score = F.coalesce("runs", F.lit(1)), F.coalesce("with_score", F.lit(0))

    def total(col):
        return F.coalesce(F.sum(col), F.lit(0)).cast("bigint")

    return rows.agg(
        total(pairs).alias("total_sessions"),
        total(with_score).alias("with_analysis"),
        total(pairs - with_score).alias("without_analysis"),
        F.count("*").alias("distinct_sessions"),
    )


def incomplete(
    sessions: DataFrame, runs: DataFrame, results: DataFrame, prefix: str = S.EVENT_ID_PREFIX
) -> DataFrame:
    """Session-run pairs that lack a score or result data.

    Complete runs are dropped before the join with the sessions. Sessions without
    any run have an incomplete pair of their own, found by an anti join.
    """
    picked = sessions.where(of_prefix(prefix)).select(
        "session_id", EVENT, "pipeline_status", "session_status"
    )
    lacking = (
        runs.select("session_id", "analysis_run_id", F.col("status").alias("analysis_status"))
        .join(results, "analysis_run_id", "left")
        .where(F.col("overall_score").isNull() | F.col("results_data").isNull())
    )
    shown = [EVENT, "pipeline_status", "session_status", "overall_score", "analysis_status"]
    with_runs = picked.join(lacking, "session_id").select(*shown)
    without = picked.join(runs.select("session_id").distinct(), "session_id", "left_anti").select(
        EVENT,
        "pipeline_status",
        "session_status",
        F.lit(None).cast("double").alias("overall_score"),
        F.lit(None).cast("string").alias("analysis_status"),
    )
    return with_runs.unionByName(without)
