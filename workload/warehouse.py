"""Warehouse and operational diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.plans import transitions
from rollcall.plans import warehouse as D
from workload.registry import query

_LATEST = """latest AS (
  SELECT * FROM (SELECT r.*, row_number() OVER (PARTITION BY session_id
    ORDER BY completed_at DESC NULLS LAST, analysis_run_id DESC) AS rn FROM analysis_runs r) x WHERE rn = 1)"""


@query(
    "diag_point_lookup",
    """SELECT scheduling_app_event_id, school_code, teacher_code, coach_code, pipeline_status,
      session_status, is_deleted FROM sessions WHERE scheduling_app_event_id = 'studio-row-4'""",
)
def diag_point_lookup(t):
    return D.session_by_event(t("sessions"), "studio-row-4")


@query(
    "diag_operational_lookup",
    """SELECT * FROM operational_sessions WHERE scheduling_app_event_id = 'studio-row-4'""",
)
def diag_operational_lookup(t):
    return D.operational_session(t("operational_sessions"), "studio-row-4")


@query(
    "diag_dims_by_prefix",
    """SELECT school_code AS code, school_name AS name FROM dim_schools WHERE starts_with(school_code, 'studio-school-')
    UNION ALL SELECT user_code, full_name FROM dim_users WHERE starts_with(user_code, 'T')""",
)
def diag_dims_by_prefix(t):
    schools = D.dims_by_prefix(t("dim_schools"), "school_code", "studio-school-")
    users = D.dims_by_prefix(D.users_to_dim(t("users")), "user_code", "T")
    return schools.select(F.col("school_code").alias("code"), F.col("school_name").alias("name")).unionByName(
        users.select(F.col("user_code").alias("code"), F.col("full_name").alias("name"))
    )


@query(
    "diag_status_counts",
    """SELECT pipeline_status, count(*) AS n FROM sessions
    WHERE starts_with(scheduling_app_event_id, 'studio-row-') GROUP BY pipeline_status""",
)
def diag_status_counts(t):
    return D.status_counts(t("sessions"))


@query(
    "diag_sessions_by_prefix",
    """SELECT scheduling_app_event_id, pipeline_status, session_status, error_message, updated_at FROM sessions
    WHERE starts_with(scheduling_app_event_id, 'studio-row-')
      AND (pipeline_status = 'failed' OR session_status = 'failed')""",
)
def diag_sessions_by_prefix(t):
    return D.failed_sessions(t("sessions"))


@query(
    "diag_total_by_prefix",
    """SELECT count(*) AS total_sessions FROM sessions
    WHERE starts_with(scheduling_app_event_id, 'studio-row-')""",
)
def diag_total_by_prefix(t):
    return D.total_sessions(t("sessions"))


@query(
    "diag_newest_users",
    """SELECT code, first_name, last_name, role, school_code, created_at FROM users
    WHERE starts_with(code, 'T') ORDER BY created_at DESC, code LIMIT 25""",
)
def diag_newest_users(t):
    return D.newest(t("users"), "code", "T", 25)


@query(
    "diag_newest_schools",
    """SELECT code, name, department, district, created_at FROM schools
    WHERE starts_with(code, 'studio-school-')""",
)
def diag_newest_schools(t):
    return D.newest(t("schools"), "code", "studio-school-")


@query(
    "latest_run_per_session",
    f"WITH {_LATEST} SELECT session_id, analysis_run_id, status, completed_at FROM latest",
)
def latest_run_per_session(t):
    return D.latest_runs(t("analysis_runs"))


@query(
    "session_report_view",
    f"""WITH {_LATEST},
    names AS (SELECT user_code, CASE WHEN trim(full_name) <> '' THEN trim(full_name) END AS shown FROM dim_users),
    scored AS (SELECT session_id, status, overall_score FROM latest LEFT JOIN analysis_results USING (analysis_run_id))
    SELECT session_id, grade, section, subject, shift, pipeline_status, session_status,
      (SELECT min(shown) FROM names WHERE user_code = teacher_code) AS teacher_name,
      (SELECT min(shown) FROM names WHERE user_code = coach_code) AS coach_name,
      school_name, department, district, status AS analysis_status, overall_score
    FROM sessions LEFT JOIN dim_schools USING (school_code) LEFT JOIN scored USING (session_id)""",
)
def session_report_view(t):
    return D.session_report(
        t("sessions"), D.users_to_dim(t("users")), t("dim_schools"), t("analysis_runs"), t("analysis_results")
    )


# Runs with their results, and the sessions of the prefix without any run.
_RUNS = """mine AS (
  SELECT session_id, scheduling_app_event_id, pipeline_status, session_status FROM sessions
  WHERE starts_with(scheduling_app_event_id, 'studio-row-')),
judged AS (
  SELECT r.session_id, r.status, x.overall_score, x.results_data
  FROM analysis_runs r LEFT JOIN analysis_results x USING (analysis_run_id)),
every_run AS (
  SELECT mine.*, status, overall_score, results_data FROM mine JOIN judged USING (session_id)
  UNION ALL
  SELECT mine.*, NULL, NULL, NULL FROM mine WHERE session_id NOT IN (SELECT session_id FROM judged))"""


@query(
    "diag_analysis_coverage",
    f"""WITH {_RUNS} SELECT count(*) AS total_sessions, count(overall_score) AS with_analysis,
      sum(CASE WHEN overall_score IS NULL THEN 1 ELSE 0 END)::BIGINT AS without_analysis,
      count(DISTINCT session_id) AS distinct_sessions FROM every_run""",
)
def diag_analysis_coverage(t):
    return D.analysis_coverage(t("sessions"), t("analysis_runs"), t("analysis_results"))


@query(
    "diag_incomplete",
    f"""WITH {_RUNS} SELECT scheduling_app_event_id, pipeline_status, session_status,
      status AS analysis_status, overall_score
    FROM every_run WHERE overall_score IS NULL OR results_data IS NULL""",
)
def diag_incomplete(t):
    return D.incomplete(t("sessions"), t("analysis_runs"), t("analysis_results"))


@query(
    "dim_patch",
    """SELECT u.code, coalesce(p.first_name, u.first_name) AS first_name,
      coalesce(p.last_name, u.last_name) AS last_name, u.role, u.school_code, u.created_at
    FROM users u LEFT JOIN (SELECT 'T' || CAST(o_custkey AS STRING) AS code, 'teacher' AS role,
        last('Patched ' || CAST(o_orderkey AS STRING) ORDER BY o_orderdate, o_orderkey)
          FILTER (o_orderkey % 3 > 0) AS first_name,
        last(o_orderstatus ORDER BY o_orderdate, o_orderkey) FILTER (o_orderkey % 2 = 0) AS last_name
      FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY o_custkey) p
    ON p.code = u.code AND p.role = u.role""",
)
def dim_patch(t):
    """Every urgent order is a patch: some set one name, some the other, some both or none."""
    key, urgent = F.col("o_orderkey"), F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    patch = t("orders").where(urgent).select(
        F.concat(F.lit("T"), F.col("o_custkey").cast("string")).alias("code"),
        F.lit("teacher").alias("role"),
        F.when(key % 3 > 0, F.concat(F.lit("Patched "), key.cast("string"))).alias("first_name"),
        F.when(key % 2 == 0, F.col("o_orderstatus")).alias("last_name"),
        "o_orderdate", "o_orderkey",
    )
    return transitions.dim_patch(t("users"), patch, ["code", "role"], ["o_orderdate", "o_orderkey"])
