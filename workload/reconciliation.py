"""Phase 2: responses folded into state."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall import sql
from rollcall.functions.responses import parsed_body, response_outcome
from rollcall.plans.reconcile import reconcile
from workload import sqltext as Q
from workload.registry import query


@query(
    "response_outcome",
    f"""WITH {Q.OUTCOMES} SELECT seq, event_id, st AS state, inc AS attempts_added, err AS error, url
    FROM outcomes""",
)
def outcome(t):
    rows = t("response_log").withColumn("parsed", parsed_body(F.col("status"), F.col("body")))
    meaning = response_outcome(F.col("status"), F.col("body"), F.col("delivery_failed"), parsed=F.col("parsed"))
    rows = rows.withColumn("o", meaning)
    return rows.select("seq", "event_id", "o.state", "o.attempts_added", "o.error", "o.url")


@query(
    "reconcile_responses",
    f"""WITH {Q.FOLD} SELECT event_id, state, attempts, last_error,
      CASE WHEN state = 'completed' THEN pdf_url END AS pdf_url, decided_at, last_seq, polls
    FROM folded""",
)
def reconcile_responses(t):
    return reconcile(t("poll_state"), t("response_log"))


@query(
    "sql_surface",
    f"""WITH {Q.CASES}, {Q.OUTCOMES}, implied AS (
      SELECT event_id, last(st ORDER BY ts, seq) FILTER (st IS NOT NULL) AS state, CAST(sum(inc) AS BIGINT) AS added
      FROM outcomes GROUP BY event_id)
    SELECT 'case' AS part, drive_case AS name, count(*) AS n, CAST(0 AS BIGINT) AS added FROM cases GROUP BY drive_case
    UNION ALL SELECT 'state', coalesce(state, 'unknown'), count(*), CAST(sum(added) AS BIGINT) FROM implied GROUP BY state""",
)
def sql_surface(t):
    """Classifying and folding in SQL text alone, by the functions that users of SQL have."""
    sql.register(t.spark)
    t("roster").createOrReplaceTempView("rollcall_roster")
    t("response_log").createOrReplaceTempView("rollcall_responses")
    return t.spark.sql("""
        WITH implied AS (
          SELECT event_id, max_by(o.state, struct(ts, seq)) FILTER (WHERE o.state IS NOT NULL) AS state,
                 sum(o.attempts_added) AS added
          FROM (SELECT *, rollcall_response(status, body, delivery_failed) AS o FROM rollcall_responses) GROUP BY event_id)
        SELECT 'case' AS part, rollcall_link_case(transcriptLink, videoLink) AS name, count(*) AS n, 0L AS added
        FROM rollcall_roster GROUP BY ALL
        UNION ALL SELECT 'state', coalesce(state, 'unknown'), count(*), sum(added) FROM implied GROUP BY state""")
