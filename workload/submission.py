"""Phase 1: selection, gating, outbox and schedule."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.functions import payload
from rollcall.operators.scratch import materialize, new_path
from rollcall.plans import reports, submit, transitions
from rollcall.sources import roster as R
from workload import sqltext as Q
from workload.fixtures import AS_OF, BLOB_PREFIX, BUCKET, SECRET, START
from workload.ingestion import assets, gated, outcomes, prepared, state_now
from workload.registry import query

AT = dt.datetime.fromisoformat(AS_OF)
WANTED = "SELECT DISTINCT l_orderkey * 2 + 1 AS row_position FROM lineitem WHERE l_returnflag = 'R'"


def wanted(t):
    rows = t("lineitem").where(F.col("l_returnflag") == "R")
    return rows.select((F.col("l_orderkey") * 2 + 1).alias(S.POSITION)).distinct()


@query(
    "select_positions",
    f"""SELECT row_position, transcriptLink, 'table' AS how FROM roster WHERE row_position IN ({WANTED})
    UNION ALL SELECT row_position, transcriptLink, 'list' FROM roster
    WHERE row_position IN (3, 17, 985, 1000, 99999999)""",
)
def select_positions(t):
    rows = t("roster").select(S.POSITION, "transcriptLink")
    by_table = submit.select_positions(rows, wanted(t)).withColumn("how", F.lit("table"))
    listed = submit.select_positions(rows, submit.parse_positions("17, 3,,985, 1000 ,99999999"))
    return by_table.unionByName(listed.withColumn("how", F.lit("list")))


@query(
    "select_range",
    "SELECT row_position, transcriptLink FROM roster WHERE row_position BETWEEN 300 AND 1300",
)
def select_range(t):
    return submit.select_range(t("roster").select(S.POSITION, "transcriptLink"), " 1300 - 300")


@query(
    "missing_positions",
    f"SELECT row_position FROM ({WANTED}) w WHERE row_position NOT IN (SELECT row_position FROM roster)",
)
def missing_positions(t):
    return submit.missing_positions(t("roster"), wanted(t))


@query(
    "position_difference",
    f"SELECT row_position FROM ({WANTED}) w EXCEPT SELECT row_position FROM roster",
)
def position_difference(t):
    return submit.position_difference(wanted(t), t("roster"))


@query(
    "already_submitted",
    """SELECT r.row_position, 'studio-row-' || CAST(r.row_position AS STRING) AS event_id FROM roster r
    WHERE NOT EXISTS (SELECT 1 FROM state_now s WHERE s.event_id = 'studio-row-' || CAST(r.row_position AS STRING)
      AND s.state IN ('completed', 'submitted', 'pdf_in_drive', 'analyzed'))""",
)
def already_submitted(t):
    rows = submit.with_event_id(t("roster").select(S.POSITION))
    return submit.not_submitted(rows, state_now(t, "event_id", "state"))


@query(
    "insert_or_ignore",
    f"""SELECT row_position, 'studio-row-' || CAST(row_position AS STRING) AS event_id, 'pending' AS state,
      0 AS attempts, {Q.denumbered('infrastructureCode')} AS infrastructureCode,
      {Q.denumbered('grade')} AS grade, {Q.CELLS}
    FROM roster r WHERE NOT EXISTS (
      SELECT 1 FROM state_now s WHERE s.event_id = 'studio-row-' || CAST(r.row_position AS STRING))""",
)
def insert_or_ignore(t):
    rows = submit.with_event_id(prepared(t))
    new = submit.new_images(rows, state_now(t, "event_id"), AT)
    cells = [
        F.get_json_object("excel_row_json", f"$.{c}").alias(c)
        for c in S.ROSTER_COLUMNS
    ]
    return new.select(S.POSITION, "event_id", "state", "attempts", *cells)


@query(
    "submit_outcome",
    f"WITH {Q.GATED} SELECT event_id, drive_case, outcome, outcome_error FROM gated",
)
def submit_outcome(t):
    return outcomes(t).select(
        "event_id", F.col("link.case").alias("drive_case"), "outcome", "outcome_error"
    )


@query(
    "outbox_eligibility",
    f"""WITH {Q.GATED} SELECT event_id, asset_file_id AS file_id, asset_mime AS mime, content_id
    FROM gated WHERE outcome = 'eligible'""",
)
def outbox_eligibility(t):
    rows = outcomes(t).where(F.col("outcome") == submit.ELIGIBLE)
    return rows.select(
        "event_id", F.col("asset_file_id").alias("file_id"), F.col("asset_mime").alias("mime"), "content_id"
    )


def outbox_of(t):
    pads = payload.secret_pads(t.spark, SECRET)
    return submit.outbox(gated(t), AT, pads, bucket=BUCKET, blob_prefix=BLOB_PREFIX)


@query(
    "outbox",
    f"""WITH {Q.GATED}, bodies AS (
      SELECT *, {Q.URI} AS uri, {Q.body(Q.URI)} AS body FROM gated WHERE outcome = 'eligible')
    SELECT row_position, event_id, drive_case, asset_file_id AS transcript_file_id, content_id,
      CASE WHEN ext = 'txt' THEN 'text/plain' ELSE '{S.DOCX}' END AS content_type,
      uri AS transcript_gcs_uri, TIMESTAMP '2024-01-25 18:00:00' AS url_expires_at, body,
      'sha256=' || {Q.hmac(f"'{Q.AS_OF_EPOCH}.' || body")} AS signature,
      'application/json' AS header_type, '{Q.AS_OF_EPOCH}' AS header_timestamp,
      'sha256=' || {Q.hmac(f"'{Q.AS_OF_EPOCH}.' || body")} AS header_signature FROM bodies""",
)
def outbox(t):
    return outbox_of(t).withColumns(
        {
            "header_type": F.col("headers")["Content-Type"],
            "header_timestamp": F.col("headers")["X-Webhook-Timestamp"],
            "header_signature": F.col("headers")["X-Webhook-Signature"],
        }
    ).drop("headers")


RUNS = 12


@query(
    "published_transcripts",
    f"""WITH {Q.GATED} SELECT event_id, '{BLOB_PREFIX}/' || event_id || '/transcript.' || ext AS blob_path,
      ext AS extension, sha256(run || ': ' || content.content) AS content_sha256, run
    FROM (SELECT *, 'run-' || CASE row_position % {RUNS} WHEN 0 THEN '{RUNS}' WHEN 2 THEN '2'
        ELSE CAST(row_position % {RUNS} + 1 AS STRING) END AS run FROM gated) g
    JOIN content ON content.content_id = g.content_id WHERE outcome = 'eligible'""",
)
def published_transcripts(t):
    """Twelve runs publish texts of their own, each event by two runs; then the second
    run publishes some of its events again. Every event has the text that was published
    last, by whatever run. Each text is stored twice. Digests are made once per text."""
    path = new_path(t.spark, "blobs")
    rows = materialize(outcomes(t).where(F.col("outcome") == submit.ELIGIBLE), "eligible")
    turn = F.col(S.POSITION) % RUNS
    texts = t("content")

    def publish(run: int, part) -> None:
        name = f"run-{run}"
        own = texts.unionByName(texts).withColumn("content", F.concat(F.lit(f"{name}: "), "content"))
        submit.write_transcripts(rows.where(part), own, path, BLOB_PREFIX, name, AT)

    for run in range(1, RUNS + 1):
        publish(run, turn.isin(run - 1, run % RUNS))
    publish(2, turn == 2)
    digest = F.sha2(F.encode("content", "UTF-8"), 256)
    found = submit.published_transcripts(t.spark, path, content_sha256=digest)
    return found.select("event_id", "blob_path", "extension", "run", "content_sha256")


@query(
    "retry_flow",
    f"""WITH {Q.GATED} SELECT g.event_id, g.drive_case, {Q.URI.replace('event_id', 'g.event_id')} AS transcript_gcs_uri,
      g.attempts_before
    FROM (SELECT gated.*, s.attempts AS attempts_before FROM gated JOIN state_now s ON s.event_id = gated.event_id
      WHERE s.state IN ('failed_drive_read', 'failed_gcs_upload', 'failed_webhook', 'failed_phase1')) g
    WHERE g.outcome = 'eligible'""",
)
def retry_flow(t):
    """Rows that failed, taken from the snapshots the state holds, through the gate into
    the outbox. The snapshots are those that registering the roster has written."""
    state = state_now(t, "event_id", "state", "attempts")
    new = submit.pending_images(submit.with_event_id(prepared(t)), S.ROSTER_COLUMNS, AT)
    saved = state.join(new.select("event_id", "excel_row_json"), "event_id")
    rows = transitions.select_retryable(saved, R.roster_schema()).withColumnRenamed("attempts", "attempts_before")
    again = submit.gate(rows.drop("state"), state, assets(t))
    pads = payload.secret_pads(t.spark, SECRET)
    box = submit.outbox(again, AT, pads, bucket=BUCKET, blob_prefix=BLOB_PREFIX)
    return box.join(rows.select("event_id", "attempts_before"), "event_id").select(
        "event_id", "drive_case", "transcript_gcs_uri", "attempts_before"
    )


@query(
    "release_schedule",
    f"""WITH {Q.GATED} SELECT row_position, event_id, slot,
      TIMESTAMP '{START}' + to_microseconds(CAST(slot * 5000000 AS BIGINT)) AS release_at
    FROM (SELECT row_position, event_id, row_number() OVER (ORDER BY row_position) - 1 AS slot
      FROM gated WHERE outcome = 'eligible') x""",
)
def release_schedule(t):
    rows = outcomes(t).where(F.col("outcome") == submit.ELIGIBLE)
    return submit.release_schedule(rows, dt.datetime.fromisoformat(START))


@query(
    "projected_duration",
    f"""WITH {Q.GATED} SELECT count(*) AS posting_rows, round(count(*) / 720.0, 2) AS hours
    FROM gated WHERE outcome = 'eligible'""",
)
def projected_duration(t):
    return submit.projected_duration(outcomes(t).where(F.col("outcome") == submit.ELIGIBLE))


_SENT = "r.published AND r.status = 202"
_FIELDS = {
    "drive_case": "g.drive_case",
    "transcript_file_id": "g.asset_file_id",
    "transcript_gcs_uri": f"CASE WHEN r.published THEN {Q.URI.replace('event_id', 'g.event_id')} ELSE s.transcript_gcs_uri END",
    "webhook_message_id": f"CASE WHEN {_SENT} THEN r.message_id ELSE s.webhook_message_id END",
    "webhook_submitted_at": f"CASE WHEN {_SENT} THEN r.sent_at ELSE s.webhook_submitted_at END",
    "state": "CASE WHEN NOT r.published THEN 'failed_gcs_upload' WHEN r.status = 202 THEN 'submitted' ELSE 'failed_webhook' END",
    "last_error": """CASE WHEN NOT r.published THEN r.publish_error
        WHEN r.status = 400 THEN '400: ' || left(r.body, 300) ELSE s.last_error END""",
    "attempts": f"CAST(s.attempts + CASE WHEN {_SENT} THEN 0 ELSE 1 END AS INT)",
}


@query(
    "apply_submissions",
    f"""WITH {Q.GATED} SELECT {Q.image("s.", **_FIELDS)}
    FROM gated g JOIN state_now s ON s.event_id = g.event_id
      JOIN submission_results r ON r.event_id = g.event_id WHERE outcome = 'eligible'""",
)
def apply_submissions(t):
    box = submit.addressed(outcomes(t), BUCKET, BLOB_PREFIX)
    return submit.apply_submissions(state_now(t), box, t("submission_results"), AT)


_READ = "outcome = 'failed_drive_read'"
_STOPPED = {
    "state": "g.outcome",
    "last_error": "g.outcome_error",
    "attempts": f"CAST(s.attempts + CASE WHEN {_READ} THEN 1 ELSE 0 END AS INT)",
    "drive_case": f"CASE WHEN {_READ} THEN g.drive_case ELSE s.drive_case END",
    "transcript_file_id": f"CASE WHEN {_READ} THEN g.asset_file_id ELSE s.transcript_file_id END",
}


@query(
    "gate_images",
    f"""WITH {Q.GATED} SELECT {Q.image("s.", **_STOPPED)}
    FROM gated g JOIN state_now s ON s.event_id = g.event_id WHERE outcome <> 'eligible'""",
)
def gate_images(t):
    return submit.gated_images(outcomes(t), state_now(t), AT)


@query(
    "report_existing",
    """SELECT event_id, name, file_id, link FROM (
      SELECT s.event_id, d.name, d.file_id, d.link,
        row_number() OVER (PARTITION BY d.name ORDER BY d.file_id) AS rn
      FROM delivered d JOIN state_now s ON d.name = 'reporte_' || s.event_id || '.pdf') x WHERE rn = 1""",
)
def report_existing(t):
    return reports.existing_reports(state_now(t, "event_id"), t("delivered"))
