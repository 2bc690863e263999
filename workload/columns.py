"""Column expressions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.functions import ids, links, payload, responses, text
from rollcall.sources import roster as R
from workload import sqltext as Q
from workload.fixtures import AS_OF, BLOB_PREFIX, BUCKET, SECRET
from workload.ingestion import prepared
from workload.registry import query


@query(
    "slug_names",
    f"""SELECT row_position, {Q.slug('teacher')} AS teacher_slug, {Q.slug('coach')} AS coach_slug,
    {Q.slug('subject')} AS subject_slug FROM roster""",
)
def slug_names(t):
    names = ["teacher", "coach", "subject"]
    return t("roster").select(S.POSITION, *[text.slug(F.col(c)).alias(f"{c}_slug") for c in names])


@query(
    "header_fold",
    f"""SELECT doc_id, lower(trim(regexp_replace({Q.fold('text')}, '\\s+', ' ', 'g'))) AS folded
    FROM documents""",
)
def header_fold(t):
    return t("documents").select("doc_id", text.header_fold(F.col("text")).alias("folded"))


_SHOWN = ["teacher", "coach", "school", "department", "district", "transcriptLink"]


@query(
    "clean_display",
    "SELECT row_position, " + ", ".join(f"{Q.display(c)} AS {c}" for c in _SHOWN) + " FROM roster",
)
def clean_display(t):
    return t("roster").select(S.POSITION, *[text.clean_display(F.col(c)).alias(c) for c in _SHOWN])


@query(
    "normalize_link",
    f"""SELECT row_position, {Q.link('transcriptLink')} AS transcript, {Q.link('videoLink')} AS video
    FROM roster""",
)
def normalize_link(t):
    return t("roster").select(
        S.POSITION,
        text.normalize_link(F.col("transcriptLink")).alias("transcript"),
        text.normalize_link(F.col("videoLink")).alias("video"),
    )


@query(
    "url_kind",
    f"""WITH urls AS (SELECT {Q.link('transcriptLink')} AS url FROM roster
      UNION ALL SELECT {Q.link('videoLink')} FROM roster UNION ALL SELECT url FROM pages)
    SELECT url, {Q.kind('url')} AS kind, {Q.link_id('url')} AS id FROM urls""",
)
def url_kind(t):
    roster = t("roster")
    urls = (
        roster.select(text.normalize_link(F.col("transcriptLink")).alias("url"))
        .unionByName(roster.select(text.normalize_link(F.col("videoLink")).alias("url")))
        .unionByName(t("pages").select("url"))
    )
    return urls.withColumn("k", links.url_kind(F.col("url"))).select("url", "k.kind", "k.id")


@query("event_ids", """SELECT row_position, 'studio-row-' || CAST(row_position AS STRING) AS event_id,
    'again-' || CAST(row_position AS STRING) AS other_id FROM roster""")
def event_ids(t):
    position = F.col(S.POSITION)
    return t("roster").select(
        S.POSITION,
        ids.event_id(position).alias("event_id"),
        ids.event_id(position, "again").alias("other_id"),
    )


@query(
    "entity_codes",
    f"""SELECT row_position, 'studio-teacher-' || {Q.slug('teacher')} AS teacher_code,
    'studio-tutor-' || {Q.slug('coach')} AS coach_code,
    'studio-school-' || {Q.denumbered('infrastructureCode')} AS school_code FROM roster""",
)
def entity_codes(t):
    return prepared(t).select(
        S.POSITION,
        ids.teacher_code(F.col("teacher")).alias("teacher_code"),
        ids.coach_code(F.col("coach")).alias("coach_code"),
        ids.school_code(F.col("infrastructureCode")).alias("school_code"),
    )


@query(
    "grade_subject_defaults",
    f"""SELECT row_position, coalesce({Q.denumbered('grade')}, 'No informado') AS grade,
    coalesce(nullif(subject, ''), 'No informado') AS subject, nullif(section, '') AS section,
    nullif(shift, '') AS shift FROM roster""",
)
def grade_subject_defaults(t):
    return prepared(t).select(
        S.POSITION,
        text.or_default(F.col("grade"), S.DEFAULT_GRADE).alias("grade"),
        text.or_default(F.col("subject"), S.DEFAULT_SUBJECT).alias("subject"),
        text.empty_to_null(F.col("section")).alias("section"),
        text.empty_to_null(F.col("shift")).alias("shift"),
    )


def _bodies(t):
    event = ids.event_id(F.col(S.POSITION))
    uri = ids.blob_uri(event, F.lit("docx"), BUCKET, BLOB_PREFIX)
    recorded = F.lit(AS_OF.replace(" ", "T") + "+00:00")
    body = payload.compact_json(payload.payload_struct(event, recorded, uri))
    return prepared(t).select(S.POSITION, event.alias("event_id"), body.alias("body"))


_BODIES = f"""bodies AS (SELECT row_position, event_id, {Q.body(Q.URI)} AS body
    FROM (SELECT *, 'studio-row-' || CAST(row_position AS STRING) AS event_id, 'docx' AS ext FROM roster) r)"""


@query("payload_json", f"WITH {_BODIES} SELECT row_position, body FROM bodies")
def payload_json(t):
    return _bodies(t).select(S.POSITION, "body")


@query(
    "payload_signature",
    f"""WITH {_BODIES} SELECT row_position,
    'sha256=' || {Q.hmac(f"'{Q.AS_OF_EPOCH}.' || body")} AS signature FROM bodies""",
)
def payload_signature(t):
    pads = payload.secret_pads(t.spark, SECRET)
    sign = payload.signature(F.lit(int(Q.AS_OF_EPOCH)), F.col("body"), pads)
    return _bodies(t).select(S.POSITION, sign.alias("signature"))


@query("terminal_422", f"SELECT seq, status, {Q.TERMINAL} AS terminal FROM response_log")
def terminal_422(t):
    found = responses.terminal_422(F.col("status"), F.col("body"))
    return t("response_log").select("seq", "status", found.alias("terminal"))


@query("report_url", f"SELECT seq, {Q.REPORT_URL} AS url FROM response_log")
def report_url(t):
    url = responses.report_url(F.col("status"), F.col("body"))
    return t("response_log").select("seq", url.alias("url"))


@query(
    "error_truncate",
    """SELECT log_seq, left(coalesce(last_error, ''), 300) AS submit_error,
    left(coalesce(last_error, ''), 200) AS collect_error,
    left(coalesce(last_error, ''), 80) AS listed_error FROM state_log""",
)
def error_truncate(t):
    error = F.col("last_error")
    return t("state_log").select(
        "log_seq",
        text.truncate(error, S.SUBMIT_ERROR_CHARS).alias("submit_error"),
        text.truncate(error, S.COLLECT_ERROR_CHARS).alias("collect_error"),
        text.truncate(error, S.LISTING_ERROR_CHARS).alias("listed_error"),
    )


@query(
    "snapshot_json",
    f"""SELECT row_position, {Q.denumbered('infrastructureCode')} AS infrastructureCode,
    {Q.denumbered('grade')} AS grade, {Q.CELLS} FROM roster""",
)
def snapshot_json(t):
    rows = prepared(t)
    text_ = R.snapshot(rows.columns).alias("snapshot")
    back = R.from_snapshot(F.col("snapshot"), R.roster_schema())
    return rows.select(text_).select(back.alias("r")).select("r.*")


@query(
    "full_name",
    """SELECT code, nullif(trim(first_name || ' ' || last_name), '') AS full_name FROM users""",
)
def full_name(t):
    name = text.full_name(F.col("first_name"), F.col("last_name"))
    return t("users").select("code", name.alias("full_name"))


@query(
    "deadline",
    """SELECT seq, ts - INTERVAL 48 HOURS AS cutoff, ts + INTERVAL 21600 SECONDS AS url_expires_at
    FROM response_log""",
)
def deadline(t):
    ts = F.col("ts")
    return t("response_log").select(
        "seq",
        ids.hours_before(ts, S.TIMEOUT_HOURS).alias("cutoff"),
        ids.seconds_after(ts, F.lit(S.SIGNED_URL_TTL_SECONDS)).alias("url_expires_at"),
    )


@query(
    "blob_layout",
    f"""SELECT row_position, '{BLOB_PREFIX}/studio-row-' || CAST(row_position AS STRING)
      || '/transcript.docx' AS blob_path,
    'gs://{BUCKET}/{BLOB_PREFIX}/studio-row-' || CAST(row_position AS STRING)
      || '/transcript.txt' AS blob_uri FROM roster""",
)
def blob_layout(t):
    event = ids.event_id(F.col(S.POSITION))
    return t("roster").select(
        S.POSITION,
        ids.blob_path(event, F.lit("docx"), f"/{BLOB_PREFIX}/").alias("blob_path"),
        ids.blob_uri(event, F.lit("txt"), BUCKET, BLOB_PREFIX).alias("blob_uri"),
    )


@query("report_name", """SELECT row_position, 'reporte_studio-row-' || CAST(row_position AS STRING)
    || '.pdf' AS report_name FROM roster""")
def report_name(t):
    event = ids.event_id(F.col(S.POSITION))
    return t("roster").select(S.POSITION, ids.report_name(event).alias("report_name"))
