"""Pieces of check SQL used by several checks."""

from __future__ import annotations

from rollcall import settings as S
from workload.fixtures import AS_OF, BLOB_PREFIX, BUCKET, DOC, DOCX, SECRET

CELLS = (
    "school, department, district, teacher, coach, subject, section, shift, videoLink, transcriptLink"
)


def fold(x: str) -> str:
    return f"regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g')"


def slug(x: str) -> str:
    text = f"upper(trim(regexp_replace({fold(x)}, '[^A-Za-z0-9]+', '-', 'g'), '-'))"
    return f"coalesce(nullif({text}, ''), 'UNKNOWN')"


IMAGE = [
    "row_position", "event_id", "drive_case", "transcript_file_id", "transcript_gcs_uri", "webhook_message_id",
    "webhook_submitted_at", "pdf_drive_id", "pdf_drive_link", "state", "last_error", "last_attempt_at", "attempts",
    "excel_row_json", "log_ts", "log_seq",
]


def image(of: str = "", **fields: str) -> str:
    """All columns of a row image: those given, and the stamps of a change, replace its own."""
    stamped = {
        "last_attempt_at": f"TIMESTAMP '{AS_OF}'", "log_ts": f"greatest({of}log_ts, TIMESTAMP '{AS_OF}')",
        "log_seq": f"{of}log_seq + 1",
    } | fields
    return ", ".join(f"{stamped.get(c, of + c)} AS {c}" for c in IMAGE)


def link(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR lower(trim({x})) = 'sin dato' THEN '' ELSE trim({x}) END"


def display(x: str) -> str:
    return f"CASE WHEN trim({x}) = '' OR lower(trim({x})) = 'sin dato' THEN NULL ELSE trim({x}) END"


def denumbered(x: str) -> str:
    return (
        f"CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS STRING) "
        f"ELSE CAST({x} AS STRING) END"
    )


def kind(u: str) -> str:
    known = "".join(
        f" WHEN regexp_matches({u}, '{pattern}') THEN '{name}'" for name, pattern in S.LINK_PATTERNS + S.UNSUPPORTED_PATTERNS
    )
    return f"CASE WHEN {u} = '' THEN 'empty'{known} ELSE '{S.UNSUPPORTED_OTHER}' END"


def link_id(u: str) -> str:
    found = "".join(
        f" WHEN regexp_matches({u}, '{pattern}') THEN regexp_extract({u}, '{pattern}', 1)" for _, pattern in S.LINK_PATTERNS
    )
    return f"CASE{found} END"


# Roster rows with their link facts: `cases` as the name of a table expression.
CASES = f"""kinds AS (
  SELECT *, {kind('t')} AS kind, {link_id('t')} AS link_id, t = v AS same
  FROM (SELECT *, {link('transcriptLink')} AS t, {link('videoLink')} AS v FROM roster) r),
cases AS (
  SELECT *, CASE WHEN kind = 'empty' THEN 'E'
    WHEN kind = 'doc' THEN CASE WHEN same THEN 'D3' ELSE 'A' END
    WHEN kind = 'file' THEN CASE WHEN same THEN 'D2' ELSE 'B' END
    WHEN kind = 'folder' THEN CASE WHEN same THEN 'D1' ELSE 'C' END
    ELSE 'F' END AS drive_case,
    'studio-row-' || CAST(row_position AS STRING) AS event_id
  FROM kinds)"""

PICKS = f"""picks AS (
  SELECT folder_id, file_id, mime FROM (
    SELECT folder_id, file_id, mime, row_number() OVER (PARTITION BY folder_id
      ORDER BY CASE mime WHEN '{DOC}' THEN 0 WHEN '{DOCX}' THEN 1 ELSE 2 END, list_order, file_id) AS rn
    FROM asset_catalog
    WHERE folder_id IS NOT NULL AND NOT trashed AND mime IN ('{DOC}', '{DOCX}', 'text/plain')) x
  WHERE rn = 1)"""

# One type per file: the listing that counts first.
TYPES = """types AS (
  SELECT file_id, mime FROM (SELECT file_id, mime, row_number() OVER (PARTITION BY file_id
    ORDER BY trashed, list_order, folder_id NULLS FIRST, mime) AS rn FROM asset_catalog) x WHERE rn = 1)"""

# All of phase-1 gating: `gated` has outcome and outcome_error per open row.
GATED = f"""{CASES}, {PICKS}, {TYPES},
busy AS (
  SELECT event_id FROM state_now WHERE state IN ('completed', 'submitted', 'pdf_in_drive', 'analyzed')),
open_rows AS (
  SELECT *, CASE WHEN drive_case IN ('C', 'D1') THEN link_id END AS folder_key,
    CASE WHEN drive_case IN ('B', 'D2') THEN link_id END AS file_key
  FROM cases WHERE NOT EXISTS (SELECT 1 FROM busy WHERE busy.event_id = cases.event_id)),
found AS (
  SELECT o.*,
    CASE WHEN drive_case IN ('C', 'D1') THEN p.file_id WHEN kind IN ('doc', 'file') THEN link_id END AS asset_file_id,
    CASE WHEN drive_case IN ('A', 'D3') THEN '{DOC}' ELSE coalesce(p.mime, f.mime) END AS asset_mime
  FROM open_rows o
  LEFT JOIN picks p ON p.folder_id = o.folder_key
  LEFT JOIN types f ON f.file_id = o.file_key),
contents AS (SELECT file_id, min(content_id) AS content_id FROM content_index GROUP BY file_id),
stored AS (
  SELECT found.*, content_id FROM found LEFT JOIN contents c ON c.file_id = found.asset_file_id),
gated AS MATERIALIZED (
  SELECT *, CASE
    WHEN drive_case = 'E' THEN 'skipped_no_link'
    WHEN drive_case = 'F' THEN 'skipped_unsupported_format'
    WHEN drive_case IN ('C', 'D1') AND asset_file_id IS NULL THEN 'skipped_no_transcript_in_folder'
    WHEN drive_case IN ('B', 'D2') AND asset_mime = 'video/mp4' THEN 'skipped_no_transcript'
    WHEN asset_mime IS NULL OR asset_mime NOT IN ('{DOC}', '{DOCX}', 'text/plain') THEN 'failed_drive_read'
    WHEN content_id IS NULL THEN 'failed_drive_read'
    ELSE 'eligible' END AS outcome,
  CASE
    WHEN drive_case = 'E' THEN 'transcript_link is empty or ''Sin dato'''
    WHEN drive_case = 'F' THEN '[' || kind || '] transcript no soportado: ' || t
    WHEN drive_case IN ('C', 'D1') AND asset_file_id IS NULL
      THEN 'carpeta ' || link_id || ' no contiene Doc/.docx/.txt'
    WHEN drive_case IN ('B', 'D2') AND asset_mime = 'video/mp4'
      THEN 'file/d is video/mp4 (case ' || drive_case || '), no transcript'
    WHEN asset_mime NOT IN ('{DOC}', '{DOCX}', 'text/plain')
      THEN 'Unsupported mime for transcript: ' || asset_mime || ' (file ' || asset_file_id || ')'
    WHEN asset_mime IS NULL OR content_id IS NULL THEN 'file ' || asset_file_id || ' cannot be read'
    END AS outcome_error,
  CASE WHEN asset_mime = 'text/plain' THEN 'txt' ELSE 'docx' END AS ext
  FROM stored)"""

AS_OF_EPOCH = "1706184000"  # AS_OF in seconds


def json_text(x: str) -> str:
    """JSON text of a string; the roster's accented letters as escapes."""
    out = x
    for char in "ÉÑéíáóúñ":
        out = f"replace({out}, '{char}', '\\u{ord(char):04x}')"
    return f"'\"' || {out} || '\"'"


def _optional(name: str, x: str) -> str:
    return f"""CASE WHEN {x} IS NULL THEN '' ELSE ',"{name}":' || {json_text(x)} END"""


def body(url: str) -> str:
    """The submission body, byte for byte."""
    def plain(name, x):
        return f"""'"{name}":' || {json_text(x)}"""

    required = " || ',' || ".join(
        [
            plain("event_id", "event_id"),
            plain("teacher_code", f"('studio-teacher-' || {slug('teacher')})"),
            plain("coach_code", f"('studio-tutor-' || {slug('coach')})"),
            plain("school_code", f"('studio-school-' || {denumbered('infrastructureCode')})"),
            plain("grade", f"coalesce({denumbered('grade')}, 'No informado')"),
            plain("subject", "coalesce(nullif(subject, ''), 'No informado')"),
            plain("recorded_at", f"'{AS_OF.replace(' ', 'T')}+00:00'"),
        ]
    )
    optional = " || ".join(
        [
            _optional("section", "nullif(section, '')"),
            _optional("shift", "nullif(shift, '')"),
            _optional("teacher_name", f"({display('teacher')})"),
            _optional("coach_name", f"({display('coach')})"),
            _optional("school_name", f"({display('school')})"),
            _optional("school_department", f"({display('department')})"),
            _optional("school_district", f"({display('district')})"),
        ]
    )
    return (
        f"""'{{"kwargs":{{"signed_url":' || {json_text(url)} || ',"params":{{' || {required}"""
        f""" || {optional} || '}}}}}}'"""
    )


def _pad_hex(byte: int) -> str:
    key = SECRET.encode().ljust(64, b"\0")
    return bytes(b ^ byte for b in key).hex()


def hmac(message: str) -> str:
    inner = f"sha256(unhex('{_pad_hex(0x36)}') || encode({message}))"
    return f"sha256(unhex('{_pad_hex(0x5C)}') || unhex({inner}))"


URI = f"('gs://{BUCKET}/{BLOB_PREFIX}/' || event_id || '/transcript.' || ext)"


# ---- reconciliation ------------------------------------------------------------------
def json_field(path: str) -> str:
    return f"CASE WHEN json_valid(body) THEN json_extract_string(body, '{path}') END"


TERMINAL = (
    f"status = 422 AND (coalesce({json_field('$.detail.pipeline_status')}, '') = 'failed' "
    f"OR coalesce({json_field('$.detail.session_status')}, '') = 'failed' "
    f"OR coalesce({json_field('$.detail.reason')}, '') = 'data_incomplete')"
)
REPORT_URL = f"CASE WHEN status = 200 THEN nullif({json_field('$.url')}, '') END"

OUTCOMES = f"""outcomes AS (
  SELECT event_id, seq, ts, CASE WHEN NOT delivery_failed THEN url END AS url,
    CASE WHEN url IS NOT NULL AND delivery_failed THEN 'failed_drive_upload'
      WHEN url IS NOT NULL THEN 'completed'
      WHEN terminal THEN 'failed_pdf_analysis'
      WHEN status = 422 THEN 'submitted' WHEN status = 404 THEN 'failed_pdf_404'
      WHEN status = 429 THEN NULL ELSE 'failed_pdf_fetch' END AS st,
    CASE WHEN url IS NOT NULL AND delivery_failed THEN 1 WHEN url IS NOT NULL THEN 0
      WHEN status IN (422, 404, 429) THEN 0 ELSE 1 END AS inc,
    CASE WHEN url IS NOT NULL AND delivery_failed THEN 'report delivery failed'
      WHEN url IS NOT NULL THEN NULL
      WHEN terminal THEN 'terminal: ' || body
      WHEN status = 422 THEN NULL WHEN status = 404 THEN 'not in BQ yet'
      WHEN status = 429 THEN NULL
      ELSE 'HTTP ' || CAST(status AS STRING) || ': ' || left(coalesce(body, ''), 200) END AS err
  FROM (SELECT *, {REPORT_URL} AS url, {TERMINAL} AS terminal FROM response_log) r)"""

FOLD = f"""{OUTCOMES},
pool AS (SELECT * FROM poll_state WHERE state IN ('submitted', 'failed_pdf_404')
  OR (state = 'failed_pdf_fetch' AND attempts < 5)),
f1 AS (
  SELECT o.*, p.state AS state0, p.last_error AS error0, p.attempts AS attempts0,
    p.webhook_submitted_at + INTERVAL 48 HOURS AS deadline,
    coalesce(last_value(st IGNORE NULLS) OVER w, p.state) AS st_before,
    coalesce(last_value(err IGNORE NULLS) OVER w, p.last_error) AS err_before
  FROM outcomes o JOIN pool p ON p.event_id = o.event_id
  WINDOW w AS (PARTITION BY o.event_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f2 AS (SELECT *, st_before = 'submitted' AND ts > deadline AS tmo FROM f1),
f3 AS (
  SELECT *, attempts0 + sum(CASE WHEN tmo THEN 0 ELSE inc END) OVER (PARTITION BY event_id
    ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS att FROM f2),
f4 AS (
  SELECT *, CASE WHEN tmo OR st IN ('completed', 'failed_drive_upload', 'failed_pdf_analysis')
    OR (st = 'failed_pdf_fetch' AND att >= 5) THEN 1 ELSE 0 END AS ends FROM f3),
f5 AS (
  SELECT *, coalesce(sum(ends) OVER (PARTITION BY event_id ORDER BY ts, seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ended FROM f4),
f6 AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, seq DESC) AS rn,
    count(*) OVER (PARTITION BY event_id) AS polls
  FROM f5 WHERE ended = 0),
folded AS (
  SELECT event_id, CASE WHEN tmo THEN 'failed_timeout_pending_analysis' ELSE coalesce(st, st_before) END AS state,
    CAST(att AS INT) AS attempts,
    CASE WHEN tmo THEN 'timeout after 48h in submitted' ELSE coalesce(err, err_before) END AS last_error,
    CASE WHEN tmo THEN NULL ELSE url END AS pdf_url, ts AS decided_at, seq AS last_seq,
    CAST(polls AS BIGINT) AS polls
  FROM f6 WHERE rn = 1)"""
