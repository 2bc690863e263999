"""Fixture views over the given tables, in SQL both engines accept."""

from __future__ import annotations

DOC = "application/vnd.google-apps.document"
DOCX = "application/vnd.openxmlformats-officedocument.wordprocessingml.document"

VIEWS: dict[str, str] = {}

# A roster with the case mix of a real one: accents, missing words, nulls, blanks
# and numbers that arrive as doubles.
VIEWS["roster"] = """
SELECT CAST(o_orderkey + 1 AS BIGINT) AS row_position,
  CAST(c_nationkey * 1000 + 11 AS DOUBLE) AS infrastructureCode,
  n_name AS school, r_name AS department, c_mktsegment AS district,
  CASE WHEN o_custkey % 50 = 0 THEN 'Sin dato' WHEN o_custkey % 50 = 1 THEN NULL
       ELSE 'PÉREZ ÑUÑEZ, ' || c_name END AS teacher,
  'García ' || CAST(o_custkey % 40 AS STRING) AS coach,
  o_orderpriority AS subject,
  CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE CAST(o_orderkey % 9 + 1 AS DOUBLE) END AS grade,
  CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderstatus END AS section,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Matutino' ELSE NULL END AS shift,
  CASE WHEN o_orderkey % 1000 < 984 OR o_orderkey % 1000 IN (992, 993, 994, 997, 998)
         THEN 'https://drive.google.com/file/d/VID' || CAST(o_orderkey AS STRING) || '/view'
       WHEN o_orderkey % 1000 < 992
         THEN 'https://drive.google.com/file/d/FILE' || CAST(o_orderkey AS STRING) || '/view'
       WHEN o_orderkey % 1000 < 997
         THEN 'https://docs.google.com/document/d/DOC' || CAST(o_orderkey AS STRING) || '/edit'
       ELSE 'https://drive.google.com/drive/folders/FOLD' || CAST(o_orderkey AS STRING)
  END AS videoLink,
  CASE WHEN o_orderkey % 1000 < 652
         THEN 'https://docs.google.com/document'
           || CASE WHEN o_orderkey % 3 = 0 THEN '/u/0' ELSE '' END
           || '/d/DOC' || CAST(o_orderkey AS STRING) || '/edit'
       WHEN o_orderkey % 1000 < 984
         THEN CASE o_orderkey % 4 WHEN 0 THEN 'Sin dato' WHEN 1 THEN '' WHEN 2 THEN NULL
              ELSE ' SIN DATO ' END
       WHEN o_orderkey % 1000 < 995
         THEN 'https://drive.google.com/file/d/FILE' || CAST(o_orderkey AS STRING) || '/view'
       WHEN o_orderkey % 1000 < 997
         THEN 'https://docs.google.com/document/d/DOC' || CAST(o_orderkey AS STRING) || '/edit'
       WHEN o_orderkey % 1000 IN (997, 999)
         THEN 'https://drive.google.com/drive/folders/FOLD' || CAST(o_orderkey AS STRING)
       ELSE CASE CAST(floor(o_orderkey / 1000) AS BIGINT) % 3
              WHEN 0 THEN 'https://docs.google.com/spreadsheets/d/S/edit'
              WHEN 1 THEN 'https://www.google.com/url?q=x'
              ELSE 'https://example.com/t.pdf' END
  END AS transcriptLink
FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

# The same roster with one row in a hundred entirely blank, and an unknown column.
# The source ordinal is not the position: blank rows take none.
VIEWS["roster_with_blanks"] = """
SELECT row_position AS src_ord,
  CASE WHEN row_position % 100 <> 7 THEN infrastructureCode END AS infrastructureCode,
  CASE WHEN row_position % 100 <> 7 THEN school END AS school,
  CASE WHEN row_position % 100 <> 7 THEN department END AS department,
  CASE WHEN row_position % 100 <> 7 THEN district END AS district,
  CASE WHEN row_position % 100 <> 7 THEN teacher END AS teacher,
  CASE WHEN row_position % 100 <> 7 THEN coach END AS coach,
  CASE WHEN row_position % 100 <> 7 THEN subject END AS subject,
  CASE WHEN row_position % 100 <> 7 THEN grade END AS grade,
  CASE WHEN row_position % 100 <> 7 THEN section END AS section,
  CASE WHEN row_position % 100 <> 7 THEN shift END AS shift,
  CASE WHEN row_position % 100 <> 7 THEN videoLink END AS videoLink,
  CASE WHEN row_position % 100 <> 7 THEN transcriptLink END AS transcriptLink
FROM roster
"""

# Files behind links, and children of folders: some trashed, some unusable. Files
# of cheap orders are missing; some are listed again in a folder, under another type.
VIEWS["asset_catalog"] = f"""
SELECT 'FILE' || CAST(o_orderkey AS STRING) AS file_id, CAST(NULL AS STRING) AS folder_id,
  'f' || CAST(o_orderkey AS STRING) AS name,
  CASE o_orderkey % 4 WHEN 0 THEN 'video/mp4' WHEN 1 THEN '{DOCX}' WHEN 2 THEN 'text/plain'
    ELSE 'application/pdf' END AS mime,
  false AS trashed, CAST(0 AS BIGINT) AS list_order
FROM orders WHERE o_totalprice > 40000
UNION ALL
SELECT 'CH' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_'
    || CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING),
  'FOLD' || CAST(l_orderkey AS STRING), 'child',
  CASE l_partkey % 5 WHEN 0 THEN '{DOC}' WHEN 1 THEN '{DOCX}' WHEN 2 THEN 'text/plain'
    ELSE 'video/mp4' END,
  l_returnflag = 'R', CAST(l_partkey * 1000 + l_suppkey AS BIGINT)
FROM lineitem
UNION ALL
SELECT 'FILE' || CAST(o_orderkey AS STRING), 'SHELF' || CAST(o_orderkey % 90 AS STRING), 'again',
  CASE WHEN o_orderkey % 3 = 0 THEN 'text/plain' ELSE 'video/mp4' END,
  o_orderkey % 5 = 0, CAST(o_orderkey % 2 AS BIGINT)
FROM orders WHERE o_orderkey % 4 < 2
"""

# Which stored text a file holds. Documents of very expensive orders are unreadable.
VIEWS["content_index"] = """
SELECT 'DOC' || CAST(o_orderkey AS STRING) AS file_id,
  CAST(o_orderkey % (SELECT count(*) FROM documents) AS BIGINT) AS content_id
FROM orders WHERE o_totalprice < 480000
UNION ALL
SELECT 'FILE' || CAST(o_orderkey AS STRING),
  CAST(o_orderkey % (SELECT count(*) FROM documents) AS BIGINT)
FROM orders
UNION ALL
SELECT 'FILE' || CAST(o_orderkey AS STRING),
  CAST(o_orderkey * 7 % (SELECT count(*) FROM documents) AS BIGINT)
FROM orders WHERE o_orderkey % 3 = 0
UNION ALL
SELECT 'CH' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_'
    || CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING),
  CAST(l_partkey % (SELECT count(*) FROM documents) AS BIGINT)
FROM lineitem
"""

VIEWS["content"] = "SELECT doc_id AS content_id, text AS content FROM documents"

# Poll answers: finished, processing, failed, not there yet, throttled, broken.
VIEWS["response_log"] = """
SELECT event_id AS seq, ts,
  'studio-row-' || CAST((event_id * 7919)
      % (SELECT CAST(floor(count(*) * 0.3) AS BIGINT) FROM events) + 1 AS STRING) AS event_id,
  CASE event_type WHEN 'purchase' THEN 200 WHEN 'view' THEN 422
    WHEN 'error' THEN CASE WHEN value > 40 THEN 422 ELSE 503 END
    WHEN 'click' THEN 404 ELSE CASE WHEN value > 40 THEN 429 ELSE 500 END END AS status,
  CASE event_type
    WHEN 'purchase' THEN CASE WHEN value > 5
        THEN '{"url":"https://x/' || CAST(event_id AS STRING) || '"}' ELSE '{}' END
    WHEN 'view' THEN '{"detail":{"pipeline_status":"processing"}}'
    WHEN 'error' THEN CASE WHEN value > 40 THEN '{"detail":{"reason":"data_incomplete"}}'
        ELSE 'oops' END
    ELSE NULL END AS body,
  event_type = 'purchase' AND event_id % 10 = 0 AS delivery_failed
FROM events
"""

# State of each polled event when its responses start.
VIEWS["poll_state"] = """
SELECT CAST(substring(event_id, 12) AS BIGINT) AS row_position, event_id,
  CASE CAST(substring(event_id, 12) AS BIGINT) % 10 WHEN 0 THEN 'failed_pdf_404'
    WHEN 1 THEN 'failed_pdf_fetch' WHEN 2 THEN 'completed' ELSE 'submitted' END AS state,
  CASE CAST(substring(event_id, 12) AS BIGINT) % 10 WHEN 0 THEN 'not in BQ yet'
    WHEN 1 THEN 'HTTP 500: early' ELSE NULL END AS last_error,
  CAST(min(seq) % 3 AS INT) AS attempts,
  min(ts) AS webhook_submitted_at
FROM response_log GROUP BY event_id
"""

# A log of full images: one pending image per event, then one per later change.
VIEWS["state_log"] = """
SELECT CAST(substring(event_id, 12) AS BIGINT) AS row_position, event_id,
  CASE WHEN seq % 7 = 3 THEN NULL ELSE 'A' END AS drive_case,
  CASE WHEN seq % 7 = 3 THEN NULL ELSE 'DOC' || substring(event_id, 12) END AS transcript_file_id,
  CASE WHEN seq % 7 = 3 THEN NULL
    ELSE 'gs://bucket/backfill/' || event_id || '/transcript.docx' END AS transcript_gcs_uri,
  CASE WHEN seq % 7 = 3 THEN NULL ELSE 'm' || CAST(seq AS STRING) END AS webhook_message_id,
  CASE WHEN seq % 7 = 3 THEN NULL ELSE ts END AS webhook_submitted_at,
  CASE WHEN status = 200 THEN 'reporte_' || event_id || '.pdf' ELSE NULL END AS pdf_drive_id,
  CASE WHEN status = 200 THEN 'https://x/' || CAST(seq AS STRING) ELSE NULL END AS pdf_drive_link,
  CASE WHEN status = 200 THEN 'completed'
    WHEN status = 404 THEN 'failed_pdf_404'
    WHEN status = 422 AND seq % 5 = 0 THEN 'failed_pdf_analysis'
    WHEN status = 422 THEN 'submitted'
    WHEN status = 503 THEN 'failed_pdf_fetch'
    WHEN status = 429 THEN CASE seq % 3 WHEN 0 THEN 'failed_webhook' WHEN 1 THEN 'skipped_no_link'
      ELSE 'failed_timeout_pending_analysis' END
    ELSE CASE seq % 7 WHEN 0 THEN 'failed_drive_read' WHEN 1 THEN 'failed_gcs_upload'
      WHEN 2 THEN 'failed_phase1' WHEN 3 THEN 'pending' WHEN 4 THEN 'skipped_unsupported_format'
      WHEN 5 THEN 'failed_drive_upload' ELSE 'failed_pdf_fetch' END
  END AS state,
  CASE WHEN status IN (200, 422) THEN NULL
    ELSE 'HTTP ' || CAST(status AS STRING) || ': ' || repeat('detail ', CAST(seq % 60 AS INT)) END AS last_error,
  ts AS last_attempt_at,
  CAST(seq % 8 AS INT) AS attempts,
  '{"row_position":' || substring(event_id, 12) || ',"teacher":"T ' || CAST(seq AS STRING)
    || '","grade":"' || CAST(seq % 9 AS STRING) || '","section":null}' AS excel_row_json,
  ts AS log_ts, seq AS log_seq,
  CASE WHEN status IN (404, 429) OR status >= 500 THEN 1 ELSE 0 END AS attempts_added
FROM response_log
"""

# The state table the log ends in.
VIEWS["state_now"] = """
SELECT row_position, event_id, drive_case, transcript_file_id, transcript_gcs_uri,
  webhook_message_id, webhook_submitted_at, pdf_drive_id, pdf_drive_link, state, last_error,
  last_attempt_at, attempts, excel_row_json, log_ts, log_seq
FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY log_ts DESC, log_seq DESC) AS rn
  FROM state_log) x WHERE rn = 1
"""

# Answers of the submission service.
VIEWS["submission_results"] = """
SELECT 'studio-row-' || CAST(o_orderkey + 1 AS STRING) AS event_id,
  o_orderpriority <> '5-LOW' AS published,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'upload refused' ELSE NULL END AS publish_error,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus = 'F' THEN 400 ELSE 202 END AS status,
  CASE WHEN o_orderpriority <> '5-LOW' AND o_orderstatus <> 'F'
    THEN 'msg-' || CAST(o_orderkey AS STRING) ELSE NULL END AS message_id,
  CASE WHEN o_orderstatus = 'F' THEN 'bad request ' || repeat('x', 400) ELSE NULL END AS body,
  o_orderdate AS sent_at
FROM orders
"""

# Reports already delivered; some names occur twice.
VIEWS["delivered"] = """
SELECT 'D' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_'
    || CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING) AS file_id,
  'reporte_studio-row-' || CAST(l_orderkey + 1 AS STRING) || '.pdf' AS name,
  'https://x/' || CAST(l_partkey AS STRING) AS link
FROM lineitem
"""

# ---- warehouse star -------------------------------------------------------------
VIEWS["sessions"] = """
SELECT CAST(o_orderkey AS STRING) AS session_id,
  'studio-row-' || CAST(o_orderkey + 1 AS STRING) AS scheduling_app_event_id,
  'studio-school-' || CAST(c_nationkey AS STRING) AS school_code,
  'T' || CAST(o_custkey AS STRING) AS teacher_code,
  'C' || CAST(o_orderkey % (SELECT count(*) FROM supplier) AS STRING) AS coach_code,
  CAST(o_orderkey % 9 + 1 AS STRING) AS grade, o_orderstatus AS section,
  o_orderpriority AS subject, c_mktsegment AS shift,
  CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'processed' ELSE 'submitted' END AS pipeline_status,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'failed' ELSE 'ok' END AS session_status,
  o_orderpriority = '5-LOW' AS is_deleted, o_orderdate AS updated_at,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 4 > 0
    THEN 'step ' || CAST(o_orderkey % 4 AS STRING) || ' failed' ELSE NULL END AS error_message
FROM orders JOIN customer ON o_custkey = c_custkey
"""

# The operational copy of the sessions.
VIEWS["operational_sessions"] = """
SELECT 'op-' || session_id AS id, scheduling_app_event_id, school_code, teacher_code, coach_code,
  grade, subject, pipeline_status, session_status AS status, updated_at AS recorded_at,
  updated_at AS created_at
FROM sessions
"""

VIEWS["users"] = """
SELECT 'T' || CAST(c_custkey AS STRING) AS code,
  CASE WHEN c_custkey % 50 = 0 THEN ' ' ELSE c_name END AS first_name,
  CASE WHEN c_custkey % 50 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 7 = 0 THEN NULL
    ELSE c_mktsegment END AS last_name,
  'teacher' AS role, 'studio-school-' || CAST(c_nationkey AS STRING) AS school_code,
  '2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0') AS created_at
FROM customer
UNION ALL
SELECT 'C' || CAST(s_suppkey AS STRING), s_name, '', 'coach',
  'studio-school-' || CAST(s_nationkey AS STRING),
  '2024-02-' || lpad(CAST(s_suppkey % 28 + 1 AS STRING), 2, '0')
FROM supplier
"""

VIEWS["dim_users"] = """
SELECT code AS user_code,
  CASE WHEN trim(first_name || ' ' || last_name) = '' THEN NULL
    ELSE trim(first_name || ' ' || last_name) END AS full_name, role
FROM users
"""

VIEWS["schools"] = """
SELECT 'studio-school-' || CAST(n_nationkey AS STRING) AS code, n_name AS name,
  r_name AS department, 'D' || CAST(n_nationkey % 7 AS STRING) AS district,
  '2024-01-' || lpad(CAST(n_nationkey + 1 AS STRING), 2, '0') AS created_at
FROM nation JOIN region ON n_regionkey = r_regionkey
"""

VIEWS["dim_schools"] = """
SELECT code AS school_code, name AS school_name, department, district FROM schools
"""

VIEWS["analysis_runs"] = """
SELECT CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_'
    || CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING) AS analysis_run_id,
  CAST(l_orderkey AS STRING) AS session_id, l_linestatus AS status,
  CASE WHEN l_linenumber = 1 THEN NULL ELSE l_shipdate END AS completed_at
FROM lineitem
"""

VIEWS["analysis_results"] = """
SELECT CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_'
    || CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING) AS analysis_run_id,
  CASE WHEN l_tax = 0 THEN NULL ELSE l_discount * 100 END AS overall_score,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE '{"flag":"' || l_returnflag || '"}' END AS results_data
FROM lineitem WHERE l_quantity > 5
"""

# ---- parameters --------------------------------------------------------------------
AS_OF = "2024-01-25 12:00:00"
START = "2024-02-01 00:00:00"
SECRET = "test-key-for-checks"
BUCKET = "bucket"
BLOB_PREFIX = "backfill"
