"""Fixed values of the data contract, and the defaults of every parameter.

Nothing here is computed: these are the names, formats, patterns and texts that
other systems already rely on, so results only match if they stay as they are.
"""

from __future__ import annotations

# ---- parameters that change results (keyword arguments elsewhere) ----------
EVENT_ID_PREFIX = "studio-row"
DEFAULT_GRADE = "No informado"
DEFAULT_SUBJECT = "No informado"
MAX_ATTEMPTS = 5
TIMEOUT_HOURS = 48
POLL_SECONDS = 900
REQUESTS_PER_SECOND = 0.2
MIN_REQUESTS_PER_SECOND = 0.0001
SIGNED_URL_TTL_SECONDS = 21600

# ---- fixed values: roster columns and accepted Spanish headers -------------
ROSTER_COLUMNS = [
    "infrastructureCode", "school", "department", "district", "teacher", "coach",
    "subject", "grade", "section", "shift", "videoLink", "transcriptLink",
]
SPANISH_HEADERS = {
    "codigo de infraestructura": "infrastructureCode",
    "escuela": "school",
    "departamento": "department",
    "distrito": "district",
    "docente": "teacher",
    "coach": "coach",
    "asignatura": "subject",
    "grado": "grade",
    "seccion": "section",
    "turno": "shift",
    "enlace de video": "videoLink",
    "enlace de transcripcion": "transcriptLink",
}
NUMERIC_TEXT_COLUMNS = ["infrastructureCode", "grade"]
POSITION = "row_position"
MISSING_WORD = "sin dato"

# ---- fixed values: media types ---------------------------------------------
GOOGLE_DOC = "application/vnd.google-apps.document"
DOCX = "application/vnd.openxmlformats-officedocument.wordprocessingml.document"
PLAIN_TEXT = "text/plain"
MP4 = "video/mp4"

# ---- fixed values: link patterns by kind, anchored at the start only ---------
# Supported kinds, in the order they are tried; the group is the id.
LINK_PATTERNS = [
    ("doc", r"^https?://docs\.google\.com/document(?:/u/\d+)?/d/([A-Za-z0-9_-]+)"),
    ("file", r"^https?://drive\.google\.com/file(?:/u/\d+)?/d/([A-Za-z0-9_-]+)"),
    ("folder", r"^https?://drive\.google\.com/drive(?:/u/\d+)?/folders/([A-Za-z0-9_-]+)"),
]
# What a link to a file or a folder holds in any case.
ASSET_SITE = "://drive.google.com/"
# Known kinds that are not supported.
UNSUPPORTED_PATTERNS = [
    ("F_sheet", r"^https?://docs\.google\.com/spreadsheets/"),
    ("F_redirect", r"^https?://(?:www\.)?google\.com/url\?"),
]
UNSUPPORTED_OTHER = "F_other"

# ---- fixed values: link cases, in the order a pilot run lists them ---------
CASES = ["A", "B", "C", "D1", "D2", "D3", "F", "E"]

# ---- fixed values: states ---------------------------------------------------
PENDING = "pending"
UPLOADED = "transcript_uploaded"
SUBMITTED = "submitted"
COMPLETED = "completed"
SKIP_NO_LINK = "skipped_no_link"
SKIP_FORMAT = "skipped_unsupported_format"
SKIP_NO_TRANSCRIPT = "skipped_no_transcript"
SKIP_EMPTY_FOLDER = "skipped_no_transcript_in_folder"
FAILED_READ = "failed_drive_read"
FAILED_UPLOAD = "failed_gcs_upload"
FAILED_WEBHOOK = "failed_webhook"
FAILED_PHASE_1 = "failed_phase1"
FAILED_404 = "failed_pdf_404"
FAILED_FETCH = "failed_pdf_fetch"
FAILED_ANALYSIS = "failed_pdf_analysis"
FAILED_DELIVERY = "failed_drive_upload"
FAILED_TIMEOUT = "failed_timeout_pending_analysis"
FAILED_TOO_MANY = "failed_too_many_attempts"

GUARD_STATES = [COMPLETED, SUBMITTED, "pdf_in_drive", "analyzed"]
RETRYABLE_STATES = [FAILED_READ, FAILED_UPLOAD, FAILED_WEBHOOK, FAILED_PHASE_1]
POLLED_STATES = [SUBMITTED, FAILED_404]

# What the state documentation says can happen next, per state.
RETRY_CLASS = [
    (PENDING, "start"),
    (UPLOADED, "transient"),
    (SUBMITTED, "automatic"),
    (COMPLETED, "final"),
    (SKIP_NO_LINK, "not_retryable"),
    (SKIP_FORMAT, "not_retryable"),
    (SKIP_NO_TRANSCRIPT, "not_retryable"),
    (SKIP_EMPTY_FOLDER, "not_retryable"),
    (FAILED_READ, "retry_failed"),
    (FAILED_UPLOAD, "retry_failed"),
    (FAILED_WEBHOOK, "retry_failed"),
    (FAILED_PHASE_1, "retry_failed"),
    (FAILED_404, "automatic"),
    (FAILED_FETCH, "automatic_capped"),
    (FAILED_ANALYSIS, "not_retryable"),
    (FAILED_DELIVERY, "manual"),
    (FAILED_TIMEOUT, "manual"),
    (FAILED_TOO_MANY, "manual"),
]

# ---- fixed values: message texts -------------------------------------------
DIAG_EMPTY = "transcript_link is empty or 'Sin dato'"
DIAG_UNSUPPORTED = "transcript host/path not supported: "
DIAG_NO_CATALOG = "classification only — drive client not provided"
DIAG_NO_CHILD = "folder {folder} has no Doc/.docx/.txt child"
MESSAGE_FORMAT = "[{variant}] transcript no soportado: {url}"
MESSAGE_EMPTY_FOLDER = "carpeta {folder} no contiene Doc/.docx/.txt"
MESSAGE_VIDEO = "file/d is video/mp4 (case {case}), no transcript"
MESSAGE_MIME = "Unsupported mime for transcript: {mime} (file {file})"
MESSAGE_UNREADABLE = "file {file} cannot be read"
ERROR_404 = "not in BQ yet"
ERROR_TERMINAL = "terminal: "

# ---- fixed values: output columns of the annotated roster ------------------
ANNOTATION_COLUMNS = ["event_id_xai", "pdf_drive_link", "backfill_status"]

# ---- fixed values: code prefixes ---------------------------------------------
TEACHER_PREFIX = "studio-teacher-"
COACH_PREFIX = "studio-tutor-"
SCHOOL_PREFIX = "studio-school-"

# ---- error text lengths -------------------------------------------------------
SUBMIT_ERROR_CHARS = 300
COLLECT_ERROR_CHARS = 200
ANNOTATION_ERROR_CHARS = 200
LISTING_ERROR_CHARS = 80
