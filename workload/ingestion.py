"""Sources: roster, catalog, responses, state log, fingerprints."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.operators.ordering import dense_index
from rollcall.operators.scratch import materialize, new_path, shuffle_partitions
from rollcall.plans import reports, submit
from rollcall.sources import catalog, fingerprint, responses, roster, statelog
from workload import sqltext as Q
from workload.fixtures import AS_OF
from workload.registry import query

AT = dt.datetime.fromisoformat(AS_OF)
SPANISH = [
    "Código de Infraestructura", "ESCUELA", " Departamento ", "distrito", "Docente", "Coach",
    "Asignatura", "GRADO", "Sección", "Turno", "Enlace  de  video", "enlace de transcripción",
]
ROW = "row_position, infrastructureCode, grade, " + Q.CELLS


@query(
    "roster_scan",
    f"""SELECT CAST(row_position AS STRING) AS row_position,
    CAST(infrastructureCode AS STRING) AS infrastructureCode, CAST(grade AS STRING) AS grade, {Q.CELLS}
    FROM roster""",
)
def roster_scan(t):
    path = new_path(t.spark, "roster-csv")
    reports.write_annotated(t("roster"), path, "csv")
    raw = roster.read_roster_file(t.spark, path, "csv")
    return raw.drop(*roster.SOURCE_ORDER)


@query("roster_canonicalize", f"SELECT {ROW}, shift AS \"Observación\" FROM roster")
def roster_canonicalize(t):
    source = t("roster").select(S.POSITION, *S.ROSTER_COLUMNS, F.col("shift").alias("Observación"))
    return roster.canonicalize(source.toDF(S.POSITION, *SPANISH, "Observación"))


@query(
    "roster_drop_blank",
    """SELECT * FROM roster_with_blanks WHERE NOT (infrastructureCode IS NULL AND school IS NULL
    AND department IS NULL AND district IS NULL AND teacher IS NULL AND coach IS NULL
    AND subject IS NULL AND grade IS NULL AND section IS NULL AND shift IS NULL
    AND videoLink IS NULL AND transcriptLink IS NULL)""",
)
def roster_drop_blank(t):
    return roster.drop_blank(t("roster_with_blanks"), S.ROSTER_COLUMNS)


@query(
    "roster_positions",
    f"""SELECT src_ord, {Q.denumbered('infrastructureCode')} AS infrastructureCode,
    {Q.denumbered('grade')} AS grade, {Q.CELLS}, CAST(row_number() OVER (ORDER BY src_ord) AS BIGINT) AS row_position
    FROM roster_with_blanks WHERE school IS NOT NULL""",
)
def roster_positions(t):
    return roster.prepare(t("roster_with_blanks"), ["src_ord"])


@query(
    "roster_positions_by_text",
    """SELECT src_ord, subject, coach, CAST(row_number() OVER (ORDER BY coach, subject, src_ord) AS BIGINT) AS n
    FROM roster_with_blanks WHERE school IS NOT NULL""",
)
def roster_positions_by_text(t):
    rows = roster.drop_blank(t("roster_with_blanks"), S.ROSTER_COLUMNS)
    return dense_index(rows.select("src_ord", "subject", "coach"), ["coach", "subject", "src_ord"], "n")


@query(
    "roster_denumber",
    f"""SELECT row_position, {Q.denumbered('infrastructureCode')} AS infrastructureCode,
    {Q.denumbered('grade')} AS grade FROM roster""",
)
def roster_denumber(t):
    return roster.repair_numbers(t("roster")).select(S.POSITION, *S.NUMERIC_TEXT_COLUMNS)


@query(
    "roster_file_positions",
    f"""SELECT row_position, {Q.denumbered('infrastructureCode')} AS infrastructureCode,
    {Q.denumbered('grade')} AS grade, {Q.CELLS},
    'first line' || chr(10) || 'line ' || CAST(row_position AS STRING) AS remark FROM roster""",
)
def roster_file_positions(t):
    """A whole CSV roster, with a line break in one cell of every row, read and numbered
    in file order: the file is written in roster order, so the positions found must be
    the positions it was written by. Its numbers are texts that end in `.0`."""
    path = new_path(t.spark, "roster-file")
    remark = F.concat(F.lit("first line\nline "), F.col(S.POSITION).cast("string"))
    ordered = t("roster").withColumn("remark", remark).orderBy(S.POSITION).drop(S.POSITION)
    reports.write_annotated(ordered, path, "csv")
    return roster.read_roster(t.spark, path, "csv", multi_line=True)


_MISSING = {"school": "Escuela", "shift": None, "videoLink": None, "grade": "Grado"}


@query(
    "roster_required_columns",
    "SELECT 'shift' AS missing, count(*) AS n FROM roster UNION ALL SELECT 'videoLink', count(*) FROM roster",
)
def roster_required_columns(t):
    """The given roster with columns renamed and taken away: those missing, by name."""
    rows = t("roster")
    for name, instead in _MISSING.items():
        rows = rows.drop(name) if instead is None else rows.withColumnRenamed(name, instead)
    names = roster.missing_columns(roster.canonicalize(rows))
    missing = F.explode(F.array(*[F.lit(n) for n in names]))
    return rows.agg(F.count("*").alias("n")).select(missing.alias("missing"), "n")


@query("asset_catalog_scan", """SELECT file_id, folder_id, name, mime, list_order FROM asset_catalog
    WHERE folder_id IS NOT NULL AND NOT trashed""")
def asset_catalog_scan(t):
    return catalog.children(t("asset_catalog")).drop("trashed")


@query(
    "response_log_scan",
    f"""SELECT seq, event_id, status, {Q.json_field('$.url')} AS url,
    {Q.json_field('$.detail.pipeline_status')} AS pipeline_status, body FROM response_log""",
)
def response_log_scan(t):
    path = new_path(t.spark, "responses")
    t("response_log").write.parquet(path)
    rows = responses.read_responses(t.spark, path)
    return rows.select(
        "seq", "event_id", "status", "body",
        F.get_json_object("body", "$.url").alias("url"),
        F.get_json_object("body", "$.detail.pipeline_status").alias("pipeline_status"),
    )


@query(
    "state_current",
    "SELECT * FROM state_now",
)
def state_current(t):
    return compacted_log(t).current()


_ROOTS: dict[tuple[str, str], str] = {}


def compacted_log(t) -> statelog.StateLog:
    """The state log as the library keeps it: most images in a snapshot, the others
    appended since. Written once per session and folder, as the fixture views are."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _ROOTS:
        log = statelog.StateLog(t.spark, new_path(t.spark, "state"))
        early = F.col("log_seq") % 10 < 9
        log.append(t("state_log").where(early), "submit", 1)
        log.append(t("state_log").where(~early), "submit", 2)
        log.compact(AT)
        _ROOTS[key] = log.root
    return statelog.StateLog(t.spark, _ROOTS[key])


def _cell(x: str) -> str:
    return f"coalesce(CAST(length({x}) AS STRING) || ':' || {x}, 'N')"


_PRINTED = [
    "CAST(row_position AS STRING)",
    *[Q.denumbered(c) if c in S.NUMERIC_TEXT_COLUMNS else c for c in S.ROSTER_COLUMNS],
]
_LIMBS = " || '-' || ".join(
    f"CAST(sum(CAST('0x' || substr(h, {k}, 16) AS UBIGINT)) AS STRING)" for k in (1, 17, 33, 49)
)
_PRINT = f"""prints AS (
    SELECT count(*) AS source_rows, {_LIMBS} AS source_digest
    FROM (SELECT sha256({" || ',' || ".join(_cell(f"({c})") for c in _PRINTED)}) AS h FROM roster) x)"""


def printed(t):
    """Every column of the roster, as ingestion leaves them."""
    return roster.repair_numbers(t("roster")).select(S.POSITION, *S.ROSTER_COLUMNS)


def roster_print(t):
    return fingerprint.table_fingerprint(printed(t))


@query("source_fingerprint", f"WITH {_PRINT} SELECT source_rows, source_digest FROM prints")
def source_fingerprint(t):
    return roster_print(t)


_LINE = "concat_ws(';', CAST(row_position AS STRING), school, teacher, subject, transcriptLink)"
_FILE = f"""bytes AS (
    SELECT hex(encode(string_agg({_LINE} || chr(10), '' ORDER BY row_position))) AS h FROM roster),
  blocks AS (
    SELECT k, sha256(unhex(substr(h, CAST(k * {2 * fingerprint.BLOCK} + 1 AS BIGINT), {2 * fingerprint.BLOCK}))) AS digest
    FROM bytes, (SELECT unnest(range(0, (SELECT (length(h) + {2 * fingerprint.BLOCK - 1}) // {2 * fingerprint.BLOCK} FROM bytes))) AS k))"""


@query(
    "source_file_fingerprint",
    f"""WITH {_FILE} SELECT (SELECT length(h) // 2 FROM bytes) AS length,
    CASE WHEN count(*) = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY k)) END AS sha256_tree FROM blocks""",
)
def source_file_fingerprint(t):
    """The whole roster written as one text file, and the fingerprint of its bytes."""
    path = new_path(t.spark, "roster-file")
    ordered = t("roster").orderBy(S.POSITION).coalesce(1)
    ordered.select(F.expr(_LINE)).write.text(path)
    return fingerprint.file_fingerprint(t.spark, path).drop("file")


@query(
    "output_provenance",
    f"""WITH {_PRINT} SELECT 'roster.parquet' AS source_path, source_digest, source_rows,
    'rollcall' AS generated_by FROM prints""",
)
def output_provenance(t):
    return reports.provenance("roster.parquet", roster_print(t))


@query(
    "phase_finish",
    f"""WITH {_PRINT} SELECT 'roster.parquet' AS path, source_digest AS digest, source_rows AS rows,
    TIMESTAMP '{AS_OF}' AS phase_1_started_at,
    TIMESTAMP '{AS_OF}' + INTERVAL 1 HOUR AS phase_1_finished_at, 'queue' AS target FROM prints""",
)
def phase_finish(t):
    """Registration and end of phase 1 over the whole roster, in a new state root."""
    log = statelog.StateLog(t.spark, new_path(t.spark, "state"))
    log.register_source("roster.parquet", roster_print(t), AT, "queue")
    log.finish_phase_1(AT + dt.timedelta(hours=1))
    return log.source_facts()


@query(
    "source_lock",
    f"""WITH {_PRINT}
    SELECT 1 AS step, 'new' AS outcome, source_rows AS offered, source_digest AS digest FROM prints
    UNION ALL SELECT 2, 'known', source_rows, source_digest FROM prints
    UNION ALL SELECT 3, 'refused', source_rows + 1, NULL FROM prints""",
)
def source_lock(t):
    """The whole roster offered and registered, offered again in another order, and
    offered with one row twice (whose digest is another one: shown as null)."""
    log = statelog.StateLog(t.spark, new_path(t.spark, "state"))
    rows = printed(t)
    first = rows.where(F.col(S.POSITION) == rows.agg(F.min(S.POSITION)).scalar())
    prints = [fingerprint.table_fingerprint(r) for r in (rows, rows.repartition(shuffle_partitions(t.spark)), rows.unionByName(first))]
    steps = [materialize(log.offer(prints[0]), "offered")]
    log.register_source("roster.parquet", prints[0], AT)
    steps += [log.offer(p) for p in prints[1:]]
    shown = [
        s.select(
            F.lit(step).alias("step"), "outcome", F.col("source_rows").alias("offered"),
            F.when(F.col("outcome") != "refused", F.col("source_digest")).alias("digest"),
        )
        for step, s in enumerate(steps, 1)
    ]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


@query(
    "reset_state",
    """SELECT 0 AS generation, state, count(*) AS events FROM state_now GROUP BY state
    UNION ALL SELECT 2, state, count(*) FROM state_now WHERE state = 'completed' GROUP BY state""",
)
def reset_state(t):
    """Events by state before a reset, after it (none), and after a second one and a new
    start with the completed ones."""
    log = statelog.StateLog(t.spark, new_path(t.spark, "state"))

    def known():
        counts = log.current(["state"]).groupBy("state").agg(F.count("*").alias("events"))
        return materialize(counts.select(F.lit(log.generation).alias("generation"), "state", "events"), "known")

    log.append(t("state_log"), "submit", 1)
    steps = [known()]
    log.reset(AT, confirm=True)
    steps.append(known())
    log.reset(AT, confirm=True)
    log.append(state_now(t).where(F.col("state") == S.COMPLETED), "submit", 1)
    steps.append(known())
    return steps[0].unionByName(steps[1]).unionByName(steps[2])


@query(
    "transcript_resolve",
    f"""WITH {Q.GATED}
    SELECT event_id, asset_file_id AS file_id,
      CASE WHEN ext = 'txt' THEN 'text/plain' ELSE '{S.DOCX}' END AS content_type, ext AS extension,
      sha256(content) AS content_sha256, CAST(octet_length(encode(content)) AS BIGINT) AS content_bytes
    FROM gated JOIN content ON content.content_id = gated.content_id WHERE outcome = 'eligible'""",
)
def transcript_resolve(t):
    return submit.transcripts(outcomes(t), catalog.content_digests(t("content")))


def prepared(t):
    """The roster after ingestion."""
    return roster.repair_numbers(t("roster"))


def assets(t):
    return catalog.usable_assets(t("asset_catalog"), t("content_index"))


def state_now(t, *columns):
    """Current state; only the named columns if any are."""
    log = t("state_log").select(*statelog.LOG_COLUMNS)
    return statelog.current_state(log, list(columns) or None)


def gated(t):
    """Whole roster rows with their outcome."""
    return submit.gate(prepared(t), state_now(t, "event_id", "state"), assets(t))


def outcomes(t):
    """Outcomes alone: no cell of the roster but the links is read."""
    return submit.outcomes(prepared(t), state_now(t, "event_id", "state"), assets(t))
