"""Phase 3 and inspection: annotated roster, summaries and listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.functions import ids
from rollcall.functions.text import truncate
from rollcall.operators.latest import best_per_key


def backfill_status(state: Column, error: Column) -> Column:
    """Status shown per row; failures and open states carry their error text."""
    plain = (state == S.COMPLETED) | state.startswith("skipped_")
    return F.when(plain, state).otherwise(
        F.concat(state, F.lit(": "), truncate(error, S.ANNOTATION_ERROR_CHARS))
    )


def annotations(state: DataFrame) -> DataFrame:
    """(row_position, event id, report link, status) per state row."""
    event, link, status = S.ANNOTATION_COLUMNS
    done = F.col("state") == S.COMPLETED
    return state.select(
        S.POSITION,
        F.col("event_id").alias(event),
        F.when(done, F.coalesce("pdf_drive_link", F.lit(""))).otherwise(F.lit("")).alias(link),
        backfill_status(F.col("state"), F.col("last_error")).alias(status),
    )


def annotate(roster: DataFrame, state: DataFrame, prefix: str = S.EVENT_ID_PREFIX) -> DataFrame:
    """The roster with the three result columns, empty where nothing is known.

    Joined on the event a row has under `prefix`: positions are counted after blank
    rows are dropped, so those cannot shift anything, and a state that also holds
    events of other prefixes gives each row one result.
    """
    event = S.ANNOTATION_COLUMNS[0]
    found = annotations(state).drop(S.POSITION).withColumnRenamed(event, "_event")
    rows = roster.withColumn("_row_event", ids.event_id(F.col(S.POSITION), prefix))
    joined = rows.join(found, F.col("_row_event") == F.col("_event"), "left")
    named = joined.withColumn(event, F.col("_event")).select(*roster.columns, *S.ANNOTATION_COLUMNS)
    return named.fillna("", subset=S.ANNOTATION_COLUMNS)


def provenance(source_path: str, fingerprint: DataFrame, generator: str = "rollcall") -> DataFrame:
    """One row on where an output came from; none if the digest is unknown."""
    return fingerprint.where(F.col("source_digest").isNotNull()).select(
        F.lit(source_path).alias("source_path"),
        "source_digest",
        "source_rows",
        F.lit(generator).alias("generated_by"),
    )


def default_output_path(source: str) -> str:
    """`roster.csv` -> `roster_with_reports.csv`, next to the source."""
    folder, slash, name = source.rpartition("/")
    stem, dot, suffix = name.rpartition(".")
    if not stem:
        stem, dot, suffix = name, "", ""
    return f"{folder}{slash}{stem}_with_reports{dot}{suffix}"


def write_annotated(
    annotated: DataFrame, path: str, fmt: str = "parquet", *, provenance_row: DataFrame | None = None
) -> None:
    """Write the annotated roster, and its provenance next to it."""
    writer = annotated.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
    writer.save(path)
    if provenance_row is not None:
        provenance_row.coalesce(1).write.mode("overwrite").json(f"{path}_meta")


def existing_reports(state: DataFrame, delivered: DataFrame) -> DataFrame:
    """Reports already delivered for the given events, one file per name (the
    first by id). `delivered` is (file_id, name, link)."""
    names = state.select("event_id", ids.report_name(F.col("event_id")).alias("name"))
    wanted = delivered.join(names, "name", "left_semi")
    first = best_per_key(wanted, "name", [F.col("file_id")], F.struct("file_id", "link"))
    return names.join(
        first.select("name", F.col("best.file_id").alias("file_id"), F.col("best.link").alias("link")),
        "name",
    )


# ---- summaries and listings -----------------------------------------------------------
def status_summary(state: DataFrame) -> DataFrame:
    """Rows and percent per state, most frequent first. The total is taken over
    the counts, one row per state."""
    counts = state.groupBy("state").agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy())
    return counts.select(
        "state", "n", F.round(F.col("n") * 100 / total, 1).alias("percent")
    ).orderBy(F.desc("n"), "state")


def failures_listing(state: DataFrame, max_attempts: int = S.MAX_ATTEMPTS) -> DataFrame:
    """Failed rows by position, with short errors. `exhausted` marks rows that
    polling has given up on."""
    rows = state.where(F.col("state").startswith("failed_"))
    return rows.select(
        S.POSITION,
        "event_id",
        "state",
        "attempts",
        truncate(F.col("last_error"), S.LISTING_ERROR_CHARS).alias("last_error"),
        ((F.col("state") == S.FAILED_FETCH) & (F.col("attempts") >= max_attempts)).alias("exhausted"),
    ).orderBy(S.POSITION)


def inspect(state: DataFrame, event: str) -> DataFrame:
    """Everything known about one event; the key filter reaches the scan."""
    return state.where(F.col("event_id") == event)


def retry_classes(state: DataFrame) -> DataFrame:
    """Rows per documented retry class and state. Counted first: the small class
    table meets one row per state."""
    spark = state.sparkSession
    classes = spark.createDataFrame(S.RETRY_CLASS, "state string, retry_class string")
    counts = state.groupBy("state").agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(classes), "state", "left").select(
        F.coalesce("retry_class", F.lit("unknown")).alias("retry_class"), "state", "n"
    )
