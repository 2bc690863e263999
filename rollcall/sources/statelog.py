"""State as an append-only log of full row images.

Plain Parquet has no update: every change appends the whole new image of a row,
and the current state is the latest image per event. Layout under one root:

    log/generation=G/writer=NAME/batch=N/   images appended by one batch
    snapshot/generation=G/id=N/             compacted current state, bucketed by event
    meta/                                   small facts: sources, phases, resets

A batch directory is overwritten as a whole, so repeating a batch (a restarted
streaming query) replaces its images instead of adding them twice.

A snapshot is one of Spark's bucketed tables: whatever joins or groups it by event (what
has been appended since, changes, responses, the roster) comes to where it lies.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.functions.ids import moment
from rollcall.operators.latest import latest_per_key
from rollcall.operators.scratch import shuffle_partitions

STATE_COLUMNS = [
    "row_position", "event_id", "drive_case", "transcript_file_id", "transcript_gcs_uri",
    "webhook_message_id", "webhook_submitted_at", "pdf_drive_id", "pdf_drive_link", "state",
    "last_error", "last_attempt_at", "attempts", "excel_row_json",
]
LOG_COLUMNS = [*STATE_COLUMNS, "log_ts", "log_seq"]
LOG_SCHEMA = (
    "row_position bigint, event_id string, drive_case string, transcript_file_id string, "
    "transcript_gcs_uri string, webhook_message_id string, webhook_submitted_at timestamp_ntz, "
    "pdf_drive_id string, pdf_drive_link string, state string, last_error string, "
    "last_attempt_at timestamp_ntz, attempts int, excel_row_json string, "
    "log_ts timestamp_ntz, log_seq bigint"
)
META_SCHEMA = (
    "generation int, kind string, at timestamp_ntz, path string, digest string, "
    "rows bigint, target string, note string"
)
LOG_ORDER = ["log_ts", "log_seq"]


class SourceChanged(RuntimeError):
    """The roster differs from the one this state was started with."""


def current_state(log: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Latest image per event. Name the columns wanted: the rest (row snapshots
    above all) is then neither read nor shuffled."""
    if columns is None:
        return latest_per_key(log, "event_id", LOG_ORDER)
    needed = list(dict.fromkeys(["event_id", *LOG_ORDER, *columns]))
    return latest_per_key(log.select(*needed), "event_id", LOG_ORDER).select(*columns)


def current_where(log: DataFrame, columns: list[str], condition: Column) -> DataFrame:
    """Whole current images of the events that meet a condition over a few columns.

    Which image is the latest, and whether it meets the condition, comes from those
    columns alone; the wide ones (row snapshots above all) are then fetched for the
    events found. An event, time and sequence number name one image.
    """
    order = ["event_id", *LOG_ORDER]
    found = current_state(log, list(dict.fromkeys([*order, *columns]))).where(condition).select(*order)
    same = [log[c].eqNullSafe(found[c]) for c in order]
    return log.join(found, same[0] & same[1] & same[2], "left_semi")


def images(changed: DataFrame, as_of, **fields) -> DataFrame:
    """Full images from current-state rows: given columns replaced, the change
    stamped. A field set to null becomes null; fields not named stay.

    An image always sorts after the one it was made from, whatever the clocks of
    the writers say.
    """
    at = moment(as_of)
    stamped = {
        "last_attempt_at": at,
        "log_ts": F.greatest(F.col("log_ts"), at),
        "log_seq": F.col("log_seq") + 1,
    }
    return changed.withColumns(stamped | fields).select(*LOG_COLUMNS)


def table_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A written table, or None where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    found = table_or_none(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def write_counting(df: DataFrame, path: str, **counts: Column) -> dict:
    """Write a table, replacing it, and return aggregates observed on the way: nothing is
    read again for them."""
    seen = Observation()
    df.observe(seen, *[c.alias(name) for name, c in counts.items()]).write.mode("overwrite").parquet(path)
    return seen.get


class StateLog:
    """Reader and writer of one state root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        if self._table(f"{self.root}/meta", META_SCHEMA) is None:
            self._note(0, "start", dt.datetime(1970, 1, 1))

    def _table(self, path: str, schema: str) -> DataFrame | None:
        return table_or_none(self.spark, path, schema)

    # ---- facts ----------------------------------------------------------------
    def _note(self, generation, kind, at, path=None, digest=None, rows=None, target=None, note=None):
        row = [(generation, kind, at, path, digest, rows, target, note)]
        facts = self.spark.createDataFrame(row, META_SCHEMA).coalesce(1)
        facts.write.mode("append").parquet(f"{self.root}/meta")

    def facts(self) -> DataFrame:
        """One row per source, phase end, reset and snapshot: a few per run."""
        return self.spark.read.schema(META_SCHEMA).parquet(f"{self.root}/meta")

    def _facts_now(self) -> tuple[int, dict]:
        """The running generation, and its newest fact of each kind."""
        rows = self.facts().collect()
        generation = max(row["generation"] for row in rows)
        mine = [row for row in rows if row["generation"] == generation]
        return generation, {row["kind"]: row for row in sorted(mine, key=lambda r: (r["rows"] or 0, r["at"]))}

    @property
    def generation(self) -> int:
        return self._facts_now()[0]

    def source_facts(self) -> DataFrame:
        """The registered source of this generation, with the phase-1 end if any."""
        generation = self.generation
        facts = self.facts().where(F.col("generation") == generation)
        finished = facts.where(F.col("kind") == "phase_1_finished").agg(F.max("at")).scalar()
        return facts.where(F.col("kind") == "source").select(
            "path", "digest", "rows", F.col("at").alias("phase_1_started_at"),
            finished.alias("phase_1_finished_at"), "target",
        )

    def offer(self, fingerprint: DataFrame) -> DataFrame:
        """The fingerprint of a roster with `outcome`, what offering it now comes to:
        `new` if none is registered, `known` if it is this one, else `refused`."""
        source = self.facts().where((F.col("generation") == self.generation) & (F.col("kind") == "source"))
        digest, rows = source.agg(F.max("digest")).scalar(), source.agg(F.max("rows")).scalar()
        same = (F.col("source_digest") == digest) & (F.col("source_rows") == rows)
        outcome = F.when(digest.isNull(), "new").when(same, "known").otherwise("refused")
        return fingerprint.withColumn("outcome", outcome)

    def register_source(self, path: str, fingerprint: DataFrame, as_of, target: str = "") -> bool:
        """Lock the state to one roster: true when this call registered it, false
        when the same roster is registered already; another roster is refused."""
        found = self.offer(fingerprint).first()
        if found["outcome"] == "refused":
            raise SourceChanged("state belongs to another roster; reset it to start over")
        if found["outcome"] == "new":
            self._note(
                self.generation, "source", as_of, path, found["source_digest"], found["source_rows"], target
            )
        return found["outcome"] == "new"

    def finish_phase_1(self, as_of) -> None:
        self._note(self.generation, "phase_1_finished", as_of)

    def reset(self, as_of, *, confirm: bool = False) -> int:
        """Start a new generation. Older ones stay on disk and are not read."""
        if not confirm:
            raise ValueError("reset needs confirm=True")
        generation = self.generation + 1
        self._note(generation, "reset", as_of)
        return generation

    # ---- log --------------------------------------------------------------------
    def append(self, rows: DataFrame, writer: str, batch: int, **counts: Column) -> dict[str, int]:
        """Append images as one batch of one writer; repeating it replaces it. Returns the
        number of `rows` and the given aggregates of them, counted while they are written."""
        path = f"{self._log_path(self.generation)}/writer={writer}/batch={batch}"
        return write_counting(rows.select(*LOG_COLUMNS), path, rows=F.count("*"), **counts)

    def next_batch(self, writer: str) -> int:
        rows = self.log().where(F.col("writer") == writer)
        return (rows.agg(F.max("batch")).first()[0] or 0) + 1

    def _log_path(self, generation: int) -> str:
        return f"{self.root}/log/generation={generation}"

    def log(self, generation: int | None = None) -> DataFrame:
        """All images of a generation, this one by default, with `writer` and `batch`."""
        path = self._log_path(self.generation if generation is None else generation)
        schema = LOG_SCHEMA + ", writer string, batch bigint"
        return table_or_empty(self.spark, path, schema)

    def current(
        self, columns: list[str] | None = None, *, before: tuple[str, int] | None = None
    ) -> DataFrame:
        """Latest image per event, starting from the newest snapshot if there is one.

        `before=(writer, batch)` leaves out that batch and later ones of the writer:
        what a repeated batch has to start from.
        """
        generation, facts = self._facts_now()
        snapshot = facts.get("snapshot")
        rows = self._before(self._uncovered(generation, snapshot), before)
        return self._latest(rows, snapshot, columns)

    @staticmethod
    def _before(rows: DataFrame, before: tuple[str, int] | None) -> DataFrame:
        if before is None:
            return rows
        writer, batch = before
        return rows.where((F.col("writer") != writer) | (F.col("batch") < batch))

    def current_images(self, found: DataFrame, *, before: tuple[str, int] | None = None) -> DataFrame:
        """Whole images by event, time and sequence number, as `current` (narrow) has named
        them: the wide columns are read for these alone and are not shuffled to find them."""
        generation, facts = self._facts_now()
        snapshot = facts.get("snapshot")
        rows = self._held(self._before(self._uncovered(generation, snapshot), before), snapshot)
        keys = found.select(*[F.col(c).alias(f"_{c}") for c in ("event_id", *LOG_ORDER)])
        same = F.lit(True)
        for c in ("event_id", *LOG_ORDER):
            same = same & (rows[c] == keys[f"_{c}"])
        return rows.join(keys, same, "left_semi")

    def current_of(self, events: DataFrame, columns: list[str] | None = None) -> DataFrame:
        """The current images of some events (a column `event_id`). Snapshot and log are
        reduced to them where they lie; only what is left is moved."""
        generation, facts = self._facts_now()
        snapshot, wanted = facts.get("snapshot"), events.select("event_id").distinct()
        needed = list(dict.fromkeys(["event_id", *LOG_ORDER, *(columns or LOG_COLUMNS)]))
        rows = self._uncovered(generation, snapshot).select(*needed).join(wanted, "event_id", "left_semi")
        if snapshot is not None:
            held = self._snapshot(snapshot).select(*needed).join(wanted, "event_id", "left_semi")
            rows = rows.unionByName(held)
        return current_state(rows).select(*(columns or LOG_COLUMNS))

    def _uncovered(self, generation: int, snapshot) -> DataFrame:
        """Images the snapshot does not hold; whole directories are left out."""
        rows = self.log(generation)
        for writer, batch in _covered(snapshot).items():
            rows = rows.where((F.col("writer") != writer) | (F.col("batch") > batch))
        return rows

    def _held(self, rows: DataFrame, snapshot) -> DataFrame:
        """The given images and those of the snapshot."""
        rows = rows.select(*LOG_COLUMNS)
        if snapshot is not None:
            rows = rows.unionByName(self.spark.read.schema(LOG_SCHEMA).parquet(snapshot["path"]))
        return rows

    def _latest(self, rows: DataFrame, snapshot, columns: list[str] | None = None) -> DataFrame:
        rows = rows.select(*LOG_COLUMNS)
        if snapshot is None:
            return current_state(rows, columns)
        columns = columns or LOG_COLUMNS
        needed = list(dict.fromkeys(["event_id", *LOG_ORDER, *columns]))
        return newer_of(self._snapshot(snapshot).select(*needed), current_state(rows, needed)).select(*columns)

    def _snapshot(self, fact) -> DataFrame:
        """A snapshot as the bucketed table it was written as."""
        name, buckets = _table_name(fact["path"]), fact["target"]
        if not buckets:  # one that was written before snapshots were bucketed
            return self.spark.read.schema(LOG_SCHEMA).parquet(fact["path"])
        if not self.spark.catalog.tableExists(name):  # as in a session that did not write it
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({LOG_SCHEMA}) USING parquet "
                f"CLUSTERED BY (event_id) SORTED BY (event_id) INTO {int(buckets)} BUCKETS LOCATION '{fact['path']}'"
            )
        return self.spark.table(name)

    # ---- compaction -------------------------------------------------------------
    def compact(self, as_of) -> None:
        """Write a snapshot, then point to it. Readers use the old one until the
        pointer is written; no path in use is overwritten.

        The newest batch of each writer stays out: a restarted query may repeat it,
        and must find the state as it was before.
        """
        generation, facts = self._facts_now()
        last = facts.get("snapshot")
        number = 1 if last is None else last["rows"] + 1
        path = f"{self.root}/snapshot/generation={generation}/id={number}"
        newest = self.log(generation).groupBy("writer").agg(F.max("batch").alias("batch")).collect()
        newest = {row["writer"]: row["batch"] for row in newest}
        rows = self._uncovered(generation, last)
        for writer, batch in newest.items():
            rows = rows.where((F.col("writer") != writer) | (F.col("batch") < batch))
        buckets = shuffle_partitions(self.spark)
        bucketed = self._latest(rows, last).write.format("parquet").bucketBy(buckets, "event_id").sortBy("event_id")
        self.spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
        bucketed.option("path", path).mode("overwrite").saveAsTable(_table_name(path))
        covered = _covered(last) | {writer: batch - 1 for writer, batch in newest.items()}
        note = ",".join(f"{writer}={batch}" for writer, batch in sorted(covered.items()))
        self._note(generation, "snapshot", as_of, path=path, rows=number, target=str(buckets), note=note)


def newer_of(held: DataFrame, tail: DataFrame) -> DataFrame:
    """Per event the later of two images, of tables with one row per event and the same
    columns. A join by event: the side that lies bucketed by it is not moved."""
    names = held.columns
    later = tail.select(*[F.col(c).alias(f"_{c}") for c in names])
    joined = held.join(later, F.col("event_id") == F.col("_event_id"), "full_outer")
    ours, theirs = F.struct(*LOG_ORDER), F.struct(*[f"_{c}" for c in LOG_ORDER])
    keep = F.col("_event_id").isNull() | (F.col("event_id").isNotNull() & (ours > theirs))
    return joined.select(*[F.when(keep, F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in names])


def _table_name(path: str) -> str:
    return f"rollcall_snapshot_{hashlib.md5(path.encode()).hexdigest()}"


def _covered(snapshot) -> dict[str, int]:
    """Newest batch of each writer that a snapshot holds."""
    note = "" if snapshot is None else snapshot["note"]
    pairs = (item.rsplit("=", 1) for item in note.split(",") if item)
    return {writer: int(batch) for writer, batch in pairs}
