"""Response collection as a stream.

Each micro-batch of responses is folded into the current state by the same code
as the batch job, and the changed rows are appended to the state log. The result
does not depend on how responses are cut into batches:

* responses newer than everything applied to their event are folded on from the
  current state;
* an event with an older one among them is folded again: from its state at the last
  midnight that no older response has come before (a mark, kept when its first
  response of a day is applied), or else from where its polling started;
* rows that stay silent time out by the clock of the stream (its newest response).

Every write of a batch goes to a directory of its own that a repeated batch
replaces, and reads leave out the batch itself, so a restart changes nothing.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollcall import settings as S
from rollcall.functions.ids import moment
from rollcall.operators.keyfilter import passing
from rollcall.operators.latest import latest_per_key
from rollcall.plans.reconcile import reconcile, reconciled_images
from rollcall.plans.transitions import overdue, pending_remaining, polled, timeout_message
from rollcall.sources.responses import RESPONSE_SCHEMA
from rollcall.sources.statelog import LOG_COLUMNS, LOG_ORDER, StateLog, table_or_empty, table_or_none, write_counting

WRITER = "collect"
DELIVERY = ["ts", "status", "body", "delivery_failed"]
BASE_COLUMNS = ["event_id", "state", "attempts", "last_error", "webhook_submitted_at"]
NARROW = [*BASE_COLUMNS, "last_attempt_at", *LOG_ORDER]
CLOCK_SCHEMA = "newest timestamp_ntz"
MARK_SCHEMA = (
    "event_id string, state string, attempts int, last_error string, webhook_submitted_at timestamp_ntz, "
    "mark_at timestamp_ntz"
)
BASE_SCHEMA = (
    "event_id string, state string, attempts int, last_error string, "
    "webhook_submitted_at timestamp_ntz, batch bigint"
)


def deduplicated(responses: DataFrame, lateness: str) -> DataFrame:
    """Drop repeated deliveries of a response within the stream itself. It forgets keys older
    than `lateness`, and responses that come later still are dropped by the watermark:
    where nothing may be dropped, use `Deduplicator`. (`Collector` needs neither: it takes
    repeats as they come.)"""
    timed = responses.withColumn("event_time", F.col("ts").cast("timestamp"))
    once = timed.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(
        ["event_id", "seq"]
    )
    return once.drop("event_time")


class Deduplicator:
    """Writes each response once, however late it or a repeat of it comes.

    What has been seen is what has been written: the stream keeps no keys, so its state
    does not grow. A batch is compared with the keys of earlier batches only. Of those
    are read the files that can hold its sequence numbers (Parquet knows their range),
    of these the rows that a filter of the batch's keys lets pass, and only they move. A
    repeated batch replaces what it wrote.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _written(self) -> DataFrame:
        return table_or_empty(self.spark, f"{self.path}/once", RESPONSE_SCHEMA + ", batch bigint")

    def responses(self) -> DataFrame:
        """All responses written so far."""
        return self._written().drop("batch")

    def apply(self, responses: DataFrame, batch: int) -> int:
        """Write what is new in a batch; returns how many responses that are."""
        given = f"{self.path}/given/batch={batch}"
        seen = write_counting(
            first_delivery(responses), given, rows=F.count("*"), least=F.min("seq"), most=F.max("seq")
        )
        fresh = self.spark.read.schema(responses.schema).parquet(given)
        if batch > 0 and seen["rows"]:
            keys = fresh.select(_response_key().alias("key"))
            known = self._written().where((F.col("batch") < batch) & F.col("seq").between(seen["least"], seen["most"]))
            known = passing(known.select("event_id", "seq"), _response_key(), keys, "key")
            same = fresh["seq"].eqNullSafe(known["seq"]) & fresh["event_id"].eqNullSafe(known["event_id"])
            fresh = fresh.join(known, same, "left_anti")
        return write_counting(fresh, f"{self.path}/once/batch={batch}", rows=F.count("*"))["rows"]

    def start(self, responses: DataFrame, checkpoint: str) -> StreamingQuery:
        """Take everything there is."""
        writer = responses.writeStream.foreachBatch(lambda rows, batch: self.apply(rows, batch) and None)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _midnight(column: str) -> Column:
    return F.col(column).cast("date").cast("timestamp_ntz")


def _response_key() -> Column:
    return F.concat_ws(":", "event_id", F.col("seq").cast("string"))


def first_delivery(responses: DataFrame) -> DataFrame:
    """One row per response. Of deliveries that differ the first counts: by batch, and
    within one by time, status, body and delivery. The fold over a history goes by the
    same order, so which way a response is applied makes no difference."""
    first = F.min(F.struct(*DELIVERY))
    once = responses.groupBy("event_id", "seq").agg(first.alias("d")).select("event_id", "seq", "d.*")
    return once.select(*responses.columns)


class Collector:
    """Applies micro-batches of responses to a state log."""

    def __init__(
        self,
        log: StateLog,
        history: str,
        *,
        max_attempts: int = S.MAX_ATTEMPTS,
        timeout_hours: int = S.TIMEOUT_HOURS,
        compact_every: int | None = 20,
    ):
        self.log = log
        self.spark = log.spark
        self.history = history.rstrip("/")
        self.max_attempts = max_attempts
        self.timeout_hours = timeout_hours
        self.compact_every = compact_every
        self.watch = False
        self.drained = False

    # ---- tables kept next to the log ------------------------------------------
    def _path(self, table: str, batch: int) -> str:
        return f"{self.history}/{table}/batch={batch}"

    def _save(self, df: DataFrame, table: str, batch: int, **counts) -> tuple[DataFrame, dict]:
        """Write a table of this batch; it as written, and aggregates observed on the way."""
        seen = write_counting(df, self._path(table, batch), rows=F.count("*"), **counts)
        return self.spark.read.schema(df.schema).parquet(self._path(table, batch)), seen

    def _saved(self, table: str, schema: str) -> DataFrame:
        """All batches of a table; none yet is an empty one."""
        return table_or_empty(self.spark, f"{self.history}/{table}", schema)

    # ---- one micro-batch ---------------------------------------------------------
    def apply(self, responses: DataFrame, batch: int) -> None:
        """What a batch reads: its own responses, the narrow columns of the current state,
        the whole images of the events it changes, and the recorded starts of those. Only
        events that an older response reaches read the history of responses."""
        fresh, seen = self._save(first_delivery(responses), "responses", batch, newest=F.max("ts"))
        clock = self._clock(seen.get("newest"), batch)
        if clock is None:
            return
        late = overdue(clock, self.timeout_hours)
        heard, open_ = F.col("_oldest").isNotNull(), polled(self.max_attempts)
        spans = fresh.groupBy("event_id").agg(F.min("ts").alias("_oldest"))
        current = self.log.current(NARROW, before=(WRITER, batch)).join(spans, "event_id", "left")
        watched, before = Observation(), None
        if self.watch:
            current = current.observe(watched, F.count_if(open_).alias("open"))
        disordered = F.coalesce(F.col("_oldest") <= F.col("last_attempt_at"), F.lit(False))
        crossing = heard & ~disordered & F.coalesce(F.col("last_attempt_at") < _midnight("_oldest"), F.lit(False))
        touched, counts = self._save(
            current.where(heard | (open_ & late)), "touched", batch,
            open=F.count_if(open_), disordered=F.count_if(disordered), crossing=F.count_if(crossing),
        )
        if counts["crossing"]:
            marks = touched.where(crossing).select(*BASE_COLUMNS, _midnight("_oldest").alias("mark_at"))
            marks.write.mode("overwrite").parquet(self._path("marks", batch))
        if self.watch:
            before = watched.get["open"] - counts["open"]
        changed, silent = touched.where(heard), touched.where(~heard)
        known = self._started(touched.where(open_), batch)
        wide = self.log.current_images(touched, before=(WRITER, batch))
        folded = self._fold(changed, fresh, known if counts["disordered"] else None, batch)
        images = self._swept(reconciled_images(wide, folded, clock), clock)
        timed_out = wide.join(silent.select("event_id"), "event_id", "left_semi")
        images = images.unionByName(self._swept(timed_out, clock, stamp=True))
        written = self.log.append(images, WRITER, batch, open=F.count_if(open_))
        if self.compact_every and batch and batch % self.compact_every == 0:
            self.log.compact(clock)
            self._roll_starts(batch)
        if self.watch:
            self.drained = before + written["open"] == 0

    def _clock(self, newest, batch: int):
        """Newest response of this batch and all earlier ones: that of the batch before is
        read, not those of all."""
        known = None
        if batch > 0:
            last = table_or_none(self.spark, self._path("clock", batch - 1), CLOCK_SCHEMA)
            if last is None:
                last = self._saved("clock", CLOCK_SCHEMA + ", batch bigint").where(F.col("batch") < batch)
            known = last.agg(F.max("newest")).first()[0]
        clock = max((t for t in (known, newest) if t is not None), default=None)
        row = self.spark.createDataFrame([(clock,)], CLOCK_SCHEMA).coalesce(1)
        row.write.mode("overwrite").parquet(self._path("clock", batch))
        return clock

    def _started(self, rows: DataFrame, batch: int) -> DataFrame | None:
        """Record where polling of the given rows starts, unless that is recorded
        already: it is needed to fold an event again. Returns the earlier records."""
        rows, known = rows.select(*BASE_COLUMNS), None
        if batch > 0:
            known = self._starts(batch)
            keys = known.select("event_id", "webhook_submitted_at")
            same_start = rows.webhook_submitted_at.eqNullSafe(keys.webhook_submitted_at)
            rows = rows.join(keys, (rows.event_id == keys.event_id) & same_start, "left_anti")
        else:
            nothing = self.spark.createDataFrame([], BASE_SCHEMA)
            nothing.write.mode("overwrite").parquet(f"{self.history}/base-rolled/rolled=-1")
        rows.write.mode("overwrite").parquet(self._path("base", batch))
        return known

    def _starts(self, batch: int) -> DataFrame:
        """Recorded starts before a batch: the table they were last rolled into, and what
        has been recorded since."""
        rolled = self._saved("base-rolled", BASE_SCHEMA + ", rolled bigint").where(F.col("rolled") < batch)
        last = rolled.agg(F.max("rolled")).first()[0]
        since = self._saved("base", BASE_SCHEMA).where(F.col("batch") < batch)
        if last is None:
            return since
        return since.where(F.col("batch") > last).unionByName(rolled.where(F.col("rolled") == last).drop("rolled"))

    def _roll_starts(self, batch: int) -> None:
        """All starts up to a batch in one table. That of a batch that is repeated is
        replaced, and readers of that batch do not look at it."""
        self._starts(batch + 1).write.mode("overwrite").parquet(f"{self.history}/base-rolled/rolled={batch}")

    def _fold(self, changed: DataFrame, fresh: DataFrame, known: DataFrame | None, batch: int) -> DataFrame:
        """Results of the events heard from; `known` is None where all came in order."""
        limits = {"max_attempts": self.max_attempts, "timeout_hours": self.timeout_hours}
        if known is None:
            return reconcile(changed, fresh, **limits)
        disordered = changed.where(F.col("_oldest") <= F.col("last_attempt_at")).select("event_id", "_oldest")
        starts = latest_per_key(known, "event_id", ["batch"]).join(disordered, "event_id")
        again, counts = self._save(
            self._marked(starts.withColumnRenamed("batch", "_since"), batch), "again", batch,
            since=F.min("_since"), least=F.min("_from"), latest=F.max("_from"), whole=F.count_if(F.col("_from").isNull()),
        )
        if not counts["rows"]:
            return reconcile(changed, fresh, **limits)
        in_order = fresh.join(again.select("event_id"), "event_id", "left_anti")
        places = again.select("event_id", "_since", "_from")
        history = self._saved("responses", RESPONSE_SCHEMA + ", batch bigint")
        history = history.where(F.col("batch").between(counts["since"], batch))
        recent = history if counts["whole"] else history.where(F.col("ts") >= F.lit(counts["least"]))
        used = (F.col("batch") >= F.col("_since")) & F.coalesce(F.col("ts") >= F.col("_from"), F.lit(True))
        # Repeats are dropped by (event, seq) before the rows meet by event: a hot
        # event is then never gathered in one task.
        recent = recent.join(places, "event_id").where(used)
        delivery = F.min(F.struct("batch", *DELIVERY))
        once = recent.groupBy("event_id", "seq").agg(delivery.alias("d")).select("event_id", "seq", "d.*")
        if counts["least"] is not None:
            # What a mark holds already may come again later: the first delivery counts.
            keys = fresh.join(again.where("_from IS NOT NULL").select("event_id"), "event_id", "left_semi")
            held = history.where((F.col("batch") < batch) & (F.col("ts") < F.lit(counts["latest"])))
            held = passing(held.select("event_id", "seq", "ts", "batch"), _response_key(), keys.select(_response_key().alias("key")), "key")
            held = held.join(places, "event_id").where((F.col("batch") >= F.col("_since")) & (F.col("ts") < F.col("_from")))
            once = once.join(held.select("event_id", "seq"), ["event_id", "seq"], "left_anti")
        whole = once.drop("batch")
        # An event starts from a mark or its recorded start with what came after, or from where
        # it is with what is new: either way one row and its responses in order.
        rest = changed.join(again.select("event_id"), "event_id", "left_anti")
        starts = rest.select(*BASE_COLUMNS).unionByName(again.select(*BASE_COLUMNS))
        return reconcile(starts, in_order.unionByName(whole.select(*in_order.columns)), **limits)

    def _marked(self, starts: DataFrame, batch: int) -> DataFrame:
        """Where events are folded again from: `_from` and the state of their last mark
        before the oldest response that is late, if one still holds, else their start.
        A mark holds until a later batch brings a response from before it."""
        marks = self._saved("marks", MARK_SCHEMA + ", batch bigint").where(F.col("batch") < batch)
        late = self._saved("again", "event_id string, _oldest timestamp_ntz, batch bigint").where(F.col("batch") < batch)
        own = starts.select(
            F.col("event_id").alias("_event"), F.col("webhook_submitted_at").alias("_submitted"), "_since", "_oldest"
        )
        fits = (
            (F.col("event_id") == F.col("_event")) & F.col("webhook_submitted_at").eqNullSafe(F.col("_submitted"))
            & (F.col("batch") >= F.col("_since")) & (F.col("mark_at") <= F.col("_oldest"))
        )
        marks = marks.join(own, fits).select(*BASE_COLUMNS, "mark_at", "batch")
        passed = late.select(F.col("event_id").alias("_event"), F.col("_oldest").alias("_late"), F.col("batch").alias("_batch"))
        broken = (F.col("event_id") == F.col("_event")) & (F.col("_batch") > F.col("batch")) & (F.col("_late") < F.col("mark_at"))
        held = marks.join(passed, broken, "left_anti")
        best = held.groupBy("event_id").agg(F.max(F.struct("mark_at", "batch", "state", "attempts", "last_error")).alias("m"))
        found = starts.join(best, "event_id", "left")
        there = F.col("m").isNotNull()
        return found.select(
            "event_id", *[F.when(there, F.col(f"m.{c}")).otherwise(F.col(c)).alias(c) for c in ("state", "attempts", "last_error")],
            "webhook_submitted_at", "_since", "_oldest", F.col("m.mark_at").alias("_from"),
        )

    def _swept(self, rows: DataFrame, clock, *, stamp: bool = False) -> DataFrame:
        """Time out overdue rows among images; `stamp` makes images of state rows."""
        late = overdue(clock, self.timeout_hours)
        at = moment(clock)
        fields = {
            "last_error": F.when(late, timeout_message(self.timeout_hours)).otherwise(F.col("last_error")),
            "last_attempt_at": F.when(late, at).otherwise(F.col("last_attempt_at")),
            "state": F.when(late, S.FAILED_TIMEOUT).otherwise(F.col("state")),
        }
        if stamp:
            fields |= {"log_ts": F.greatest("log_ts", at), "log_seq": F.col("log_seq") + 1}
        return rows.withColumns(fields).select(*LOG_COLUMNS)

    def remaining(self) -> int:
        state = self.log.current(["state", "attempts"])
        return pending_remaining(state, self.max_attempts).first()[0]

    # ---- running -------------------------------------------------------------------
    def start(self, responses: DataFrame, checkpoint: str, *, once: bool = False,
              poll_seconds: int = S.POLL_SECONDS) -> StreamingQuery:
        """Start collecting: everything there is, once, or on a polling interval."""
        writer = responses.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        trigger = {"availableNow": True} if once else {"processingTime": f"{poll_seconds} seconds"}
        return writer.trigger(**trigger).start()

    def run_until_drained(
        self, query: StreamingQuery, *, check_seconds: float = 1.0, at_most_seconds: float | None = None
    ) -> bool:
        """Wait until nothing is polled any more, then stop the query. True when
        drained, false when the time was up first; a failed query raises."""
        self.watch, started = True, time.monotonic()
        while not self.drained and not query.awaitTermination(check_seconds):
            if at_most_seconds is not None and time.monotonic() - started > at_most_seconds:
                break
        query.stop()
        return self.drained
