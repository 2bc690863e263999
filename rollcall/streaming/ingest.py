"""Roster rows as a stream: each event is registered once, however often it comes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollcall import settings as S
from rollcall.plans.submit import new_images, with_event_id
from rollcall.sources.statelog import StateLog

WRITER = "ingest"


class Ingestor:
    """Registers new roster rows in a state log."""

    def __init__(self, log: StateLog, as_of, *, prefix: str = S.EVENT_ID_PREFIX):
        self.log = log
        self.as_of = as_of
        self.prefix = prefix

    def apply(self, rows: DataFrame, batch: int) -> None:
        # Of rows of one event in a batch the first by its cells counts, as earlier
        # batches count before later ones.
        events = with_event_id(rows, self.prefix)
        first = F.min(F.struct(*rows.columns))
        events = events.groupBy("event_id").agg(first.alias("r")).select("r.*", "event_id")
        known = self.log.current(["event_id"], before=(WRITER, batch))
        self.log.append(new_images(events, known, self.as_of), WRITER, batch)

    def start(self, rows: DataFrame, checkpoint: str) -> StreamingQuery:
        writer = rows.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start()
