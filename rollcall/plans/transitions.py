"""State changes that are not driven by responses, and selections of state rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall import settings as S
from rollcall.functions import ids
from rollcall.operators.chunks import with_previous
from rollcall.sources.roster import from_snapshot
from rollcall.sources.statelog import LOG_ORDER, images


def fetch_by_state(state: DataFrame, states, max_attempts: int | None = None) -> DataFrame:
    """Rows in the given states, under an attempt cap if one is given, by position.
    The filter reaches the scan of a written state table."""
    if not states:
        return state.limit(0)
    rows = state.where(F.col("state").isin(*states))
    if max_attempts is not None:
        rows = rows.where(F.col("attempts") < max_attempts)
    return rows.orderBy(S.POSITION)


def polled(max_attempts: int = S.MAX_ATTEMPTS) -> Column:
    """Whether a state row is still polled. One predicate, so one scan."""
    return F.col("state").isin(*S.POLLED_STATES) | (
        (F.col("state") == S.FAILED_FETCH) & (F.col("attempts") < max_attempts)
    )


def collect_pool(state: DataFrame, max_attempts: int = S.MAX_ATTEMPTS) -> DataFrame:
    return state.where(polled(max_attempts))


def pending_remaining(state: DataFrame, max_attempts: int = S.MAX_ATTEMPTS) -> DataFrame:
    """One row: how many rows are still polled. Zero means drained."""
    return state.agg(F.count_if(polled(max_attempts)).alias("remaining"))


def select_retryable(state: DataFrame, roster_schema: T.StructType) -> DataFrame:
    """Rows to process again, taken from their saved snapshot, not the source."""
    rows = state.where(F.col("state").isin(*S.RETRYABLE_STATES))
    row = from_snapshot(F.col("excel_row_json"), roster_schema)
    return rows.select("event_id", "state", "attempts", row.alias("_r")).select(
        "event_id", "state", "attempts", "_r.*"
    )


def retryable() -> Column:
    return F.col("state").isin(*S.RETRYABLE_STATES)


def retry_failed(state: DataFrame, as_of) -> DataFrame:
    """Retryable rows back to pending; their attempts keep counting."""
    rows = state.where(retryable())
    return images(rows, as_of, state=F.lit(S.PENDING), last_error=F.lit(None).cast("string"))


def retry_rows(state: DataFrame, events: list[str] | DataFrame, as_of) -> DataFrame:
    """Listed events back to pending with a clean count; unknown ids do nothing."""
    if isinstance(events, DataFrame):
        rows = state.join(events.select("event_id").distinct(), "event_id", "left_semi")
    else:
        rows = state.where(F.col("event_id").isin([e.strip() for e in events if e.strip()]))
    return images(
        rows, as_of, state=F.lit(S.PENDING), last_error=F.lit(None).cast("string"), attempts=F.lit(0)
    )


def overdue(as_of, hours: int = S.TIMEOUT_HOURS) -> Column:
    """Submitted, and longer ago than the limit."""
    cutoff = ids.hours_before(ids.moment(as_of), hours)
    return (F.col("state") == S.SUBMITTED) & F.coalesce(
        F.col("webhook_submitted_at") < cutoff, F.lit(False)
    )


def timeout_message(hours: int) -> str:
    return f"timeout after {hours}h in {S.SUBMITTED}"


def timeout_sweep(state: DataFrame, as_of, hours: int = S.TIMEOUT_HOURS) -> DataFrame:
    """Images of the rows that have waited too long."""
    return images(
        state.where(overdue(as_of, hours)),
        as_of,
        state=F.lit(S.FAILED_TIMEOUT),
        last_error=F.lit(timeout_message(hours)),
    )


def patch_images(state: DataFrame, changes: DataFrame, as_of, *, order: list[str] | None = None) -> DataFrame:
    """Images from a table of changes: every column of `changes` besides the event and the
    order replaces the stored one, nulls included. Unknown events do nothing.

    An event gets one image, so that its time and sequence number name it: of several
    changes the last by `order` counts. Changes that differ without an order between
    them are refused: the query fails with the event's id.
    """
    order = order or []
    named = [c for c in changes.columns if c not in ("event_id", *order)]
    said = F.struct(*named)
    places = changes.groupBy("event_id", *order).agg(F.min(said).alias("_least"), F.max(said).alias("_said"))
    fault = F.raise_error(F.concat(F.lit("changes that differ without an order between them: "), F.col("event_id")))
    kind = places.schema["_said"].dataType
    told = F.when(F.col("_least").eqNullSafe(F.col("_said")), F.col("_said")).otherwise(fault.cast(kind))
    last = F.max(F.struct(*order, told.alias("_said")))["_said"]
    new = places.groupBy("event_id").agg(last.alias("_new"))
    rows = state.join(new, "event_id")
    return images(rows, as_of, **{c: F.col(f"_new.{c}") for c in named})


def state_history(log: DataFrame, **cutting) -> DataFrame:
    """Every image with the state it replaced, in log order; any group size."""
    rows = log.select("event_id", "state", "attempts", *LOG_ORDER)
    return with_previous(rows, "event_id", LOG_ORDER, "state", "previous_state", **cutting)


def attempts_spent(log: DataFrame, **cutting) -> DataFrame:
    """(event_id, spent, attempts): failed tries over an event's whole log, and those
    that count now. What an image adds to the one before it was spent; a retry that
    sets the count back spends nothing and forgets nothing."""
    rows = log.select("event_id", "attempts", *LOG_ORDER)
    steps = with_previous(rows, "event_id", LOG_ORDER, "attempts", "_before", **cutting)
    added = F.greatest(F.col("attempts") - F.coalesce("_before", F.lit(0)), F.lit(0))
    last = F.max(F.struct(*LOG_ORDER, "attempts"))["attempts"]
    return steps.groupBy("event_id").agg(F.sum(added).cast("int").alias("spent"), last.alias("attempts"))


def dim_patch(base: DataFrame, patch: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """`base` with the values of `patch` in place of its own, by key, as if the patches of
    a key were applied one after the other: each column has its last non-null value by
    `order` (of equal places, the greatest value), or keeps its own if there is none."""
    named = [c for c in patch.columns if c not in (*key, *order)]

    def last(c: str) -> Column:
        return F.max(F.when(F.col(c).isNotNull(), F.struct(*order, c)))[c]

    new = patch.groupBy(*key).agg(*[last(c).alias(f"_new_{c}") for c in named])
    joined = base.join(new, key, "left")
    return joined.select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in named else F.col(c) for c in base.columns]
    )
