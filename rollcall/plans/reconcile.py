"""Phase 2: fold a history of responses into the state of each event.

Rules, per event in (ts, seq) order:

* a row still `submitted` past its deadline times out when it is next polled, and
  the response of that poll is not used;
* each response implies a state (or none, for 429), may add an attempt, may set the
  error; a final state, or a fetch failure at the attempt cap, ends polling;
* what comes after the end is ignored.

Every response before the end was applied, so the true state before a response is
just the last implied one, and attempts are a running count: no row needs the
result of another, and one window per event does it, or one per chunk of an event
that is too large for a task (see `operators.chunks`).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.functions import ids
from rollcall.operators.chunks import Chunked, cut_hot_groups
from rollcall.plans.transitions import collect_pool, timeout_message
from rollcall.sources.responses import with_outcome
from rollcall.sources.statelog import images

ORDER = ["ts", "seq"]
FINAL_STATES = [S.COMPLETED, S.FAILED_DELIVERY, S.FAILED_ANALYSIS]


def reconcile(
    state: DataFrame,
    responses: DataFrame,
    *,
    max_attempts: int = S.MAX_ATTEMPTS,
    timeout_hours: int = S.TIMEOUT_HOURS,
    **cutting,
) -> DataFrame:
    """Final state per polled event that got a response.

    `state` has event_id, state, attempts, last_error, webhook_submitted_at; rows
    that are not polled are left out. Returns event_id, state, attempts,
    last_error, pdf_url, decided_at, last_seq, polls (responses used up).
    """
    pool = collect_pool(state, max_attempts).select(
        "event_id",
        F.col("state").alias("_state0"),
        F.col("attempts").alias("_attempts0"),
        F.col("last_error").alias("_error0"),
        ids.hours_after(F.col("webhook_submitted_at"), timeout_hours).alias("_deadline"),
    )
    chunked = cut_hot_groups(responses, "event_id", ORDER, **cutting)
    chunked = replace(chunked, rows=with_outcome(chunked.rows, "chunk"))
    start = _carried(chunked, chunked.spread(pool))
    keys = ["event_id", "chunk"]
    rows = chunked.rows.join(start, keys)

    # Step 1: state and error before each response, attempts with it.
    window = chunked.window(*ORDER)
    earlier = window.rowsBetween(W.unboundedPreceding, -1)
    upto = window.rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumns(
        {
            "before": F.coalesce(F.last("st", ignorenulls=True).over(earlier), F.col("_state0")),
            "error_before": F.coalesce(F.last("err", ignorenulls=True).over(earlier), F.col("_error0")),
            "attempts_before": F.coalesce(F.sum("inc").over(earlier), F.lit(0)) + F.col("_attempts0"),
        }
    )
    # Step 2: where polling ends.
    late = F.coalesce(F.col("ts") > F.col("_deadline"), F.lit(False))
    rows = rows.withColumn("timed_out", late & (F.col("before") == S.SUBMITTED))
    attempts = F.col("attempts_before") + F.when(F.col("timed_out"), 0).otherwise(F.col("inc"))
    rows = rows.withColumn("attempts", attempts.cast("int"))
    ends = (
        F.col("timed_out")
        | F.coalesce(F.col("st").isin(*FINAL_STATES), F.lit(False))
        | (F.coalesce(F.col("st") == S.FAILED_FETCH, F.lit(False)) & (F.col("attempts") >= max_attempts))
    )
    rows = rows.withColumn("ends", ends)
    # Step 3: keep rows with no end strictly before them; the last one decides.
    ended_before = F.coalesce(F.max("ends").over(earlier), F.lit(False))
    rows = rows.withColumns({"ended_before": ended_before, "_n": F.row_number().over(window)})
    kept = rows.where(~F.col("ended_before"))
    decided = kept.groupBy(*keys).agg(F.max(_result(timeout_hours)).alias("r"))
    decided = _first_end(decided)
    return decided.select(
        "event_id",
        "r.state",
        "r.attempts",
        "r.last_error",
        "r.pdf_url",
        "r.decided_at",
        F.col("r.seq").alias("last_seq"),
        F.col("r._n").cast("bigint").alias("polls"),
    )


def _result(timeout_hours: int) -> Column:
    """What a row decides if it is the last one used. Ordered by its place first."""
    timed_out = F.col("timed_out")
    state = F.when(timed_out, S.FAILED_TIMEOUT).otherwise(F.coalesce("st", "before"))
    error = F.when(timed_out, timeout_message(timeout_hours)).otherwise(
        F.coalesce("err", "error_before")
    )
    return F.struct(
        "ts",
        "seq",
        "_n",
        "ends",
        state.alias("state"),
        F.col("attempts").alias("attempts"),
        error.alias("last_error"),
        F.when(~timed_out, F.col("url")).alias("pdf_url"),
        F.col("ts").alias("decided_at"),
    )


def _carried(chunked: Chunked, start: DataFrame) -> DataFrame:
    """Starting values per chunk: those of the event, moved on by earlier chunks."""
    place = [F.col(c) for c in ORDER]
    sums = chunked.carry(
        _st=F.max(F.when(F.col("st").isNotNull(), F.struct(*place, F.col("st").alias("v")))),
        _err=F.max(F.when(F.col("err").isNotNull(), F.struct(*place, F.col("err").alias("v")))),
        _inc=F.sum("inc"),
    )
    earlier = W.partitionBy("event_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    moved = sums.select(
        "event_id",
        "chunk",
        F.last(F.col("_st")["v"], ignorenulls=True).over(earlier).alias("_st"),
        F.last(F.col("_err")["v"], ignorenulls=True).over(earlier).alias("_err"),
        F.coalesce(F.sum("_inc").over(earlier), F.lit(0)).alias("_inc"),
    )
    return (
        start.join(F.broadcast(moved), ["event_id", "chunk"], "left")
        .withColumns(
            {
                "_state0": F.coalesce("_st", "_state0"),
                "_error0": F.coalesce("_err", "_error0"),
                "_attempts0": F.col("_attempts0") + F.coalesce("_inc", F.lit(0)),
            }
        )
        .drop("_st", "_err", "_inc")
    )


def _first_end(decided: DataFrame) -> DataFrame:
    """Per event: the result of the first chunk that ends polling, else of the
    last chunk; polls are added up to there."""
    by_chunk = W.partitionBy("event_id").orderBy("chunk")
    earlier = by_chunk.rowsBetween(W.unboundedPreceding, -1)
    rows = decided.withColumns(
        {
            "_over": F.coalesce(F.max(F.col("r.ends")).over(earlier), F.lit(False)),
            "_before": F.coalesce(F.sum(F.col("r._n")).over(earlier), F.lit(0)),
        }
    ).where(~F.col("_over"))
    moved = F.col("r").withField("_n", (F.col("r._n") + F.col("_before")))
    return rows.withColumn("r", moved).groupBy("event_id").agg(F.max("r").alias("r"))


def reconciled_images(state: DataFrame, folded: DataFrame, as_of) -> DataFrame:
    """Images for the events of a fold. A report link stays only with `completed`:
    folding a longer history may take an event out of that state again."""
    new = folded.select(
        "event_id",
        F.col("state").alias("_state"),
        F.col("attempts").alias("_attempts"),
        F.col("last_error").alias("_error"),
        "pdf_url",
        "decided_at",
    )
    rows = state.join(new, "event_id")
    done = F.col("_state") == S.COMPLETED
    return images(
        rows,
        as_of,
        state=F.col("_state"),
        attempts=F.col("_attempts"),
        last_error=F.col("_error"),
        last_attempt_at=F.col("decided_at"),
        pdf_drive_id=F.when(done, ids.report_name(F.col("event_id"))),
        pdf_drive_link=F.when(done, F.col("pdf_url")),
    )
