"""Meaning of one poll response."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.functions.text import truncate


def parsed_body(status: Column, body: Column) -> Column:
    """The body of an answer whose body says something (200 and 422), parsed once; null for
    others, and where it is not JSON."""
    return F.when(status.isin(200, 422), F.try_parse_json(body))


def _text_at(parsed: Column, path: str) -> Column:
    return F.try_variant_get(parsed, path, "string")


def terminal_422(status: Column, body: Column, parsed: Column | None = None) -> Column:
    """True when a 422 says the analysis has failed for good. `parsed` is the body as
    `parsed_body` gives it, if it is at hand."""
    parsed = parsed_body(status, body) if parsed is None else parsed

    def detail(name, value):
        return F.coalesce(_text_at(parsed, f"$.detail.{name}") == value, F.lit(False))

    failed = (
        detail("pipeline_status", "failed")
        | detail("session_status", "failed")
        | detail("reason", "data_incomplete")
    )
    return (F.coalesce(status, F.lit(0)) == 422) & failed


def report_url(status: Column, body: Column, parsed: Column | None = None) -> Column:
    """Link to the finished report, null unless the answer was a 200 with one."""
    parsed = parsed_body(status, body) if parsed is None else parsed
    return F.when(status == 200, F.nullif(_text_at(parsed, "$.url"), F.lit("")))


def response_outcome(
    status: Column,
    body: Column,
    delivery_failed: Column,
    *,
    request_error: Column | None = None,
    delivery_error: Column | None = None,
    parsed: Column | None = None,
) -> Column:
    """struct(state, attempts_added, error, url) implied by one response alone.

    `state` is null when the response changes nothing (429); `error` is null when
    the recorded error stays. A null status means the request itself failed.
    `parsed` is the body as `parsed_body` gives it, for callers that keep it.
    """
    url = report_url(status, body, parsed)
    request_text = F.lit("request failed") if request_error is None else request_error
    delivery_text = F.lit("report delivery failed") if delivery_error is None else delivery_error

    def outcome(state, added, error=None, link=None):
        text = F.lit(None) if error is None else error
        shown = F.lit(None) if link is None else link
        return F.struct(
            F.lit(state).cast("string").alias("state"),
            F.lit(added).alias("attempts_added"),
            text.cast("string").alias("error"),
            shown.cast("string").alias("url"),
        )

    http_text = F.concat(
        F.lit("HTTP "), status.cast("string"), F.lit(": "), truncate(body, S.COLLECT_ERROR_CHARS)
    )
    return (
        F.when(status.isNull(), outcome(S.FAILED_FETCH, 1, request_text))
        .when(
            url.isNotNull() & F.coalesce(delivery_failed, F.lit(False)),
            outcome(S.FAILED_DELIVERY, 1, delivery_text),
        )
        .when(url.isNotNull(), outcome(S.COMPLETED, 0, link=url))
        .when(
            terminal_422(status, body, parsed),
            outcome(S.FAILED_ANALYSIS, 0, F.concat(F.lit(S.ERROR_TERMINAL), body)),
        )
        .when(status == 422, outcome(S.SUBMITTED, 0))
        .when(status == 404, outcome(S.FAILED_404, 0, F.lit(S.ERROR_404)))
        .when(status == 429, outcome(None, 0))
        .otherwise(outcome(S.FAILED_FETCH, 1, http_text))
    )
