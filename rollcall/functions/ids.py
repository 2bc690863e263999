"""Identifiers, paths and deadlines derived from a row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.functions.text import slug


def event_id(position: Column, prefix: str = S.EVENT_ID_PREFIX) -> Column:
    return F.concat_ws("-", F.lit(prefix), position.cast("string"))


def teacher_code(teacher: Column) -> Column:
    return F.concat(F.lit(S.TEACHER_PREFIX), slug(teacher))


def coach_code(coach: Column) -> Column:
    return F.concat(F.lit(S.COACH_PREFIX), slug(coach))


def school_code(infrastructure_code: Column) -> Column:
    return F.concat(F.lit(S.SCHOOL_PREFIX), F.coalesce(infrastructure_code, F.lit("UNKNOWN")))


def blob_path(event: Column, ext: Column, prefix: str) -> Column:
    return F.concat_ws(
        "/", F.lit(prefix.strip("/")), event, F.concat(F.lit("transcript."), ext)
    )


def blob_uri(event: Column, ext: Column, bucket: str, prefix: str) -> Column:
    return F.concat(F.lit(f"gs://{bucket}/"), blob_path(event, ext, prefix))


def report_name(event: Column) -> Column:
    return F.concat(F.lit("reporte_"), event, F.lit(".pdf"))


def _utc(as_of: dt.datetime | str) -> dt.datetime:
    """A point in time without zone, which stands for UTC."""
    at = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return at if at.tzinfo is None else at.astimezone(dt.timezone.utc).replace(tzinfo=None)


def moment(as_of: dt.datetime | str) -> Column:
    """A point in time as a column; session and machine time zones play no part."""
    return F.lit(_utc(as_of).isoformat(sep=" ")).cast("timestamp_ntz")


def epoch_seconds(as_of: dt.datetime | str) -> int:
    return int(_utc(as_of).replace(tzinfo=dt.timezone.utc).timestamp())


def hours_before(ts: Column, hours: int) -> Column:
    return ts - F.make_dt_interval(F.lit(0), F.lit(hours))


def hours_after(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(hours))


def seconds_after(ts: Column, seconds: Column) -> Column:
    """Timestamp plus a (fractional) number of seconds."""
    zero = F.lit(0)
    return ts + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))
