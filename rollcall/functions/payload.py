"""Submission payload: nested JSON body, signature and headers."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.functions import ids
from rollcall.functions.text import clean_display, empty_to_null, or_default

def payload_struct(
    event: Column,
    recorded_at: Column,
    signed_url: Column,
    *,
    default_grade: str = S.DEFAULT_GRADE,
    lesson_number: Column | None = None,
) -> Column:
    """Nested payload of one roster row. Null fields are optional ones."""
    lesson = F.lit(None).cast("int") if lesson_number is None else lesson_number
    params = F.struct(
        event.alias("event_id"),
        ids.teacher_code(F.col("teacher")).alias("teacher_code"),
        ids.coach_code(F.col("coach")).alias("coach_code"),
        ids.school_code(F.col("infrastructureCode")).alias("school_code"),
        or_default(F.col("grade"), default_grade).alias("grade"),
        or_default(F.col("subject"), S.DEFAULT_SUBJECT).alias("subject"),
        recorded_at.alias("recorded_at"),
        empty_to_null(F.col("section")).alias("section"),
        empty_to_null(F.col("shift")).alias("shift"),
        lesson.alias("lesson_number"),
        clean_display(F.col("teacher")).alias("teacher_name"),
        clean_display(F.col("coach")).alias("coach_name"),
        clean_display(F.col("school")).alias("school_name"),
        clean_display(F.col("department")).alias("school_department"),
        clean_display(F.col("district")).alias("school_district"),
    )
    kwargs = F.struct(signed_url.alias("signed_url"), params.alias("params"))
    return F.struct(kwargs.alias("kwargs"))


def compact_json(struct: Column) -> Column:
    """JSON without blanks, ASCII only, null fields left out.

    Spark writes the hex digits of escapes in upper case; consumers that check a
    signature over the bytes expect lower case. Doubled backslashes are set aside
    meanwhile as a control character, which JSON text never holds: what then reads
    as an escape is one. Each step mentions its input once, so the JSON is built
    once per row, and all of them compile to code.
    """
    text = F.to_json(struct, {"writeNonAsciiCharacterAsCodePoint": "true"})
    text = F.replace(text, F.lit("\x7f"), F.lit("\\u007F"))
    text = F.replace(text, F.lit("\\\\"), F.lit("\x01"))
    for digit in "ABCDEF":
        in_escape = digit + r"(?<=\\u[0-9A-Fa-f]{0,3}" + digit + ")"
        text = F.regexp_replace(text, in_escape, digit.lower())
    return F.replace(text, F.lit("\x01"), F.lit("\\\\"))


def _pads(secret: str) -> tuple[bytearray, bytearray]:
    key = secret.encode("utf-8")
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    return bytearray(b ^ 0x36 for b in key), bytearray(b ^ 0x5C for b in key)


def secret_pads(spark: SparkSession, secret: str) -> tuple[Column, Column]:
    """The two key pads as scalar subqueries over a one-row table, so that the
    key is not written into plans or event logs as a literal."""
    pads = spark.createDataFrame([_pads(secret)], "inner_pad binary, outer_pad binary")
    return pads.select("inner_pad").scalar(), pads.select("outer_pad").scalar()


def hmac_sha256(message: Column, pads: tuple[Column, Column]) -> Column:
    """Hex HMAC-SHA256 of a text, from two built-in hashes."""
    inner_pad, outer_pad = pads
    inner = F.sha2(F.concat(inner_pad, F.encode(message, "UTF-8")), 256)
    return F.sha2(F.concat(outer_pad, F.unhex(inner)), 256)


def signature(timestamp: Column, body: Column, pads: tuple[Column, Column]) -> Column:
    signed_text = F.concat(timestamp.cast("string"), F.lit("."), body)
    return F.concat(F.lit("sha256="), hmac_sha256(signed_text, pads))


def headers(timestamp: Column, sign: Column) -> Column:
    return F.struct(
        F.lit("application/json").alias("Content-Type"),
        sign.alias("X-Webhook-Signature"),
        timestamp.cast("string").alias("X-Webhook-Timestamp"),
    )
