"""The library's rules for users of SQL: temporary functions of a session.

`register(spark)` once, then `SELECT rollcall_link_case(transcriptLink, videoLink) ...`.
Their texts are built from the same fixed values as the column functions; Spark puts a
function's text in the place of its call, so they cost what the expressions cost.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from rollcall import settings as S
from rollcall.functions.links import CASES
from rollcall.functions.text import WHITESPACE


def _text(value: str) -> str:
    """A SQL literal, whatever the value holds."""
    return "'" + "".join(c if c.isalnum() and c.isascii() else f"\\u{ord(c):04x}" for c in value) + "'"


def _cases(pairs, otherwise: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {a} THEN {b}" for a, b in pairs) + f" ELSE {otherwise} END"


def definitions() -> dict[str, str]:
    """Signature and body of each function, in the order in which they use one another."""
    kinds = [(f"url RLIKE {_text(p)}", _text(name)) for name, p in S.LINK_PATTERNS + S.UNSUPPORTED_PATTERNS]
    ids = [(f"url RLIKE {_text(p)}", f"regexp_extract(url, {_text(p)}, 1)") for _, p in S.LINK_PATTERNS]
    keyed = [(f"kind_and_same = {_text(k)}", _text(v)) for k, v in CASES.items()]
    struct = "STRUCT<state: STRING, attempts_added: INT, error: STRING, url: STRING>"

    def outcome(state, added, error="NULL", url="NULL"):
        shown = "NULL" if state is None else _text(state)
        return (
            f"named_struct('state', CAST({shown} AS STRING), 'attempts_added', {added}, "
            f"'error', CAST({error} AS STRING), 'url', CAST({url} AS STRING))"
        )

    field = "try_variant_get(rollcall_body(status, body), {0}, 'string')".format
    link = f"nullif({field(_text('$.url'))}, '')"
    details = [("pipeline_status", "failed"), ("session_status", "failed"), ("reason", "data_incomplete")]
    failed = " OR ".join(f"coalesce({field(_text('$.detail.' + k))} = {_text(v)}, false)" for k, v in details)
    http = f"concat('HTTP ', status, ': ', substring(coalesce(body, ''), 1, {S.COLLECT_ERROR_CHARS}))"
    outcomes = [
        ("status IS NULL", outcome(S.FAILED_FETCH, 1, "'request failed'")),
        (f"status = 200 AND {link} IS NOT NULL AND coalesce(delivery_failed, false)",
         outcome(S.FAILED_DELIVERY, 1, "'report delivery failed'")),
        (f"status = 200 AND {link} IS NOT NULL", outcome(S.COMPLETED, 0, url=link)),
        (f"status = 422 AND ({failed})", outcome(S.FAILED_ANALYSIS, 0, f"concat({_text(S.ERROR_TERMINAL)}, body)")),
        ("status = 422", outcome(S.SUBMITTED, 0)),
        ("status = 404", outcome(S.FAILED_404, 0, _text(S.ERROR_404))),
        ("status = 429", outcome(None, 0)),
    ]
    trimmed = f"btrim(link, {_text(WHITESPACE)})"
    return {
        "rollcall_display(link STRING) RETURNS STRING":
            f"nullif(CASE WHEN lower({trimmed}) <> {_text(S.MISSING_WORD)} THEN {trimmed} END, '')",
        "rollcall_link_kind(url STRING) RETURNS STRING": _cases([("url IS NULL", "'empty'"), *kinds], _text(S.UNSUPPORTED_OTHER)),
        "rollcall_link_id(url STRING) RETURNS STRING": _cases(ids),
        "rollcall_case_of(kind_and_same STRING) RETURNS STRING": _cases(keyed, "'F'"),
        "rollcall_link_case(transcript STRING, video STRING) RETURNS STRING":
            "rollcall_case_of(concat(rollcall_link_kind(rollcall_display(transcript)), "
            "CASE WHEN rollcall_display(transcript) = rollcall_display(video) THEN '=' ELSE '' END))",
        "rollcall_body(status INT, body STRING) RETURNS VARIANT": "CASE WHEN status IN (200, 422) THEN try_parse_json(body) END",
        f"rollcall_response(status INT, body STRING, delivery_failed BOOLEAN) RETURNS {struct}":
            _cases(outcomes, outcome(S.FAILED_FETCH, 1, http)),
    }


def register(spark: SparkSession) -> None:
    """Make the functions known to a session."""
    for signature, body in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
