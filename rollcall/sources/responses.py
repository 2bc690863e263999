"""Response log: batch and streaming readers of poll answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.responses import parsed_body, response_outcome

RESPONSE_SCHEMA = (
    "seq bigint, ts timestamp_ntz, event_id string, status int, body string, "
    "delivery_failed boolean"
)


def read_responses(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(RESPONSE_SCHEMA).load(path)


def stream_responses(
    spark: SparkSession, path: str, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """New response files as a stream. A body that is not JSON stays as it is and
    reads as null where a field is wanted."""
    reader = spark.readStream.format(fmt).schema(RESPONSE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def with_outcome(responses: DataFrame, *keep: str) -> DataFrame:
    """Narrow rows for folding: the meaning of each response, without its body, and the
    columns to keep."""
    body = parsed_body(F.col("status"), F.col("body")).alias("_parsed")
    meaning = response_outcome(F.col("status"), F.col("body"), F.col("delivery_failed"), parsed=F.col("_parsed"))
    return responses.select("*", body).select("event_id", "ts", "seq", *keep, meaning.alias("o")).select(
        "event_id",
        "ts",
        "seq",
        *keep,
        F.col("o.state").alias("st"),
        F.col("o.attempts_added").alias("inc"),
        F.col("o.error").alias("err"),
        F.col("o.url").alias("url"),
    )
