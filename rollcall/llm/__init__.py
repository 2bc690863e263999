"""Operators for preparing training data. Nothing else in the library imports them."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (where it is
    installed on the executors, as on a cluster, this changes nothing), and bound what
    reaches them at a time, unless the session has bounds of its own."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [_ROOT])
    if spark.conf.get(_BATCH, "10000") == "10000":
        spark.conf.set(_BATCH, "2000")


def load():
    """The registry of this package's queries, with their check SQL."""
    from rollcall.llm import queries

    return queries
