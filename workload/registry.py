"""Queries over the given tables, each with the SQL that must agree with it.

Fixture views (roster, catalog, logs, warehouse star) are SQL over the given
tables, written once in words both engines understand. In Spark a table name is
replaced by its Parquet file or by the view's text. A view that joins, groups or numbers
is written once as a table; one that only renames and computes row by row is read as it
is, so that a query computes the columns it needs and no others. In the check SQL views
become common table expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollcall.operators.scratch import new_path
from workload.fixtures import VIEWS

GIVEN = {
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
}
_TABLE = re.compile(r"\b(FROM|JOIN)\s+([a-z_]+)\b")
_GATHERS = re.compile(r"\b(JOIN|GROUP BY|OVER|DISTINCT)\b")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}
_VIEW_PATHS: dict[tuple[str, str, str], str] = {}


def _names(sql: str) -> list[str]:
    return [name for _, name in _TABLE.findall(sql)]


def _given(view: str) -> set[str]:
    """The given tables that a view is made of."""
    found = set()
    for name in _names(VIEWS[view]):
        found |= {name} if name in GIVEN else _given(name)
    return found


class Tables:
    """Given tables and fixture views as DataFrames: `t("roster")`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        if name in GIVEN:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        sql = self._inlined(VIEWS[name])
        return self._written(name, sql) if _GATHERS.search(sql) else self.spark.sql(sql)

    def _written(self, name: str, sql: str) -> DataFrame:
        """A view is computed once per session and folder, as a Parquet table, so
        that queries scan it like the tables they are meant for. Its rows are dealt anew
        only if the given tables are too small to be read by as many tasks."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _VIEW_PATHS:
            path, rows = new_path(self.spark, f"view-{name}"), self.spark.sql(sql)
            tasks = self.spark.sparkContext.defaultParallelism
            if max(self._splits(table) for table in _given(name)) < tasks:
                rows = rows.repartition(tasks)
            rows.write.parquet(path)
            _VIEW_PATHS[key] = path
        return self.spark.read.parquet(_VIEW_PATHS[key])

    def _splits(self, table: str) -> int:
        """How many tasks read a given table."""
        return self(table).rdd.getNumPartitions()

    def _inlined(self, sql: str) -> str:
        def table(match):
            word, name = match.groups()
            if name in GIVEN:
                return f"{word} parquet.`{self.folder}/{name}.parquet`"
            if name in VIEWS:
                return f"{word} ({self._inlined(VIEWS[name])}) {name}"
            return match.group(0)

        return _TABLE.sub(table, sql)


def _with_views(sql: str) -> str:
    """Put the views a check needs in front of it, dependencies first."""
    order: list[str] = []

    def add(text: str):
        for name in _names(text):
            if name in VIEWS and name not in order:
                add(VIEWS[name])
                if name not in order:
                    order.append(name)

    add(sql)
    views = ",\n".join(f"{name} AS MATERIALIZED ({VIEWS[name].strip()})" for name in order)
    body = sql.strip()
    if not views:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"


def query(name: str, sql: str | None = None):
    """Register a function of `Tables` under a name, with its check."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = _with_views(sql)
        return build

    return register
