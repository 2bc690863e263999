"""Many rows, each with a key, to the one row of a table that has it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.scratch import materialize

#: Rows that ask for one key before they are dealt to a further task.
ASKING = 50_000


def look_up(
    rows: DataFrame, table: DataFrame, key: str, *, values: Sequence[str], asking: int = ASKING, label: str = "asking"
) -> DataFrame:
    """`rows` with the columns `values` of `table` by `key`; rows whose key is not in the
    table (or null) are left out.

    Rows are written once and counted by key. The counts decide which rows of the table
    are looked at at all, and how often each is needed: a key that many rows ask for
    is copied once per `asking` of them, and its rows are dealt over the copies, so no
    task receives all rows of a key. Of several rows of the table with one key the one
    with the smallest values counts. The wide side moves once.
    """
    written = materialize(rows, label)
    asked = written.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.ceil(F.count("*") / F.lit(asking)).cast("int").alias("_copies")
    )
    asked = asked.withColumnRenamed(key, "_key")
    found = table.select(F.col(key).alias("_asked"), *values).join(asked, F.col("_asked") == F.col("_key")).drop("_asked")
    found = found.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    one = found.groupBy("_key", "_copy").agg(
        F.min(F.struct(*values)).alias("_found"), F.first("_copies").alias("_copies")
    )
    own = written.join(asked.withColumnRenamed("_copies", "_n"), F.col(key) == F.col("_key")).drop("_key")
    dealt = own.withColumn("_deal", F.pmod(F.xxhash64(*written.columns), F.col("_n"))).drop("_n")
    joined = dealt.join(one, (F.col(key) == F.col("_key")) & (F.col("_deal") == F.col("_copy")))
    return joined.select(*written.columns, "_found.*")
