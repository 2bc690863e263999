"""Roster ingestion: headers, blank rows, numeric text, positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall import settings as S
from rollcall.functions.text import denumber, fold_header_name
from rollcall.operators.ordering import dense_index, dense_index_by_ordinal, scan_index

# Where a row stood in the source, in reading order: its file, and the block a task read.
SOURCE_ORDER = ["_src_file", "_src_block"]


class MissingColumns(ValueError):
    """The roster lacks required columns."""


def canonical_names(names: list[str]) -> list[str]:
    """Canonical name per header; unknown headers keep their own."""
    alias = {fold_header_name(c): c for c in S.ROSTER_COLUMNS} | S.SPANISH_HEADERS
    return [alias.get(fold_header_name(n), n) for n in names]


def canonicalize(df: DataFrame) -> DataFrame:
    """Rename headers (English or Spanish, any case, accents or spacing). Of two
    headers that mean the same column the right-most is kept."""
    names = canonical_names(df.columns)
    last = {name: i for i, name in enumerate(names)}
    numbered = df.toDF(*[f"_c{i}" for i in range(len(names))])
    seen = list(dict.fromkeys(names))
    return numbered.select(*[F.col(f"_c{last[name]}").alias(name) for name in seen])


def missing_columns(df: DataFrame) -> list[str]:
    return [c for c in S.ROSTER_COLUMNS if c not in df.columns]


def require_columns(df: DataFrame) -> DataFrame:
    missing = missing_columns(df)
    if missing:
        raise MissingColumns(f"roster is missing required columns: {missing}")
    return df


def drop_blank(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows whose every source cell is null."""
    return df.dropna(how="all", subset=columns or df.columns)


def repair_numbers(df: DataFrame, *, numeric_text: bool = False) -> DataFrame:
    """The two columns that need it as text: integral doubles without `.0`, integers and
    decimals as they print. With `numeric_text`, for sources that have no types, a text
    of digits followed by `.0` loses it too."""
    repaired = {}
    for c, kind in df.select(*[c for c in S.NUMERIC_TEXT_COLUMNS if c in df.columns]).dtypes:
        if kind in ("double", "float"):
            repaired[c] = denumber(F.col(c))
        elif kind != "string":
            repaired[c] = F.col(c).cast("string")
        elif numeric_text:
            repaired[c] = F.regexp_replace(c, r"^(-?[0-9]+)\.0+$", "$1")
    return df.withColumns(repaired) if repaired else df


def read_roster_file(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Raw rows of a CSV or Parquet roster with their place in the source.

    CSV cells are text (nothing is inferred); an unquoted empty cell is null, a
    quoted one is empty text. Cells with line breaks need `multi_line`, which
    gives up splitting a file over tasks.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        # An unquoted empty cell reads as the null text, which no real cell holds.
        df = reader.csv(
            path, header=True, inferSchema=False, escape='"', nullValue="\0", emptyValue="",
            multiLine=multi_line,
        )
    elif fmt == "parquet":
        df = reader.parquet(path)
    else:
        raise ValueError(f"roster format must be csv or parquet, not {fmt}")
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_src_file"),
        F.col("_metadata.file_block_start").alias("_src_block"),
    )


def read_roster(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """A ready roster from a file: canonical columns, blank rows dropped, numeric
    text repaired (CSV has no types: `numeric_text`), `row_position` in file order, files
    in order of their paths. Rows are numbered where they are read. Cells with line
    breaks need `multi_line`."""
    raw = read_roster_file(spark, path, fmt, schema, multi_line)
    places = raw.select(*SOURCE_ORDER).columns
    cells = [c for c in raw.columns if c not in places]
    keep = [F.col(f"`{c}`") for c in cells]
    named = canonicalize(raw.select(*keep, *places))
    rows = _cleaned(named, SOURCE_ORDER, numeric_text=fmt == "csv")
    return scan_index(rows, SOURCE_ORDER, S.POSITION).drop(*SOURCE_ORDER)


def _cleaned(df: DataFrame, order: list[str], *, numeric_text: bool) -> DataFrame:
    require_columns(df)
    cells = [c for c in df.columns if c not in order]
    return repair_numbers(drop_blank(df, cells), numeric_text=numeric_text)


def prepare(df: DataFrame, order: list[str], *, numeric_text: bool = False) -> DataFrame:
    """Validate, clean and number a roster whose columns are canonical already.

    `order` is a total order of the source rows. With a single integer column only
    that is numbered; nulls and repeats in it are refused. (Files need no order: see
    `read_roster`.)
    """
    rows = _cleaned(df, order, numeric_text=numeric_text)
    kind = dict(rows.dtypes)[order[0]]
    if len(order) == 1 and kind in ("bigint", "int"):
        return dense_index_by_ordinal(rows, order[0], S.POSITION)
    return dense_index(rows, order, S.POSITION)


def snapshot(columns: list[str]) -> Column:
    """The whole row as JSON text, nulls included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def from_snapshot(col: Column, schema: T.StructType) -> Column:
    return F.from_json(col, schema)


def roster_schema(extra: list[str] | None = None) -> T.StructType:
    """Schema of a prepared roster row."""
    fields = [T.StructField(S.POSITION, T.LongType())]
    fields += [T.StructField(c, T.StringType()) for c in S.ROSTER_COLUMNS + (extra or [])]
    return T.StructType(fields)
