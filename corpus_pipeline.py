"""The corpus pipeline: quality rules, language, exact and near duplicates, packing.

Each stage calls one operator of rollcall.llm, works on every row the stage before has
kept, and returns rows in the columns of documents; the last returns packed pieces.
Where an operator decides about a row alone, the row goes along with the decision
(`carry`); where it decides about groups, the operator gives the rows that stay. A null
id, ids that occur twice and columns named like an operator's own are no special cases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import exact, langid, packing, prepare, queries, rules, simhash
from rollcall.operators.scratch import materialize

#: Tokens, fingerprints and language models have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of policy 2 rejects."""
    return rules.ledger(docs, carry=True).where(~rules.rejected("2")).select("doc.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learned from the others: neither without letters nor
    beyond what their language's training texts look like."""
    prepare(spark)
    return langid.identify(docs, carry=True).where("NOT rejected").select("doc.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the one with most code points, then the
    smallest id; one row of each group, also where ids are null or repeated."""
    return exact.one_of_each(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of 4-word shingles at 4 bits or less, one with
    the smallest id; one row of each component, also where ids are null or repeated."""
    prepare(spark)
    return simhash.one_of_each(docs, shingle=4, bits=4)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens in sequences of 1024, as op4 returns them."""
    prepare(spark)
    return queries.packed_pieces(docs)


STAGES = [
    ("quality rules", quality),
    ("language ID", language),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written and read again."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        rows = stage(spark, rows, sf_dir)
        if place + 1 < len(STAGES):
            rows = materialize(rows, f"stage-{place + 1}")
    return rows
