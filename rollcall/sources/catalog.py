"""Asset catalog: listings, type lookups and transcript content."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import links as L
from rollcall.operators.keyfilter import passing
from rollcall.operators.latest import best_per_key


def children(catalog: DataFrame) -> DataFrame:
    """Files inside folders, not trashed: the whole listing, no page cap."""
    return catalog.where(F.col("folder_id").isNotNull() & ~F.col("trashed"))


def folder_picks(catalog: DataFrame) -> DataFrame:
    """(folder_id, file_id, mime): the best transcript per folder.

    A document before a docx before a text file, then listing order. Partial and
    final aggregation, so a folder of any size costs one row per task.
    """
    usable = children(catalog).withColumn("_rank", L.transcript_rank(F.col("mime")))
    picked = best_per_key(
        usable.where(F.col("_rank").isNotNull()),
        "folder_id",
        [F.col("_rank"), F.col("list_order"), F.col("file_id")],
        F.struct("file_id", "mime"),
    )
    return picked.select("folder_id", "best.file_id", "best.mime")


def file_mimes(catalog: DataFrame) -> DataFrame:
    """(file_id, mime), one row per file. A file may be listed several times, and its
    type may have changed: a listing that is not trashed counts first, then listing
    order, folder and type."""
    ranking = [F.col(c) for c in ("trashed", "list_order", "folder_id", "mime")]
    return best_per_key(catalog, "file_id", ranking, F.col("mime")).withColumnRenamed("best", "mime")


def stored_content(content: DataFrame) -> DataFrame:
    """(file_id, content_id), one row per file: the smallest content id."""
    return content.groupBy("file_id").agg(F.min("content_id").alias("content_id"))


def file_key(file_id: Column) -> Column:
    return F.concat(F.lit("file:"), file_id)


def folder_key(folder_id: Column) -> Column:
    return F.concat(F.lit("folder:"), folder_id)


def _as_file_and_child() -> list[Column]:
    """A listing's row under the key of its file, and under that of its folder if it is a
    usable child; ranked as `file_mimes` and `folder_picks` do."""
    rank = L.transcript_rank(F.col("mime"))
    usable = F.col("folder_id").isNotNull() & ~F.col("trashed") & rank.isNotNull()
    key, first, tie = (lambda c: c.alias("asset_key")), (lambda c: c.alias("first")), (lambda c: c.alias("tie"))
    return [
        F.struct(key(file_key(F.col("file_id"))), first(F.col("trashed").cast("int")), tie(F.col("folder_id"))),
        F.struct(key(F.when(usable, folder_key(F.col("folder_id")))), first(rank), tie(F.col("file_id"))),
    ]


@dataclass(frozen=True)
class Assets:
    """What links can resolve to: the listing and the content index, as they are.

    Neither is grouped or shuffled as a whole: rows that no link asks for are dropped
    where they are read, by a filter of the keys that are asked for.
    """

    listing: DataFrame
    content: DataFrame

    def wanted(self, keys: DataFrame) -> DataFrame:
        """(asset_key, found_file, found_mime) for at least the given keys (column
        `asset_key`): `file:<id>` and `folder:<id>`."""
        listed = self.listing.select(
            "file_id", "mime", "list_order", F.explode(F.array(*_as_file_and_child())).alias("x")
        )
        listed = listed.where("x.asset_key IS NOT NULL").select("file_id", "mime", "list_order", "x.*")
        asked = passing(listed, F.col("asset_key"), keys, "asset_key")
        ranking = [F.col(c) for c in ("first", "list_order", "tie", "mime")]
        best = best_per_key(asked, "asset_key", ranking, F.struct("file_id", "mime"))
        return best.select("asset_key", F.col("best.file_id").alias("found_file"), F.col("best.mime").alias("found_mime"))

    def content_of(self, files: DataFrame) -> DataFrame:
        """(file_id, content_id) for at least the given files (column
        `asset_file_id`), one row per file."""
        return stored_content(passing(self.content, F.col("file_id"), files, "asset_file_id"))


def usable_assets(catalog: DataFrame, content: DataFrame) -> Assets:
    """`catalog` is a listing, `content` is (file_id, content_id)."""
    return Assets(catalog, content)


def content_digests(documents: DataFrame) -> DataFrame:
    """(content_id, content_sha256, content_bytes): each stored text read once."""
    raw = F.encode("content", "UTF-8")
    return documents.select(
        "content_id",
        F.sha2(raw, 256).alias("content_sha256"),
        F.octet_length("content").cast("bigint").alias("content_bytes"),
    )
