"""How the links of a roster classify, and what they resolve to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.functions import links as L
from rollcall.operators.latest import first_n_per_key
from rollcall.operators.scratch import materialize
from rollcall.sources.catalog import Assets, file_key, folder_key


def case_distribution(roster: DataFrame) -> DataFrame:
    """Rows per case, most frequent first. Reads the two link columns only and
    never touches the catalog."""
    cases = L.with_case(roster.select("transcriptLink", "videoLink"))
    counts = cases.groupBy("drive_case").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "drive_case")


def sample_per_case(roster: DataFrame, n: int = 3) -> DataFrame:
    """The first n rows of every case, by position."""
    rows = roster.select(S.POSITION, "transcriptLink", "videoLink")
    linked = L.with_link(rows).select(
        F.col("link.case").alias("drive_case"),
        S.POSITION,
        F.col("link.transcript_url").alias("url"),
        F.col("link.sub_variant").alias("sub_variant"),
    )
    return first_n_per_key(linked, ["drive_case"], [F.col(S.POSITION)], n)


def pilot_suggestion(roster: DataFrame) -> DataFrame:
    """One row: the first position of every case that occurs, in pilot order."""
    cases = L.with_case(roster.select(S.POSITION, "transcriptLink", "videoLink"))
    firsts = cases.groupBy("drive_case").agg(F.min(S.POSITION).alias("p"))
    rank = F.array_position(F.array(*[F.lit(c) for c in S.CASES]), F.col("drive_case"))
    ordered = F.array_sort(F.collect_list(F.struct(rank.alias("r"), "p")))
    text = F.array_join(F.transform(ordered, lambda x: x["p"].cast("string")), ",")
    return firsts.agg(text.alias("suggested_rows"))


def resolved_links(rows: DataFrame, assets: Assets, keep: list[str]) -> DataFrame:
    """The columns `keep` of each row, its `link`, and what that resolves to:
    `asset_file_id`, `asset_mime`, `content_id`.

    Links are recognised once and written with the columns to keep, which should be
    narrow; all that follows reads that table. Only links to files and folders meet the
    listing, only rows with a file meet the content index, and both are reduced to what
    is asked for where they are read; other rows are not moved. What is found is written
    before it is joined, one row per key, so that a key that many rows ask for can be
    split (or what is found broadcast, if it is small).
    """
    case = F.col("link.case")
    listed = L.is_file_case(case) | L.is_folder_case(case)
    key = F.when(L.is_folder_case(case), folder_key(F.col("link.folder_id"))).otherwise(file_key(F.col("link.file_id")))
    narrow = L.with_link(rows.select(*keep, "transcriptLink", "videoLink")).select(*keep, "link")
    narrow = materialize(narrow.withColumn("asset_key", F.when(listed, key)), "links")

    asking = narrow.where("asset_key IS NOT NULL")
    found = materialize(assets.wanted(asking), "found-files")
    known = F.when(L.is_folder_case(case), F.col("found_file")).otherwise(F.col("link.file_id"))
    by_key = asking.join(found, "asset_key", "left").select(
        *keep, "link", known.alias("asset_file_id"), F.col("found_mime").alias("asset_mime")
    )
    direct = narrow.where("asset_key IS NULL").select(
        *keep, "link", F.col("link.file_id").alias("asset_file_id"), F.col("link.mime").alias("asset_mime")
    )
    placed = direct.unionByName(by_key)

    stored = materialize(assets.content_of(placed), "found-content").withColumnRenamed("file_id", "asset_file_id")
    held = placed.where("asset_file_id IS NOT NULL").join(stored, "asset_file_id", "left")
    nothing = placed.where("asset_file_id IS NULL").withColumn("content_id", F.lit(None).cast(stored.schema["content_id"].dataType))
    return held.unionByName(nothing).select(*keep, "link", "asset_file_id", "asset_mime", "content_id")


def resolve_links(roster: DataFrame, assets: Assets, key: str = S.POSITION) -> DataFrame:
    """The rows of `roster`, one per key, with what `resolved_links` finds: it works on
    the links and the key alone, and the wide rows are joined to it once."""
    return roster.join(resolved_links(roster, assets, [key]), key)
