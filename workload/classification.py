"""Link classification and its reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.functions import links
from rollcall.operators.keyfilter import passing
from rollcall.plans import classify
from rollcall.sources import catalog
from workload import sqltext as Q
from workload.registry import query


@query(
    "classify_links",
    f"""WITH {Q.CASES}
    SELECT row_position, drive_case,
      CASE WHEN kind IN ('doc', 'file') THEN link_id END AS file_id,
      CASE WHEN kind = 'doc' THEN '{S.GOOGLE_DOC}' END AS mime,
      CASE WHEN kind = 'empty' THEN coalesce(trim(transcriptLink), '') ELSE t END AS transcript_url,
      CASE WHEN kind = 'folder' THEN link_id END AS folder_id,
      CASE WHEN drive_case = 'F' THEN kind END AS sub_variant FROM cases""",
)
def classify_links(t):
    rows = links.with_link(t("roster").select(S.POSITION, "transcriptLink", "videoLink"))
    return rows.select(
        S.POSITION, F.col("link.case").alias("drive_case"), "link.file_id", "link.mime",
        "link.transcript_url", "link.folder_id", "link.sub_variant",
    )


@query(
    "link_diagnostics",
    f"""WITH {Q.CASES}, {Q.PICKS}
    SELECT row_position,
      CASE WHEN drive_case = 'E' THEN 'transcript_link is empty or ''Sin dato'''
        WHEN drive_case = 'F' THEN 'transcript host/path not supported: ' || kind
        WHEN kind = 'folder' THEN 'classification only — drive client not provided' END AS before_listing,
      CASE WHEN kind = 'folder' AND file_id IS NULL
        THEN 'folder ' || link_id || ' has no Doc/.docx/.txt child' END AS after_listing
    FROM cases LEFT JOIN picks ON kind = 'folder' AND folder_id = link_id""",
)
def link_diagnostics(t):
    """Only links to folders meet the listing: the others, which name no folder, would all
    be one key of the join."""
    rows = links.with_link(t("roster").select(S.POSITION, "transcriptLink", "videoLink"))
    folder = F.col("link.folder_id")
    named, others = rows.where(folder.isNotNull()), rows.where(folder.isNull())
    asked = named.select(folder.alias("folder_id")).distinct()
    listed = passing(t("asset_catalog"), F.col("folder_id"), asked, "folder_id")
    picks = catalog.folder_picks(listed.join(asked, "folder_id", "left_semi"))
    found = named.join(picks, folder == picks["folder_id"], "left").select(S.POSITION, "link", "file_id")
    found = found.unionByName(others.select(S.POSITION, "link", F.lit(None).cast("string").alias("file_id")))
    case = F.col("link.case")
    after = links.folder_diagnostic(F.col("link.folder_id"), F.col("file_id"))
    return found.select(
        S.POSITION,
        F.col("link.diagnostic").alias("before_listing"),
        F.when(links.is_folder_case(case), after).alias("after_listing"),
    )


@query("pick_folder_transcript", f"WITH {Q.PICKS} SELECT folder_id, file_id, mime FROM picks")
def pick_folder_transcript(t):
    return catalog.folder_picks(t("asset_catalog"))


@query(
    "probe_mime",
    f"""WITH {Q.CASES}, {Q.TYPES} SELECT row_position, drive_case, link_id AS file_id, mime
    FROM cases LEFT JOIN types ON file_id = link_id WHERE drive_case IN ('B', 'D2')""",
)
def probe_mime(t):
    rows = links.with_link(t("roster").select(S.POSITION, "transcriptLink", "videoLink"))
    files = rows.where(links.is_file_case(F.col("link.case"))).select(
        S.POSITION, F.col("link.case").alias("drive_case"), F.col("link.file_id").alias("file_id")
    )
    asked = files.select("file_id").distinct()
    types = catalog.file_mimes(t("asset_catalog").join(asked, "file_id", "left_semi"))
    return files.join(types, "file_id", "left")


@query(
    "case_distribution",
    f"WITH {Q.CASES} SELECT drive_case, count(*) AS n FROM cases GROUP BY drive_case",
)
def case_distribution(t):
    return classify.case_distribution(t("roster"))


@query(
    "sample_per_case",
    f"""WITH {Q.CASES} SELECT drive_case, row_position,
      CASE WHEN kind = 'empty' THEN coalesce(trim(transcriptLink), '') ELSE t END AS url,
      CASE WHEN drive_case = 'F' THEN kind END AS sub_variant
    FROM (SELECT *, row_number() OVER (PARTITION BY drive_case ORDER BY row_position) AS rn FROM cases) x
    WHERE rn <= 5""",
)
def sample_per_case(t):
    return classify.sample_per_case(t("roster"), 5)


@query(
    "pilot_suggestion",
    f"""WITH {Q.CASES} SELECT string_agg(CAST(p AS STRING), ',' ORDER BY
      list_position(['A','B','C','D1','D2','D3','F','E'], drive_case)) AS suggested_rows
    FROM (SELECT drive_case, min(row_position) AS p FROM cases GROUP BY drive_case) x""",
)
def pilot_suggestion(t):
    return classify.pilot_suggestion(t("roster"))
