"""The classification cases, as one table of links with the expected outcome."""

import pytest
from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.functions import links as L
from rollcall.plans import classify
from rollcall.sources import catalog

DOC, FILE, FOLDER = (
    "https://docs.google.com/document/d/", "https://drive.google.com/file/d/",
    "https://drive.google.com/drive/folders/",
)
VID = FILE + "VIDEO_1/view"

# name, transcript, video, case, file_id, mime, sub_variant
PLAIN = [
    ("doc", DOC + "Doc-1_a/edit", VID, "A", "Doc-1_a", S.GOOGLE_DOC, None),
    ("file", FILE + "F1/view", VID, "B", "F1", None, None),
    ("same file", VID, VID, "D2", "VIDEO_1", None, None),
    ("same doc", DOC + "X/edit", DOC + "X/edit", "D3", "X", S.GOOGLE_DOC, None),
    ("empty", "", "", "E", None, None, None),
    ("null", None, None, "E", None, None, None),
    ("missing word", "Sin dato", "Sin dato", "E", None, None, None),
    ("missing word upper", "SIN DATO", None, "E", None, None, None),
    ("missing word lower", "sin dato", None, "E", None, None, None),
    ("missing word mixed", "Sin Dato", None, "E", None, None, None),
    ("missing word padded", "  Sin dato\t", None, "E", None, None, None),
    ("missing word, video", "Sin dato", VID, "E", None, None, None),
    ("sheet", "https://docs.google.com/spreadsheets/d/S/edit", VID, "F", None, None, "F_sheet"),
    ("redirect", "https://www.google.com/url?q=https://x", VID, "F", None, None, "F_redirect"),
    ("redirect without www", "http://google.com/url?q=x", VID, "F", None, None, "F_redirect"),
    ("videos", "https://docs.google.com/videos/d/V", VID, "F", None, None, "F_other"),
    ("other host", "https://example.com/t.pdf", VID, "F", None, None, "F_other"),
    ("doc user 0", "https://docs.google.com/document/u/0/d/U0/edit?usp=x#h", None, "A", "U0", S.GOOGLE_DOC, None),
    ("doc user 4", "https://docs.google.com/document/u/4/d/U4/edit", None, "A", "U4", S.GOOGLE_DOC, None),
    ("doc mobile", DOC + "M/mobilebasic", None, "A", "M", S.GOOGLE_DOC, None),
    ("doc user and mobile", "https://docs.google.com/document/u/1/d/UM/mobilebasic", None, "A", "UM", S.GOOGLE_DOC, None),
    ("file user", "https://drive.google.com/file/u/0/d/FU/view", VID, "B", "FU", None, None),
    ("videos edit", "https://docs.google.com/videos/d/V/edit", None, "F", None, None, "F_other"),
    ("not anchored", "x https://docs.google.com/document/d/Z/edit", None, "F", None, None, "F_other"),
    ("other cloud", "https://onedrive.example.com/document/d/Z", None, "F", None, None, "F_other"),
    ("doc without id", DOC, None, "F", None, None, "F_other"),
    ("padded same", f"  {VID} ", VID, "D2", "VIDEO_1", None, None),
    ("http", "http://docs.google.com/document/d/H", None, "A", "H", S.GOOGLE_DOC, None),
]


@pytest.mark.parametrize("with_struct", [True, False])
def test_plain_cases(spark, with_struct):
    rows = spark.createDataFrame(
        [(n, t, v) for n, t, v, *_ in PLAIN], "name string, transcriptLink string, videoLink string"
    )
    wanted = {n: tuple(rest) for n, _, _, *rest in PLAIN}
    if with_struct:
        found = L.with_link(rows).select("name", "link.*").collect()
        got = {r["name"]: (r["case"], r["file_id"], r["mime"], r["sub_variant"]) for r in found}
        assert got == wanted
    else:
        found = L.with_case(rows).collect()
        assert {r["name"]: r["drive_case"] for r in found} == {n: w[0] for n, w in wanted.items()}


def test_original_text_of_missing_links(spark):
    rows = spark.createDataFrame([(" Sin dato ", None), (None, None)], "transcriptLink string, videoLink string")
    urls = [r["u"] for r in L.with_link(rows).select(F.col("link.transcript_url").alias("u")).collect()]
    assert sorted(urls) == ["", "Sin dato"]


FOLDERS = [
    # name, children (mime, trashed), same as video, case, picked child
    ("doc wins", [("docx", 0), ("doc", 0), ("mp4", 0)], False, "C", 1),
    ("docx", [("docx", 0)], False, "C", 0),
    ("text", [("mp4", 0), ("txt", 0)], False, "C", 1),
    ("first of a kind", [("docx", 0), ("docx", 0)], False, "C", 0),
    ("trashed doc", [("doc", 1), ("txt", 0)], False, "C", 1),
    ("unusable", [("mp4", 0)], False, "C", None),
    ("same folder", [("doc", 0)], True, "D1", 0),
    ("not listed", [], False, "C", None),
]
MIMES = {"doc": S.GOOGLE_DOC, "docx": S.DOCX, "txt": S.PLAIN_TEXT, "mp4": S.MP4}


def test_folder_cases(spark):
    links, files = [], []
    for i, (name, children, same, _, _) in enumerate(FOLDERS):
        url = f"{FOLDER}FOLD{i}"
        links.append((i + 1, name, url, url if same else VID))
        for j, (kind, trashed) in enumerate(children):
            files.append((f"c{i}_{j}", f"FOLD{i}", "n", MIMES[kind], bool(trashed), j))
    rows = spark.createDataFrame(links, "row_position long, name string, transcriptLink string, videoLink string")
    listed = spark.createDataFrame(
        files, "file_id string, folder_id string, name string, mime string, trashed boolean, list_order long"
    )
    content = listed.select("file_id", F.lit(1).alias("content_id"))
    found = classify.resolve_links(rows, catalog.usable_assets(listed, content))
    got = {r["name"]: (r["link"]["case"], r["asset_file_id"], r["link"]["folder_id"]) for r in found.collect()}
    assert got == {
        name: (case, None if pick is None else f"c{i}_{pick}", f"FOLD{i}")
        for i, (name, _, _, case, pick) in enumerate(FOLDERS)
    }


def test_folder_without_catalog(spark):
    rows = spark.createDataFrame([(FOLDER + "A1", VID)], "transcriptLink string, videoLink string")
    link = L.with_link(rows).first()["link"]
    assert (link["case"], link["file_id"], link["folder_id"]) == ("C", None, "A1")
    assert link["diagnostic"].startswith("classification only")
