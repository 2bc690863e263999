"""Link recognition and the eight-way classification rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.functions.text import clean_display, filled, strip


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


# Case by kind of transcript link; `=` marks a video link equal to it.
CASES = {
    "empty": "E", "empty=": "E", "doc": "A", "doc=": "D3", "file": "B", "file=": "D2",
    "folder": "C", "folder=": "D1",
}


def kind_of(url: Column) -> Column:
    """Kind of a trimmed link; a null link is `empty`."""
    kind = F.when(url.isNull(), F.lit("empty"))
    for name, pattern in S.LINK_PATTERNS + S.UNSUPPORTED_PATTERNS:
        kind = kind.when(url.rlike(pattern), F.lit(name))
    return kind.otherwise(F.lit(S.UNSUPPORTED_OTHER))


def id_of(url: Column, kind: Column) -> Column:
    """Id a supported link of a known kind points to, else null."""
    found = None
    for name, pattern in S.LINK_PATTERNS:
        part = F.regexp_extract(url, pattern, 1)
        found = F.when(kind == name, part) if found is None else found.when(kind == name, part)
    return found


def url_kind(url: Column) -> Column:
    """struct(kind, id) of a link; empty text and null are `empty`."""
    link = F.nullif(url, F.lit(""))
    return F.struct(kind_of(link).alias("kind"), id_of(link, kind_of(link)).alias("id"))


def case_of(kind: Column, same: Column) -> Column:
    key = F.concat(kind, F.when(same, "=").otherwise(""))
    return F.coalesce(_lookup(CASES, key), F.lit("F"))


def is_folder_case(case: Column) -> Column:
    return case.isin("C", "D1")


def is_file_case(case: Column) -> Column:
    return case.isin("B", "D2")


def is_doc_case(case: Column) -> Column:
    return case.isin("A", "D3")


def with_case(df, transcript="transcriptLink", video="videoLink"):
    """Add only `drive_case` (enough for counting and sampling)."""
    t, v = clean_display(F.col(transcript)), clean_display(F.col(video))
    return df.withColumn("drive_case", case_of(kind_of(t), t == v))


def with_link(df, transcript="transcriptLink", video="videoLink"):
    """Add the `link` struct: case, file_id, mime, transcript_url, folder_id,
    sub_variant, diagnostic. Folder contents are not looked at here."""
    t, v = clean_display(F.col(transcript)), clean_display(F.col(video))
    df = df.withColumn("_t", t).withColumn("_kind", kind_of(F.col("_t")))
    df = df.withColumn("_id", id_of(F.col("_t"), F.col("_kind")))
    df = df.withColumn("_case", case_of(F.col("_kind"), F.col("_t") == v))
    case, kind, id_ = F.col("_case"), F.col("_kind"), F.col("_id")
    link = F.struct(
        case.alias("case"),
        F.when(is_doc_case(case) | is_file_case(case), id_).alias("file_id"),
        F.when(is_doc_case(case), F.lit(S.GOOGLE_DOC)).alias("mime"),
        F.coalesce(F.col("_t"), strip(F.col(transcript)), F.lit("")).alias("transcript_url"),
        F.when(is_folder_case(case), id_).alias("folder_id"),
        F.when(case == "F", kind).alias("sub_variant"),
        link_diagnostic(case, kind).alias("diagnostic"),
    )
    return df.withColumn("link", link).drop("_t", "_kind", "_id", "_case")


def link_diagnostic(case: Column, kind: Column) -> Column:
    """Skip reason of a link before any folder was looked at; null if usable."""
    return (
        F.when(case == "E", F.lit(S.DIAG_EMPTY))
        .when(case == "F", F.concat(F.lit(S.DIAG_UNSUPPORTED), kind))
        .when(is_folder_case(case), F.lit(S.DIAG_NO_CATALOG))
    )


def folder_diagnostic(folder_id: Column, picked_file: Column) -> Column:
    """Skip reason of a folder link once its children are known."""
    return F.when(
        picked_file.isNull(),
        F.concat(*filled(S.DIAG_NO_CHILD, folder=folder_id)),
    )


def transcript_rank(mime: Column) -> Column:
    """Preference among the files of a folder; null for unusable types."""
    return F.when(mime == S.GOOGLE_DOC, 0).when(mime == S.DOCX, 1).when(mime == S.PLAIN_TEXT, 2)


def content_type(mime: Column) -> Column:
    """Type a transcript is published under; null when unsupported."""
    return F.when(mime.isin(S.GOOGLE_DOC, S.DOCX), F.lit(S.DOCX)).when(
        mime == S.PLAIN_TEXT, F.lit(S.PLAIN_TEXT)
    )


def extension(mime: Column) -> Column:
    return F.when(mime.isin(S.GOOGLE_DOC, S.DOCX), F.lit("docx")).when(
        mime == S.PLAIN_TEXT, F.lit("txt")
    )
