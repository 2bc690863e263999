"""Text column expressions. All of them stay inside the JVM: no Python UDF."""

from __future__ import annotations

import functools
import re
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall import settings as S

# Every character Unicode counts as white space, for trimming.
WHITESPACE = "".join(
    chr(code) for code in range(0x3001) if chr(code).isspace()
)


@functools.cache
def _ascii_folds() -> tuple[dict[str, str], dict[str, str]]:
    """Compatibility-decompose every character and keep the ASCII part.

    Folding is done per character: decomposition of a text is the decomposition
    of its characters up to reordering of combining marks, and those are dropped.
    Returns the folds to one character and the folds to several.
    """
    single, several = {}, {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        decomposed = unicodedata.normalize("NFKD", char)
        if decomposed == char:
            continue
        ascii_part = "".join(c for c in decomposed if c < "\x80")
        if len(ascii_part) == 1:
            single[char] = ascii_part
        elif ascii_part:
            several[char] = ascii_part
    return single, several


def _char_class(chars) -> str:
    """A regex for one of the given characters, with runs written as ranges."""
    codes = sorted(ord(c) for c in chars)
    parts, start = [], 0
    for i, code in enumerate(codes):
        if i + 1 < len(codes) and codes[i + 1] == code + 1:
            continue
        parts.append("\\x{%x}-\\x{%x}" % (codes[start], code))
        start = i + 1
    # Most text is ASCII: leave those characters before trying the ranges.
    return r"(?=[^\x00-\x7F])[" + "".join(parts) + "]"


def ascii_fold(col: Column) -> Column:
    """Compatibility decomposition with everything outside ASCII dropped.

    Pure-ASCII values pass through. Characters that fold to several letters
    (ligatures, fractions) are rare: only values holding one take the
    per-character lookup, the rest is one `translate` and one delete.
    """
    single, several = _ascii_folds()
    pairs = "\x1e".join(f"{char}\x1f{ascii_part}" for char, ascii_part in several.items())
    table = F.str_to_map(F.lit(pairs), F.lit("\x1e"), F.lit("\x1f"))
    expanded = F.array_join(
        F.transform(F.split(col, ""), lambda ch: F.coalesce(F.element_at(table, ch), ch)), ""
    )
    prepared = F.when(col.rlike(_char_class(several)), expanded).otherwise(col)
    folded = F.regexp_replace(
        F.translate(prepared, "".join(single), "".join(single.values())), r"[^\x00-\x7F]+", ""
    )
    return F.when(col.rlike(r"[^\x00-\x7F]"), folded).otherwise(col)


def strip(col: Column) -> Column:
    """Trim all Unicode white space, not only blanks."""
    return F.btrim(col, F.lit(WHITESPACE))


def slug(col: Column) -> Column:
    """Upper-case ASCII words joined by hyphens; UNKNOWN when nothing is left."""
    words = F.regexp_replace(ascii_fold(col), r"[^A-Za-z0-9]+", "-")
    text = F.upper(F.btrim(words, F.lit("-")))
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("UNKNOWN"))


def header_fold(col: Column) -> Column:
    """Accent fold, collapse white space, trim, lower-case."""
    return F.lower(F.btrim(F.regexp_replace(ascii_fold(col), r"[\t-\r\x1c-\x1f ]+", " ")))


def fold_header_name(name) -> str:
    """`header_fold` for one column name (schema metadata, on the driver)."""
    decomposed = unicodedata.normalize("NFKD", str(name or ""))
    ascii_part = decomposed.encode("ascii", "ignore").decode("ascii")
    return " ".join(ascii_part.split()).lower()


def is_missing_word(col: Column) -> Column:
    return F.lower(strip(col)) == S.MISSING_WORD


def clean_display(col: Column) -> Column:
    """Trimmed text; null when empty or the missing-word in any case."""
    return F.nullif(F.when(~is_missing_word(col), strip(col)), F.lit(""))


def normalize_link(col: Column) -> Column:
    """Trimmed link; empty text for null and for the missing-word."""
    return F.when(col.isNull() | is_missing_word(col), F.lit("")).otherwise(strip(col))


def denumber(col: Column) -> Column:
    """Double to text, integral values without the `.0`. For double columns only."""
    integral = (F.rint(col) == col) & ~F.isnan(col) & (F.abs(col) < F.lit(1e38))
    short = F.abs(col) < F.lit(9e18)
    whole = F.when(short, col.cast("bigint").cast("string")).otherwise(
        col.cast("decimal(38,0)").cast("string")
    )
    return F.when(integral, whole).otherwise(col.cast("string"))


def or_default(col: Column, default: str) -> Column:
    """The value, or a default where it is null or empty."""
    return F.when(col.isNull() | (col == ""), F.lit(default)).otherwise(col)


def empty_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def full_name(first: Column, last: Column) -> Column:
    """First and last name with a blank between; null when blank after trimming, or when
    either half is null."""
    return F.nullif(F.trim(F.concat(first, F.lit(" "), last)), F.lit(""))


def filled(template: str, **parts: Column) -> list[Column]:
    """The pieces of a text with `{name}` places, to be concatenated."""
    pieces = re.split(r"\{(\w+)\}", template)
    return [parts[p] if k % 2 else F.lit(p) for k, p in enumerate(pieces) if p]


def truncate(col: Column, chars: int) -> Column:
    """The first characters of a text, empty for null."""
    return F.substring(F.coalesce(col, F.lit("")), 1, chars)
