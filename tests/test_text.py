"""Text functions against their definitions in plain Python."""

import hashlib
import hmac
import itertools
import json
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.functions import payload, text


def slug(name):
    """Runs of letters and digits among the ASCII signs a name decomposes into."""
    signs = [c for c in unicodedata.normalize("NFKD", name) if c.isascii()]
    runs = ["".join(run) for word, run in itertools.groupby(signs, str.isalnum) if word]
    return "-".join(runs).upper() or "UNKNOWN"


def apply(spark, function, values, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}").repartition(2)
    found = rows.select("i", function(F.col("v")).alias("o")).collect()
    return [r["o"] for r in sorted(found, key=lambda r: r["i"])]


def every_character():
    step = 64
    codes = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or c % 7 == 0 or c > 0x1D000)]
    for i in range(0, len(codes), step):
        yield "a" + "b".join(chr(c) for c in codes[i:i + step]) + "c"


def test_slug_over_all_of_unicode(spark):
    values = list(every_character())
    assert apply(spark, text.slug, values) == [slug(v) for v in values]


# A value, its slug and its folded header, by hand.
HAND = [
    (None, "UNKNOWN", None),
    ("", "UNKNOWN", ""),
    (" ", "UNKNOWN", ""),
    ("---", "UNKNOWN", "---"),
    ("LÓPEZ VELASCO, CARLOS MAURICIO", "LOPEZ-VELASCO-CARLOS-MAURICIO", "lopez velasco, carlos mauricio"),
    ("Ñandú", "NANDU", "nandu"),
    ("\ufb01n ½ œuvre ø ß", "FIN-12-UVRE", "fin 12 uvre"),
    ("漢字", "UNKNOWN", ""),
    ("Sin dato", "SIN-DATO", "sin dato"),
    ("a\tb\nc", "A-B-C", "a b c"),
    ("½", "12", "12"),
    ("e\u0301a", "EA", "ea"),
    ("\uff21\uff11", "A1", "a1"),
    ("  Código\xa0 de   Infraestructura ", "CODIGO-DE-INFRAESTRUCTURA", "codigo de infraestructura"),
    ("x\xa0y", "X-Y", "x y"),
    ("…", "UNKNOWN", "..."),
]


def test_slug_and_header_by_hand(spark):
    values = [v for v, _, _ in HAND]
    assert apply(spark, text.slug, values) == [s for _, s, _ in HAND]
    assert apply(spark, text.header_fold, values) == [h for _, _, h in HAND]
    assert [text.fold_header_name(v) for v in values if v] == [h for v, _, h in HAND if v]


def test_missing_words(spark):
    values = [None, "", "  ", "Sin dato", " SIN DATO\n", "sin datos", " x ", "a"]
    assert apply(spark, text.clean_display, values) == [None, None, None, None, None, "sin datos", "x", "a"]
    assert apply(spark, text.normalize_link, values) == ["", "", "", "", "", "sin datos", "x", "a"]


def test_denumber(spark):
    values = [11769.0, 4.0, 0.0, -0.0, 4.5, None, 1e15, 1e19, float("inf"), float("nan"), -3.0]
    found = apply(spark, text.denumber, values, "double")
    assert found[:4] == ["11769", "4", "0", "0"]
    assert found[4:8] == ["4.5", None, "1000000000000000", "10000000000000000000"]
    assert found[10] == "-3"


def test_full_name(spark):
    names = [("A", "B"), ("A", ""), ("", ""), (None, "B"), ("A", None), (None, None)]
    rows = spark.createDataFrame(names, "f string, l string")
    found = rows.select(text.full_name(F.col("f"), F.col("l")).alias("n")).collect()
    assert [r["n"] for r in found] == ["A B", "A", None, None, None, None]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=30), min_size=40, max_size=60))
def test_json_bytes_and_signature(spark, values):
    values += ['back\\slash \\u00d3', "\\\\u00D3 Ó", '"quoted"', "\x7f\x1f\x00", "Ó\\", "tab\tline\n", "😀 Ñ", ""]
    body = lambda c: payload.compact_json(F.struct(c.alias("name"), F.lit(None).cast("string").alias("none")))
    bodies = [json.dumps({"name": v}, separators=(",", ":")) for v in values]
    assert apply(spark, body, values) == bodies
    for secret in ("k", "a long secret " * 9):
        pads = payload.secret_pads(spark, secret)
        found = apply(spark, lambda c: payload.signature(F.lit(17), body(c), pads), values)
        assert found == [
            "sha256=" + hmac.new(secret.encode(), b"17." + b.encode(), hashlib.sha256).hexdigest()
            for b in bodies
        ]


def test_secret_is_not_in_the_plan(spark):
    pads = payload.secret_pads(spark, "very-secret-key")
    df = spark.range(1).select(payload.hmac_sha256(F.lit("x"), pads).alias("h"))
    shown = df._jdf.queryExecution().toString()
    inner = bytes(b ^ 0x36 for b in b"very-secret-key").hex().upper()
    assert "very-secret-key" not in shown and inner not in shown.upper().replace(" ", "")
