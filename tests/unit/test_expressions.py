"""Text, time and array expressions with the cases that go wrong."""

import html
import html.entities
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chronicle.functions import arrays, registry, text, timeops


def one(spark, column, **given):
    names = list(given)
    kinds = {str: "string", int: "long", bool: "boolean", datetime: "timestamp", type(None): "string"}
    ddl = ", ".join(f"{n} {'array<string>' if isinstance(given[n], list) else kinds[type(given[n])]}" for n in names) or "x int"
    return spark.createDataFrame([tuple(given.values()) or (1,)], ddl).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("given,want", [("  a\u00a0b\t c ", "a b c"), ("so\u00adft", "soft"), ("a\u0085b", "ab"), ("a\u0090 \u0090b", "a b"), ("   ", None), ("", None), (None, None), ("x", "x")])
def test_clean(spark, given, want):
    assert one(spark, text.clean(F.col("x")), x=given) == want


@pytest.mark.parametrize("given,want", [("a b", True), (None, True), ("a  b", False), (" a", False), ("", False), ("a\u00a0b", False), ("a\u0090", False)])
def test_is_clean(spark, given, want):
    assert one(spark, text.is_clean(F.col("x")), x=given) is want


@pytest.mark.parametrize(
    "given,want",
    [("&lt;b&gt;x&lt;/b&gt;y", "x y"), ("&amp;lt;", "&lt;"), ("<![CDATA[a]]>", "a"), ("<p> </p>", None), ("a &amp;quot;", "a &quot;"), ("A&nbsp;B", "A B")],
)
def test_strip_html(spark, given, want):
    assert one(spark, text.strip_html(F.col("x")), x=given) == want


def test_every_reference(spark):
    """All that the standard names, and numbers of all kinds, as the library of the language decodes them."""
    r = random.Random(1)
    names = sorted(html.entities.html5)
    cases = [f"a&{n}b" for n in names] + [f"&#{n};" for n in [*range(0, 300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0x1F600, 0x1FFFF, 0x10FFFF, 0x110000, 10**7, 10**30]]
    cases += [f"&#x{n:x};" for n in (0, 0xE4, 0x20AC, 0x1F600, 0x10FFFE, 0x110000, 16**20)] + ["&#00228;", "&#x00E4", "&#228x", "&#", "&#;", "&#x;", "&", "&&amp;", "&amp;amp;", "R&D", "&notit;", "&ampx", "&" + "x" * 50 + ";", "&copy\n", "a & b &lt c", "x" * 100_000 + "&amp;"]
    bits = ["&", "#", "x", ";", "amp", "lt", "not", "in", "8364", " ", "é", "&euro;", "\n"]
    cases += ["".join(r.choices(bits, k=r.randint(1, 8))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, x string").select("i", text.unescape(F.col("x")).alias("y"))
    for i, y in df.collect():
        assert y == html.unescape(cases[i]), cases[i]
    assert one(spark, text.unescape(F.col("x")), x=None) is None


def test_keys(spark):
    assert one(spark, text.leaf(F.col("x")), x="/a/b") == "b" and one(spark, text.leaf(F.col("x")), x="/a/") is None
    slug = text.id_slug(F.col("x"), "Schemes/")
    assert one(spark, slug, x="https://s/Schemes/A/Schemes/B.html") == "a-schemes-b" and one(spark, slug, x="https://s/none.html") == "" and one(spark, slug, x=None) is None
    assert one(spark, text.id_hash(F.lit("a"))) == "0cc175b9c0f1b6a831c399e269772661"
    assert one(spark, text.without_prefix(F.col("x"), "target:"), x="target:a target:b") == "a target:b"
    assert one(spark, text.classifier(F.col("x")), x="/x/Common/Area") == "Area" and one(spark, text.classifier(F.col("x")), x="/x/Area") is None
    assert one(spark, text.normal_label(F.col("x")), x="Forst-&Land (EU)") == "forst und land eu"
    assert one(spark, text.bare(F.col("x")), x="(\"a.b\";)") == "a.b"
    assert one(spark, text.tokens(F.col("x")), x=" a  b\n") == ["a", "b"] and one(spark, text.tokens(F.col("x")), x="") == []
    assert text.snake("fundingTypeAb") == "funding_type_ab" and text.classifier_column("ABC", ("ABC",)) == "abc" and text.classifier_column("XYNewArea", (), ("XY",)) == "xy_new_area" and text.camel("on_website_from") == "onWebsiteFrom"


@pytest.mark.parametrize(
    "given,want",
    [("2024-02-03", "2024-02-03 00:00:00"), ("2024-02-03T04:05:06+01:00", "2024-02-03 03:05:06"), ("2024-02-03T04:05", "2024-02-03 04:05:00"), ("2024-02-03 04:05+0200", "2024-02-03 02:05:00"), ("2024-02-03T04:05:06,5Z", "2024-02-03 04:05:06"), ("2024", None), ("2024-02", None), ("2024-02-30", None), ("x", None), (None, None), ("0207-01-01", "0207-01-01 00:00:00")],
)
def test_parse_iso(spark, given, want):
    assert one(spark, F.date_format(timeops.parse_iso(F.col("x")), "yyyy-MM-dd HH:mm:ss"), x=given) == want
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # without an offset it is UTC there too
    got = one(spark, timeops.parse_iso(F.col("x")).cast("long"), x=given)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == one(spark, F.lit(want).cast("timestamp").cast("long"))


@pytest.mark.parametrize("day,want", [("2025-12-29", "2026-W01"), ("2026-01-01", "2026-W01"), ("2027-01-03", "2026-W53"), ("2024-12-30", "2025-W01")])
def test_iso_week(spark, day, want):
    assert one(spark, timeops.iso_week(F.lit(day).cast("timestamp"))) == want


def test_slot(spark):
    t = lambda x: F.lit(x).cast("timestamp")
    assert one(spark, timeops.on_slot(t("2024-01-08 04:59:00"))) and not one(spark, timeops.on_slot(t("2024-01-08 05:00:00"))) and not one(spark, timeops.on_slot(t("2024-01-09 03:00:00")))
    assert one(spark, timeops.plausible(t("2100-12-31"))) and not one(spark, timeops.plausible(t("0207-01-01"))) and one(spark, timeops.plausible(F.lit(None).cast("timestamp")))
    assert one(spark, timeops.from_unix(F.lit(0)).cast("long")) == 0


def test_arrays(spark):
    x = F.col("x")
    assert one(spark, arrays.length(x), x=["a"]) == 1 and one(spark, arrays.length(F.lit(None).cast("array<string>"))) == 0
    assert one(spark, arrays.all_true(x, lambda e: e == "a"), x=["a", None]) is False
    assert one(spark, arrays.all_true(F.lit(None).cast("array<string>"), lambda e: e == "a")) is True
    assert one(spark, arrays.aliased(x, {"o": "n"}), x=["n", "o", "z", "n"]) == ["n", "z"] and one(spark, arrays.aliased(x, {}), x=["b", "a", "b"]) == ["b", "a"]
    assert one(spark, arrays.collapsed([("p", x), ("q", F.lit(None).cast("array<string>")), ("r", x)]), x=["1", None]) == ["p.1", "r.1"]
    assert one(spark, arrays.contains(F.lit(None).cast("array<string>"), "a")) is False
    assert one(spark, arrays.contiguous(F.array(F.lit(3), F.lit(1), F.lit(2), F.lit(2)))) is True and one(spark, arrays.contiguous(F.array(F.lit(1), F.lit(3)))) is False


def test_sql_functions(spark):
    assert {"clean_text", "iso_week"} <= set(registry.register(spark))
    row = spark.sql("SELECT clean_text('  a\u00a0 b ') AS a, leaf_of('/x/y') AS b, iso_week(timestamp'2027-01-03') AS c, word_tokens(' a  b ') AS d, bare_term('(x)') AS e, xml_repaired('a\u0002b') AS f").first()
    assert tuple(row) == ("a b", "y", "2026-W53", ["a", "b"], "x", "ab")
