import pytest
from pyspark.sql import functions as F

from ratelake.functions.brackets import lookup_bracket, parse_percent_text, parse_range_text
from ratelake.functions.dates import date_warning, parse_date_text
from ratelake.functions.numbers import format_percent, format_price, to_finite, within_tolerance
from ratelake.functions.text import canonical_carrier, collapse_whitespace, relative_path, truncate
from ratelake.functions.urls import is_valid_url, resolve_href
from ratelake.operators.pages import link_filter


def values(spark, inputs, fn, kind="string"):
    rows = [(i, x) for i, x in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


RANGES = {
    "$1.50 - $1.99": (1.5, 1.99, "1.50_1.99", True),
    "$1.50 – $1.99": (1.5, 1.99, "1.50_1.99", True),
    "2.00 to 2.49": (2.0, 2.49, "2.00_2.49", True),
    "$2.00 and above": (2.0, None, "2.00_plus", True),
    "2.00+": (2.0, None, "2.00_plus", True),
    ">= 2": (2.0, None, "2.00_plus", True),
    "Less than $1.50": (None, 1.5, "lt_1.50", True),
    "under 1.50": (None, 1.5, "lt_1.50", True),
    "< 1.50": (None, 1.5, "lt_1.50", True),
    "at least 2.00 but less than 2.05": (None, 2.05, "lt_2.05", True),
    "2.00 or more": (None, None, "2.00_or_more", False),
    "$,": (None, None, "unknown_range", False),
}


def test_range_text(spark):
    got = values(spark, list(RANGES), parse_range_text)
    assert [tuple(r) for r in got] == list(RANGES.values())


def test_percent_text(spark):
    texts = ["5.00%", "1,005 %", "5.00abc", "n/a", "-.5e1%", "", " 7 %"]
    assert values(spark, texts, parse_percent_text) == [5.0, 1005.0, 5.0, None, -5.0, None, 7.0]


def test_date_text(spark):
    cases = {
        "Effective Dec. 1, 2025": "2025-12-01", "January 8th, 2026": "2026-01-08", "12/1/2025": "2025-12-01",
        "1-8-2026": "2026-01-08", "Sept 5, 2024": "2024-09-05", "2026-01-08": None, "soon": None,
        "January 99, 2026": "2026-01-99", "": None, "a1/2/2026": None,
    }
    assert values(spark, list(cases), parse_date_text) == list(cases.values())
    messages = values(spark, ["soon", None, "1-8-2026"], date_warning)
    assert [m and m["message"] for m in messages] == [
        "Could not normalize effective date: soon", "Effective date was missing.", None,
    ]


def test_bracket_lookup_takes_the_first_match(spark):
    brackets = F.array(*[
        F.struct(F.lit(lo).cast("double").alias("min_index"), F.lit(hi).cast("double").alias("max_index"),
                 F.lit(name).alias("id"))
        for lo, hi, name in [(1.5, 1.99, "a"), (2.0, None, "b"), (1.0, 3.0, "c")]
    ])
    got = values(spark, [1.99, 1.995, 2.0, 0.5, None], lambda x: lookup_bracket(brackets, x)["id"], "double")
    assert got == ["a", "c", "b", None, None]


def test_tolerance(spark):
    pairs = [(5.01, 5.0), (1.01, 1.0), (None, None), (None, 1.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a double, b double")
    got = df.orderBy("i").select(within_tolerance(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [True, False, True, False]


def test_numbers(spark):
    assert values(spark, ["1.5", "NaN", "Infinity", "x", None], to_finite) == [1.5, None, None, None, None]
    assert values(spark, [1.0, None], format_percent, "double") == ["1.00%", "n/a"]
    assert values(spark, [1.0, None], format_price, "double") == ["$1.000", "n/a"]


def test_text(spark):
    assert values(spark, ["﻿ a \n b "], collapse_whitespace) == ["a b"]
    assert values(spark, ["abcdef", "ab"], lambda x: truncate(x, 3)) == ["abc", "ab"]
    assert values(spark, ["UPS", "fedEx", "dhl"], canonical_carrier) == ["UPS", "FedEx", None]
    assert values(spark, ["/r/a/b", "/x/a"], lambda x: relative_path(F.lit("/r"), x)) == ["a/b", None]


BASE = "https://x.example.com/a/b/c?d#e"
HREFS = {
    "/a/../b c/für?x=é": "https://x.example.com/b%20c/f%C3%BCr?x=%C3%A9",
    "b": "https://x.example.com/a/b/b",
    "../x.pdf": "https://x.example.com/a/x.pdf",
    "../../../../x": "https://x.example.com/x",
    "//h.org/x": "https://h.org/x",
    "?q=1": "https://x.example.com/a/b/c?q=1",
    "#f": "https://x.example.com/a/b/c?d#f",
    "https://Ex.com": "https://ex.com/",
    "mailto:a@b": "mailto:a@b",
    "http://ex ample.com/": None,
}


def test_resolve_href(spark):
    assert values(spark, list(HREFS), lambda x: resolve_href(x, F.lit(BASE))) == list(HREFS.values())
    assert values(spark, ["/a", "http://h/a"], lambda x: resolve_href(x, F.lit(None).cast("string"))) == [
        None, "http://h/a",
    ]


@pytest.mark.parametrize("url,ok", [
    ("https://example.com/a b", True), ("ftp://h/x", True), ("mailto:a@b", True), ("/x", False), ("text", False),
    ("http://", False), ("https://h/%zz|", True),
])
def test_valid_url(spark, url, ok):
    assert values(spark, [url], is_valid_url) == [ok]


def test_link_filter(spark):
    rows = [("read", "x.pdf?v=1"), ("Fuel rates", "/a"), ("read", "/a"), ("read", "/a.pdfx")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, h string")
    got = df.orderBy("i").select(link_filter(F.col("t"), F.col("h"))).collect()
    assert [r[0] for r in got] == [True, True, False, False]
