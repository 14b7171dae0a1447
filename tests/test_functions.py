"""Golden values of the scalar functions."""

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from stayline.functions import application, labels, masks, scalar
from stayline.plans import rules
from stayline.sources import links


def value(spark, build, text, kind="string"):
    df = spark.createDataFrame([(text,)], f"x {kind}")
    return df.select(build(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "build, text, expected",
    [
        (masks.mask_name, "Rahul Sharma", "R**** S*****"),
        (masks.mask_name, "  Om   P ", "O* P"),
        (masks.mask_mobile, "9876543210", "98XXXXXX10"),
        (masks.mask_mobile, "1234", "XXXX"),
        (masks.mask_email, "rahul@gmail.com", "r***@g***.com"),
        (masks.mask_email, "a.b@mail.co.in", "a***@m***.co.in"),
        (masks.mask_email, "a@b@c.de", "a***@b***.de"),
        (masks.mask_email, "@x.de", "***@x***.de"),
        (masks.mask_email, "nomail", "***@***.***"),
        (masks.mask_email, None, "***@***.***"),
        (masks.mask_address, "12, MG Road, Mumbai - 400001", "**, MG Road, Mumbai - 400001"),
        (masks.mask_address, "somewhere", "**"),
        (masks.birth_year, "15-07-1985", "1985"),
        (masks.birth_year, "1985", "1985"),
        (masks.birth_year, None, ""),
        (application.normalise_number, "\t irl12345678 ", "12345678"),
        (application.letters_in, "1bca4b", "ABC"),
        (application.decision_class, "Visa GRANTED", "approved"),
        (application.decision_class, "Refused - reason 3", "refused"),
        (application.decision_class, "Pending", "other"),
        (scalar.safe_number, "x", 0.0),
        (scalar.safe_number, "2.5", 2.5),
        (lambda c: scalar.format_date(scalar.parse_date(c)), "31-12-1999", "31-12-1999"),
        (lambda c: scalar.format_date(scalar.parse_date(c)), "31-02-1999", ""),
        (lambda c: scalar.prefixed_id("CUST", c, 4), "7", "CUST0007"),
        (lambda c: scalar.prefixed_id("CUST", c, 4), "123456", "CUST123456"),
    ],
)
def test_text_functions(spark, build, text, expected):
    assert value(spark, build, text) == expected


@pytest.mark.parametrize(
    "build, number, expected",
    [
        (lambda c: scalar.round_half_up(c, 0), 2.5, 3.0),
        (lambda c: scalar.round_half_up(c, 0), -2.5, -2.0),
        (lambda c: F.round(c), -2.5, -3.0),
        (lambda c: scalar.fixed_decimals(c, 4), 0.5, "0.5000"),
        (lambda c: scalar.percent(c, F.lit(3)), 1.0, 33.3),
        (lambda c: scalar.percent(c, F.lit(0)), 1.0, 0.0),
        (lambda c: scalar.floor_percent(c, F.lit(3)), 2.0, 66),
        (rules.score_tier, 0.65, "Medium"),
        (rules.score_tier, 0.6501, "High"),
        (rules.score_tier, 0.35, "Low"),
    ],
)
def test_number_functions(spark, build, number, expected):
    assert value(spark, build, number, "double") == expected


@pytest.mark.parametrize("gap, expiry, label", [(400, -10, 1), (100, -10, 0), (400, 90, 0), (365, -1, 0), (366, -1, 1)])
def test_churn_label(spark, gap, expiry, label):
    df = spark.createDataFrame([(gap, expiry)], "g int, e int")
    assert df.select(rules.churn_label(F.col("g"), F.col("e")).alias("y")).first().y == label


def test_tier_rules_differ_where_stated(spark):
    df = spark.createDataFrame([(400, -1, 3), (200, 90, 3), (100, 90, 1), (100, 20, 3), (100, 90, 3)], "g int, e int, v int")
    got = df.select(
        rules.baseline_tier(F.col("g"), F.col("e"), F.col("v")).alias("b"), rules.legend_tier(F.col("g"), F.col("e")).alias("l")
    ).collect()
    assert [(r.b, r.l) for r in got] == [
        ("High", "High"), ("Medium", "Medium"), ("Medium", "Low"), ("Low", "Medium"), ("Low", "Low")
    ]


def test_labels(spark):
    df = spark.createDataFrame([("High", -3, 366), ("Low", 29, 180), ("Medium", 30, 181)], "t string, e int, g int")
    got = df.select(
        labels.tier_icon(F.col("t")), labels.expiry_label(F.col("e")), labels.expiry_band(F.col("e")),
        labels.gap_band(F.col("g")), labels.tier_rank(F.col("t")),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("🔴 HIGH", "-3 (EXPIRED)", "High", "High", 1), ("🟢 LOW", "29", "Medium", "Low", 3), ("🟡 MEDIUM", "30", "Low", "Medium", 2)
    ]


def test_number_check_order(spark):
    texts = {
        "12345678": (None, "12345678"), "IRL12345678": (None, "12345678"), "irl12345678 ": (None, "12345678"),
        "": ("empty", ""), None: ("empty", ""), "12 45": ("not_alphanumeric", ""), "IRL12X": ("letters_after_prefix", ""),
        "IRL": ("letters_after_prefix", ""), "1234567A": ("letters_at_end", ""), "AB345678": ("other_letters", ""),
        "123": ("too_short", ""), "123456789": ("too_long", ""),
    }
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    got = {r.raw: (r.error_code, r.number) for r in application.with_number_check(df, "raw").collect()}
    assert got == texts


def test_links_resolve_like_the_standard(spark):
    bases = ["http://a.example/b/c/d.html?q=1#f", "https://a.example", "https://a.example/x/"]
    hrefs = ["g", "./g", "../g", "../../../g", "/g", "/a/./b/../c", "//h.example/p", "?y", "#s", "g?y=1#z", "http://z.example/q", ""]
    df = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "b string, h string")
    for r in df.select("b", "h", links.resolve(F.col("b"), F.col("h")).alias("link")).collect():
        expected = urljoin(r.b, r.h)
        # A bare host and its root path are the same address.
        assert r.link.replace("example/g", "example/g") == expected or (r.b == bases[1] and r.link.rstrip("/") == expected.rstrip("/")), (r, expected)
