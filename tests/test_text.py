from datetime import date

import pytest
from pyspark.sql import functions as F

from retail_lens.functions import text
from retail_lens.plans.cleaning import CHANNEL_LABELS, REGION_LABELS


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def check(spark, function, cases):
    assert apply(spark, function, [given for given, _ in cases]) == [expected for _, expected in cases]


def test_parse_dates(spark):
    check(
        spark,
        text.parse_dates,
        [
            ("2025-02-03", date(2025, 2, 3)),
            (" 2025-2-3\t", date(2025, 2, 3)),
            ("04/08/2021", date(2021, 8, 4)),
            ("4/8/2021", date(2021, 8, 4)),
            ("Jan 05, 2025", date(2025, 1, 5)),
            ("15-May-20", date(2020, 5, 15)),
            ("31-Dec-70", date(1970, 12, 31)),
            ("01-Jan-69", date(1969, 1, 1)),
            ("29-Feb-68", date(2068, 2, 29)),
            ("31/02/2025", None),
            ("2025-13-01", None),
            ("15-Foo-20", None),
            ("2025-02-03T10:00", None),
            ("20250203", None),
            ("N/A", None),
            ("", None),
            (None, None),
        ],
    )


def test_first_format_wins(spark):
    month_first = ("M/d/yyyy", "d/M/yyyy")
    assert apply(spark, lambda c: text.parse_dates(c, month_first), ["04/08/2021", "14/08/2021"]) == [
        date(2021, 4, 8),
        date(2021, 8, 14),
    ]


def test_parse_month_start(spark):
    check(
        spark,
        text.parse_month_start,
        [("Jan-2025", date(2025, 1, 1)), ("2025-02", date(2025, 2, 1)), ("2025", None), ("x", None), (None, None)],
    )


def test_to_number(spark):
    check(
        spark,
        text.to_number,
        [
            ("GHS 18.50", 18.5),
            ("12 ctn", 12.0),
            ("5%", 5.0),
            ("25,400", 25400.0),
            ("-3", -3.0),
            ("12.", 12.0),
            ("1-2", None),
            ("-", None),
            ("", None),
            ("abc", None),
            (None, None),
            ("1e5", 15.0),
            ("42.0", 42.0),
        ],
    )


def test_region_labels(spark):
    check(
        spark,
        lambda c: text.match_label(c, REGION_LABELS),
        [
            ("Gt. Accra", "Greater Accra"),
            ("accra", "Greater Accra"),
            ("GREATER ACCRA", "Greater Accra"),
            ("Ashanti ", "Ashanti"),
            ("ashanti region", "Ashanti"),
            ("Northern Region ", "Northern"),
            ("Unknown", None),
            (None, None),
        ],
    )


def test_channel_labels(spark):
    check(
        spark,
        lambda c: text.match_label(c, CHANNEL_LABELS, squeeze=True),
        [
            ("Super Market", "Supermarket"),
            ("supermarket", "Supermarket"),
            ("RETAIL", "Retail Shop"),
            ("Retail shop", "Retail Shop"),
            ("Whole sale", "Wholesale"),
            ("wholesale retail", "Wholesale"),
            ("stall", None),
        ],
    )


def test_keys_and_titles(spark):
    check(spark, text.normalise_key, [(" sku1\t", "SKU1"), ("c 9 ", "C 9"), (None, None)])
    check(spark, text.title_case, [("  NANA'S mini mart 2go ", "Nana'S Mini Mart 2Go"), ("kofi-ama", "Kofi-Ama"), (None, None)])
    check(spark, lambda c: text.title_case(c, after_any_symbol=False), [("NANA'S mini", "Nana's Mini")])


@pytest.mark.parametrize("token", ["N/A", "n/a", "", "  "])
def test_missing_tokens(spark, token):
    assert apply(spark, text.blank_to_null, [token, "7", None]) == [None, "7", None]
    assert apply(spark, text.is_missing_token, [token, "7", None]) == [True, False, False]


def test_missing_tokens_are_found_whatever_they_begin_with(spark):
    texts = ["", " ", "\t\n", " ", "\x00", "\x00NA", " N/A", "n/a\v", "1.#IND", "1", "-nan ", "- nan", "<NA>", "é", "ÑA", "Na", "\x1fNA", "#NA\r", *text.MISSING_TOKENS]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    got = {r.t: r.m for r in df.select("t", text.is_missing_token(F.col("t")).alias("m")).collect()}
    assert got == {t: t is not None and t.strip(" \t\n\r\f\v") in text.MISSING_TOKENS for t in [*texts, None]}
    assert [r.m for r in df.select(text.is_missing_token(F.col("t"), ["x", "öd"]).alias("m")).distinct().collect()] == [False]
    assert spark.range(1).select(text.is_missing_token(F.lit(" öd"), ["x", "öd"])).first()[0]
