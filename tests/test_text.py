"""Parsing of single raw values."""

from decimal import Decimal

import pytest

from roomledger.functions import text


def values(spark, column, *raw):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, raw string")
    return [row[0] for row in df.orderBy("i").select(column).collect()]


def test_price(spark):
    raw = ("$123.45", "$1,234.00", None, "", "N/A", "$0.05", "-$3.10", " $7 ")
    assert values(spark, text.parse_price("raw"), *raw) == [
        Decimal("123.45"), None, None, None, None, Decimal("0.05"), Decimal("-3.10"), Decimal("7.00"),
    ]
    assert values(spark, text.parse_price("raw", thousands=True), *raw[:2]) == [
        Decimal("123.45"), Decimal("1234.00"),
    ]


def test_flag(spark):
    raw = (None, " f ", "t", "yes", "f", "F")
    assert values(spark, text.parse_flag("raw"), *raw) == [True, False, True, True, False, True]
    assert values(spark, text.parse_flag("raw", keep_unknown=True), *raw) == [
        None, False, True, None, False, None,
    ]


def test_percent(spark):
    raw = ("100%", "N/A", None, "95.9%", "7", "-3%", "99999999999%", "%")
    assert values(spark, text.parse_percent("raw"), *raw) == [100, None, None, 95, 7, -3, None, None]


def test_whole_number(spark):
    raw = ("12", " 12 ", "12.9", "-12.9", "x", None, "9223372036854775807")
    assert values(spark, text.parse_whole_number("raw"), *raw) == [
        12, 12, 12, -12, None, None, 9223372036854775807,
    ]


def test_list(spark):
    raw = ("['a', 'b']", "[]", None, '["TV, cable", "b"]', "[a]")
    assert values(spark, text.parse_list("raw"), *raw) == [
        ["a", " b"], [""], None, ['"TV', ' cable"', ' "b"'], ["a"],
    ]
    assert values(spark, text.parse_list_strict("raw"), *raw) == [
        ["a", "b"], [], None, ["TV, cable", "b"], ["a"],
    ]


def test_list_with_broken_quotes_is_read_as_plain_text(spark):
    assert values(spark, text.parse_list_strict("raw"), '["a", \'b\']') == [["a", "b"]]


def test_list_size(spark):
    parsed = text.parse_list("raw")
    assert values(spark, text.list_size(parsed), "['a', 'b']", None, "[]") == [2, -1, 1]
    assert values(spark, text.list_size(parsed, null_size=None), "['a', 'b']", None) == [2, None]


@pytest.mark.parametrize(
    "raw, city, state",
    [
        ("New York City, NY", "New York City", "NY"),
        ("Paris", "Paris", None),
        (None, None, None),
        ("A, B, C", "A", "B"),
        ("", "", None),
    ],
)
def test_location(spark, raw, city, state):
    assert values(spark, text.nth_part("raw", 1), raw) == [city]
    assert values(spark, text.nth_part("raw", 2), raw) == [state]


def test_na(spark):
    assert values(spark, text.na_to_null("raw"), "N/A", "n/a", " N/A", None, "x") == [
        None, "n/a", " N/A", None, "x",
    ]


def test_prose(spark):
    assert values(spark, text.clean_text("raw"), '\r"Nice"<br/>place', 'a ""b""', None) == [
        "Nice  place", "a  b", None,
    ]


def test_comment(spark):
    raw = 'Good!!\r<br/>We   like\n the <br > "thing"\t<br>'
    assert values(spark, text.clean_comment("raw"), raw) == ["Good!! We like the thing"]
