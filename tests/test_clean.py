"""Cell tables for the Column -> Column cleaning functions (FIXTURES.md §2)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starflow.functions import clean as C


def run(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_normalize_decimal(spark):
    cells = ["$1,234.50", "2.300,00", "12,5", "1,234", "12.50", "12.345", "2.300",
             "-45.10", "EUR 99", "N/A", "1,234,567.89", None]
    text = ["1,234.50", "2,300.00", "12.5", "1,234", "12.50", "12,345", "2,300",
            "45.10", "99", "", "1,234,567.89", None]
    dec = [None, None, Decimal("12.50"), None, Decimal("12.50"), None, None,
           Decimal("45.10"), Decimal("99.00"), None, None, None]
    assert run(spark, C.normalize_decimal, cells) == text
    assert run(spark, lambda c: C.to_decimal(C.normalize_decimal(c)), cells) == dec


def test_parse_money(spark):
    cells = ["$1,234.50", "2.300,00", "12,5", "1,234", "12.50", "12.345", "2.300",
             "-45.10", "EUR 99", "N/A", "1,234,567.89", None, "(12.00)"]
    want = [Decimal(x) if x else None for x in
            ["1234.50", "2300.00", "12.50", "1234.00", "12.50", "12345.00", "2300.00",
             "-45.10", "99.00", None, "1234567.89", None, "-12.00"]]
    assert run(spark, C.parse_money, cells) == want


def test_parse_date(spark):
    cells = ["2024-01-31", "2024-01-31 00:00:00", "01/31/2024", "1/5/2024", "05 Jan 2024",
             "45322", "45322.0", "13/45/2024", "abc", "", None, "2024/01/31", "-5", "2024"]
    d = dt.date
    want = [d(2024, 1, 31), d(2024, 1, 31), d(2024, 1, 31), d(2024, 1, 5), d(2024, 1, 5),
            d(2024, 1, 31), d(2024, 1, 31), None, None, None, None, d(2024, 1, 31),
            d(1899, 12, 25), d(1905, 7, 16)]
    assert run(spark, C.parse_date, cells) == want


def test_parse_percent(spark):
    cells = [None, "15%", "0.15", "12.5%", "7.5%", "15", "abc"]
    want = [Decimal("0.00"), Decimal("0.15"), Decimal("0.15"), Decimal("0.13"),
            Decimal("0.08"), Decimal("15.00"), None]
    assert run(spark, C.parse_percent, cells) == want


def test_parse_int(spark):
    assert run(spark, C.parse_int, ["12", "12.6", "45322.0", " 7 ", "-2", "1e3", "x", None,
                                    "99999999999"]) == [12, 13, 45322, 7, -2, 1000, None, None, None]


def test_text(spark):
    assert run(spark, C.clean_text, ["Home-Office", " Corp. ", "", None]) == \
        ["homeoffice", "corp", "", "unknown"]
    assert run(spark, C.map_segment, ["corp", "homeoffice", "consumer"]) == \
        ["corporate", "home office", "consumer"]
    assert run(spark, C.map_country_code, ["U.S.A.", " uk ", "España", "Somaliland", "Italy", None]) == \
        ["US", "GB", "ES", "Somaliland", "Italy", None]
    assert run(spark, C.clean_id, ["#10-01", "ORD-1001"]) == [1001, None]
    assert run(spark, C.clean_name, [" Ann   LEE ", None]) == ["ann lee", "unknown"]
    assert run(spark, C.trim_chars, ["Notebook", "Desk Lamp", None]) == ["teb", "desk lamp", None]


# Each damaged or sound cell and what it must become.
MOJIBAKE = [
    ("Jos\u00c3\u00a9", "Jos\u00e9"), ("Jos\u00e9", "Jos\u00e9"), ("\u00e2\u201a\u00ac 5", "\u20ac 5"),
    ("\u65e5\u672c", "\u65e5\u672c"), ("\u00c5\u2019uvre", "\u0152uvre"), (None, None), ("  plain  ", "plain"),
    ("\u0081x ", "\u0081x"),
]


def test_fix_mojibake(spark):
    assert run(spark, C.fix_mojibake, [cell for cell, _ in MOJIBAKE]) == [want for _, want in MOJIBAKE]


def test_wide_ids(spark):
    cells = ["00000000012", "#3000000000", "9223372036854775807", "9223372036854775808", ""]
    assert run(spark, C.clean_id, cells) == [12, 3000000000, 9223372036854775807, None, None]


def test_dates_parts(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),)], "d date")
    r = df.select(C.day_name("d"), C.day_of_week0("d")).first()
    assert tuple(r) == ("Sunday", 0)
