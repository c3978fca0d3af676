"""As-of join against a plain search per row."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from starflow.operators.asof import asof_join
from starflow.operators.fx import convert_asof, convert_to_base, fill_calendar, stage_fx


def brute(left, right, strict=False, days=None):
    out = []
    for k, d, x in left:
        best = None
        for rk, rd, v in right:
            if None in (k, d, rk, rd) or rk != k or rd > d or (strict and rd == d):
                continue
            if best is None or (rd, v is not None, v or 0) > (best[0], best[1] is not None, best[1] or 0):
                best = (rd, v)
        if best and days is not None and (d - best[0]).days > days:
            best = None
        out.append((k, d, x, best[1] if best else None, best[0] if best else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(4)
    start = datetime.date(2020, 1, 1)

    def some(n, span):
        # A third of all rows has one key; one key is missing, some dates are.
        return [(None if rng.random() < 0.05 else 0 if rng.random() < 0.33 else rng.randrange(1, 6),
                 None if rng.random() < 0.05 else start + datetime.timedelta(days=rng.randrange(span)), i)
                for i in range(n)]

    left = some(400, 900)
    # Bursts of quotes with months between them; ties and missing values too.
    right = [(k, d, None if v % 11 == 0 else v) for k, d, v in some(120, 900) if d is None or d.month in (1, 6)]
    return left, right


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("bucket", ["day", "month", "year"])
@pytest.mark.parametrize("days", [None, 20])
def test_asof_matches_a_search(spark, sides, strict, bucket, days):
    left, right = sides
    a = spark.createDataFrame(left, "k int, d date, x int")
    b = spark.createDataFrame(right, "k int, day date, v int")
    got = asof_join(a, b, ["k"], "d", "day", ["v"], bucket=bucket, strict=strict,
                    within=None if days is None else f"{days} days")
    assert got.columns == ["k", "d", "x", "v", "day"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(left, right, strict, days)


def test_asof_edges(spark):
    """No rows on a side, repeated left rows, clashing names."""
    a = spark.createDataFrame([(1, datetime.date(2024, 1, 5), "p")] * 3, "k int, d date, v string")
    b = spark.createDataFrame([(1, datetime.date(2024, 1, 2), "q")], "k int, d date, v string")
    got = asof_join(a, b, ["k"], "d", "d", ["v"], prefix="r_").collect()
    assert [tuple(r) for r in got] == [(1, datetime.date(2024, 1, 5), "p", "q", datetime.date(2024, 1, 2))] * 3
    assert {r.r_v for r in asof_join(a, b.limit(0), ["k"], "d", "d", ["v"], prefix="r_").collect()} == {None}
    assert asof_join(a.limit(0), b, ["k"], "d", "d", ["v"], prefix="r_").count() == 0


def test_no_range_join_in_the_plan(spark, sides):
    left, right = sides
    a = spark.createDataFrame(left, "k int, d date, x int")
    got = asof_join(a, spark.createDataFrame(right, "k int, day date, v int"), ["k"], "d", "day", ["v"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_conversion_agrees_with_the_filled_calendar(spark):
    """Where each country has one currency and quotes are usable, the as-of
    rate is that of the filled calendar."""
    days = [datetime.date(2024, 1, 1) + datetime.timedelta(days=i) for i in range(60)]
    quotes = spark.createDataFrame([(d, "USD", c, r + d.day / 100) for d in days if d.weekday() < 5
                                    for c, r in (("EUR", 0.9), ("JPY", 140.0))],
                                   "actual_date date, base string, currency string, rate double")
    countries = spark.createDataFrame([("DE", "Germany", ["EUR"]), ("JP", "Japan", ["JPY"]), ("AQ", "Antarctica", None)],
                                      "alpha_2 string, common_name string, currency_codes array<string>")
    sales = spark.createDataFrame([(i, c, days[i % 60], float(i)) for i in range(200) for c in ("DE", "JP", "AQ", None)],
                                  "order_id int, country string, order_date date, amount double")
    sales = sales.withColumns({c: F.lit(None).cast("string") for c in (
        "customer_id", "customer_name", "product_name", "ship_date", "unit_price", "segment", "category",
        "order_channel", "discount", "tax", "_row_id", "_load_id", "loaded_date", "quarantine_reason")})
    sales = sales.withColumns({"product_id": F.lit(1), "quantity": F.lit(1), "is_quarantined": F.lit(False)})
    last = days[-1]
    dense = convert_to_base(sales, countries, stage_fx(fill_calendar(quotes, end=last)))
    asof = convert_asof(sales, countries, quotes)

    def rows(df):
        return sorted((r.order_id, r.country or "", r.rate or 0, r.amount_usd or 0) for r in df.collect())
    assert rows(dense) == rows(asof)
