"""Pipeline invariants on sf0.001."""

import pytest
from pyspark.sql import functions as F

from starflow.plans import pipeline as P
from starflow.operators import quality as Q


@pytest.fixture(scope="module")
def star(spark):
    return P.build(spark, "/root/testdata/sf0.001", persist_mode="cache")


def test_clean_plus_quarantined_is_all(star):
    clean, bad = Q.split(star.staged)
    assert clean.count() + bad.count() == star.staged.count()


def test_one_fact_row_per_conformed_row(star):
    assert star.fact.count() == star.conformed.count()
    assert star.fact.select("order_line_id").distinct().count() == star.conformed.count()


def test_usd_totals_agree(star):
    a = star.fact.agg(F.sum("gross_amount_usd")).first()[0]
    b = star.conformed.agg(F.sum("amount_usd")).first()[0]
    assert abs(a - b) < 1e-6 * max(1.0, abs(b))


def test_versions_do_not_overlap(star):
    d = star.dim_customer.filter(F.col("customer_id") != -1)
    nxt = d.alias("a").join(d.alias("b"), (F.col("a.customer_id") == F.col("b.customer_id"))
                            & (F.col("a.valid_from") < F.col("b.valid_from"))
                            & (F.col("a.valid_to").isNull() | (F.col("a.valid_to") > F.col("b.valid_from"))))
    assert nxt.count() == 0
    assert d.filter("is_current").groupBy("customer_id").count().filter("count > 1").count() == 0


def test_checks_pass(star):
    assert Q.ship_before_order(star.staged).count() == 0
    assert Q.converted_but_null(star.conformed).count() == 0


def test_direction_of_conversion(spark):
    from starflow.operators.fx import convert_to_base
    sales = spark.createDataFrame(
        [(1, 2, 3, "x", "p", "2024-01-06", "2024-01-07", 1, 9.0, 90.0, "s", "c", "o", "ZZ", 0.0, 0.0, "r1", "L", "2024-01-07 00:00:00")],
        "order_id int, customer_id int, product_id int, customer_name string, product_name string, order_date string, "
        "ship_date string, quantity int, unit_price double, amount double, segment string, category string, "
        "order_channel string, country string, discount double, tax double, _row_id string, _load_id string, loaded_date string"
    ).withColumn("order_date", F.col("order_date").cast("date"))
    countries = spark.createDataFrame([("Zed", "ZZ", ["ZZD"])], "common_name string, alpha_2 string, currency_codes array<string>")
    fx = spark.createDataFrame([("2024-01-06", "ZZD", 0.9, False)], "rate_date string, currency string, rate double, is_quarantined boolean") \
        .withColumn("rate_date", F.col("rate_date").cast("date"))
    r = convert_to_base(sales, countries, fx).first()
    assert abs(r["amount_usd"] - 100.0) < 1e-9 and r["order_line_id"] == "1-3-1"
