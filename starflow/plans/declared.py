"""The checks that the pipeline's tables declare, as suites."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import (ACCEPTED_CATEGORIES, ACCEPTED_CHANNELS, ACCEPTED_SEGMENTS, FRESHNESS_FX,
                                   FRESHNESS_SALES)
from ..operators.checks import Check, accepted, expect, fresh, not_null, run_checks, unique


def staged_sales() -> list[Check]:
    """Identifying columns known, categories of the business, and clean rows
    shipped after they were ordered."""
    return [not_null("order_id"), not_null("product_id"), not_null("customer_id"), not_null("order_date"),
            accepted("segment", ACCEPTED_SEGMENTS), accepted("category", ACCEPTED_CATEGORIES),
            accepted("order_channel", ACCEPTED_CHANNELS), unique("_row_id"),
            expect("ship_before_order", (F.col("order_date") > F.col("ship_date")) & ~F.col("is_quarantined"))]


def staged_fx() -> list[Check]:
    return [not_null("rate_date"), not_null("currency"), not_null("rate"), fresh("actual_date", *FRESHNESS_FX)]


def staged_countries() -> list[Check]:
    return [not_null("common_name"), unique("common_name"), unique("alpha_2")]


def loads() -> list[Check]:
    return [not_null("load_id"), unique("load_id"), fresh("inserted_at", *FRESHNESS_SALES)]


def conformed() -> list[Check]:
    return [expect("converted_but_null", F.col("rate").isNotNull() & F.col("amount_usd").isNull()),
            unique("order_line_id"), not_null("order_line_id"), not_null("country_name")]


def all_tables(sales: DataFrame, fx: DataFrame, countries: DataFrame, load_log: DataFrame,
               conformed_sales: DataFrame, as_of) -> DataFrame:
    """The suites of all tables, one scan each."""
    suites = [run_checks(sales, staged_sales(), "stg_sales", "order_id"),
              run_checks(fx, staged_fx(), "stg_fx", "rate_date", as_of),
              run_checks(countries, staged_countries(), "stg_countries", "ccn3"),
              run_checks(load_log, loads(), "loads", "inserted_at", as_of),
              run_checks(conformed_sales, conformed(), "conformed", "order_date")]
    return reduce(DataFrame.unionByName, suites)
