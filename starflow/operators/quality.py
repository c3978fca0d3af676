"""Quarantine flags (QRT1-2) and data-quality checks (CHK1-7).

Rows are never deleted for being bad: ``flag`` adds a readable
``quarantine_reason`` (rule names joined by ', ' in rule order, NULL when the
row is clean) and ``is_quarantined``.  Checks return the failing rows, so a
check passes when its DataFrame is empty; all of them are narrow projections
and filters that Spark pushes into the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def reason_column(rules: Sequence[Rule]) -> Column:
    return F.nullif(F.concat_ws(", ", *[F.when(pred, F.lit(name)) for name, pred in rules]),
                    F.lit(""))


def flag(df: DataFrame, rules: Sequence[Rule], reason_col: str = "quarantine_reason",
         flag_col: str = "is_quarantined") -> DataFrame:
    """QRT1: add the reason list and the boolean flag; keeps every row."""
    return (df.withColumn(reason_col, reason_column(rules))
              .withColumn(flag_col, F.col(reason_col).isNotNull()))


def split(df: DataFrame, flag_col: str = "is_quarantined") -> tuple[DataFrame, DataFrame]:
    """QRT2: (clean, quarantined).  Together they are exactly the input."""
    return df.filter(~F.col(flag_col)), df.filter(F.col(flag_col))


# ------------------------------------------------------------------ rule sets

def sales_rules(allow_returns: bool = False) -> list[Rule]:
    """The 13 staging rules for sales lines, in order.

    ``allow_returns=True`` keeps negative quantities and amounts (returns):
    only a zero quantity is invalid and invalid_amount is dropped."""
    c = F.col
    rules: list[Rule] = [
        ("missing_order_id", c("order_id").isNull()),
        ("missing_customer_id", c("customer_id").isNull()),
        ("missing_product_id", c("product_id").isNull()),
        ("missing_order_date", c("order_date").isNull()),
        ("missing_ship_date", c("ship_date").isNull()),
        ("missing_quantity", c("quantity").isNull()),
        ("invalid_quantity", (c("quantity") == 0) if allow_returns else (c("quantity") <= 0)),
        ("missing_unit_price", c("unit_price").isNull()),
        ("invalid_unit_price", c("unit_price") < 0),
        ("ship_before_order", c("ship_date") < c("order_date")),
        ("missing_amount", c("amount").isNull()),
    ]
    if not allow_returns:
        rules.append(("invalid_amount", c("amount") < 0))
    rules.append(("missing_country", c("country").isNull()))
    return rules


def fx_rules() -> list[Rule]:
    c = F.col
    return [
        ("missing_rate_date", c("rate_date").isNull()),
        ("missing_currency", c("currency").isNull()),
        ("missing_base", c("base").isNull()),
        ("missing_rate", c("rate").isNull()),
        ("invalid_rate", c("rate") <= 0),
    ]


def country_rules() -> list[Rule]:
    c = F.col
    return [
        ("missing_common_name", c("common_name").isNull()),
        ("missing_alpha_2", c("alpha_2").isNull()),
        ("missing_alpha_3", c("alpha_3").isNull()),
        ("missing_ccn3", c("ccn3").isNull()),
        ("missing_currency", c("currency_codes").isNull()),
    ]


def conformed_rules() -> list[Rule]:
    c = F.col
    return [
        ("missing_country_mapping", c("country_name").isNull()),
        ("missing_rate", c("rate").isNull()),
    ]


# --------------------------------------------------------------------- checks

def not_null(df: DataFrame, col: str) -> DataFrame:
    """CHK1: rows where ``col`` is NULL."""
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """CHK2: values of ``col`` seen more than once (NULLs ignored), with counts.

    One aggregation with map-side combine; a hot value costs one partial
    count per task, never a collected group."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """CHK3: rows whose ``col`` is outside ``values`` (NULL passes)."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))


def freshness(df: DataFrame, ts_col: str, warn_hours: float, error_hours: float,
              as_of: datetime | str | Column | None = None) -> DataFrame:
    """CHK4: one row: latest ``ts_col``, age in hours at ``as_of`` and a status.

    Status is 'pass', 'warn' or 'error'; an empty table is 'error'."""
    now = (F.current_timestamp() if as_of is None
           else as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp"))
    latest = df.agg(F.max(ts_col).alias("max_loaded_at"))
    age = (F.unix_timestamp(now) - F.unix_timestamp("max_loaded_at")) / F.lit(3600.0)
    return (latest.withColumn("age_hours", age)
            .withColumn("status",
                        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
                        .when(F.col("age_hours") > warn_hours, "warn").otherwise("pass")))


def converted_but_null(conformed: DataFrame) -> DataFrame:
    """CHK5: a rate was found but the USD amount is NULL."""
    return conformed.filter(F.col("rate").isNotNull() & F.col("amount_usd").isNull())


def unmapped_country(staged: DataFrame, countries: DataFrame) -> DataFrame:
    """CHK6: staged rows whose country matches no country key (anti join).

    Spark broadcasts the country side where its measured size allows."""
    keys = countries.select(country_key().alias("_ck")).filter(F.col("_ck").isNotNull())
    return (staged.filter(F.col("country").isNotNull())
                  .join(keys, F.col("country") == F.col("_ck"), "left_anti"))


def ship_before_order(staged: DataFrame) -> DataFrame:
    """CHK7: clean rows that ship before they are ordered (must be none)."""
    return staged.filter((F.col("order_date") > F.col("ship_date")) & ~F.col("is_quarantined"))


def country_key() -> Column:
    """Match key of a country: alpha-2 code, else the common name."""
    return F.coalesce(F.nullif(F.col("alpha_2"), F.lit("")), F.col("common_name"))
