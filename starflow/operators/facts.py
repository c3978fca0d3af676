"""Point-in-time fact (JN5, FCT1) and the calendar dimension (DIM2, GEN1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import day_name, day_of_week0
from ..functions.constants import CALENDAR_HORIZON_YEARS, UNKNOWN_KEY


def point_in_time_join(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                       fact_date: str, select: list[str], prefix: str) -> DataFrame:
    """JN5: left join each fact row to the dimension version in force on its
    date: equal keys and valid_from <= d < valid_to (open when NULL).

    The versions are carried to the distinct (key, date) pairs of the facts
    first, and the facts then join on (key, date).  The pairs of a key are as
    many as it has days, however many rows and versions it has, and a hot key
    is dealt out by its dates.  Versions of a key must not overlap; one that
    starts and ends on the same day is never in force."""
    d = f"{prefix}date"
    version = F.struct("valid_to", *select)
    starts = (dim.filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))
              .select(F.col(dim_key).alias(f"{prefix}key"), F.col("valid_from").alias(d), version.alias("_v")))
    asked = facts.select(F.col(fact_key).alias(f"{prefix}key"), F.col(fact_date).alias(d)).distinct()
    days = starts.unionByName(asked, allowMissingColumns=True).groupBy(f"{prefix}key", d).agg(F.max("_v").alias("_v"))
    w = (Window.partitionBy(f"{prefix}key").orderBy(d)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = days.withColumn("_v", F.last("_v", ignorenulls=True).over(w))
    in_force = carried.filter(F.col("_v.valid_to").isNull() | (F.col(d) < F.col("_v.valid_to"))).select(
        f"{prefix}key", d, *[F.col(f"_v.{c}").alias(f"{prefix}{c}") for c in select])
    cond = (facts[fact_key] == in_force[f"{prefix}key"]) & (facts[fact_date] == in_force[d])
    return facts.join(in_force, cond, "left").drop(f"{prefix}key", d)


FACT_COLUMNS = [
    "order_line_id", "order_id", "order_date", "ship_date", "quantity", "gross_amount_usd",
    "discount_usd", "net_amount_usd", "order_channel", "discount", "_row_id", "_load_id",
    "loaded_date", "customer_key", "product_key",
]


def build_fact(conformed: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
               clean_only: bool = False) -> DataFrame:
    """FCT1: USD gross, discount and net per line, with the customer and
    product version keys in force on the order date ('-1-unknown' if none).

    ``clean_only`` drops quarantined conformed rows first (the source keeps
    them, so their USD amounts can be NULL)."""
    src = conformed.filter(~F.col("is_quarantined")) if clean_only else conformed
    j = point_in_time_join(src, dim_customer, "customer_id", "customer_id", "order_date",
                           ["customer_surrogate_id"], "_dc_")
    j = point_in_time_join(j, dim_product, "product_id", "product_id", "order_date",
                           ["product_surrogate_id"], "_dp_")
    usd = F.col("amount_usd")
    disc = F.col("discount").cast("double")
    return j.select(
        "order_line_id", "order_id", "order_date", "ship_date", "quantity",
        usd.alias("gross_amount_usd"),
        (usd * disc).alias("discount_usd"),
        (usd * (F.lit(1.0) - disc)).alias("net_amount_usd"),
        "order_channel", "discount", "_row_id", "_load_id", "loaded_date",
        F.coalesce(F.col("_dc_customer_surrogate_id"), F.lit(UNKNOWN_KEY)).alias("customer_key"),
        F.coalesce(F.col("_dp_product_surrogate_id"), F.lit(UNKNOWN_KEY)).alias("product_key"),
    )


def calendar_dim(conformed: DataFrame, staged: DataFrame,
                 horizon_years: int = CALENDAR_HORIZON_YEARS) -> DataFrame:
    """DIM2: one row per day from the first conformed order date to the last
    staged order date (quarantined rows included) plus ``horizon_years``.

    Bounds come from one aggregate over a union of the two date columns (no
    join); the day list is generated from that single row, so its size is
    the calendar span, independent of the data volume."""
    lo = conformed.select(F.col("order_date").alias("_lo"), F.lit(None).cast("date").alias("_hi"))
    hi = staged.select(F.lit(None).cast("date").alias("_lo"), F.col("order_date").alias("_hi"))
    b = lo.unionByName(hi).agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    b = b.withColumn("_end", F.add_months("_hi", 12 * horizon_years))
    days = b.filter(F.col("_lo") <= F.col("_end")).select(
        F.explode(F.sequence("_lo", "_end", F.expr("INTERVAL 1 DAY"))).alias("date_key"))
    d = F.col("date_key")
    return days.select(
        d, F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"), day_name(d).alias("day_name"),
        day_of_week0(d).alias("day_of_week"), F.weekofyear(d).alias("week_of_year"))
