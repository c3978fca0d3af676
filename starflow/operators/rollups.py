"""Reports on the star (AGG6-8): revenue rollup, unknown-member revenue and
the quarantine summary.  All are single aggregations with map-side combine;
dimension lookups are equi-joins Spark may broadcast from measured sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import UNKNOWN_KEY
from .quality import country_key


def _in_force(dim: DataFrame) -> DataFrame:
    # A day with two changes yields a zero-length version sharing its
    # surrogate key with the version that follows; facts never point to it.
    return dim.filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))


def revenue_rollup(fact: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
                   countries: DataFrame) -> DataFrame:
    """AGG6: USD revenue by order month, region and category, with rollup
    subtotals (month, month+region, all)."""
    dc = _in_force(dim_customer).select(F.col("customer_surrogate_id").alias("_ck"), F.col("country").alias("_cc"))
    dp = _in_force(dim_product).select(F.col("product_surrogate_id").alias("_pk"), "category")
    regions = countries.select(country_key().alias("_rk"), "region")
    j = (fact.join(dc, fact["customer_key"] == dc["_ck"], "left")
             .join(regions, F.col("_cc") == F.col("_rk"), "left")
             .join(dp, fact["product_key"] == dp["_pk"], "left")
             .withColumn("order_month", F.trunc("order_date", "month")))
    return (j.rollup("order_month", "region", "category")
             .agg(F.count(F.lit(1)).alias("n_lines"),
                  F.round(F.sum("net_amount_usd"), 2).alias("net_usd"),
                  F.round(F.sum("gross_amount_usd"), 2).alias("gross_usd")))


def unknown_revenue(fact: DataFrame) -> DataFrame:
    """AGG7: lines and USD landing on the unknown members."""
    cu, pu = F.col("customer_key") == UNKNOWN_KEY, F.col("product_key") == UNKNOWN_KEY
    member = (F.when(cu & pu, "both").when(cu, "customer").when(pu, "product").otherwise("none"))
    return (fact.groupBy(member.alias("unknown_member"))
                .agg(F.count(F.lit(1)).alias("n_lines"),
                     F.round(F.sum("gross_amount_usd"), 2).alias("gross_usd")))


def quarantine_summary(df: DataFrame, reason_col: str = "quarantine_reason") -> DataFrame:
    """AGG8: rows per quarantine reason (a row with two reasons counts for
    both)."""
    return (df.filter(F.col(reason_col).isNotNull())
              .select(F.explode(F.split(F.col(reason_col), ", ")).alias("reason"))
              .groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")))
