"""Reference data and currency conversion: countries (JN2, AGG2), FX calendar
fill (SRC8), FX staging, conversion to the base currency (FX1) and the order
line key (KEY1).

Conversion plan.  The source joins every sale to the FX table through an
array-membership predicate and then keeps one row per sale with a window over
the sale's row id — that shuffles every sale by row id.  Here the reduction
happens on the reference side instead: country codes are exploded and joined
to the rates, reduced to one rate per (country, day), and the sales side
meets that small table through one equi-join on (country, order date).  No
window over sales, no row multiplication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import sign_int
from .asof import asof_join
from .quality import conformed_rules, country_key, country_rules, flag, fx_rules


# ------------------------------------------------------------------ countries

def stage_countries(parent: DataFrame, currencies: DataFrame) -> DataFrame:
    """stg_countries: trimmed names, ordered currency lists, quarantine flags.

    ``parent``: _row_id, names__common, names__official, codes__alpha_2,
    codes__alpha_3, codes__ccn3, region.  ``currencies``: _parent_id, _pos,
    code, name, symbol (the child table written by ``unnest``)."""
    countries = parent.select(
        "_row_id",
        F.trim("names__common").alias("common_name"),
        F.trim("names__official").alias("official_name"),
        F.col("codes__alpha_2").alias("alpha_2"),
        F.col("codes__alpha_3").alias("alpha_3"),
        F.col("codes__ccn3").alias("ccn3"),
        F.trim("region").alias("region"),
    )
    # Lists aligned by position: collect structs (NULL fields survive, unlike
    # collect_list of a bare column) and sort by the child position.
    lists = (currencies.groupBy("_parent_id")
             .agg(F.array_sort(F.collect_list(F.struct(
                 F.col("_pos"), F.trim("code").alias("code"), F.trim("name").alias("name"),
                 F.trim("symbol").alias("symbol")))).alias("_cur"))
             .select(F.col("_parent_id"),
                     F.col("_cur.code").alias("currency_codes"),
                     F.col("_cur.name").alias("currency_names"),
                     F.col("_cur.symbol").alias("currency_symbols")))
    joined = countries.join(lists, countries["_row_id"] == lists["_parent_id"], "left")
    out = flag(joined, country_rules())
    return out.select("common_name", "official_name", "alpha_2", "alpha_3", "ccn3", "region",
                      "currency_codes", "currency_names", "currency_symbols",
                      "quarantine_reason", "is_quarantined")


# ------------------------------------------------------------------------- FX

def fill_calendar(quotes: DataFrame, end=None) -> DataFrame:
    """SRC8: one row per (base, currency, calendar day) from each currency's
    first quote to ``end`` (default: the latest quote of any currency).

    ``quotes``: (actual_date date, base, currency, rate) for trading days.
    A closed day carries the latest earlier quote: rate_date is the requested
    day, actual_date the day the quote is from.  Work per currency is one
    window over its days, so the cost grows with currencies x days only."""
    bounds = quotes.groupBy("base", "currency").agg(F.min("actual_date").alias("_first"),
                                                    F.max("actual_date").alias("_last"))
    if end is None:
        # Latest quote of any currency; the window runs over the small
        # one-row-per-currency table only.
        bounds = bounds.withColumn("_end", F.max("_last").over(Window.partitionBy()))
    else:
        bounds = bounds.withColumn("_end", F.lit(end).cast("date"))
    days = bounds.select("base", "currency",
                         F.explode(F.sequence("_first", "_end", F.expr("INTERVAL 1 DAY"))).alias("rate_date"))
    q = quotes.select("base", "currency", F.col("actual_date").alias("rate_date"),
                      F.struct("actual_date", "rate").alias("_q"))
    w = (Window.partitionBy("base", "currency").orderBy("rate_date")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = (days.join(q, ["base", "currency", "rate_date"], "left")
              .withColumn("_q", F.last("_q", ignorenulls=True).over(w)))
    return filled.select("rate_date", F.col("_q.actual_date").alias("actual_date"), "base",
                         "currency", F.col("_q.rate").alias("rate"))


def with_identity_rate(fx: DataFrame, base: str = "USD") -> DataFrame:
    """Add base->base rows at rate 1.0 for every day present (option V16)."""
    days = fx.select("rate_date", "actual_date").distinct()
    ident = days.select("rate_date", "actual_date", F.lit(base).alias("base"),
                        F.lit(base).alias("currency"), F.lit(1.0).alias("rate"))
    return fx.filter(F.col("currency") != base).unionByName(ident)


def stage_fx(fx: DataFrame) -> DataFrame:
    """stg_fx: typed with try_cast, trimmed, quarantine flags."""
    typed = fx.select(
        F.col("rate_date").try_cast("date").alias("rate_date"),
        F.col("actual_date").try_cast("date").alias("actual_date"),
        F.trim("base").alias("base"),
        F.trim("currency").alias("currency"),
        F.col("rate").try_cast("double").alias("rate"),
    )
    return flag(typed, fx_rules())


def country_day_rates(countries: DataFrame, fx: DataFrame) -> DataFrame:
    """One rate per (country key, day): the country's currencies in list
    order, first one with a clean rate that day (tie-break: position, code)."""
    codes = (countries.select(country_key().alias("_ck"),
                              F.posexplode("currency_codes").alias("_pos", "currency"))
             .filter(F.col("_ck").isNotNull()))
    ok = fx.filter(~F.col("is_quarantined")).select("currency", "rate_date", "rate")
    return (codes.join(ok, "currency")
            .groupBy("_ck", "rate_date")
            .agg(F.min_by(F.col("rate"), F.struct("_pos", "currency", "rate")).alias("rate")))


def order_line_id() -> F.Column:
    """KEY1: order-product-sign, NULL when any part is NULL."""
    return F.concat(F.col("order_id").cast("string"), F.lit("-"), F.col("product_id").cast("string"),
                    F.lit("-"), sign_int("quantity").cast("string"))


CONFORMED_COLUMNS = [
    "order_id", "customer_id", "customer_name", "product_id", "product_name", "order_date",
    "ship_date", "quantity", "unit_price", "amount", "segment", "category", "order_channel",
    "country", "country_name", "discount", "tax", "_row_id", "_load_id", "loaded_date", "rate",
    "amount_usd", "order_line_id", "quarantine_reason", "is_quarantined",
]


def convert_to_base(sales: DataFrame, countries: DataFrame, fx: DataFrame) -> DataFrame:
    """FX1: country name, the order-day rate and amount_usd = amount / rate.

    Rates are base->local (base USD), so dividing converts to USD.  Rows
    without a country or a rate are kept and flagged.  Columns that the sales
    were staged without are left out here too."""
    keyed = (countries.select(country_key().alias("_ck"), "common_name")
             .filter(F.col("_ck").isNotNull())
             .groupBy("_ck").agg(F.min("common_name").alias("country_name")))
    rates = country_day_rates(countries, fx).withColumnRenamed("_ck", "_rk")
    # No broadcast hint: AQE measures both small sides at runtime and
    # broadcasts them under the session's threshold; else the shuffle joins
    # stay, where it splits skewed keys.
    s = sales.join(keyed, sales["country"] == keyed["_ck"], "left")
    s = s.join(rates, (s["country"] == rates["_rk"]) & (s["order_date"] == rates["rate_date"]), "left")
    s = (s.withColumn("amount_usd", F.try_divide(F.col("amount").cast("double"), F.col("rate")))
          .withColumn("order_line_id", order_line_id()))
    s = flag(s.drop("quarantine_reason", "is_quarantined"), conformed_rules())
    return s.select(*[c for c in CONFORMED_COLUMNS if c in s.columns])


def convert_asof(sales: DataFrame, countries: DataFrame, quotes: DataFrame, within: str | None = None) -> DataFrame:
    """JN7: the local currency's rate in force on the order date, straight
    from the trading-day quotes (actual_date, currency, rate): adds currency,
    rate, the day it is from, and amount_usd = amount / rate.

    No calendar is filled, so gaps between quotes cost nothing.  Unlike
    ``convert_to_base``, which takes the first currency with a rate, a sale
    has its country's first listed currency; unusable quotes (no rate, or
    none above zero) are passed over, and an earlier one counts."""
    first = (countries.select(country_key().alias("_ck"), F.get("currency_codes", F.lit(0)).alias("currency"))
             .filter(F.col("_ck").isNotNull()).groupBy("_ck").agg(F.min("currency").alias("currency")))
    priced = sales.join(first, sales["country"] == first["_ck"], "left").drop("_ck")
    usable = quotes.filter(F.col("rate") > 0)
    out = asof_join(priced, usable, ["currency"], "order_date", "actual_date", ["rate"], within=within)
    return out.withColumn("amount_usd", F.try_divide(F.col("amount").cast("double"), F.col("rate")))
