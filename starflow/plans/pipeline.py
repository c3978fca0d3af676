"""The sales star: stage -> dedupe -> conform -> dimensions -> fact.

Each step is a function DataFrame -> DataFrame.  ``build`` wires them together
and writes the tables that several consumers read (parsed and staged sales,
the conformed table) as Parquet in the session's shared folder, so the windows
under them run once and an executor lost later re-reads them instead of
recomputing from raw.  With persistence 'none' nothing runs until an action.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions.constants import INCREMENTAL_LOOKBACK_DAYS, WATERMARK_FLOOR
from ..operators.facts import build_fact, calendar_dim
from ..operators.fx import convert_to_base, fill_calendar, stage_countries, stage_fx
from ..operators.ordered import dedupe_latest, forward_fill
from ..operators.quality import flag, sales_rules
from ..operators.scd import scd2_from_events, with_unknown_member
from ..session import materialise
from ..sources.readers import unnest
from . import testbed

STAGED_COLUMNS = [
    "order_id", "customer_id", "customer_name", "product_id", "product_name", "country",
    "order_date", "ship_date", "quantity", "unit_price", "amount", "category", "segment",
    "order_channel", "discount", "tax", "quarantine_reason", "is_quarantined", "_load_id", "_row_id",
]


def persist(df: DataFrame, mode: str) -> DataFrame:
    """'none' (lazy), 'cache' (executor memory/disk) or 'table': written as
    Parquet in the session's shared folder, which runs the job, and read back
    with column pruning and pushdown.  The folder goes with the application."""
    if mode == "cache":
        return df.cache()
    if mode == "table":
        return materialise(df, "stage")
    return df


# Staged columns that neither the fill nor the rules read.
CARRIED_COLUMNS = ("customer_name", "product_name", "category", "segment", "order_channel", "discount", "tax", "_load_id")


def stage_sales(raw: DataFrame, money: str = "reference", allow_returns: bool = False,
                product_name: str = "reference", persist_mode: str = "none",
                carried: Sequence[str] = CARRIED_COLUMNS) -> DataFrame:
    """stg_sales: clean, type, forward-fill unit price per product, flag.

    ``money``: 'reference' (normalize_decimal then cast; thousands
    separators give NULL) or 'corrected' (parse_money).
    ``product_name``: 'reference' (trim of the character set 'unknown') or
    'clean' (clean_name).
    ``carried``: those of ``CARRIED_COLUMNS`` that are asked for.  A table that
    is written keeps all its columns, whoever reads it, so Spark cannot leave
    out what is not: filling and flagging take whole rows of all others."""
    price_txt = C.normalize_decimal("unit_price") if money == "reference" else C.parse_money("unit_price")
    amount = (C.to_decimal(C.normalize_decimal("amount")) if money == "reference"
              else C.parse_money("amount"))
    parsed = raw.select(
        C.clean_id_text("order_id").try_cast("bigint").alias("order_id"),
        C.clean_id_text("customer_id").try_cast("bigint").alias("customer_id"),
        C.clean_name("customer_name").alias("customer_name"),
        C.clean_id_text("product_id").alias("product_id_t"),
        (C.trim_chars("product_name") if product_name == "reference"
         else C.clean_name("product_name")).alias("product_name"),
        C.map_country_code("country").alias("country"),
        C.parse_date("order_date").alias("order_date"),
        C.parse_date("ship_date").alias("ship_date"),
        C.parse_int("quantity").alias("quantity"),
        price_txt.alias("unit_price_n"),
        amount.alias("amount"),
        C.clean_text("category").alias("category"),
        C.map_segment(C.clean_text("segment")).alias("segment"),
        C.clean_text("order_channel").alias("order_channel"),
        C.parse_percent("discount").alias("discount"),
        C.parse_percent("tax").alias("tax"),
        "_load_id", "_row_id",
    ).drop(*[c for c in CARRIED_COLUMNS if c not in carried])
    # WIN1: carry the last known price text forward per product by date.
    # The fill reads its input in two branches (rows and per-day tails) that
    # Spark prunes differently, so the exchange is not reused; materialising
    # the parsed rows first makes the raw scan and the parsing run once.
    parsed = persist(parsed, persist_mode)
    priced = forward_fill(parsed, "unit_price_n", ["product_id_t"], "order_date", "_row_id",
                          out_col="unit_price_f")
    typed = priced.select(
        "order_id", "customer_id",
        F.col("product_id_t").try_cast("bigint").alias("product_id"),
        "country", "order_date", "ship_date", "quantity",
        (C.to_decimal("unit_price_f") if money == "reference" else F.col("unit_price_f")).alias("unit_price"),
        "amount", "_row_id", *carried,
    )
    staged = flag(typed, sales_rules(allow_returns))
    return staged.select(*[c for c in STAGED_COLUMNS if c in staged.columns])


def dedupe_sales(staged: DataFrame, loads: DataFrame) -> DataFrame:
    """int_sales_deduped: clean rows only, stamped with their load time, the
    latest load per (order, product, sign of quantity) wins; ties go to the
    greater row id."""
    ld = loads.select(F.col("load_id").alias("_load_id"), F.col("inserted_at").alias("loaded_date"))
    # The load log has one row per load; AQE broadcasts it from its measured
    # size (no extra scan to count it).
    joined = staged.filter(~F.col("is_quarantined")).join(ld, "_load_id", "inner")
    return dedupe_latest(joined, ["order_id", "product_id", C.sign_int("quantity")],
                         ["loaded_date"], ["_row_id"])


def conform_since(staged: DataFrame, loads: DataFrame, countries: DataFrame, fx: DataFrame, target: DataFrame,
                  lookback_days: int = INCREMENTAL_LOOKBACK_DAYS) -> DataFrame:
    """The incremental batch: as ``conform_sales`` with a ``target``, but the
    load times are cut before the dedupe.  The winner of a line is its latest
    load, so the rows are the same, while only the loads since the watermark
    are joined, windowed and shuffled."""
    mark = F.coalesce(target.agg(F.max("loaded_date")).scalar(), F.lit(WATERMARK_FLOOR).cast("timestamp"))
    recent = loads.filter(F.col("inserted_at") >= mark - F.expr(f"INTERVAL {lookback_days} DAYS"))
    return conform_sales(dedupe_sales(staged, recent), countries, fx)


def conform_sales(deduped: DataFrame, countries: DataFrame, fx: DataFrame,
                  target: DataFrame | None = None,
                  lookback_days: int = INCREMENTAL_LOOKBACK_DAYS) -> DataFrame:
    """int_sales_conformed source rows: all deduped rows on a first run or
    full refresh; with a ``target``, only rows loaded at or after the
    target's latest load time minus the lookback."""
    src = deduped
    if target is not None:
        mark = F.coalesce(target.agg(F.max("loaded_date")).scalar(),
                          F.lit(WATERMARK_FLOOR).cast("timestamp"))
        src = src.filter(F.col("loaded_date") >= mark - F.expr(f"INTERVAL {lookback_days} DAYS"))
    return convert_to_base(src, countries, fx)


def dim_customer(conformed: DataFrame, **history) -> DataFrame:
    """``history``: options of ``scd2_from_events``."""
    base = conformed.filter(~F.col("is_quarantined"))
    dim = scd2_from_events(base, "customer_id", ["customer_name", "country", "segment"],
                           "order_date", "_row_id", "customer_surrogate_id", **history)
    return with_unknown_member(dim, "customer_id", "customer_surrogate_id",
                               {"customer_name": "unknown", "country": "unknown", "segment": "unknown"})


def dim_product(conformed: DataFrame, **history) -> DataFrame:
    """``history``: options of ``scd2_from_events``."""
    base = (conformed.filter(~F.col("is_quarantined"))
            .withColumn("unit_price_usd", F.try_divide(F.col("unit_price").cast("double"), F.col("rate"))))
    dim = scd2_from_events(base, "product_id", ["product_name", "category", "unit_price_usd"],
                           "order_date", "_row_id", "product_surrogate_id", **history)
    return with_unknown_member(dim, "product_id", "product_surrogate_id",
                               {"product_name": "unknown", "category": "unknown", "unit_price_usd": 0.0})


def staged_countries(t: dict[str, DataFrame]) -> DataFrame:
    parent, child = unnest(testbed.countries_nested(t), "currencies")
    return stage_countries(parent, child)


def staged_fx(t: dict[str, DataFrame]) -> DataFrame:
    return stage_fx(fill_calendar(testbed.fx_quotes(t)))


@dataclass
class Star:
    staged: DataFrame
    deduped: DataFrame
    countries: DataFrame
    fx: DataFrame
    conformed: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    fact: DataFrame
    extra: dict = field(default_factory=dict)


def build(spark: SparkSession, sf_dir: str, persist_mode: str = "none", **stage_opts) -> Star:
    t = testbed.load_tables(spark, sf_dir)
    raw = testbed.raw_sales(t)
    staged = persist(stage_sales(raw, persist_mode=persist_mode, **stage_opts), persist_mode)
    deduped = dedupe_sales(staged, testbed.loads(t))
    countries = staged_countries(t)
    fx = staged_fx(t)
    conformed = persist(conform_sales(deduped, countries, fx), persist_mode)
    dc, dp = dim_customer(conformed), dim_product(conformed)
    fact = build_fact(conformed, dc, dp)
    return Star(staged, deduped, countries, fx, conformed, dc, dp, calendar_dim(conformed, staged), fact)
