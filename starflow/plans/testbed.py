"""Render the benchmark tables as the pipeline's raw inputs.

The driver's tables are clean and typed; the pipeline expects messy all-text
sales exports, daily FX quotes and nested country records.  This module
derives them from the tables with deterministic expressions of the keys, so
every input grows with the data and the DuckDB oracle (``oracle_sql.py``)
can derive the same rows with the same rules:

* sales lines = lineitem ⋈ orders ⋈ customer ⋈ part ⋈ supplier ⋈ nation,
  split into two export versions by line number (v1 has Segment and Amount,
  v2 has Total Amount, Order Channel and Tax), with ids, dates, numbers and
  names written in several formats chosen by key;
* one load per ship month, inserted on the 1st of the following month;
* FX quotes for every trading day between the first and last order date,
  rate from a closed formula of (currency, day), a few bad quotes by rule;
* countries from nation ⋈ region, currencies as a nested array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.contracts import SALES_COLUMNS, SALES_RENAMES
from ..sources.readers import conform_schema, normalize_columns, union_exports

# Fixture spec shared with the oracle: nations 0-6 stand for real countries.
CORE_NATIONS = {
    0: ("CA", "CAD", ["CA", "Canada", "c.a.", " CANADA "]),
    1: ("DE", "EUR", ["DE", "Germany", "Deutschland", " de "]),
    2: ("ES", "EUR", ["ES", "España", "Spain", "e.s."]),
    3: ("FR", "EUR", ["FR", "France", "f.r.", " FRANCE"]),
    4: ("GB", "GBP", ["GB", "United Kingdom", "U.K.", "uk"]),
    5: ("JP", "JPY", ["JP", "Japan", "j.p.", "JAPAN "]),
    6: ("US", "USD", ["US", "U.S.A.", "United States", "united states of america"]),
}
NO_ALPHA2_EMPTY = 23     # alpha_2 '' -> joins on the common name
NO_ALPHA2_NULL = 24      # alpha_2 NULL -> flagged, still joins on the name
NO_CCN3 = 21
NO_CURRENCY = 22
SEGMENTS = {"AUTOMOBILE": "Consumer", "BUILDING": "Corp.", "FURNITURE": "Home-Office",
            "HOUSEHOLD": " HOME OFFICE", "MACHINERY": "corporate"}
CATEGORIES = {"STANDARD": "Furniture", "MEDIUM": "Office Supplies", "LARGE": "TECHNOLOGY",
              "PROMO": "technology ", "SMALL": "Office-Supplies"}
CHANNELS = {"1-URGENT": "Online", "2-HIGH": " ONLINE", "3-MEDIUM": "Partner", "5-LOW": "Retail"}

LINES_PER_TASK = 500_000

V1_HEADERS = {
    "order_id": "Order ID", "order_date": "Order Date", "ship_date": "Ship Date",
    "customer_id": "Customer ID", "customer_name": "Customer Name", "country": "Country",
    "segment": "Segment", "product_id": "Product ID", "product_name": "Product Name",
    "category": "Category", "quantity": "Quantity", "unit_price": "Unit Price",
    "discount": "Discount", "amount": "Amount", "currency": "Currency", "sales_rep": "Sales Rep",
}
V2_HEADERS = {**{k: v for k, v in V1_HEADERS.items() if k not in ("segment", "amount")},
              "amount": "Total Amount ", "order_channel": "Order Channel", "tax": "Tax"}


class Tables(dict):
    """Table name -> DataFrame, opened on first use (opening reads footers)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        self[name] = df
        return df


def load_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return Tables(spark, sf_dir)


def _case(col: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v)))
    return out


def _idiv(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("bigint")


def _s(c: Column) -> Column:
    return c.cast("string")


def _thousands(w: Column, sep: str) -> Column:
    return (F.when(w >= 1_000_000, F.concat(_s(_idiv(w, 1_000_000)), F.lit(sep),
                                            F.lpad(_s(_idiv(w, 1000) % 1000), 3, "0"), F.lit(sep),
                                            F.lpad(_s(w % 1000), 3, "0")))
            .when(w >= 1000, F.concat(_s(_idiv(w, 1000)), F.lit(sep), F.lpad(_s(w % 1000), 3, "0")))
            .otherwise(_s(w)))


def money_text(cents: Column, variant: Column) -> Column:
    """Cents -> one of four export spellings: '1234.50', '$1,234.50',
    '1.234,50', 'EUR 1234.50'."""
    w = _idiv(cents, 100)
    ff = F.lpad(_s(cents % 100), 2, "0")
    return (F.when(variant == 0, F.concat(_s(w), F.lit("."), ff))
            .when(variant == 1, F.concat(F.lit("$"), _thousands(w, ","), F.lit("."), ff))
            .when(variant == 2, F.concat(_thousands(w, "."), F.lit(","), ff))
            .otherwise(F.concat(F.lit("EUR "), _s(w), F.lit("."), ff)))


def _serial(d: Column) -> Column:
    return F.datediff(d, F.lit("1899-12-30").cast("date"))


def alpha2(nk: Column) -> Column:
    core = _case(nk, {k: v[0] for k, v in CORE_NATIONS.items()})
    return (F.when(nk < 7, core)
            .when(nk == NO_ALPHA2_EMPTY, F.lit(""))
            .when(nk == NO_ALPHA2_NULL, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("X"), F.char(F.lit(65) + nk))))


def local_currency(nk: Column) -> Column:
    core = _case(nk, {k: v[1] for k, v in CORE_NATIONS.items()})
    return F.when(nk < 7, core).otherwise(F.concat(F.lit("X"), F.char(F.lit(65) + nk), F.lit("D")))


def country_text(nk: Column, name: Column, variant: Column) -> Column:
    spellings = F.create_map(*[F.lit(x) for k, (_, _, forms) in CORE_NATIONS.items()
                               for i, form in enumerate(forms) for x in (k * 4 + i, form)])
    code = F.concat(F.lit("X"), F.char(F.lit(65) + nk))
    return (F.when(nk < 7, F.try_element_at(spellings, nk * 4 + variant))
            .when(nk >= NO_ALPHA2_EMPTY, name)
            .when(variant == 2, F.lower(code)).otherwise(code))


def _whole(x: Column) -> Column:
    """A double to the nearest whole number, halves away from zero.  Spark's
    ``round`` goes through a decimal of the number's digits, which costs more
    than the rest of a line's arithmetic; it is asked only where the number is
    not plainly next to a whole one."""
    near = F.floor(x + 0.5)
    return F.when(F.abs(x - near) < 0.25, near).otherwise(F.round(x).cast("bigint"))


def _digits(d: Column) -> Column:
    """'yyyyMMdd' of a date of the years 1000 to 9999, else NULL.  A few string
    operations on integers, where a formatter walks a pattern."""
    y = F.year(d)
    return F.when(y.between(1000, 9999), _s(y * 10000 + F.month(d) * 100 + F.dayofmonth(d)))


def _date_text(d: Column, digits: Column, pattern: str) -> Column:
    """``date_format`` of a date for the patterns of digits used here."""
    y, m, day = F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2)
    parts = {"yyyy-MM-dd": (y, F.lit("-"), m, F.lit("-"), day), "MM/dd/yyyy": (m, F.lit("/"), day, F.lit("/"), y),
             "yyyy/MM/dd": (y, F.lit("/"), m, F.lit("/"), day), "yyyyMM": (y, m),
             "M/d/yyyy": (F.ltrim(m, F.lit("0")), F.lit("/"), F.ltrim(day, F.lit("0")), F.lit("/"), y)}
    return F.when(digits.isNotNull(), F.concat(*parts[pattern])).otherwise(F.date_format(d, pattern))


def _order_texts(t: dict[str, DataFrame]) -> DataFrame:
    """The columns of an order that its lines repeat, rendered once per
    customer or order."""
    o, c, n = t["orders"], t["customer"], t["nation"]
    nk, key, name = F.col("c_nationkey"), F.col("c_custkey"), F.col("c_name")
    c = c.join(n.select("n_nationkey", "n_name"), nk == F.col("n_nationkey"), "left").select(
        "c_custkey",
        F.when(key % 3 == 0, name).when(key % 3 == 1, F.concat(F.lit(" "), F.upper(name), F.lit("  ")))
        .otherwise(F.replace(name, F.lit("#"), F.lit("  #  "))).alias("customer_name"),
        country_text(nk, F.col("n_name"), key % 4).alias("country"),
        _case(F.col("c_mktsegment"), SEGMENTS).alias("segment"),
        local_currency(nk).alias("currency"))
    o = o.withColumn("od", F.col("o_orderdate").cast("date")).withColumn("o_digits", _digits(F.col("od")))
    k, ck, od, digits = F.col("o_orderkey"), F.col("o_custkey"), F.col("od"), F.col("o_digits")
    cks = _s(ck)
    return o.join(c, ck == F.col("c_custkey"), "left").select(
        "o_orderkey",
        F.when(k % 4 == 0, _date_text(od, digits, "yyyy-MM-dd")).when(k % 4 == 1, _date_text(od, digits, "MM/dd/yyyy"))
        .when(k % 4 == 2, F.date_format(od, "dd MMM yyyy")).otherwise(_s(_serial(od))).alias("order_date"),
        F.when(ck % 3 == 0, cks).when(ck % 3 == 1, F.concat(F.lit("#"), cks))
        .otherwise(F.concat(cks, F.lit(" "))).alias("customer_id"),
        "customer_name", "country",
        F.when((F.year(od) >= 1999) & (ck % 5 == 0), F.lit("Corp.")).otherwise(F.col("segment")).alias("segment"),
        "currency", _case(F.col("o_orderpriority"), CHANNELS).alias("order_channel"))


def sales_lines(t: dict[str, DataFrame]) -> DataFrame:
    """All sales lines with every export column rendered as text.

    What a customer, a part or an order says is rendered there, once, and not
    for each of its lines.  Of the lines' own columns, integers and dates come
    first and text second, so each value is computed once and the generated
    code stays small."""
    li, p, s = t["lineitem"], t["part"], t["supplier"]
    pk = F.col("p_partkey")
    p = p.select("p_partkey", F.when(pk % 13 == 0, F.lit(None).cast("string"))
                 .when(pk % 3 == 0, F.col("p_name")).when(pk % 3 == 1, F.upper("p_name"))
                 .otherwise(F.concat(F.lit(" "), F.col("p_name"))).alias("product_name"),
                 _case(F.col("p_type"), CATEGORIES).alias("category"))
    # Rendering and parsing are the costly part: the narrow lines are dealt out
    # to all cores before it, however few row groups their file has, and to
    # more tasks the more lines there are.  By order and last of all joins, so
    # that the join to the orders by shuffle finds them in place and the tasks
    # that render are these, not ones sized by the bytes of narrow lines.
    parts = max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), li.count() // LINES_PER_TASK)
    lines = (li.join(p, li["l_partkey"] == p["p_partkey"], "left")
             .join(s.select("s_suppkey", F.col("s_name").alias("sales_rep")), li["l_suppkey"] == F.col("s_suppkey"), "left")
             .drop("p_partkey", "s_suppkey").repartition(parts, "l_orderkey"))
    j = lines.join(_order_texts(t), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    carried = ["order_date", "customer_id", "customer_name", "country", "segment", "product_name", "category",
               "currency", "sales_rep", "order_channel"]
    base = j.select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("ln"), F.col("l_partkey").alias("pk"),
        F.col("l_shipdate").cast("date").alias("sd"), "l_shipdate", "l_suppkey", "l_returnflag", "l_linestatus",
        _digits(F.col("l_shipdate").cast("date")).alias("digits"),
        _whole(F.col("l_extendedprice") * 100).alias("cents"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        _whole(F.col("l_quantity") * 100).alias("qty100"),
        _whole(F.col("l_discount") * 100).cast("int").alias("disc"),
        _whole(F.col("l_tax") * 100).cast("int").alias("tax_pct"), *carried,
    ).withColumn("unit_cents", F.floor(F.col("cents") / F.col("qty")).cast("bigint"))
    k, ln, pk = F.col("k"), F.col("ln"), F.col("pk")
    sd, digits = F.col("sd"), F.col("digits")
    ks, pks = _s(k), _s(pk)
    qty, disc, tax = F.col("qty"), F.col("disc"), F.col("tax_pct")
    neg = F.when(F.col("l_returnflag") == "R", F.lit("-")).otherwise(F.lit(""))
    cols = {
        "order_id": (F.when(k % 4 == 0, ks).when(k % 4 == 1, F.concat(F.lit("#"), ks))
                     .when(k % 4 == 2, F.concat(F.lit(" "), ks, F.lit(" ")))
                     .when(k % 20 == 3, F.concat(F.lit("ORD-"), ks)).otherwise(F.concat(ks, F.lit(".")))),
        "order_date": F.when(k % 97 == 0, F.lit("n/a")).otherwise(F.col("order_date")),
        "ship_date": (F.when(ln % 4 == 0, F.date_format(F.col("l_shipdate"), "yyyy-MM-dd HH:mm:ss"))
                      .when(ln % 4 == 1, _date_text(sd, digits, "M/d/yyyy"))
                      .when(ln % 4 == 2, _date_text(sd, digits, "yyyy/MM/dd"))
                      .otherwise(F.concat(_s(_serial(sd)), F.lit(".0")))),
        **{c: F.col(c) for c in ("customer_id", "customer_name", "country", "segment")},
        "product_id": (F.when(pk % 3 == 0, pks).when(pk % 3 == 1, F.concat(F.lit("#"), pks))
                       .otherwise(F.concat(pks, F.lit(" ")))),
        **{c: F.col(c) for c in ("product_name", "category")},
        "quantity": (F.when(ln % 3 == 0, F.concat(neg, _s(qty)))
                     .when(ln % 3 == 1, F.concat(neg, _s(qty), F.lit(".0")))
                     .otherwise(F.concat(F.lit(" "), neg, _s(qty)))),
        "unit_price": F.when(k % 7 != 0, money_text(F.col("unit_cents"), (k + ln) % 4)),
        "discount": (F.when(ln % 3 == 0, F.concat(_s(disc), F.lit("%")))
                     .when(ln % 3 == 1, F.concat(F.lit("0."), F.lpad(_s(disc), 2, "0")))),
        "amount": money_text(F.col("cents"), k % 4),
        **{c: F.col(c) for c in ("currency", "sales_rep", "order_channel")},
        "tax": (F.when(ln % 3 == 1, F.concat(_s(tax), F.lit("%")))
                .when(ln % 3 == 2, F.concat(F.lit("0."), F.lpad(_s(tax), 2, "0")))),
        "_load_id": _date_text(sd, digits, "yyyyMM"),
        "_row_id": F.md5(F.concat_ws("|", ks, _s(ln), pks, _s(F.col("l_suppkey")), _s(F.col("qty100")),
                                     _s(F.col("cents")), _s(disc), _s(tax), F.col("l_returnflag"),
                                     F.col("l_linestatus"), _date_text(sd, digits, "yyyy-MM-dd"))),
        "_v": ln % 2,
    }
    return base.select(*[v.alias(name) for name, v in cols.items()])


def sales_exports(t: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The two export versions with their original headers (v1, v2)."""
    lines = sales_lines(t)
    lineage = ["_load_id", "_row_id"]
    v1 = lines.filter(F.col("_v") == 1).select(
        *[F.col(k).alias(h) for k, h in V1_HEADERS.items()], *lineage)
    v2 = lines.filter(F.col("_v") == 0).select(
        *[F.col(k).alias(h) for k, h in V2_HEADERS.items()], *lineage)
    return v1, v2


def raw_sales(t: dict[str, DataFrame]) -> DataFrame:
    """raw.sales: both export versions on the contract, with lineage.

    Equal to normalising and unioning ``sales_exports`` (the columns one
    version lacks are NULL) but computed in one pass over the joined lines,
    so the join runs once instead of once per version."""
    lines = sales_lines(t)
    v1 = F.col("_v") == 1
    only_v1 = {"segment"}
    only_v2 = {"order_channel", "tax"}
    cols = []
    for c in SALES_COLUMNS:
        if c in only_v1:
            cols.append(F.when(v1, F.col(c)).alias(c))
        elif c in only_v2:
            cols.append(F.when(~v1, F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return lines.select(*cols, "_load_id", "_row_id")


def raw_sales_from_exports(t: dict[str, DataFrame]) -> DataFrame:
    """raw.sales the way a loader builds it: normalise each export's headers
    (SRC2), conform it to the contract (SRC3) and union them."""
    frames = []
    for export in sales_exports(t):
        df = normalize_columns(export)
        frames.append(conform_schema(df, SALES_RENAMES, SALES_COLUMNS + ["_load_id", "_row_id"]))
    return union_exports(frames)


def loads(t: dict[str, DataFrame]) -> DataFrame:
    """The load log: one load per ship month, inserted the next month 06:00."""
    m = t["lineitem"].select(F.date_trunc("month", F.col("l_shipdate")).alias("_m")).distinct()
    return m.select(F.date_format("_m", "yyyyMM").alias("load_id"),
                    (F.add_months(F.col("_m").cast("date"), 1).cast("timestamp")
                     + F.expr("INTERVAL 6 HOURS")).alias("inserted_at"))


def countries_nested(t: dict[str, DataFrame]) -> DataFrame:
    """Country records as the API returns them (nested structs + array)."""
    n = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"), "left")
    nk = F.col("n_nationkey")
    local = local_currency(nk)

    def cur(code: Column) -> Column:
        return F.struct(code.alias("code"), F.concat(code, F.lit(" unit")).alias("name"),
                        F.when(code != "EUR", F.lit("¤")).alias("symbol"))

    currencies = (F.when(nk == NO_CURRENCY, F.array().cast("array<struct<code:string,name:string,symbol:string>>"))
                  .when((nk >= 7) & (nk % 5 == 0), F.array(cur(local), cur(F.lit("EUR"))))
                  .otherwise(F.array(cur(local))))
    common = F.when(nk % 5 == 1, F.concat(F.col("n_name"), F.lit(" "))).otherwise(F.col("n_name"))
    return n.select(
        F.struct(common.alias("common"), F.concat(F.lit("Republic of "), F.col("n_name")).alias("official")).alias("names"),
        F.struct(alpha2(nk).alias("alpha_2"), F.concat(F.lit("N"), F.lpad(_s(nk), 2, "0")).alias("alpha_3"),
                 F.when(nk != NO_CCN3, F.lpad(_s(nk), 3, "0")).alias("ccn3")).alias("codes"),
        F.col("r_name").alias("region"),
        F.lit(None).cast("string").alias("subregion"),
        (nk * 1000).cast("long").alias("population"),
        currencies.alias("currencies"),
    )


def fx_quotes(t: dict[str, DataFrame], base: str = "USD") -> DataFrame:
    """Trading-day quotes (actual_date, base, currency, rate) for every
    currency any country lists, from 10 days before the first order date to
    the last order date.  Weekends and 1 January have no quote."""
    o = t["orders"]
    lo = o.agg(F.date_sub(F.min(F.col("o_orderdate").cast("date")), 10)).scalar()
    hi = o.agg(F.max(F.col("o_orderdate").cast("date"))).scalar()
    codes = (countries_nested(t).select(F.explode("currencies.code").alias("currency"))
             .filter(F.col("currency") != base).distinct())
    days = codes.select("currency", F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias("d"))
    days = days.filter(~F.dayofweek("d").isin(1, 7) & ~((F.month("d") == 1) & (F.dayofmonth("d") == 1)))
    cur = F.col("currency")
    cnum = (F.ascii(F.substring(cur, 1, 1)) * 3 + F.ascii(F.substring(cur, 2, 1))
            + F.ascii(F.substring(cur, 3, 1))).cast("bigint")
    dnum = F.unix_date("d").cast("bigint")
    good = (F.lit(500) + (cnum % 17) * 250 + ((dnum * 7 + cnum) % 41)).cast("double") / F.lit(1000.0)
    rate = (F.when((dnum + cnum) % 89 == 0, F.lit(None).cast("double"))
            .when((dnum + cnum) % 97 == 0, F.lit(0.0)).otherwise(good))
    return days.select(F.col("d").alias("actual_date"), F.lit(base).alias("base"), cur, rate.alias("rate"))
