"""

Every query reads the driver's tables through ``starflow.plans.testbed``
(which renders them as the pipeline's raw inputs) and runs over the whole
tables.  ``oracle_sql`` gives the DuckDB statement that defines the expected
result of each query (see ``oracle_sql.py``).
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import functions as F  # noqa: E402

from starflow.functions import clean as C  # noqa: E402
from starflow.functions.constants import ACCEPTED_SEGMENTS, FRESHNESS_SALES  # noqa: E402
from starflow.operators import profile as PR  # noqa: E402
from starflow.operators.splice import splice_events  # noqa: E402
from starflow.sources import drift as DR  # noqa: E402
from starflow.sources.nested import normalise_nested  # noqa: E402
from starflow.operators.scd import latest_per_key, scd2_from_events, scd2_snapshot  # noqa: E402
from starflow.sources import incremental as INC  # noqa: E402
from starflow.sources.contracts import SALES_COLUMNS, SALES_RENAMES  # noqa: E402
from starflow.sources.readers import (append_load, drop_exact, ingest_sales, materialize, normalize_columns,  # noqa: E402
                                      read_fx, read_loads, read_since, read_text_table, replace_table, scan, upsert)
from starflow.operators import quality as Q  # noqa: E402
from starflow.operators import rollups as R  # noqa: E402
from starflow.operators.facts import build_fact, calendar_dim  # noqa: E402
from starflow.operators.asof import asof_join  # noqa: E402
from starflow.operators.fx import convert_asof, fill_calendar  # noqa: E402
from starflow.operators.checks import expect, not_null, run_checks, unique  # noqa: E402
from starflow.plans import declared as D  # noqa: E402
from starflow.plans import pipeline as P  # noqa: E402
from starflow.plans import testbed as T  # noqa: E402
from starflow.session import configure, materialise, share_code, work_dir  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def _t(spark: SparkSession, sf_dir: str):
    share_code(configure(spark))
    return T.load_tables(spark, sf_dir)


# Tables read by several consumers are written to the session's shared folder,
# as a production run materialises them: the windows under them run once, and
# a lost executor re-reads the table instead of recomputing.
PERSIST = os.environ.get("STARFLOW_PERSIST", "table")


def _staged(spark, sf_dir, persist=False, carried=P.CARRIED_COLUMNS):
    t = _t(spark, sf_dir)
    st = P.stage_sales(T.raw_sales(t), persist_mode=PERSIST, carried=carried)
    return t, (P.persist(st, PERSIST) if persist else st)


def _staged_clean(spark, sf_dir, carried=P.CARRIED_COLUMNS):
    """For queries that read the clean rows several times, and only these."""
    t, st = _staged(spark, sf_dir, carried=carried)
    return t, P.persist(Q.split(st)[0], PERSIST)


# What dimensions read of the carried columns; the load id finds the load time.
CUSTOMER = ("customer_name", "segment", "_load_id")
PRODUCT = ("product_name", "category", "_load_id")


def _conformed(spark, sf_dir, persist=False, persist_staged=False, carried=P.CARRIED_COLUMNS):
    t, st = _staged(spark, sf_dir, persist_staged, carried)
    dd = P.dedupe_sales(st, T.loads(t))
    countries, fx = P.staged_countries(t), P.staged_fx(t)
    conf = P.conform_sales(dd, countries, fx)
    return t, st, countries, fx, (P.persist(conf, PERSIST) if persist else conf)


def _star(spark, sf_dir):
    t, st, countries, fx, conf = _conformed(spark, sf_dir, persist=True)
    dc = P.persist(P.dim_customer(conf), PERSIST)
    dp = P.persist(P.dim_product(conf), PERSIST)
    return countries, conf, dc, dp, build_fact(conf, dc, dp)


def q_raw_sales(spark, sf_dir):
    return T.raw_sales(_t(spark, sf_dir))


def q_conform_schema(spark, sf_dir):
    return T.raw_sales_from_exports(_t(spark, sf_dir))


def q_stage_sales(spark, sf_dir):
    return _staged(spark, sf_dir)[1]


def q_quarantine_summary(spark, sf_dir):
    return R.quarantine_summary(_staged(spark, sf_dir, carried=())[1])


def q_dedupe_latest(spark, sf_dir):
    t, st = _staged(spark, sf_dir)
    return P.dedupe_sales(st, T.loads(t)).select(*P.STAGED_COLUMNS, "loaded_date")


def q_stage_countries(spark, sf_dir):
    return P.staged_countries(_t(spark, sf_dir))


def q_fx_calendar_fill(spark, sf_dir):
    return fill_calendar(T.fx_quotes(_t(spark, sf_dir)))


def q_stage_fx(spark, sf_dir):
    return P.staged_fx(_t(spark, sf_dir))


def q_convert_usd(spark, sf_dir):
    return _conformed(spark, sf_dir)[4]


def q_scd2_customer(spark, sf_dir):
    return P.dim_customer(_conformed(spark, sf_dir, carried=CUSTOMER)[4])


def q_scd2_product(spark, sf_dir):
    return P.dim_product(_conformed(spark, sf_dir, carried=PRODUCT)[4])


def q_point_in_time_fact(spark, sf_dir):
    return _star(spark, sf_dir)[4]


def q_calendar(spark, sf_dir):
    # Conforming keeps every deduped row, so its first order date is theirs.
    # The last one is of all staged rows: filling leaves dates alone, so Spark
    # reads it from the parsed table and nothing is written again for it.
    t, st = _staged(spark, sf_dir, carried=["_load_id"])
    return calendar_dim(P.dedupe_sales(st, T.loads(t)), st)


def q_revenue_rollup(spark, sf_dir):
    countries, conf, dc, dp, fact = _star(spark, sf_dir)
    return R.revenue_rollup(fact, dc, dp, countries)


def q_unknown_revenue(spark, sf_dir):
    return R.unknown_revenue(_star(spark, sf_dir)[4])


def q_chk_accepted_segment(spark, sf_dir):
    return Q.accepted_values(_staged(spark, sf_dir, carried=["segment"])[1], "segment", ACCEPTED_SEGMENTS).select("_row_id", "segment")


def q_chk_unmapped_country(spark, sf_dir):
    t, st = _staged(spark, sf_dir, carried=())
    return Q.unmapped_country(st, P.staged_countries(t)).select("_row_id", "country")


def q_chk_ship_before_order(spark, sf_dir):
    return Q.ship_before_order(_staged(spark, sf_dir, carried=())[1]).select("_row_id")


def q_chk_converted_null(spark, sf_dir):
    return Q.converted_but_null(_conformed(spark, sf_dir, carried=["_load_id"])[4]).select("_row_id")


def q_chk_not_null_rate(spark, sf_dir):
    return Q.not_null(P.staged_fx(_t(spark, sf_dir)), "rate").select("rate_date", "currency")


def q_chk_unique_common_name(spark, sf_dir):
    return Q.unique(P.staged_countries(_t(spark, sf_dir)), "common_name")


def q_chk_freshness(spark, sf_dir):
    ld = T.loads(_t(spark, sf_dir))
    as_of = ld.agg(F.max("inserted_at") + F.expr("INTERVAL 8 HOURS")).scalar()
    return Q.freshness(ld, "inserted_at", *FRESHNESS_SALES, as_of=as_of)


def q_parse_money(spark, sf_dir):
    raw = T.raw_sales(_t(spark, sf_dir))
    return raw.select("_row_id", "unit_price", "amount",
                      C.parse_money("unit_price").alias("unit_price_money"),
                      C.parse_money("amount").alias("amount_money"))


def q_table_profile(spark, sf_dir):
    return PR.table_profile(T.raw_sales(_t(spark, sf_dir)), "order_id")


def q_column_profile(spark, sf_dir):
    return PR.column_profile(T.raw_sales(_t(spark, sf_dir)))


def q_numeric_describe(spark, sf_dir):
    return PR.numeric_describe(_staged(spark, sf_dir, carried=["discount", "tax"])[1], ["quantity", "unit_price", "amount", "discount", "tax"])


def q_distinct_values(spark, sf_dir):
    return PR.distinct_values(_staged(spark, sf_dir, carried=())[1], "country")


def q_first_last(spark, sf_dir):
    return PR.first_last(_staged(spark, sf_dir)[1], ["order_date", "_row_id"], 10)


def _cutoff(loads):
    """Loads inserted before this time form the first run; the last year of
    loads arrives incrementally."""
    return loads.agg(F.max("inserted_at") - F.expr("INTERVAL 365 DAYS")).scalar()


def q_incremental_upsert(spark, sf_dir):
    t, st = _staged_clean(spark, sf_dir)
    loads = T.loads(t)
    countries, fx = P.staged_countries(t), P.staged_fx(t)
    early = loads.filter(F.col("inserted_at") < _cutoff(loads))
    first = P.conform_sales(P.dedupe_sales(st, early), countries, fx)
    first = P.persist(first, PERSIST)
    batch = P.conform_since(st, loads, countries, fx, first)
    return upsert(first, batch, ["order_line_id"])


def q_scd2_snapshot(spark, sf_dir):
    t, st = _staged_clean(spark, sf_dir, ["customer_name", "segment", "_load_id"])
    loads = T.loads(t)
    clean = (st
             .join(loads.select(F.col("load_id").alias("_load_id"), "inserted_at"), "_load_id"))
    cut = _cutoff(loads)
    checks = ["customer_name", "segment", "country"]
    cur1 = latest_per_key(clean.filter(F.col("inserted_at") < cut), "customer_id", "order_date", "_row_id")
    cur2 = latest_per_key(clean, "customer_id", "order_date", "_row_id")
    run2 = loads.agg(F.max("inserted_at")).scalar()
    state = P.persist(scd2_snapshot(None, cur1, "customer_id", checks, cut), PERSIST)
    return scd2_snapshot(state, cur2, "customer_id", checks, run2)


def q_ingest_sales(spark, sf_dir):
    exports = [e.drop("_load_id", "_row_id") for e in T.sales_exports(_t(spark, sf_dir))]
    return ingest_sales(exports, SALES_RENAMES, SALES_COLUMNS)


def q_scd2_events(spark, sf_dir):
    """What each user did last, as versions by time of day."""
    versions = scd2_from_events(_t(spark, sf_dir)["events"], "user_id", ["event_type"], "ts", "event_id", "version_id")
    return versions.select("user_id", "event_type", "valid_from", "valid_to")


def q_chk_accepted_status(spark, sf_dir):
    orders = _t(spark, sf_dir)["orders"]
    return Q.accepted_values(orders, "o_orderstatus", ["F", "O"]).select("o_orderkey", "o_orderstatus")


def q_chk_unique_customer(spark, sf_dir):
    return Q.unique(_t(spark, sf_dir)["orders"], "o_custkey")


def q_chk_ordered_after_shipping(spark, sf_dir):
    t = _t(spark, sf_dir)
    lines = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", F.col("o_orderdate").alias("order_date"),
        F.col("l_shipdate").alias("ship_date"), F.lit(False).alias("is_quarantined"))
    return Q.ship_before_order(lines).select("l_orderkey", "l_linenumber")


def q_chk_undivided_price(spark, sf_dir):
    lines = _t(spark, sf_dir)["lineitem"].select(
        "l_orderkey", "l_linenumber", F.col("l_discount").alias("rate"),
        F.try_divide("l_extendedprice", "l_discount").alias("amount_usd"))
    return Q.converted_but_null(lines).select("l_orderkey", "l_linenumber")


def q_split_clean(spark, sf_dir):
    return Q.split(_staged(spark, sf_dir, carried=())[1])[0].select("_row_id", "order_id", "product_id")


def q_drop_exact(spark, sf_dir):
    """Export lines of a customer's product that agree in all that is asked."""
    raw = T.raw_sales(_t(spark, sf_dir))
    return drop_exact(raw.select("customer_name", "country", "segment", "category", "_load_id", "_row_id"))


def q_fx_merge(spark, sf_dir):
    """Quotes landed in two runs: the second reads from the last known day on
    and replaces what it meets."""
    quotes = T.fx_quotes(_t(spark, sf_dir))
    half = quotes.agg(F.date_add(F.min("actual_date"), (F.date_diff(F.max("actual_date"), F.min("actual_date")) / 2)
                                 .cast("int"))).scalar()
    first = quotes.filter(F.col("actual_date") <= half)
    return upsert(first, read_since(quotes, "actual_date", first, "1900-01-01"), ["actual_date", "currency"])


def q_incremental_write(spark, sf_dir):
    """The conformed table on disk: the first loads, then the loads of the
    last year merged by line, twice as after a restart."""
    t, st = _staged_clean(spark, sf_dir)
    loads = T.loads(t)
    countries, fx = P.staged_countries(t), P.staged_fx(t)
    early = loads.filter(F.col("inserted_at") < _cutoff(loads))
    path, month = work_dir(spark, "conformed"), INC.month_of("order_date")
    INC.merge(P.persist(P.conform_sales(P.dedupe_sales(st, early), countries, fx), PERSIST), path,
              ["order_line_id"], month)
    target = INC.read(spark, path)
    batch = P.persist(P.conform_since(st, loads, countries, fx, target), PERSIST)
    for _ in range(2):
        INC.merge(batch, path, ["order_line_id"], month)
    return INC.read(spark, path).select(*target.columns).drop(INC.PART)


def q_incremental_moves(spark, sf_dir):
    """Orders some of which were landed 45 days late: the corrections put
    them into the month they belong to."""
    o = _t(spark, sf_dir)["orders"].select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date"), "o_totalprice")
    key = F.col("o_orderkey")
    wrong = o.withColumn("o_orderdate", F.when(key % 10 == 0, F.date_add("o_orderdate", 45)).otherwise(F.col("o_orderdate")))
    fixed = materialise(o.filter(key % 20 == 0).withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2)), "fixes")
    path, month = work_dir(spark, "orders"), INC.month_of("o_orderdate")
    INC.merge(materialise(wrong, "orders-first"), path, ["o_orderkey"], month, batch_id="first")
    INC.merge(fixed, path, ["o_orderkey"], month, batch_id="fixes")
    INC.merge(fixed, path, ["o_orderkey"], month, batch_id="fixes")
    return INC.read(spark, path).withColumnRenamed(INC.PART, "part")


def q_asof_fx(spark, sf_dir):
    """Clean sales at the latest quote of their currency; quotes come in
    bursts with weeks between them, and half a year old ones don't count."""
    t, st = _staged_clean(spark, sf_dir, ())
    quotes = T.fx_quotes(t).filter(F.day("actual_date") <= 6).filter(
        ~(F.col("currency").isin("EUR", "GBP") & (F.month("actual_date") > 4)))
    rows = convert_asof(st, P.staged_countries(t), quotes, within="180 days")
    return rows.select("_row_id", "country", "currency", "order_date", "actual_date", "rate", "amount_usd")


def q_asof_events(spark, sf_dir):
    """The user's error before each event; a third of all events is of one user."""
    e = _t(spark, sf_dir)["events"].withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    last = e.filter(F.col("event_type") == "error").select(
        "user_id", F.col("ts").alias("error_ts"), F.col("event_id").alias("error_id"))
    return asof_join(e.select("event_id", "user_id", "event_type", "ts"), last, ["user_id"], "ts", "error_ts",
                     ["error_id"], bucket="day", strict=True)


def q_scd2_daily(spark, sf_dir):
    """Products by the last row of a day; one without a name has one version
    as long as nothing changes."""
    return P.dim_product(_conformed(spark, sf_dir, carried=PRODUCT)[4], first_by="row_number", one_per_day=True)


def q_scd2_price_band(spark, sf_dir):
    """Products whose price must leave a band of a fifth to make history."""
    return P.dim_product(_conformed(spark, sf_dir, carried=PRODUCT)[4], one_per_day=True, tolerance={"unit_price_usd": 0.2})


def q_check_suite(spark, sf_dir):
    """Every declared check of every table, 30 hours after the last load."""
    t, st, countries, fx, conf = _conformed(spark, sf_dir, persist=True, persist_staged=True,
                                            carried=["category", "segment", "order_channel", "_load_id"])
    ld = T.loads(t)
    as_of = ld.agg(F.max("inserted_at") + F.expr("INTERVAL 8 HOURS")).scalar()
    return D.all_tables(st, fx, countries, ld, conf, as_of)


def q_check_suite_orders(spark, sf_dir):
    """A suite that finds something: customers with several orders, urgent
    orders, and statuses outside the list."""
    orders = _t(spark, sf_dir)["orders"]
    return run_checks(orders, [unique("o_custkey"), unique("o_orderkey"), not_null("o_orderdate"),
                               expect("urgent", F.col("o_orderpriority") == "1-URGENT"),
                               expect("open_status", ~F.col("o_orderstatus").isin("F", "O"))], "orders", "o_orderkey")


def q_landed_loads(spark, sf_dir):
    """Each export version landed as a load, the first one twice: half of it
    before a correction, which replaces it."""
    v1, v2 = (e.drop("_load_id", "_row_id") for e in T.sales_exports(_t(spark, sf_dir)))
    raw, log = work_dir(spark, "landed"), work_dir(spark, "load-log")
    first, second = (ingest_sales([e], SALES_RENAMES, SALES_COLUMNS) for e in (v1, v2))
    append_load(first.filter(F.length("order_id") % 2 == 0), raw, log, "v1", "2024-01-01 06:00:00")
    append_load(second, raw, log, "v2", "2024-01-02 06:00:00")
    append_load(first, raw, log, "v1", "2024-01-03 06:00:00")
    return read_loads(spark, raw, log).drop("_load_id", "_row_id")


def q_column_summary(spark, sf_dir):
    """Types, nulls, distinct values and quartiles of the order lines, exact."""
    lines = _t(spark, sf_dir)["lineitem"].select("l_quantity", "l_extendedprice", "l_discount", "l_partkey",
                                                 "l_returnflag", "l_linenumber")
    return PR.column_summary(lines, exact=True)


def q_scd2_spliced(spark, sf_dir):
    """What each user did last, two sevenths of the events coming late in two
    batches: as if all had been there at once."""
    events = _t(spark, sf_dir)["events"].select("user_id", "event_type", "ts", "event_id")
    late = F.col("event_id") % 7
    options = ("user_id", ["event_type"], "ts", "event_id", "version_id")
    history = events.filter(~late.isin(3, 5))
    dim = materialise(scd2_from_events(history, *options), "versions")
    for k in (3, 5):
        batch = events.filter(late == k)
        dim = materialise(splice_events(dim, history, batch, *options), "versions")
        history = history.unionByName(batch)
    return dim.select("user_id", "event_type", "valid_from", "valid_to")


def q_nested_charges(spark, sf_dir):
    """Orders as nested JSON, three levels deep, read under their schema and
    taken apart: the charges of the lines of each order."""
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax")
    charges = F.array(*[F.struct(F.lit(k).alias("kind"), F.col("_l")[f"l_{k}"].alias("rate")) for k in ("discount", "tax")])
    lines = _t(spark, sf_dir)["lineitem"].select("l_orderkey", line.alias("_l")).select(
        "l_orderkey", "_l", F.struct(F.col("_l"), F.struct(F.col("_l.l_partkey").alias("id")).alias("part"),
                                     charges.alias("charges")).alias("_line"))
    records = lines.groupBy(F.col("l_orderkey").alias("order_id")).agg(F.sort_array(F.collect_list("_line")).alias("lines"))
    records = records.withColumn("lines", F.transform("lines", lambda x: F.struct(x["part"].alias("part"),
                                                                                 x["charges"].alias("charges"))))
    path = work_dir(spark, "nested-orders")
    records.write.json(path)
    tables = normalise_nested(spark.read.schema(records.schema).json(path), "orders", ["order_id"])
    return tables["orders__lines__charges"]


def q_multiline_exports(spark, sf_dir):
    """Orders exported as quoted text whose notes hold line breaks, blank
    lines and quotes, read back as text."""
    o = _t(spark, sf_dir)["orders"]
    key = F.col("o_orderkey")
    note = (F.when(key % 3 == 0, F.concat("o_orderpriority", F.lit("\n\nsaid \"soon\", then\nleft ")))
            .when(key % 3 == 1, F.concat(F.lit("a, b\n"), "o_orderstatus")).otherwise(F.col("o_orderpriority")))
    path = work_dir(spark, "notes")
    o.select(key.alias("Order ID"), note.alias("Note"), F.col("o_custkey").alias("Customer ID")).write.option(
        "header", True).option("quoteAll", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return normalize_columns(read_text_table(spark, path, quoted_breaks=True))


def q_fx_landed(spark, sf_dir):
    """Quotes of every day as landed responses, the half of them first and then
    all in its place, read as a table by name."""
    days = materialise(fill_calendar(T.fx_quotes(_t(spark, sf_dir))), "days")
    path, raw = work_dir(spark, "fx-table"), work_dir(spark, "fx-responses")
    days.select(F.col("actual_date").alias("date"), "base", F.col("currency").alias("quote"), "rate",
                F.col("rate_date").alias("requested")).write.json(raw)
    landed = read_fx(raw)
    replace_table(landed.filter(F.day("rate_date") <= 15), path)
    replace_table(landed, path)
    name = f"fx_landed_{path.rsplit('-', 1)[-1]}"
    materialize(scan(spark, path), name, "table", work_dir(spark, "fx-copy"))
    return scan(spark, name)


def q_ingest_damaged(spark, sf_dir):
    """Exports in which names are read in the wrong code page and order ids
    are missing: names are mended, lines without an id dropped."""
    def damage(export, headers):
        order, name, product = (F.col(f"`{headers[k]}`") for k in ("order_id", "customer_name", "product_name"))
        mark = F.when(F.length(product) % 2 == 0, F.lit(" \u00c3\u00a9")).otherwise(F.lit(" \u00e9"))
        return export.drop("_load_id", "_row_id").withColumns({
            headers["customer_name"]: F.concat(name, mark), headers["order_id"]: F.when(F.length(order) % 3 != 0, order)})

    v1, v2 = T.sales_exports(_t(spark, sf_dir))
    return ingest_sales([damage(v1, T.V1_HEADERS), damage(v2, T.V2_HEADERS)], SALES_RENAMES, SALES_COLUMNS)


def q_drift_landed(spark, sf_dir):
    """Orders landed in loads of different schemas: a wider key and a nested
    field pass the gate, a date as text does not."""
    o = _t(spark, sf_dir)["orders"].select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    word = F.split("o_orderpriority", "-", 2)
    narrow = o.filter(F.col("o_orderkey") % 2 == 0).withColumn("o_custkey", F.col("o_custkey").cast("int"))
    wide = o.filter(F.col("o_orderkey") % 2 == 1).withColumn(
        "priority", F.struct(word[0].cast("int").alias("level"), word[1].alias("name")))
    raw, log, drift = (work_dir(spark, n) for n in ("drift-landed", "drift-loads", "drift-log"))
    DR.land(narrow.drop("o_orderpriority"), raw, log, drift, "narrow", "2024-01-01 06:00:00")
    DR.land(wide.drop("o_orderpriority"), raw, log, drift, "wide", "2024-01-02 06:00:00")
    try:
        DR.land(o.withColumn("o_orderdate", F.col("o_orderdate").cast("string")), raw, log, drift, "text",
                "2024-01-03 06:00:00")
    except DR.IncompatibleSchema:
        pass
    return DR.read_landed(spark, raw, log, drift).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", F.col("priority.level").alias("level"),
        F.col("priority.name").alias("name"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_sales": q_raw_sales,
    "conform_schema": q_conform_schema,
    "stage_sales": q_stage_sales,
    "quarantine_summary": q_quarantine_summary,
    "dedupe_latest": q_dedupe_latest,
    "stage_countries": q_stage_countries,
    "fx_calendar_fill": q_fx_calendar_fill,
    "stage_fx": q_stage_fx,
    "convert_usd": q_convert_usd,
    "scd2_customer": q_scd2_customer,
    "scd2_product": q_scd2_product,
    "point_in_time_fact": q_point_in_time_fact,
    "calendar": q_calendar,
    "revenue_rollup": q_revenue_rollup,
    "unknown_revenue": q_unknown_revenue,
    "chk_accepted_segment": q_chk_accepted_segment,
    "chk_unmapped_country": q_chk_unmapped_country,
    "chk_ship_before_order": q_chk_ship_before_order,
    "chk_converted_null": q_chk_converted_null,
    "chk_not_null_rate": q_chk_not_null_rate,
    "chk_unique_common_name": q_chk_unique_common_name,
    "chk_freshness": q_chk_freshness,
    "parse_money": q_parse_money,
    "table_profile": q_table_profile,
    "column_profile": q_column_profile,
    "numeric_describe": q_numeric_describe,
    "distinct_values": q_distinct_values,
    "first_last": q_first_last,
    "incremental_upsert": q_incremental_upsert,
    "scd2_snapshot": q_scd2_snapshot,
    "ingest_sales": q_ingest_sales,
    "split_clean": q_split_clean,
    "drop_exact": q_drop_exact,
    "fx_merge": q_fx_merge,
    "scd2_events": q_scd2_events,
    "chk_accepted_status": q_chk_accepted_status,
    "chk_unique_customer": q_chk_unique_customer,
    "chk_ordered_after_shipping": q_chk_ordered_after_shipping,
    "chk_undivided_price": q_chk_undivided_price,
    "column_summary": q_column_summary,
    "landed_loads": q_landed_loads,
    "check_suite": q_check_suite,
    "check_suite_orders": q_check_suite_orders,
    "scd2_daily": q_scd2_daily,
    "scd2_price_band": q_scd2_price_band,
    "asof_fx": q_asof_fx,
    "asof_events": q_asof_events,
    "incremental_write": q_incremental_write,
    "incremental_moves": q_incremental_moves,
    "scd2_spliced": q_scd2_spliced,
    "nested_charges": q_nested_charges,
    "drift_landed": q_drift_landed,
    "multiline_exports": q_multiline_exports,
    "fx_landed": q_fx_landed,
    "ingest_damaged": q_ingest_damaged,
}


def _llm() -> tuple[dict, dict]:
    """Queries and oracle SQL of the training-data subpackage, if it and the
    pipeline are there; an error inside them is not hidden."""
    for name in ("starflow.llm", "starflow.llm.queries", "corpus_pipeline"):
        if importlib.util.find_spec(name) is None:
            return {}, {}
    import corpus_pipeline as CP
    from starflow.llm import queries as L
    sql = dict(L.ORACLE_SQL)
    if CP.ORACLE_SQL is not None:
        sql["pipeline"] = CP.ORACLE_SQL
    return {**L.QUERIES, "pipeline": CP.run}, sql


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the whole star on sf0.001, reported as USD revenue by
    month, region and category with rollup subtotals."""
    return q_revenue_rollup(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_llm()[0]}


def oracle_sql() -> dict[str, str]:
    import oracle_sql as O
    sql = O.queries()
    sql["conform_schema"] = sql["raw_sales"]
    return {**{k: v for k, v in sql.items() if k in _QUERIES}, **_llm()[1]}
