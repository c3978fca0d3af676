"""Staging at scale: rendering per customer, part and order, the fill without
a split of ordinary keys, written tables without columns nobody asked for."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from starflow.functions import clean as C
from starflow.operators import ordered as O
from starflow.plans import pipeline as P
from starflow.plans import testbed as T
from starflow.session import materialise


def _same(df, a, b):
    return df.filter(~a.eqNullSafe(b)).count() == 0


def test_whole_numbers_as_round(spark):
    rng = random.Random(1)
    x = [0.0, -0.0, 0.5, 1.5, -0.5, -2.5, 0.49999999999999994, 1e15 + 0.5, 4503599627370497.0, 0.29 * 100, None]
    x += [rng.randint(-10**7, 10**7) / 100 * 100 for _ in range(300)] + [rng.randint(-99, 99) + 0.5 for _ in range(50)]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    assert _same(df, T._whole(F.col("x")), F.round("x").cast("bigint"))


def test_date_texts_as_date_format(spark):
    days = [(datetime.date(1, 1, 1) + datetime.timedelta(days=k * 911),) for k in range(4000)] + [(None,)]
    df = spark.createDataFrame(days, "d date").unionByName(spark.sql("SELECT date_add(date'9999-12-30', 3) AS d"))
    for pattern in ("yyyy-MM-dd", "MM/dd/yyyy", "yyyy/MM/dd", "yyyyMM", "M/d/yyyy"):
        assert _same(df, T._date_text(F.col("d"), T._digits(F.col("d")), pattern), F.date_format("d", pattern))


def test_texts_of_an_order_are_rendered_below_the_lines(spark):
    """Customer and product texts are made before the lines are joined, and no
    exchange of lines follows the deal to the tasks that render them."""
    t = T.Tables(spark, "")
    t |= {
        "lineitem": spark.createDataFrame(
            [(1, 7, 3, 1, 2.0, 10.5, 0.1, 0.05, "R", "F", datetime.datetime(2020, 2, 3)),
             (97, 13, 4, 2, 3.0, 10.5, None, 0.05, "N", "O", datetime.datetime(2020, 12, 31)),
             (5, None, None, 3, 1.0, 1.0, 0.0, 0.0, "N", "O", None)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "orders": spark.createDataFrame([(1, 4, datetime.datetime(2020, 1, 2), "2-HIGH")],
                                        "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string"),
        "customer": spark.createDataFrame([(4, "Cu#4", 1, "BUILDING")],
                                          "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "part": spark.createDataFrame([(7, "red ring", "LARGE")], "p_partkey long, p_name string, p_type string"),
        "supplier": spark.createDataFrame([(3, "S3")], "s_suppkey long, s_name string"),
        "nation": spark.createDataFrame([(1, "GERMANY")], "n_nationkey int, n_name string"),
    }
    assert {"customer_name", "country", "segment", "order_date"} <= set(T._order_texts(t).columns)
    rows = {r["order_id"].strip(" #."): r.asDict() for r in T.raw_sales(t).collect()}
    one = rows["1"]
    assert (one["order_date"], one["ship_date"], one["customer_name"], one["product_name"]) == (
        "01/02/2020", "2/3/2020", " CU#4  ", "RED RING")
    assert (one["country"], one["segment"], one["currency"], one["_load_id"]) == ("DE", "Corp.", "EUR", "202002")
    # No order, part or supplier: the line stays, with what its own keys say.
    assert rows["97"]["order_date"] == "n/a" and rows["97"]["product_id"] == "#13"
    assert rows["97"]["customer_name"] is None and rows["5"]["_load_id"] is None and rows["5"]["_row_id"]


def test_date_forms_told_by_their_separator(spark):
    given = {"2024-1-2 10:00:00": "2024-01-02", "2024/1/2": "2024-01-02", "2024/02/30": None, "12/3/2024": "2024-12-03",
             "13/1/2024": None, "2 MAR 2024": "2024-03-02", "2 March 2024": None, "1 anf 2024": None, "31 Sep 2024": None,
             "45322.0": "2024-01-31", "-5": "1899-12-25", "1/2/2024\n": None, "1-2-2024": None, "n/a": None, "": None}
    df = spark.createDataFrame(list(given), "string").select("value", C.parse_date("value").cast("string").alias("d"))
    assert {r["value"]: r["d"] for r in df.collect()} == given
    # Only the form's own parser is asked: none of them walks a pattern.
    assert "gettimestamp" not in df._jdf.queryExecution().optimizedPlan().toString().lower()


@pytest.mark.parametrize("hot_rows", [0, 3, 500_000])
def test_fill_is_the_same_whichever_keys_are_hot(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(O, "HOT_ROWS", hot_rows)
    rng = random.Random(5)
    rows = [(rng.choice(["a", "a", "a", "b", None]), datetime.date(2024, 1, rng.randint(1, 4)) if rng.random() < .9 else None,
             f"{i:04d}", rng.choice([None, None, f"{i}"])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, d date, r string, v string")
    expected, last = {}, {}
    for k, d, r, v in sorted(rows, key=lambda x: (x[1] is None, x[1] or datetime.date.min, x[2])):
        last[k] = v or last.get(k)
        expected[r] = last[k]
    got = O.forward_fill(df, "v", ["k"], "d", "r", out_col="f")
    assert {x["r"]: x["f"] for x in got.collect()} == expected


def test_staging_writes_what_is_asked_for(spark):
    raw = spark.createDataFrame(
        [{**{c: None for c in T.SALES_COLUMNS}, "order_id": "#1", "product_id": "7", "unit_price": "1.50", "quantity": "2",
          "order_date": "2024-01-02", "segment": "Corp.", "_load_id": "202401", "_row_id": "x"}],
        ", ".join(f"{c} string" for c in [*T.SALES_COLUMNS, "_load_id", "_row_id"]))
    whole = P.stage_sales(raw, persist_mode="table")
    some = P.stage_sales(raw, persist_mode="table", carried=["segment"])
    assert whole.columns == P.STAGED_COLUMNS
    assert [c for c in P.STAGED_COLUMNS if c not in some.columns] == [
        c for c in P.STAGED_COLUMNS if c in P.CARRIED_COLUMNS and c != "segment"]
    assert some.collect() == whole.select(*some.columns).collect()


def test_written_tables_have_no_dictionary_of_row_ids(spark):
    import pyarrow.parquet as pq

    df = materialise(spark.range(50).select(F.md5(F.col("id").cast("string")).alias("_row_id"), F.lit("a").alias("k")), "ids")
    group = pq.ParquetFile(df.inputFiles()[0].removeprefix("file://")).metadata.row_group(0)
    encodings = {group.column(i).path_in_schema: group.column(i).encodings for i in range(2)}
    assert not any("DICTIONARY" in e for e in encodings["_row_id"])
    assert any("DICTIONARY" in e for e in encodings["k"])


_ODD = ["17", "#17", " 17 ", "17.", "ORD-17", "", " ", "-", "é-7", "a\U0001f600b", "a\nb", " x  ", "�", "A  b", "  a   b  ",
        "\ta \t b", " \ta", "a\x0bb", "Corp.", "Home-Office", "x \n", "x\n", "$1,234.50", "1.234,50", "EUR 1234.50", "€ 1.234,5", "!1.234,5!0",
        "eur 12,5", "-12.50", "(12)", "USD", "1e3", "1.", ".5", "12.0", " -12.0 ", "-0.0", "12.6", "12.5", "-12.5", "007", "+7", "1234567",
        "-999999", "999999.0", "12.00", "12 .0", "45322.0", "-5", "4.5e4", "2147483648", "\t7", "7\n", "٣", None]


def test_patterns_are_searched_only_where_a_text_needs_it(spark):
    df = spark.createDataFrame([(x,) for x in _ODD], "c string")
    c = F.col("c")
    number = F.regexp_replace(c, r"[^0-9.,]+", "")
    pc, pd = F.locate(",", number), F.locate(".", number)
    decimal = (F.when((pc > pd) & (pc > 0) & (pd > 0), F.translate(F.regexp_replace(c, r"[^0-9.,!]+", ""), ",.!", ".,."))
               .when((pc > 0) & (pd == 0) & (F.length(number) - pc <= 2), F.replace(number, F.lit(","), F.lit(".")))
               .when((pd > 0) & (pc == 0) & (F.length(number) - pd > 2), F.replace(number, F.lit("."), F.lit(",")))
               .otherwise(number))
    whole = F.round(C.guarded_cast(c, "decimal(20,6)"), 0)
    s = F.trim(c)
    days = F.round(F.when(s.rlike(r"^-?\d+(\.\d+)?$"), s.try_cast("decimal(20,6)")), 0)
    serial = F.when(days.between(-693593, 2958465), F.date_add(F.lit("1899-12-30").cast("date"), days.try_cast("int")))
    pairs = {
        "id": (C.clean_id_text(c), F.regexp_replace(c, r"[^A-Za-z0-9]+", "")),
        "text": (C.clean_text(c), F.coalesce(F.lower(F.trim(F.regexp_replace(c, r"[^a-zA-Z ]+", ""))), F.lit("unknown"))),
        "name": (C.clean_name(c), F.coalesce(F.lower(F.trim(F.regexp_replace(c, r"\s+", " "))), F.lit("unknown"))),
        "decimal": (C.normalize_decimal(c), decimal),
        "int": (C.parse_int(c), F.when(whole.between(-2147483648, 2147483647), whole).try_cast("int")),
        "date": (C.parse_date(c).cast("string"), serial.cast("string")),
    }
    for name, (got, expected) in pairs.items():
        rows = df.select("c", got.alias("got"), expected.alias("expected")).collect()
        assert [(r["c"], r["got"]) for r in rows] == [(r["c"], r["expected"]) for r in rows], name
    for fn in (C.clean_id_text, C.clean_text, C.clean_name):
        plan = df.select(fn("c"))._jdf.queryExecution().optimizedPlan().toString().lower()
        assert 0 < plan.find("rlike") < plan.find("regexp_replace")


def test_parsed_ids_are_written_as_numbers(spark, monkeypatch):
    written = []
    monkeypatch.setattr(P, "persist", lambda df, mode: written.append(df) or df)
    raw = spark.createDataFrame([{**{c: None for c in T.SALES_COLUMNS}, "order_id": "#1", "customer_id": "C 7", "product_id": "A7",
                                  "_load_id": "202401", "_row_id": "x"}],
                                ", ".join(f"{c} string" for c in [*T.SALES_COLUMNS, "_load_id", "_row_id"]))
    row = P.stage_sales(raw).collect()[0]
    types = dict(written[0].dtypes)
    # The fill is by the text of a product: two that are no numbers are two.
    assert (types["order_id"], types["customer_id"], types["product_id_t"]) == ("bigint", "bigint", "string")
    assert (row["order_id"], row["customer_id"], row["product_id"]) == (1, None, None)


@pytest.fixture()
def small_tables(spark, tmp_path):
    when = datetime.datetime
    frames = {
        "lineitem": spark.createDataFrame(
            [(k, p, 3, ln, q, 10.5, 0.1, 0.05, "N", "F", when(2020, 2, 3 + ln))
             for k, p, ln, q in [(1, 7, 1, 2.0), (2, 7, 1, 2.0), (4, 9, 2, 3.0), (7, 7, 1, 2.0), (97, 9, 2, 1.0)]],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "orders": spark.createDataFrame(
            [(1, 4, when(2020, 1, 2), "2-HIGH"), (2, 4, when(2020, 1, 5), "2-HIGH"), (4, 4, when(2020, 1, 9), "5-LOW"),
             (7, 4, when(2020, 1, 11), "5-LOW"), (97, 4, when(2019, 1, 1), "5-LOW"), (99, 4, when(2020, 12, 1), "5-LOW")],
            "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string"),
        "customer": spark.createDataFrame([(4, "Cu#4", 1, "BUILDING")],
                                          "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "part": spark.createDataFrame([(7, "red ring", "LARGE"), (9, "cap", "PROMO")], "p_partkey long, p_name string, p_type string"),
        "supplier": spark.createDataFrame([(3, "S3")], "s_suppkey long, s_name string"),
        "nation": spark.createDataFrame([(1, "GERMANY", 3)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": spark.createDataFrame([(3, "EUROPE")], "r_regionkey int, r_name string"),
    }
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture()
def written(monkeypatch):
    """The columns of each table that a query writes on its way."""
    out, write = [], P.persist
    monkeypatch.setattr(P, "persist", lambda df, mode: (out.append(df.columns), write(df, mode))[1])
    return out


def test_calendar_writes_the_parsed_rows_only(spark, small_tables, written):
    import __spark_entry__ as E

    days = [r["date_key"] for r in E.q_calendar(spark, small_tables).orderBy("date_key").collect()]
    assert days[0] == datetime.date(2020, 1, 2)
    # The last order date is that of all staged rows, and of no order without lines.
    assert days[-1] == datetime.date(2020 + P.calendar_dim.__defaults__[0], 1, 11)
    assert len(written) == 1


def test_product_history_writes_what_it_reads(spark, small_tables, written):
    import __spark_entry__ as E

    others = {"customer_name", "segment", "order_channel", "discount", "tax"}
    for query in (E.q_scd2_product, E.q_scd2_daily):
        written.clear()
        rows = query(spark, small_tables).collect()
        assert {(r["product_id"], r["product_name"]) for r in rows} == {(-1, "unknown"), (7, "red ring"), (9, "cap")}
        assert len(written) == 1 and not others & set(written[0])


def test_check_suite_writes_what_it_reads(spark, small_tables, written):
    import __spark_entry__ as E

    suite = {r["check_name"]: r for r in E.q_check_suite(spark, small_tables).collect()}
    assert {"accepted_segment", "accepted_category", "accepted_order_channel", "converted_but_null"} <= set(suite)
    assert not any({"customer_name", "product_name", "discount", "tax"} & set(columns) for columns in written)
