"""Sources and sinks: banner-skipping text reads, header normalisation,
nested JSON + unnest, schema diff, lineage, read_since and upsert."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from starflow.sources import readers as R
from starflow.sources.contracts import SALES_COLUMNS, SALES_RENAMES
from starflow.plans import testbed as T


def test_read_text_table_skips_banner(spark):
    d = tempfile.mkdtemp(prefix="sf-src1-")
    for i, rows in enumerate([[("1", "a"), ("2", "b")], [("3", "c")]]):
        with open(os.path.join(d, f"export{i}.csv"), "w") as fh:
            fh.write("Sales export\nGenerated 2024-01-01\n\n")
            fh.write("Order ID , Total Amount\n")
            for r in rows:
                fh.write(",".join(r) + "\n")
    df = R.normalize_columns(R.read_text_table(spark, d, skip_rows=3))
    assert df.columns == ["order_id", "total_amount"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", "a"), ("2", "b"), ("3", "c")]
    conformed = R.conform_schema(df, SALES_RENAMES, SALES_COLUMNS)
    assert conformed.columns == SALES_COLUMNS
    assert conformed.filter(F.col("amount").isNotNull()).count() == 3


def test_headers_per_file(spark, tmp_path):
    """Two versions of an export: each file is read under its own header."""
    (tmp_path / "a.csv").write_text("Order ID,Segment,Amount\n1,corp,10\n")
    (tmp_path / "b.csv").write_text("Order ID,Total Amount ,Tax\n2,20,5%\n,30,1%\n")
    exports = R.read_text_tables(spark, str(tmp_path))
    landed = R.ingest_sales(exports, SALES_RENAMES, SALES_COLUMNS)
    got = {(r.order_id, r.segment, r.amount, r.tax) for r in landed.collect()}
    assert got == {("1", "corp", "10", None), ("2", None, "20", "5%")}


def test_unnest_of_equal_records(spark):
    df = spark.createDataFrame([("x", [{"code": "A"}]), ("x", [{"code": "A"}])],
                               "name string, currencies array<struct<code:string>>")
    parent, child = R.unnest(df, "currencies")
    ids = [r["_row_id"] for r in parent.collect()]
    assert len(set(ids)) == 2 and sorted(r["_parent_id"] for r in child.collect()) == sorted(ids)


def test_exports_union_equals_single_pass(spark):
    t = T.load_tables(spark, "/root/testdata/sf0.001")
    a = T.raw_sales(t)
    b = T.raw_sales_from_exports(t)
    assert a.count() == b.count() == t["lineitem"].count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_read_nested_and_unnest(spark):
    d = tempfile.mkdtemp(prefix="sf-src11-")
    page = {"data": {"objects": [
        {"names": {"common": "Canada", "official": "Canada"}, "codes": {"alpha_2": "CA", "alpha_3": "CAN", "ccn3": "124"},
         "region": "Americas", "subregion": "North America", "population": 1,
         "currencies": [{"code": "CAD", "name": "Canadian dollar", "symbol": "$"}]},
        {"names": {"common": "Zimbabwe", "official": "Republic of Zimbabwe"},
         "codes": {"alpha_2": "ZW", "alpha_3": "ZWE", "ccn3": "716"}, "region": "Africa", "subregion": None,
         "population": 2, "currencies": [{"code": "ZWL", "name": "dollar", "symbol": None},
                                         {"code": "USD", "name": "US dollar", "symbol": "$"}]}],
        "meta": {"total": 2}}}
    with open(os.path.join(d, "page0.json"), "w") as fh:
        json.dump(page, fh)
    records = R.read_nested(spark, d)
    parent, child = R.unnest(records, "currencies")
    assert {"names__common", "codes__alpha_2", "region", "_row_id"} <= set(parent.columns)
    assert parent.count() == 2 and child.count() == 3
    from starflow.operators.fx import stage_countries
    st = {r["common_name"]: r for r in stage_countries(parent, child).collect()}
    assert st["Zimbabwe"]["currency_codes"] == ["ZWL", "USD"]
    assert st["Zimbabwe"]["currency_symbols"] == [None, "$"]   # NULLs kept, lists aligned
    assert st["Canada"]["is_quarantined"] is False


def test_schema_diff(spark):
    t = T.load_tables(spark, "/root/testdata/sf0.001")
    v1, v2 = T.sales_exports(t)
    diff = {(c, ch) for c, ch, _, _ in R.schema_diff(v1.schema, v2.schema)}
    assert ("Segment", "removed") in diff and ("Amount", "removed") in diff
    assert ("Total Amount ", "added") in diff and ("Order Channel", "added") in diff


def test_append_load_and_lineage(spark):
    d = tempfile.mkdtemp(prefix="sf-src6-")
    df = spark.createDataFrame([("1", "x"), ("1", "x")], "order_id string, note string")
    R.append_load(df, f"{d}/raw", f"{d}/loads", "L1", "2024-01-02 06:00:00")
    R.append_load(df, f"{d}/raw", f"{d}/loads", "L2", "2024-01-03 06:00:00")
    raw = spark.read.parquet(f"{d}/raw")
    assert raw.count() == 4 and raw.select("_row_id").distinct().count() == 4
    assert spark.read.parquet(f"{d}/loads").count() == 2


def test_read_since_and_upsert(spark):
    target = spark.createDataFrame([("2024-01-01", "EUR", 1.0), ("2024-01-02", "EUR", 1.1)],
                                   "rate_date string, currency string, rate double") \
        .withColumn("rate_date", F.col("rate_date").cast("date"))
    fresh = spark.createDataFrame([("2024-01-01", "EUR", 9.0), ("2024-01-02", "EUR", 1.2), ("2024-01-03", "EUR", 1.3)],
                                  "rate_date string, currency string, rate double") \
        .withColumn("rate_date", F.col("rate_date").cast("date"))
    batch = R.read_since(fresh, "rate_date", target, "2024-01-01")
    assert batch.count() == 2  # inclusive of the last seen day
    merged = R.upsert(target, batch, ["rate_date", "currency"])
    got = {str(r["rate_date"]): r["rate"] for r in merged.collect()}
    assert got == {"2024-01-01": 1.0, "2024-01-02": 1.2, "2024-01-03": 1.3}
    again = R.upsert(merged, batch, ["rate_date", "currency"])   # idempotent
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))
    assert R.read_since(fresh, "rate_date", None, "2024-01-02").count() == 2


def test_a_load_counts_once_it_is_in_the_log(spark, tmp_path):
    """A crash between files and log, a load landed again, a new column."""
    raw, log = f"{tmp_path}/raw", f"{tmp_path}/loads"
    one = spark.createDataFrame([("1", "x"), ("2", "y")], "order_id string, note string")
    R.append_load(one, raw, log, "2024/01", "2024-01-02 06:00:00")
    # Files of an attempt that never reached the log.
    R.with_lineage(one, "2024/02").write.parquet(R._load_folder(raw, "2024/02", "dead"))
    R.with_lineage(one, "2024/01").write.parquet(R._load_folder(raw, "2024/01", "dead"))
    assert sorted((r.order_id, r._load_id) for r in R.read_loads(spark, raw, log).collect()) == [
        ("1", "2024/01"), ("2", "2024/01")]
    # The same load again, corrected: its own rows are replaced.
    R.append_load(one.filter("order_id = '2'"), raw, log, "2024/01", "2024-01-02 07:00:00")
    R.append_load(one.withColumn("tax", R.F.lit("5%")).limit(1), raw, log, "2024/02", "2024-02-02 06:00:00")
    got = R.read_loads(spark, raw, log)
    assert sorted((r.order_id, r._load_id, r.tax) for r in got.collect()) == [
        ("1", "2024/02", "5%"), ("2", "2024/01", None)]
    assert R.read_loads(spark, raw, log, ["2024/01"]).count() == 1
    assert sorted((r.load_id, str(r.inserted_at)) for r in R.load_log(spark, log).collect()) == [
        ("2024/01", "2024-01-02 07:00:00"), ("2024/02", "2024-02-02 06:00:00")]
