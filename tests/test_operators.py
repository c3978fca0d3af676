"""Operator scenarios from FIXTURES.md §3 and plan-shape checks."""

import datetime as dt
import os
import random
import tempfile

from pyspark.sql import functions as F

from starflow.operators.ordered import dedupe_latest, forward_fill
from starflow.operators.scd import scd2_from_events, scd2_snapshot
from starflow.operators.facts import point_in_time_join


def d(n):
    return dt.date(2024, 1, n)


def test_forward_fill_scenario(spark):
    rows = [("a", d(1), "r1", "10"), ("a", d(2), "r2", None), ("a", d(3), "r3", None), ("a", d(4), "r4", "12"),
            ("b", d(1), "r5", None), ("b", None, "r6", None), (None, d(2), "r7", "5"), (None, d(3), "r8", None)]
    df = spark.createDataFrame(rows, "k string, od date, rid string, v string")
    got = {r["rid"]: r["v"] for r in forward_fill(df, "v", ["k"], "od", "rid").collect()}
    assert got == {"r1": "10", "r2": "10", "r3": "10", "r4": "12", "r5": None, "r6": None, "r7": "5", "r8": "5"}


def test_forward_fill_matches_plain_window(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        k = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 30)}"
        day = None if rnd.random() < 0.05 else d(1) + dt.timedelta(days=rnd.randint(0, 40))
        v = None if rnd.random() < 0.6 else str(rnd.randint(0, 99))
        rows.append((k, day, f"r{i:05d}", v))
    df = spark.createDataFrame(rows, "k string, od date, rid string, v string")
    got = {r["rid"]: r["v"] for r in forward_fill(df, "v", ["k"], "od", "rid").collect()}
    want, last = {}, {}
    for k, day, rid, v in sorted(rows, key=lambda r: (r[0], r[1] is None, r[1] or d(1), r[2])):
        if v is not None:
            last[k] = v
        want[rid] = last.get(k)
    assert got == want


def test_scd2_scenario(spark):
    rows = [(7, "A", d(1), "r1"), (7, "A", d(2), "r2"), (7, "B", d(3), "r3"), (7, "A", d(4), "r4")]
    df = spark.createDataFrame(rows, "cid int, seg string, od date, rid string")
    out = scd2_from_events(df, "cid", ["seg"], "od", "rid", "sk").orderBy("valid_from").collect()
    assert [(r["seg"], r["valid_from"], r["valid_to"], r["is_current"]) for r in out] == \
        [("A", d(1), d(3), False), ("B", d(3), d(4), False), ("A", d(4), None, True)]
    assert out[0]["sk"] == "7-2024-01-01"


def test_point_in_time(spark):
    dim = spark.createDataFrame([(7, d(1), d(3), "v1"), (7, d(3), d(9), "v2"), (7, d(9), None, "v3")],
                                "cid int, valid_from date, valid_to date, sk string")
    facts = spark.createDataFrame([(7, d(2)), (7, d(3)), (7, d(9)), (8, d(2))], "cid int, od date")
    out = point_in_time_join(facts, dim, "cid", "cid", "od", ["sk"], "_d_")
    got = sorted((r["cid"], r["od"], r["_d_sk"]) for r in out.collect())
    assert got == [(7, d(2), "v1"), (7, d(3), "v2"), (7, d(9), "v3"), (8, d(2), None)]


def test_snapshot_scenario(spark):
    s0 = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, x string")
    snap = scd2_snapshot(None, s0, "id", ["x"], "2024-01-01 00:00:00")
    cur = spark.createDataFrame([(1, "A"), (3, "c"), (4, "d")], "id int, x string")   # 1 changed, 4 new, 3 same, 2 missing
    out = scd2_snapshot(snap, cur, "id", ["x"], "2024-01-02 00:00:00").collect()
    by = sorted((r["id"], r["x"], str(r["valid_from"])[:10], str(r["valid_to"])[:10] if r["valid_to"] else None) for r in out)
    assert by == [(1, "A", "2024-01-02", None), (1, "a", "2024-01-01", "2024-01-02"), (2, "b", "2024-01-01", None),
                  (3, "c", "2024-01-01", None), (4, "d", "2024-01-02", None)]


def test_dedupe_plans_partial_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("ts"))
    out = dedupe_latest(df, ["k"], ["ts"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted(r["ts"] for r in out.collect()) == list(range(993, 1000))


def test_stream_merges_latest_correction(spark):
    from starflow.plans import testbed as T
    from starflow.streaming import raw_stream as S
    base = tempfile.mkdtemp(prefix="sf-stream-")
    land, target = os.path.join(base, "landing"), os.path.join(base, "target")
    raw = T.raw_sales(T.load_tables(spark, "/root/testdata/sf0.001")).limit(200)
    raw.write.mode("append").parquet(land)
    q = S.start(spark, land, target, "t_stream", trigger_once=True)
    q.awaitTermination()
    first = S.read_target(spark, target).count()
    assert first > 0
    # a correction of every clean line lands later with a newer load id
    corr = raw.withColumn("_load_id", F.lit("999999")).withColumn("_row_id", F.concat(F.lit("c-"), "_row_id"))
    corr.write.mode("append").parquet(land)
    q = S.start(spark, land, target, "t_stream", trigger_once=True)
    q.awaitTermination()
    out = S.read_target(spark, target)
    assert out.count() == first
    assert out.filter(F.col("_load_id") != "999999").count() == 0


def test_stream_late_load_and_known_price(spark, tmp_path):
    """An older load that arrives late does not replace a newer row, and a
    line without a price gets the one known from an earlier batch."""
    from starflow.streaming import raw_stream as S

    def land(*rows):
        base = {"customer_id": "7", "customer_name": "ann", "country": "US", "quantity": "1", "amount": "10",
                "category": "chairs", "product_name": "desk", "discount": "0%", "tax": "0%", "segment": "corporate",
                "order_channel": "web", "ship_date": "2024-02-01"}
        data = [tuple({**base, **r}.get(f.name) for f in S.RAW_SCHEMA) for r in rows]
        S.merge_batch(spark, spark.createDataFrame(data, S.RAW_SCHEMA), target)

    target = str(tmp_path / "target")
    line = {"order_id": "1", "product_id": "5", "order_date": "2024-01-05"}
    land({**line, "unit_price": "4.00", "_load_id": "202402", "_row_id": "b"})
    land({**line, "unit_price": "3.00", "_load_id": "202401", "_row_id": "a"},
         {**line, "order_id": "2", "order_date": "2024-01-09", "_load_id": "202402", "_row_id": "c"})
    got = {r.order_id: (r["_load_id"], str(r.unit_price)) for r in S.read_target(spark, target).collect()}
    assert got == {1: ("202402", "4.00"), 2: ("202402", "4.00")}
    assert len(S.versions(spark, target)) == 2


def test_next_start_of_timestamps_and_the_last_day(spark):
    from starflow.operators.ordered import with_next_start
    rows = [(1, "2024-01-01 09:00:00"), (1, "2024-01-01 15:00:00"), (1, "2024-01-03 10:00:00"),
            (1, "9999-12-31 00:00:00"), (1, None)]
    df = spark.createDataFrame([(k, s, i) for i, (k, s) in enumerate(rows)], "k int, s string, i int")
    for kind in ("timestamp", "date"):
        out = with_next_start(df.withColumn("start", F.col("s").cast(kind)), ["k"], "start", "i").orderBy("i")
        starts = [r.start for r in out.collect()]
        assert [r.valid_to for r in out.collect()] == [*starts[1:4], None, None]


def test_point_in_time_join_on_a_hot_key(spark):
    """A third of all lines on one key, versions of a day, and no range join."""
    from starflow.operators.facts import point_in_time_join
    dim = spark.createDataFrame(
        [(1, "2024-01-01", "2024-01-05", "a"), (1, "2024-01-05", "2024-01-05", "zero"), (1, "2024-01-05", None, "b"),
         (2, "2024-01-02", "2024-01-03", "c")], "k int, f string, t string, v string").select(
        "k", F.col("f").cast("date").alias("valid_from"), F.col("t").cast("date").alias("valid_to"), "v")
    facts = spark.range(9000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).cast("int").alias("key"),
        F.date_add(F.lit("2023-12-30").cast("date"), (F.col("id") % 10).cast("int")).alias("d"))
    out = point_in_time_join(facts, dim, "key", "k", "d", ["v"], "_x_")
    plan = out._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    versions = [(r.k, r.valid_from, r.valid_to, r.v) for r in dim.collect()]
    got = {r.id: r["_x_v"] for r in out.collect()}
    assert len(got) == 9000
    for r in facts.collect():
        want = [v for k, a, b, v in versions if k == r.key and a <= r.d and (b is None or r.d < b)]
        assert got[r.id] == (want[0] if want else None)


def test_forward_fill_leaves_rows_with_a_value_in_place(spark):
    rows = [("a", d(1), "r1", "10", "w"), ("a", d(1), "r1", "10", "w"), ("a", d(1), "r2", None, "x"),
            ("a", d(2), "r3", None, None), ("a", d(2), "r3", None, None), (None, None, "r4", None, "y")]
    df = spark.createDataFrame(rows, "k string, od date, rid string, v string, wide string")
    out = forward_fill(df, "v", ["k"], "od", "rid", out_col="f")
    assert out.columns == ["k", "od", "rid", "v", "wide", "f"]
    assert sorted((r.rid, r.wide or "", r.f or "") for r in out.collect()) == [
        ("r1", "w", "10"), ("r1", "w", "10"), ("r2", "x", "10"), ("r3", "", "10"), ("r3", "", "10"), ("r4", "y", "")]
    assert "Union" in out._jdf.queryExecution().optimizedPlan().toString()
    same = forward_fill(df, "v", ["k"], "od", "rid")
    assert same.columns == df.columns and same.count() == len(rows)


def test_more_lines_are_rendered_by_more_tasks(spark, monkeypatch):
    from starflow.plans import testbed as T
    monkeypatch.setattr(T, "LINES_PER_TASK", 3)
    t = T.Tables(spark, "/root/testdata/sf0.001")
    t["lineitem"] = t["lineitem"].limit(60)
    plan = T.sales_lines(t)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [l_orderkey" in plan and ", 20" in plan.split("RepartitionByExpression")[1].split("\n")[0]
