"""Check suites against counting row by row."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from starflow.operators import checks as K

SCHEMA = "id long, a string, b string, t timestamp"
NOW = datetime.datetime(2024, 5, 1, 12)


def all_kinds():
    return [K.not_null("a"), K.accepted("a", ["x", "y"]), K.unique("a"), K.unique("b"),
            K.expect("odd", F.col("id") % 2 == 1), K.fresh("t", 6, 12)]


def suite(spark, rows, checks=None, as_of=NOW):
    got = K.run_checks(spark.createDataFrame(rows, SCHEMA), checks or all_kinds(), "t1", "id", F.lit(as_of))
    assert got.columns == ["table_name", "check_name", "n_failing", "status", "first_example", "last_example"]
    return {r.check_name: tuple(r)[2:] for r in got.collect()}


def brute(rows):
    def of(hits, n=None):
        ids = [r[0] for r in hits if r[0] is not None]
        n = len(hits) if n is None else n
        return (n, "fail" if n else "pass", str(min(ids)) if ids else None, str(max(ids)) if ids else None)

    def repeated(i):
        values = [r[i] for r in rows if r[i] is not None]
        several = {v for v in values if values.count(v) > 1}
        return of([r for r in rows if r[i] in several], len(several))
    return {"not_null_a": of([r for r in rows if r[1] is None]),
            "accepted_a": of([r for r in rows if r[1] is not None and r[1] not in ("x", "y")]),
            "unique_a": repeated(1), "unique_b": repeated(2),
            "odd": of([r for r in rows if r[0] is not None and r[0] % 2])}


def test_matches_counting(spark):
    rng = random.Random(2)
    rows = [(None if rng.random() < .05 else i, "x" if rng.random() < .4 else rng.choice(["y", "z", None]),
             rng.choice([None, f"b{rng.randrange(400)}"]), NOW - datetime.timedelta(hours=7 + i)) for i in range(300)]
    got = suite(spark, rows)
    assert got.pop("fresh_t") == (1, "warn", None, "2024-05-01 05:00:00")
    assert got == brute(rows)


@pytest.mark.parametrize("hours, status", [(1, "pass"), (6, "pass"), (7, "warn"), (12, "warn"), (13, "error")])
def test_freshness(spark, hours, status):
    got = suite(spark, [(1, "x", None, NOW - datetime.timedelta(hours=hours))], [K.fresh("t", 6, 12)])
    assert got["fresh_t"][:2] == (0 if status == "pass" else 1, status)


def test_empty_tables_and_no_unique_checks(spark):
    got = suite(spark, [])
    assert got.pop("fresh_t") == (1, "error", None, None)
    assert set(got.values()) == {(0, "pass", None, None)} and len(got) == 5
    assert suite(spark, [(1, None, None, None)], [K.not_null("a")]) == {"not_null_a": (1, "fail", "1", "1")}
    with pytest.raises(ValueError):
        suite(spark, [], [K.expect(f"c{i}", F.lit(False)) for i in range(63)])
    many = suite(spark, [(1, None, None, None)], [K.expect(f"c{i}", F.col("id") == i) for i in range(62)])
    assert sum(v[0] for v in many.values()) == 1 and many["c1"][0] == 1


def test_one_scan(spark, tmp_path):
    """All kinds of checks read the table once and keep hash aggregates."""
    spark.createDataFrame([(1, "x", "b", NOW)], SCHEMA).write.parquet(f"{tmp_path}/t")
    df = K.run_checks(spark.read.parquet(f"{tmp_path}/t"), all_kinds(), "t1", "id", F.lit(NOW))
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1 and "SortAggregate" not in plan and "ReadSchema: struct<id" in plan
