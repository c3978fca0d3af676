"""Column summaries: exact ones against a sort, sketches within their error."""

import bisect
import random

import pytest

from starflow.operators.profile import column_summary

SCHEMA = "x double, `a.b` int, s string"


def test_sketches_keep_their_error(spark):
    rng = random.Random(6)
    # A third of all values is one; the rest has a long tail.
    rows = [(None if rng.random() < .05 else 7.0 if rng.random() < .33 else rng.lognormvariate(2, 2),
             rng.randrange(5000), rng.choice(["p", "q", None])) for _ in range(20000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    for error in (0.05, 0.01):
        got = {r["column"]: r for r in column_summary(df, error=error).collect()}
        assert [got[c].type for c in ("x", "a.b", "s")] == ["double", "int", "string"]
        for i, c in enumerate(("x", "a.b")):
            values = sorted(r[i] for r in rows if r[i] is not None)
            assert got[c].nulls == len(rows) - len(values) and got[c].n_rows == len(rows)
            assert (got[c].least, got[c].greatest) == (values[0], values[-1])
            assert abs(got[c].n_distinct - len(set(values))) <= 4 * error * len(set(values))
            for q, p in ((got[c].q25, .25), (got[c].median, .5), (got[c].q75, .75)):
                low, high = bisect.bisect_left(values, q), bisect.bisect_right(values, q)
                at = p * len(values)
                assert low - error * len(values) - 1 <= at <= high + error * len(values) + 1
        assert got["s"].n_distinct == 2 and got["s"].median is None


def test_one_pass_and_no_explode(spark):
    plan = column_summary(spark.range(10).selectExpr("id", "id % 3 AS m"))._jdf.queryExecution().sparkPlan().toString()
    assert "Expand" not in plan and plan.count("Range (") == 1


@pytest.mark.parametrize("exact", [False, True])
def test_empty_tables_and_chosen_columns(spark, exact):
    df = spark.createDataFrame([], SCHEMA)
    assert [tuple(r)[2:] for r in column_summary(df, exact=exact).collect()] == [(0, 0, 0, *[None] * 6)] * 3
    assert [r["column"] for r in column_summary(df, ["a.b"], exact=exact).collect()] == ["a.b"]


def test_exact_figures_hold_no_column_in_a_task(spark):
    rng = random.Random(9)
    rows = [(None if rng.random() < .05 else float("nan") if rng.random() < .01 else 7.0 if rng.random() < .33
             else rng.choice([-1, 1]) * rng.lognormvariate(2, 2), rng.randrange(50), rng.choice(["p", "q", None]))
            for _ in range(5000)]
    df = spark.createDataFrame(rows * 2, SCHEMA).repartition(8)
    out = column_summary(df, exact=True)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan and "Expand" not in plan
    got = {r["column"]: r for r in out.collect()}
    for c, name in (("x", "x"), ("`a.b`", "a.b")):
        want = df.selectExpr(f"count(distinct {c})", *[f"percentile({c}, {p})" for p in (.25, .5, .75)]).first()
        assert (got[name].n_distinct, got[name].q25, got[name].median, got[name].q75) == tuple(want)
    assert got["s"].n_distinct == 2 and got["s"].median is None


def test_exact_figures_of_few_and_equal_values(spark):
    for values in ([3], [3, 3, 3], [1, 2], [None, None], [-5, 10**15, 10**15, 4]):
        df = spark.createDataFrame([(v,) for v in values], "v long")
        want = df.selectExpr("count(distinct v)", *[f"percentile(v, {p})" for p in (.25, .5, .75)]).first()
        r = column_summary(df, exact=True).first()
        assert (r.n_distinct, r.q25, r.median, r.q75) == tuple(want)
