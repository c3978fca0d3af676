"""Column profiles: exact however values are dealt out, and of one read."""

import random

import pytest

from starflow.operators import profile as PR

SCHEMA = "k int, `a.b` string, x double, none string, b binary"


def _rows(n):
    rng = random.Random(4)
    words = ["", " ", "é", "zÿ", "\U0001f600", "a", "a ", "ab", "|"]
    return [(rng.randrange(n // 3), rng.choice([None, *words]), rng.choice([None, 0.0, -0.0, 1e20, rng.random()]),
             None, rng.choice([None, b"q", b"\x00", b"\x7f"])) for _ in range(n)]


def _expected(rows, i, text, n_samples):
    values = [text(r[i]) for r in rows if r[i] is not None]
    nulls, unique = len(rows) - len(values), sorted(set(values), key=lambda v: v.encode())
    return (nulls, int((nulls * 2000 + len(rows)) // (len(rows) * 2)) / 10.0, len(rows) - len(unique) - (nulls > 0),
            len(unique), " | ".join(unique[:n_samples]) if unique else None)


@pytest.mark.parametrize("held, buckets, n_samples", [(1, 7, 5), (2000, 1, 3), (PR._HELD, 1024, 5)])
def test_exact_however_values_are_dealt(spark, monkeypatch, held, buckets, n_samples):
    """Tasks that send their values many times, values in few or many buckets."""
    monkeypatch.setattr(PR, "_HELD", held)
    rows = _rows(3000)
    df = spark.createDataFrame(rows * 2, SCHEMA).repartition(5)
    got = {r["column"]: tuple(r)[1:] for r in PR.column_profile(df, n_samples=n_samples, buckets=buckets).collect()}
    texts = dict(df.selectExpr("x", "string(x)").distinct().collect())
    text = {"k": str, "a.b": str, "x": texts.get, "none": str, "b": bytes.decode}
    # -0.0 and 0.0 are one key of a dict and two texts.
    zeros = {r[0] for r in df.selectExpr("string(x)").distinct().collect() if r[0] is not None}
    for i, (name, kind) in enumerate(df.dtypes):
        want = _expected(rows * 2, i, text[name], n_samples)
        if name == "x":
            want = (*want[:2], 6000 - len(zeros) - 1, len(zeros), " | ".join(sorted(zeros)[:n_samples]))
        assert got[name] == (kind, *want)


def test_empty_table_and_chosen_columns(spark):
    df = spark.createDataFrame([], SCHEMA)
    out = PR.column_profile(df)
    assert out.collect() == []
    assert [f.simpleString() for f in out.schema] == ["column:string", "type:string", "nulls:bigint", "null_pct:double",
                                                      "duplicates:bigint", "unique:bigint", "samples:string"]
    rows = PR.column_profile(spark.createDataFrame(_rows(30), SCHEMA), ["a.b"]).collect()
    assert [r["column"] for r in rows] == ["a.b"]


def test_rows_are_read_once_and_values_cross_packed(spark):
    """The rows are computed once, no row is made per column, and of the rows
    that cross the network there are a few per task and bucket, not one per value."""
    out = PR.column_profile(spark.range(10).selectExpr("id", "string(id % 3) AS m"))
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Range (") == 1 and "Generate" not in plan and "Expand" not in plan
    df = spark.range(0, 20000, 1, 4).selectExpr("binary(md5(string(id))) AS c0", "binary(string(id)) AS c1")
    dealt = df.mapInArrow(PR._deal_values(2, 16), PR._DEALT).collect()
    assert len(dealt) <= 4 * 17
    # 32 and 5 characters a row; a random hexadecimal digit is half a byte.
    assert sum(len(r.packed or b"") for r in dealt) < 20000 * 32
