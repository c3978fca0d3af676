"""Schema drift: comparison, widening and the gate."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.sources import drift


def said(old, new):
    schema, changes = drift.compare(T._parse_datatype_string(old), T._parse_datatype_string(new))
    return schema.simpleString(), [(c.path, c.change, c.old_type, c.new_type, c.compatible) for c in changes]


@pytest.mark.parametrize("old,new,both", [
    ("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("float", "double", "double"), ("int", "double", "double"),
    ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("int", "decimal(5,2)", "decimal(12,2)"),
    ("date", "timestamp_ntz", "timestamp_ntz"),
    # No type holds both exactly.
    ("bigint", "double", None), ("int", "float", None), ("int", "string", None), ("date", "string", None),
    ("decimal(38,0)", "decimal(38,10)", None), ("boolean", "int", None), ("array<int>", "int", None),
    ("struct<a:int>", "map<string,int>", None)])
def test_widest(spark, old, new, both):
    schema, changes = said(f"struct<x:{old}>", f"struct<x:{new}>")
    assert schema == f"struct<x:{both or old}>"
    assert len(changes) == 1 and changes[0][0] == "x" and changes[0][4] == (both is not None)


def test_nested_changes(spark):
    schema, changes = said("struct<a:int,b:struct<c:int,d:array<struct<e:int>>>,m:map<string,int>>",
                           "struct<b:struct<d:array<struct<e:bigint,f:string>>>,m:map<string,string>,n:date>")
    assert schema == "struct<a:int,b:struct<c:int,d:array<struct<e:bigint,f:string>>>,m:map<string,int>,n:date>"
    assert changes == [
        ("a", "removed", "int", None, True), ("b.c", "removed", "int", None, True),
        ("b.d[].e", "widened", "int", "bigint", True), ("b.d[].f", "added", None, "string", True),
        ("m{value}", "retyped", "int", "string", False), ("n", "added", None, "date", True)]


def test_gate(spark, tmp_path):
    raw, loads, log = (str(tmp_path / n) for n in ("raw", "loads", "drift"))

    def land(df, name, day):
        return drift.land(df, raw, loads, log, name, f"2024-01-0{day} 00:00:00")

    one = spark.sql("SELECT 1 AS k, array(named_struct('e', 1)) AS l, CAST(1.5 AS FLOAT) AS x, CAST(3 AS INT) AS d")
    two = spark.sql("SELECT 5000000000 AS k, array(named_struct('e', 7000000000, 'f', 'q')) AS l, CAST(2.5 AS DOUBLE) AS x,"
                    " CAST(1.25 AS DECIMAL(5,2)) AS d, 'new' AS n")
    assert land(one, "a", 1) == []
    assert [c.path for c in land(two, "b", 2)] == ["k", "l[].e", "l[].f", "x", "d", "n"]
    # Nothing of a load that doesn't fit is landed.
    with pytest.raises(drift.IncompatibleSchema, match="k: retyped"):
        land(one.withColumn("k", F.lit("text")), "c", 3)
    # A narrow load again, in a table that is wider by now; then the same load once more.
    for _ in range(2):
        land(one.drop("x"), "d", 4)
    got = drift.read_landed(spark, raw, loads, log)
    assert got.drop("_load_id", "_row_id").schema.simpleString() == (
        "struct<k:bigint,l:array<struct<e:bigint,f:string>>,x:double,d:decimal(12,2),n:string>")
    rows = sorted((r._load_id, r.k, r.l[0].e, r.l[0].f, r.x, float(r.d), r.n) for r in got.collect())
    assert rows == [("a", 1, 1, None, 1.5, 3.0, None), ("b", 5000000000, 7000000000, "q", 2.5, 1.25, "new"),
                    ("d", 1, 1, None, None, 3.0, None)]
    changes = spark.read.parquet(log)
    assert {r.load_id for r in changes.collect()} == {"a", "b", "d"}
    assert changes.filter("load_id = 'b'").count() == 6


def test_a_load_that_dies_is_landed_again(spark, tmp_path):
    raw, loads, log = (str(tmp_path / n) for n in ("raw", "loads", "drift"))
    assert drift.table_schema(spark, log) is None
    drift.land(spark.sql("SELECT 1 AS x"), raw, loads, log, "a", "2024-01-01 00:00:00")
    dies = spark.sql("SELECT raise_error('stop') AS y").select(F.lit(2).cast("long").alias("x"), F.col("y").cast("int").alias("y"))
    with pytest.raises(Exception, match="stop"):
        drift.land(dies, raw, loads, log, "b", "2024-01-02 00:00:00")
    assert [tuple(r) for r in drift.read_landed(spark, raw, loads, log).select("x", "y").collect()] == [(1, None)]
    drift.land(spark.sql("SELECT 2L AS x, 3 AS y"), raw, loads, log, "b", "2024-01-02 00:00:00")
    rows = drift.read_landed(spark, raw, loads, log).select("x", "y").orderBy("x").collect()
    assert [tuple(r) for r in rows] == [(1, None), (2, 3)]
    assert spark.read.parquet(log).filter("load_id = 'b'").count() == 2
