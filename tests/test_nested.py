"""Nested records as tables."""

import pytest
from pyspark.sql import functions as F

from starflow.sources.nested import normalise_nested

LINES = [
    '{"k": 1, "who": {"name": "A", "at": {"city": "X"}}, "orders": [{"no": 7, "lines": [{"sku": "s1", "tags": ["t", null]},'
    ' {"sku": "s2", "tags": []}], "more": {"w": 1}}, null, {"no": 8}], "m": {"a": 1, "b": 2}, "grid": [[1, 2], [], [3]]}',
    '{"k": 2, "orders": [], "who": null}',
    '{"k": 3}']
SCHEMA = ("k long, who struct<name: string, at: struct<city: string>>, orders array<struct<no: long, lines: array<struct<"
          "sku: string, tags: array<string>>>, more: map<string, int>>>, m map<string, int>, grid array<array<int>>")


@pytest.fixture(scope="module")
def records(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("nested") / "in.json"
    path.write_text("\n".join(LINES))
    return spark.read.schema(SCHEMA).json(str(path))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_tables_at_any_depth(records):
    t = normalise_nested(records, "r", ["k"])
    assert sorted(t) == ["r", "r__grid", "r__grid__value", "r__m", "r__orders", "r__orders__lines",
                         "r__orders__lines__tags", "r__orders__more"]
    assert t["r"].columns == ["_row_id", "k", "who__name", "who__at__city"]
    assert rows(t["r"]) == [("1", 1, "A", "X"), ("2", 2, None, None), ("3", 3, None, None)]
    assert rows(t["r__orders"]) == [("1/orders/0", "1", 0, 7), ("1/orders/1", "1", 1, None), ("1/orders/2", "1", 2, 8)]
    assert rows(t["r__orders__lines"]) == [("1/orders/0/lines/0", "1/orders/0", 0, "s1"),
                                           ("1/orders/0/lines/1", "1/orders/0", 1, "s2")]
    assert rows(t["r__orders__lines__tags"]) == [
        ("1/orders/0/lines/0/tags/0", "1/orders/0/lines/0", 0, "t"), ("1/orders/0/lines/0/tags/1", "1/orders/0/lines/0", 1, None)]
    assert rows(t["r__orders__more"]) == [("1/orders/0/more/0", "1/orders/0", 0, "w", 1)]
    assert [r[-1] for r in rows(t["r__grid__value"])] == [1, 2, 3]
    assert [r[-2:] for r in rows(t["r__m"])] == [("a", 1), ("b", 2)]


def test_every_child_has_its_parent(records):
    t = normalise_nested(records, "r", ["k"])
    for child, parent in (("r__orders", "r"), ("r__orders__lines", "r__orders"), ("r__orders__lines__tags", "r__orders__lines")):
        orphans = t[child].join(t[parent].select(F.col("_row_id").alias("_parent_id")), "_parent_id", "left_anti")
        assert orphans.count() == 0


def test_ids_without_keys_and_clashes(spark, records):
    plain = records.drop("m", "grid")
    plain = plain.union(plain)
    t = normalise_nested(plain.select("k", "orders"), "r")
    assert t["r"].select("_row_id").distinct().count() == 6
    assert t["r__orders"].count() == 6
    assert normalise_nested(plain.limit(0), "r", ["k"])["r__orders__lines"].count() == 0
    with pytest.raises(ValueError, match="_row_id"):
        normalise_nested(plain.withColumn("_row_id", F.lit(1)), "r", ["k"])
    with pytest.raises(ValueError, match="who__name"):
        normalise_nested(plain.withColumn("who__name", F.lit(1)), "r", ["k"])
    dotted = spark.range(1).select(F.lit(5).alias("a.b"), F.array(F.lit(1)).alias("c.d"))
    t = normalise_nested(dotted, "r", ["a.b"])
    assert rows(t["r__c.d"]) == [("5/c.d/0", "5", 0, 1)]


def test_a_reader_takes_only_its_columns(records):
    plan = normalise_nested(records, "r", ["k"])["r__orders"].select("_pos")._jdf.queryExecution().executedPlan().toString()
    read = plan.split("ReadSchema")[-1]
    assert "orders" in read and "grid" not in read and "who" not in read
