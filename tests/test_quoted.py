"""Line breaks in quoted fields, in files of many splits."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from starflow.sources import quoted
from starflow.sources import readers as R


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes, several of them to a task or not."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(path, rows, banner=""):
    with open(path, "w", newline="") as fh:
        fh.write(banner)
        csv.writer(fh, lineterminator="\n").writerows([["Order ID", "Note", "Amount"], *rows])


def test_records_over_split_borders(spark, small_splits, tmp_path):
    rng = random.Random(3)
    pieces = ["plain words", 'a "quoted" word', "a, b", "\n", "\n\n", "line\n", '"', "x" * 90]
    files = {}
    for f in range(3):
        files[f"{f}.csv"] = [[f"{f}-{i}", "".join(rng.choices(pieces, k=rng.randint(1, 6))) + ".", str(i)] for i in range(60)]
    # One record over many splits, and a file without any break.
    files["0.csv"][30][1] = "long\n" * 400 + "end"
    files["3.csv"] = [[f"3-{i}", "plain", str(i)] for i in range(60)]
    for name, rows in files.items():
        write(tmp_path / name, rows, 'An "odd banner\n\n')
    df = R.read_text_table(spark, str(tmp_path), skip_rows=2, quoted_breaks=True)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    got = sorted(tuple(r) for r in df.select("Order ID", "Note", "Amount").collect())
    assert got == sorted(tuple(r) for rows in files.values() for r in rows)


def test_unbalanced_and_empty(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('Order ID,Note\n1,"open\n2,x\n')
    with pytest.raises(quoted.UnbalancedQuotes, match="bad.csv"):
        R.read_text_table(spark, str(tmp_path), quoted_breaks=True)
    lines = spark.createDataFrame([], "value string, _f string, _b long, _id long")
    assert quoted.whole_records(lines).count() == 0
    one = spark.createDataFrame([(None, "f", 0, 1), ('"a', "f", 0, 2), (None, "f", 9, 3), ('b"', "f", 20, 4)], lines.schema)
    assert sorted(tuple(r) for r in quoted.whole_records(one.withColumn("other", F.lit(1))).collect()) == [
        ("", "f", 0, 1), ('"a\n\nb"', "f", 0, 2)]


def test_header_with_a_break(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"Order\nID",Note\n1,"x\ny"\n')
    df = R.normalize_columns(R.read_text_table(spark, str(tmp_path), quoted_breaks=True))
    assert [tuple(r) for r in df.select("order_id", "note").collect()] == [("1", "x\ny")]
