"""The merged table on disk: what is replaced, what is left alone, what a
crash leaves behind."""

import os

import pytest
from pyspark.sql import functions as F

from starflow.sources import incremental as INC

SCHEMA = "k long, d date, v string, load int"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("d", F.col("d").cast("date"))


def day(text):
    import datetime
    return datetime.date.fromisoformat(text) if text else None


def rows_of(spark, path):
    return sorted(((r.k, str(r.d), r.v, r.load) for r in INC.read(spark, path).collect()), key=str)


def files_of(path, part):
    out = {}
    for folder, _, names in os.walk(f"{path}/data"):
        if folder.endswith(part):
            out.update({f"{folder}/{n}": os.stat(f"{folder}/{n}").st_mtime_ns for n in names})
    return out


FIRST = [(1, day("2024-01-05"), "a", 1), (2, day("2024-01-06"), "b", 1), (3, day("2024-02-01"), "c", 1),
         (4, day("2024-03-01"), "d", 1), (5, None, "e", 1), (None, day("2024-01-09"), "n", 1)]


@pytest.fixture
def path(spark, tmp_path):
    p = f"file://{tmp_path}/t"
    INC.merge(table(spark, FIRST), p, ["k"], INC.month_of("d"))
    return p


def test_replaces_keys_and_moves_them(spark, path):
    batch = [(1, day("2024-02-07"), "a2", 2), (3, day("2024-02-01"), "c2", 2), (7, day("2024-04-01"), "g", 2)]
    local = path[len("file://"):]
    march, undated = files_of(local, "_part=202403"), files_of(local, "__HIVE_DEFAULT_PARTITION__")
    assert march and undated
    INC.merge(table(spark, batch), path, ["k"], INC.month_of("d"))
    want = sorted([(1, "2024-02-07", "a2", 2), (2, "2024-01-06", "b", 1), (3, "2024-02-01", "c2", 2),
                   (4, "2024-03-01", "d", 1), (5, "None", "e", 1), (7, "2024-04-01", "g", 2),
                   (None, "2024-01-09", "n", 1)], key=str)
    assert rows_of(spark, path) == want
    assert files_of(local, "_part=202403") == march and files_of(local, "__HIVE_DEFAULT_PARTITION__") == undated
    of = INC.partitions(spark, path)
    assert of["_part=202403"] == 1 and {of[f"_part={m}"] for m in (202401, 202402, 202404)} == {2}
    # The same batch again, as after a restart, gives the same table.
    INC.merge(table(spark, batch), path, ["k"], INC.month_of("d"))
    assert rows_of(spark, path) == want


def test_a_month_may_run_empty(spark, path):
    INC.merge(table(spark, [(4, day("2024-01-01"), "d2", 2)]), path, ["k"], INC.month_of("d"))
    assert "_part=202403" not in INC.partitions(spark, path)
    assert (4, "2024-01-01", "d2", 2) in rows_of(spark, path) and len(rows_of(spark, path)) == len(FIRST)


def test_preferred_rows(spark, path):
    """With ``prefer`` an older load that arrives late loses, wherever its
    row would lie, and a batch may hold several rows of a key."""
    batch = [(1, day("2024-05-01"), "old", 0), (2, day("2024-05-01"), "x", 2), (2, day("2024-06-01"), "y", 3),
             (None, day("2024-01-09"), "n2", 1)]
    INC.merge(table(spark, batch), path, ["k"], INC.month_of("d"), prefer=["load"])
    got = rows_of(spark, path)
    assert (1, "2024-01-05", "a", 1) in got and (2, "2024-06-01", "y", 3) in got
    assert [r[2] for r in got if r[0] is None] == ["n", "n2"] and len(got) == len(FIRST) + 1


def test_batches_are_merged_once(spark, path):
    batch = table(spark, [(None, day("2024-01-09"), "again", 2)])
    for _ in range(3):
        INC.merge(batch, path, ["k"], INC.month_of("d"), batch_id="b7")
    assert sum(r[2] == "again" for r in rows_of(spark, path)) == 1 and len(INC.commits(spark, path)) == 2


def test_a_dead_merge_is_not_seen(spark, path):
    """Files without a commit, and a commit without its marker."""
    before = rows_of(spark, path)
    dead = table(spark, [(1, day("2024-01-05"), "dead", 9)])
    dead.withColumn(INC.PART, INC.month_of("d")).write.partitionBy(INC.PART).parquet(f"{path}/data/{INC.VERSION}=2")
    assert rows_of(spark, path) == before
    os.makedirs(f"{path[len('file://'):]}/commits/{2:012d}")
    assert rows_of(spark, path) == before
    INC.merge(table(spark, [(1, day("2024-01-05"), "a3", 2)]), path, ["k"], INC.month_of("d"))
    assert (1, "2024-01-05", "a3", 2) in rows_of(spark, path) and len(rows_of(spark, path)) == len(before)


def test_full_refresh_expire_and_empty_batches(spark, path):
    INC.merge(table(spark, []), path, ["k"], INC.month_of("d"))
    assert len(rows_of(spark, path)) == len(FIRST)
    INC.merge(table(spark, FIRST[:1]), path, ["k"], INC.month_of("d"), full_refresh=True)
    assert rows_of(spark, path) == [(1, "2024-01-05", "a", 1)]
    assert INC.expire(spark, path, keep=1) and rows_of(spark, path) == [(1, "2024-01-05", "a", 1)]
    INC.merge(table(spark, []), path, ["k"], INC.month_of("d"), full_refresh=True)
    assert rows_of(spark, path) == [] and INC.read(spark, path).columns == ["k", "d", "v", "load", "_part"]


def test_only_touched_partitions_are_read(spark, path):
    """The merge reads rows of touched months; the table only for its keys."""
    one = INC.read(spark, path, ["_part=202401"])
    assert {r["_part"] for r in one.collect()} == {"202401"} and len(one.inputFiles()) == len(
        [f for f in INC.read(spark, path).inputFiles() if "_part=202401" in f])
