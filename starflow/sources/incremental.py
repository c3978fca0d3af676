"""A Parquet table that is merged by key (SNK2, UPS1): delete + insert of the
keys of a batch, without rewriting what the batch does not touch.

The table is partitioned (sales: by order month).  A merge finds the
partitions it touches - those of the batch's rows and those that hold its keys
today, since a correction may move a key to another month - and writes these
anew under a version of its own.  The last step writes a commit: the version
of each partition.  Readers follow the newest complete commit, so a merge that
dies on the way leaves nothing to be seen, and the files of untouched
partitions are never written again.

    <path>/data/_version=<n>/_part=<value>/*.parquet
    <path>/commits/<n>/        one row per partition, complete with _SUCCESS

One writer at a time.  Paths go through Spark's file system API.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordered import dedupe_latest

PART, VERSION = "_part", "_version"
_COMMIT = "part string, version long, batch_id string, columns string"


def month_of(col: str) -> Column:
    """Partition value of a date: 202401, NULL for an undated row."""
    return F.year(col) * 100 + F.month(col)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def commits(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete commits, ascending."""
    out = []
    for name in _names(spark, f"{path}/commits"):
        fs, done = _fs(spark, f"{path}/commits/{name}/_SUCCESS")
        if fs.exists(done):
            out.append(int(name))
    return out


def _commit_rows(spark: SparkSession, path: str, number: int) -> tuple[dict[str, int], str | None, T.StructType]:
    """(version of each partition folder, batch id, columns) of a commit."""
    rows = spark.read.schema(_COMMIT).json(f"{path}/commits/{number:012d}").collect()  # one row per partition
    head = next(r for r in rows if r["columns"])
    columns = T.StructType.fromJson(json.loads(head["columns"]))
    return {r["part"]: r["version"] for r in rows if r["part"]}, head["batch_id"], columns


def partitions(spark: SparkSession, path: str) -> dict[str, int]:
    """Folder name of each partition -> the version that is in force."""
    done = commits(spark, path)
    return _commit_rows(spark, path, done[-1])[0] if done else {}


def read(spark: SparkSession, path: str, parts: Sequence[str] | None = None) -> DataFrame:
    """The table as of its newest commit, or those of its partitions that are
    named in ``parts`` (folder names), with its own columns and ``_part``."""
    done = commits(spark, path)
    if not done:
        raise ValueError(f"no complete commit in {path}")
    of, _, columns = _commit_rows(spark, path, done[-1])
    paths = [f"{path}/data/{VERSION}={v}/{name}" for name, v in of.items() if parts is None or name in parts]
    schema = T.StructType([*columns.fields, T.StructField(VERSION, T.LongType()), T.StructField(PART, T.StringType())])
    if not paths:
        return spark.createDataFrame([], schema).drop(VERSION)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*paths).drop(VERSION)


def _folder_name(part: Column) -> Column:
    return F.concat(F.lit(f"{PART}="), F.coalesce(part.cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))


def _touched(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], part: Column) -> list[str]:
    """Folders of the batch's rows and of its keys' present rows.  Of the
    table only keys are read; the answer has one row per partition."""
    names = batch.select(_folder_name(part).alias("n")).distinct()
    if partitions(spark, path):
        present = read(spark, path).select(*keys, PART).join(batch.select(*keys).distinct(), keys, "left_semi")
        names = names.unionByName(present.select(_folder_name(F.col(PART)).alias("n")).distinct())
    return [r["n"] for r in names.distinct().collect()]


def merge(batch: DataFrame, path: str, keys: Sequence[str], part: Column, prefer: Sequence[str] = (),
          batch_id: str | None = None, full_refresh: bool = False) -> int:
    """Merge ``batch`` into the table at ``path`` (created by the first merge)
    and return the number of the commit.

    A row of the batch replaces the rows with its ``keys``; with ``prefer``,
    the greatest by those columns stays instead, old or new, so an older
    correction that arrives late loses.  A NULL key matches nothing: such rows
    are added.  ``batch`` has one row per key, unless ``prefer`` says which
    wins, and is read several times: materialise it if it is costly.  ``part``
    is the partition value of a row.

    A ``batch_id`` that is already committed is not merged again.
    ``full_refresh`` puts the batch in place of the whole table.
    """
    spark = batch.sparkSession
    keys, done = list(keys), commits(spark, path)
    if batch_id is not None and done:
        seen = spark.read.schema(_COMMIT).json([f"{path}/commits/{n:012d}" for n in done])
        if not seen.filter(F.col("batch_id") == batch_id).isEmpty():
            return done[-1]
    old = {} if full_refresh or not done else partitions(spark, path)
    rows, touched = batch, []
    if old:
        touched = _touched(spark, path, batch, keys, part)
        present = read(spark, path, touched).select(*batch.columns)
        if not prefer:
            present = present.join(batch.select(*keys).distinct(), keys, "left_anti")
        rows = present.unionByName(batch)
    if prefer:
        has_key = reduce(and_, (F.col(k).isNotNull() for k in keys))
        rows = dedupe_latest(rows.filter(has_key), keys, list(prefer)).unionByName(rows.filter(~has_key))
    # A number is never used twice, also not after a merge that died.
    used = [int(n.split("=")[1]) for n in _names(spark, f"{path}/data")]
    number = max([0, *done, *used]) + 1
    data = f"{path}/data/{VERSION}={number}"
    # Few files per partition, and a hot partition dealt out to many tasks.
    (rows.select(*batch.columns, part.alias(PART)).hint("rebalance", F.col(PART))
     .write.partitionBy(PART).parquet(data))
    new = {n: v for n, v in old.items() if n not in touched}
    new |= {n: number for n in _names(spark, data) if n.startswith(f"{PART}=")}
    head = [(None, number, batch_id, batch.schema.json())]
    manifest = spark.createDataFrame(head + [(n, v, None, None) for n, v in sorted(new.items())], _COMMIT)
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/commits/{number:012d}")
    return number


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove the partition folders that none of the last ``keep`` commits
    uses, also those of merges that died; returns them."""
    needed, done = set(), commits(spark, path)[-keep:]
    for n in done:
        needed |= {f"{VERSION}={v}/{name}" for name, v in _commit_rows(spark, path, n)[0].items()}
    gone = []
    for version in _names(spark, f"{path}/data"):
        for name in _names(spark, f"{path}/data/{version}"):
            if name.startswith(f"{PART}=") and f"{version}/{name}" not in needed:
                fs, p = _fs(spark, f"{path}/data/{version}/{name}")
                fs.delete(p, True)
                gone.append(f"{version}/{name}")
    return gone
