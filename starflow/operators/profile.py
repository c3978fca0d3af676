"""Profiling (PRF1-4) as Spark aggregates.

The source prints pandas summaries of one file; here each profile is a
DataFrame computed with partial aggregation, so a column with billions of
values costs one pass and a shuffle of its distinct values only.  Samples are
the five smallest distinct values as text (a deterministic stand-in for
"first five seen", which has no meaning on partitioned data).
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def table_profile(df: DataFrame, key_col: str, ignore: Sequence[str] = ("_load_id", "_row_id")) -> DataFrame:
    """PRF1: one row - rows, rows that repeat another one, distinct keys and
    the NULL count of every column.  Lineage columns (``ignore``) tell no rows
    apart and are not counted.

    Rows and NULLs are plain partial sums; only the count of distinct rows
    shuffles whole rows, combined on the map side."""
    own = df.drop(*ignore)
    n_distinct = own.distinct().agg(F.count(F.lit(1))).scalar()
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.col(key_col)).alias(f"n_distinct_{key_col}")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in own.columns]
    out = own.agg(*aggs).withColumn("n_duplicate_rows", F.col("n_rows") - n_distinct)
    return out.select("n_rows", "n_duplicate_rows", f"n_distinct_{key_col}", *[f"nulls_{c}" for c in own.columns])


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, n_samples: int = 5,
                   buckets: int = 1024) -> DataFrame:
    """PRF3: per column — type, nulls, null % (1 decimal), duplicates,
    unique (non-NULL distinct) and up to ``n_samples`` sample values.

    duplicates = rows - (distinct non-NULL values + 1 if any NULL).

    The rows are read once.  Tasks drop the values that they have seen before
    and send the others compressed, dealt out by a hash of the value to
    ``buckets``.  All copies of a value meet in its bucket, where values are
    compared whole, so the counts of buckets are exact and add up.  A task
    holds the distinct values of one bucket at a time."""
    cols = list(columns or df.columns)
    types = dict(df.dtypes)
    values = df.select(*[_quoted(c).cast("string").cast("binary").alias(f"c{i}") for i, c in enumerate(cols)])
    dealt = values.mapInArrow(_deal_values(len(cols), buckets), _DEALT)
    counts = dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _count_values(len(cols), n_samples), "i int, n_rows long, nulls long, unique long, samples array<binary>")
    least = F.slice(F.array_sort(F.flatten(F.collect_list("samples"))), 1, n_samples).cast("array<string>")
    per_col = counts.groupBy("i").agg(F.sum("n_rows").alias("n_rows"), F.sum("nulls").alias("nulls"),
                                      F.sum("unique").alias("unique"), least.alias("samples"))
    column = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type")) for c in cols])[F.col("i")]
    n, nulls = F.col("n_rows"), F.col("nulls")
    return per_col.select(
        column["column"].alias("column"), column["type"].alias("type"), "nulls",
        (F.floor((nulls * 2000 + n) / (n * 2)) / F.lit(10.0)).alias("null_pct"),
        (n - F.col("unique") - F.when(nulls > 0, 1).otherwise(0)).alias("duplicates"),
        "unique", F.when(F.size("samples") > 0, F.array_join("samples", " | ")).alias("samples"))


_DEALT = "bucket int, n_rows long, nulls array<long>, packed binary"
# Bytes of values that a task keeps before it drops those it has twice, or
# sends what is left.
_HELD = 32 << 20


def _deal_values(n_cols: int, buckets: int):
    """Rows -> the distinct values of all columns, a packed table per bucket,
    and a row with the number of rows and the NULLs of each column."""
    def distinct(chunks: list[pa.Array]) -> pa.Array:
        return pc.drop_null(pc.unique(pa.chunked_array(chunks)))

    def dealt(seen: list[list[pa.Array]], n_rows: int, nulls: list[int]) -> pa.RecordBatch:
        columns = [distinct(chunks).cast(pa.large_binary()) for chunks in seen]
        column = np.repeat(np.arange(n_cols, dtype=np.int32), [len(v) for v in columns])
        hashes = [np.fromiter(map(zlib.crc32, v.to_numpy(zero_copy_only=False)), np.uint32, len(v)) for v in columns]
        bucket = (np.concatenate(hashes) % buckets).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        table = pa.record_batch({"i": column[order], "v": pa.concat_arrays(columns).take(pa.array(order))})
        sent, begin = np.unique(bucket[order], return_index=True)
        packed = [_packed(table.slice(b, e - b)) for b, e in zip(begin, [*begin[1:], len(order)])]
        return pa.record_batch({
            "bucket": pa.array([*sent, 0], pa.int32()), "n_rows": pa.array([0] * len(sent) + [n_rows], pa.int64()),
            "nulls": pa.array([None] * len(sent) + [nulls], pa.list_(pa.int64())),
            "packed": pa.array([*packed, None], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, new, n_rows, nulls = [[] for _ in range(n_cols)], 0, 0, [0] * n_cols
        for batch in batches:
            n_rows, new = n_rows + batch.num_rows, new + batch.nbytes
            for i, c in enumerate(batch.columns):
                nulls[i] += c.null_count
                seen[i].append(c)
            if new > _HELD:
                seen, new = [[distinct(chunks)] for chunks in seen], 0
                if sum(chunks[0].nbytes for chunks in seen) > _HELD:
                    yield dealt(seen, n_rows, nulls)
                    seen, n_rows, nulls = [[] for _ in range(n_cols)], 0, [0] * n_cols
        if n_rows:
            yield dealt(seen, n_rows, nulls)

    return run


def _packed(table: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(table)
    return sink.getvalue().to_pybytes()


def _count_values(n_cols: int, n_samples: int):
    """Packed tables in the order of their buckets -> a row per column: rows,
    NULLs, distinct values and the least of these."""
    def distinct(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by(["i", "v"], use_threads=False).aggregate([])

    def least(values: pa.Array) -> pa.Array:
        return values.take(pc.select_k_unstable(values, n_samples, [("", "ascending")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*batch.columns))
        n_rows, nulls, unique = 0, np.zeros(n_cols, np.int64), np.zeros(n_cols, np.int64)
        samples = [pa.array([], pa.large_binary())] * n_cols
        for _, bucket in itertools.groupby(rows, lambda row: row[0].as_py()):
            tables, new, most = [], 0, 2 * _HELD
            for _, n, k, packed in bucket:
                n_rows += n.as_py()
                if not packed.is_valid:
                    nulls += k.as_py()
                    continue
                tables.append(pa.ipc.open_stream(packed.as_buffer()).read_all())
                new += tables[-1].nbytes
                if new > most:
                    tables, new = [distinct(tables)], 0
                    most = max(most, tables[0].nbytes)
            if tables:
                table = distinct(tables)
                column = table["i"].to_numpy()
                values = table["v"].combine_chunks().take(pa.array(np.argsort(column, kind="stable")))
                counts = np.bincount(column, minlength=n_cols)
                unique += counts
                for i, end in enumerate(np.cumsum(counts)):
                    if counts[i]:
                        samples[i] = least(pa.concat_arrays([samples[i], values[end - counts[i]:end]]))
        if n_rows or unique.any():
            yield pa.record_batch({
                "i": pa.array(range(n_cols), pa.int32()), "n_rows": pa.array([n_rows] * n_cols, pa.int64()),
                "nulls": pa.array(nulls), "unique": pa.array(unique),
                "samples": pa.array([v.to_pylist() for v in samples], pa.list_(pa.binary()))})

    return run


def numeric_describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PRF2: count, mean, sample stddev, min and max of numeric columns, one
    row per column (as doubles, rounded to 4 decimals)."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])).alias("_p")
    ).select("_p.*")
    return long.groupBy("column").agg(
        F.count("x").alias("count"), F.round(F.avg("x"), 4).alias("mean"),
        F.round(F.stddev_samp("x"), 4).alias("stddev"), F.min("x").alias("min"), F.max("x").alias("max"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """PRF4 / AGG5: the distinct values of one column, in order."""
    return df.select(col).distinct().orderBy(F.col(col).asc_nulls_last())


def first_last(df: DataFrame, order_cols: Sequence[str], n: int = 10) -> DataFrame:
    """PRF4 / SRT1-2: the first and last ``n`` rows by ``order_cols`` (a
    top-k each way, planned as TakeOrderedAndProject), tagged 'first'/'last'."""
    asc = [F.col(c).asc_nulls_last() for c in order_cols]
    desc = [F.col(c).desc_nulls_first() for c in order_cols]  # exact reverse of asc
    first = df.orderBy(*asc).limit(n).withColumn("position", F.lit("first"))
    last = df.orderBy(*desc).limit(n).withColumn("position", F.lit("last"))
    return first.unionByName(last)


def column_summary(df: DataFrame, columns: Sequence[str] | None = None, error: float = 0.01,
                   exact: bool = False) -> DataFrame:
    """PRF1-3 in one pass: a row per column with its type, nulls, distinct
    values, and for numbers mean, least, quartiles and greatest.

    By default quartiles and distinct values come from sketches that tasks
    merge: of n values a quartile is one whose rank is off by ``error * n`` at
    most, a distinct count has a relative standard deviation of ``error``.
    Their size depends on the error alone, nothing is exploded and one row per
    task crosses the network.  ``exact`` counts and interpolates instead, which
    shuffles the distinct values of a column with their counts, so no task
    holds a column; it is for tables that allow it.  An empty table has 0
    distinct values and NULL figures."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    parts = (0.25, 0.5, 0.75)
    aggregates: list[Column] = [F.count(F.lit(1)).alias("n")]
    rows = []
    for i, f in enumerate(fields):
        c = _quoted(f.name)
        aggregates.append(F.count(c).alias(f"k{i}"))
        if not exact:
            aggregates.append(F.approx_count_distinct(c, error).alias(f"d{i}"))
        names = ["mean", "least", "q25", "median", "q75", "greatest"]
        figures = {x: F.lit(None).cast("double").alias(x) for x in names}
        if isinstance(f.dataType, NumericType):
            x = c.cast("double")
            aggregates += [F.avg(x).alias(f"m{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
            if not exact:
                aggregates.append(F.percentile_approx(x, list(parts), max(1, round(1 / error))).alias(f"q{i}"))
            figures |= {"mean": F.round(f"m{i}", 4).alias("mean"), "least": F.col(f"lo{i}").alias("least"),
                        "greatest": F.col(f"hi{i}").alias("greatest")}
            figures |= {n: F.col(f"q{i}")[j].alias(n) for j, n in enumerate(names[2:5])}
        rows.append(F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                             F.col("n").alias("n_rows"), (F.col("n") - F.col(f"k{i}")).alias("nulls"),
                             F.col(f"d{i}").alias("n_distinct"), *[figures[n] for n in names]))
    out = df.agg(*aggregates)
    if exact:
        for i, f in enumerate(fields):
            own = _exact(df, f.name, isinstance(f.dataType, NumericType), parts)
            out = out.crossJoin(own.select(*[F.col(x).alias(f"{x}{i}") for x in own.columns]))
    return out.select(F.inline(F.array(*rows)))


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _exact(df: DataFrame, column: str, numeric: bool, parts: Sequence[float], ranges: int = 256) -> DataFrame:
    """One row: the distinct values ``d`` of a column and, of numbers, the
    percentiles ``q``, interpolated as ``percentile`` does.

    The distinct values are counted by a shuffle.  Bounds from a sketch deal
    them out to ranges, which only balance: the rows of each range are summed,
    so it is known in which range a rank lies, and only the values of these
    few ranges are put in order."""
    counts = df.filter(_quoted(column).isNotNull()).groupBy(_quoted(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    if not numeric:
        return counts.agg(F.count(F.lit(1)).alias("d"))
    bounds = df.agg(F.percentile_approx(_quoted(column).cast("double"), [k / ranges for k in range(1, ranges)],
                                        4 * ranges)).first()[0] or []
    x = F.col("v").cast("double")
    at = F.lit(0)
    if bounds:
        below = F.array(*[F.lit(float(b)) for b in sorted(set(bounds))])
        at = F.size(F.filter(below, lambda b: b < x))
    counts = counts.select(x.alias("x"), "n", at.alias("r"))
    # One row per range: the window over all of them is small.
    w = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.groupBy("r").agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("n"))
    sums = sums.select("r", "d", "n", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"),
                       F.sum("n").over(Window.partitionBy()).alias("all"))
    rank = [(F.col("all") - 1) * F.lit(p) for p in parts]
    ends = [e(p).cast("long") for p in rank for e in (F.floor, F.ceil)]
    asked = F.array(*ends)
    within = sums.select("r", "before", F.filter(asked, lambda a: (a >= F.col("before")) &
                                                 (a < F.col("before") + F.col("n"))).alias("asked"))
    found = counts.join(F.broadcast(within.filter(F.size("asked") > 0)), "r")
    order = Window.partitionBy("r").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = found.withColumn("upto", F.col("before") + F.sum("n").over(order))
    found = found.select("x", F.explode(F.filter("asked", lambda a: (a < F.col("upto")) &
                                                 (a >= F.col("upto") - F.col("n")))).alias("a"))
    # At most six ranks.
    value = F.map_from_entries(F.collect_set(F.struct("a", "x")))
    total = sums.agg(F.coalesce(F.sum("d"), F.lit(0)).alias("d"), F.max("all").alias("all"))
    out = total.crossJoin(found.agg(value.alias("value")))

    def interpolated(position: Column) -> Column:
        low, high = F.floor(position).cast("long"), F.ceil(position).cast("long")
        a, b = F.try_element_at("value", low), F.try_element_at("value", high)
        return F.when((low == high) | (a == b), a).otherwise((high - position) * a + (position - low) * b)

    return out.select("d", F.array(*[interpolated(p) for p in rank]).alias("q"))
