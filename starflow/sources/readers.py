"""Sources and sinks (SRC1-15, SNK1-2).

All readers declare their schema (no inference); all writers go to the
shared folder named by the session, never a machine-local one.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import fix_mojibake
from ..operators.ordered import dedupe_latest
from .contracts import COUNTRY_JSON, FX_LANDING
from .quoted import whole_records


# ------------------------------------------------------------- text exports

def snake_case(name: str) -> str:
    """'Order ID' -> 'order_id', ' Total Amount ' -> 'total_amount'."""
    lead = re.match(r"_*", name.strip()).group(0)  # lineage columns keep their prefix
    s = re.sub(r"[^0-9a-zA-Z]+", "_", name.strip()).strip("_")
    return lead + s.lower()


def normalize_columns(df: DataFrame) -> DataFrame:
    """SRC2: strip and snake-case every column name."""
    return df.toDF(*[snake_case(c) for c in df.columns])


def read_text_tables(spark: SparkSession, paths: str | Sequence[str], skip_rows: int = 0,
                     sep: str = ",", quoted_breaks: bool = False) -> list[DataFrame]:
    """SRC1: delimited exports read as all text, one table per distinct header
    line, skipping a banner of ``skip_rows`` lines above it in every file.

    Lines are numbered per file from the file's first split only (the split
    starting at byte 0 holds the banner): row ids are consecutive within a
    task, so line = id - first id of that file.  Each file's lines are read
    under its own header; every value stays a string.  With
    ``quoted_breaks`` quoted fields may hold line breaks (read as line feeds)
    and doubled quotes (see ``quoted.whole_records``).  Only the distinct header lines reach the driver, as
    many as there are versions of the export."""
    lines = (spark.read.text(paths)
             .select("value", F.col("_metadata.file_path").alias("_f"),
                     F.col("_metadata.file_block_start").alias("_b"),
                     F.monotonically_increasing_id().alias("_id")))
    first = (lines.filter(F.col("_b") == 0).groupBy("_f").agg(F.min("_id").alias("_id0")))
    numbered = (lines.join(first, "_f", "left")
                .withColumn("_line", F.when(F.col("_b") == 0, F.col("_id") - F.col("_id0"))))
    options = {"sep": sep}
    if quoted_breaks:
        options["escape"] = '"'
        records = whole_records(numbered, F.col("_line").isNull() | (F.col("_line") >= skip_rows))
        numbered = records.join(first, "_f", "left").withColumn(
            "_line", F.when(F.col("_b") == 0, F.col("_id") - F.col("_id0")))
    headers = numbered.filter(F.col("_line") == skip_rows).select("_f", F.col("value").alias("_header"))
    versions = sorted(r[0] for r in headers.select("_header").distinct().collect())
    if not versions:
        raise ValueError(f"no header line after {skip_rows} banner lines in {paths}")
    body = numbered.filter(F.col("_line").isNull() | (F.col("_line") > skip_rows))
    body = body.filter(F.length(F.trim("value")) > 0).join(headers, "_f")
    out = []
    for header in versions:
        names = next(iter(_csv_rows(header.splitlines(keepends=True), sep)))
        schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))])
        parsed = body.filter(F.col("_header") == header).select(
            F.from_csv("value", schema.simpleString(), options).alias("_r"))
        out.append(parsed.select(*[F.col(f"_r._c{i}").alias(n.strip()) for i, n in enumerate(names)]))
    return out


def read_text_table(spark: SparkSession, paths: str | Sequence[str], skip_rows: int = 0,
                    sep: str = ",", quoted_breaks: bool = False) -> DataFrame:
    """SRC1 as one table: the union by column name of ``read_text_tables``."""
    return union_exports(read_text_tables(spark, paths, skip_rows, sep, quoted_breaks))


def _csv_rows(lines: Iterable[str], sep: str):
    import csv
    return csv.reader(lines, delimiter=sep)


def conform_schema(df: DataFrame, renames: dict[str, str], columns: Sequence[str],
                   keep_extra: bool = False) -> DataFrame:
    """SRC3: rename drifted headers, then project onto the contract; absent
    contract columns become NULL text."""
    present = {k: v for k, v in renames.items() if k in df.columns}
    df = df.withColumnsRenamed(present) if present else df
    out = [F.col(c).cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c)
           for c in columns]
    if keep_extra:
        out += [F.col(c) for c in df.columns if c not in columns]
    return df.select(*out)


def union_exports(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of export versions by column name; absent columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SRC4: drop rows whose key is NULL."""
    return df.dropna(subset=list(keys))


def drop_exact(df: DataFrame, ignore: Sequence[str] = ("_load_id", "_row_id")) -> DataFrame:
    """AGG3: one row of each set of rows that agree in all columns but
    ``ignore``; those columns are left out of the result."""
    return df.drop(*ignore).distinct()


def repair_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """SRC5 applied: undo mojibake in the named columns."""
    return df.withColumns({c: fix_mojibake(c) for c in columns})


def ingest_sales(exports: Sequence[DataFrame], renames: dict[str, str], columns: Sequence[str],
                 keys: Sequence[str] = ("order_id",),
                 text: Sequence[str] = ("customer_name", "product_name", "country")) -> DataFrame:
    """The sales ingest path: each export's headers normalised and conformed
    to the contract, united, rows without a key dropped and text repaired.
    ``append_load`` then stamps and lands the result."""
    united = union_exports([conform_schema(normalize_columns(e), renames, list(columns)) for e in exports])
    return repair_text(drop_null_keys(united, keys), text)


def with_lineage(df: DataFrame, load_id: str | Column) -> DataFrame:
    """Stamp a load id and a row id (hash of load, content and position)."""
    lid = load_id if isinstance(load_id, Column) else F.lit(load_id)
    content = F.concat_ws("\u001f", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in df.columns])
    return (df.withColumn("_load_id", lid)
              .withColumn("_row_id", F.md5(F.concat_ws("\u001e", lid, F.monotonically_increasing_id().cast("string"),
                                                       content))))


LOADS = "load_id string, inserted_at timestamp, attempt string, committed_at timestamp"


def _load_folder(path: str, load_id: str, attempt: str) -> str:
    return f"{path}/load={quote(load_id, safe='')}/attempt={attempt}"


def append_load(df: DataFrame, path: str, loads_path: str, load_id: str, inserted_at: str) -> None:
    """SRC6: append a raw load, exactly once: its files go into a folder of
    this attempt, and the row in the load log that follows is the commit.
    Readers (``read_loads``) follow the log, so a load that dies between the
    two is not seen, and one that is landed again replaces its own rows."""
    spark = df.sparkSession
    attempt = uuid.uuid4().hex
    with_lineage(df, load_id).write.parquet(_load_folder(path, load_id, attempt))
    log = spark.range(1).select(F.lit(load_id).alias("load_id"), F.lit(inserted_at).cast("timestamp").alias("inserted_at"),
                                F.lit(attempt).alias("attempt"), F.current_timestamp().alias("committed_at"))
    log.write.mode("append").parquet(loads_path)


def load_log(spark: SparkSession, loads_path: str) -> DataFrame:
    """The committed loads, one row each: load_id, inserted_at, attempt."""
    log = spark.read.schema(LOADS).parquet(loads_path)
    return dedupe_latest(log, ["load_id"], ["committed_at"], ["attempt"]).drop("committed_at")


def read_loads(spark: SparkSession, path: str, loads_path: str, load_ids: Sequence[str] | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """The rows of all committed loads, or of those in ``load_ids``; columns
    that a load lacks are NULL.  With a ``schema`` every load is read under it,
    else under the columns of all.  The log has one row per load and is the only
    thing that reaches the driver."""
    log = load_log(spark, loads_path)
    if load_ids is not None:
        log = log.filter(F.col("load_id").isin(list(load_ids)))
    folders = [_load_folder(path, r["load_id"], r["attempt"]) for r in log.select("load_id", "attempt").collect()]
    if not folders:
        raise ValueError(f"no committed load in {loads_path}")
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    return reader.parquet(*folders)


def replace_table(df: DataFrame, path: str) -> None:
    """SRC13: full replace load."""
    df.write.mode("overwrite").parquet(path)


# ----------------------------------------------------------------------- FX

def read_fx(path: str | Sequence[str]) -> DataFrame:
    """SRC7: landed FX quotes -> (rate_date, actual_date, base, currency, rate).
    ``rate_date`` is the day that was asked for, ``actual_date`` that of the
    quote that came; a record that doesn't say the former was asked for its own."""
    spark = SparkSession.getActiveSession()
    raw = spark.read.schema(FX_LANDING).json(path)
    return raw.select(F.coalesce("requested", "date").try_cast("date").alias("rate_date"),
                      F.col("date").try_cast("date").alias("actual_date"), "base",
                      F.col("quote").alias("currency"), "rate")


def read_since(df: DataFrame, cursor_col: str, target: DataFrame | None,
               initial: str, lookback_days: int = 0) -> DataFrame:
    """SRC9: rows whose cursor is at or after the latest cursor in ``target``
    (inclusive, optionally minus a lookback); ``initial`` on an empty target.

    The watermark is an uncorrelated scalar subquery: Spark evaluates it once
    before the scan and pushes the comparison into the reader."""
    if target is None:
        mark = F.lit(initial).cast("date")
    else:
        mark = F.coalesce(target.agg(F.max(cursor_col).cast("date")).scalar(), F.lit(initial).cast("date"))
    return df.filter(F.col(cursor_col) >= F.date_sub(mark, lookback_days))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str],
           order_desc: Sequence[str] = ()) -> DataFrame:
    """SRC10: merge on ``keys``; a batch row replaces the target row.

    Within the batch the latest row per key wins (``order_desc``).  Plan:
    anti join of the target against the batch keys, then union — one
    shuffle on the key for each side, no row-by-row merge."""
    b = dedupe_latest(batch, list(keys), list(order_desc)) if order_desc else batch
    kept = target.join(b.select(*keys), list(keys), "left_anti")
    return kept.unionByName(b)


# ---------------------------------------------------------------- countries

def read_nested(spark: SparkSession, path: str | Sequence[str], selector: str = "data.objects",
                schema: T.StructType = COUNTRY_JSON) -> DataFrame:
    """SRC11 / JSN1: read paged JSON responses and take the records under
    ``selector`` (one row per record)."""
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    return raw.select(F.explode(F.col(selector)).alias("_o")).select("_o.*")


def flatten(df: DataFrame, sep: str = "__") -> DataFrame:
    """Struct fields -> ``a__b`` columns (recursively); arrays untouched."""
    cols: list[Column] = []

    def walk(prefix: list[str], dtype: T.DataType):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(prefix + [f.name], f.dataType)
        else:
            cols.append(F.col(".".join(f"`{p}`" for p in prefix)).alias(sep.join(prefix)))

    for f in df.schema.fields:
        walk([f.name], f.dataType)
    return df.select(*cols)


def unnest(df: DataFrame, array_col: str, sep: str = "__") -> tuple[DataFrame, DataFrame]:
    """SRC12: (parent, child).  The parent gets a ``_row_id`` and flattened
    struct columns; the child has one row per array element with
    ``_parent_id`` and ``_pos``.  Records that are equal in every field are
    numbered, so each has an id of its own; nothing is collected."""
    content = F.md5(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    nth = F.row_number().over(Window.partitionBy("_content").orderBy("_content"))
    keyed = (df.withColumn("_content", content)
             .withColumn("_row_id", F.md5(F.concat_ws("#", "_content", nth))).drop("_content"))
    parent = flatten(keyed.drop(array_col), sep)
    child = (keyed.select(F.col("_row_id").alias("_parent_id"),
                          F.posexplode(array_col).alias("_pos", "_e"))
             .select("_parent_id", "_pos", "_e.*"))
    return parent, child


# ------------------------------------------------------------------ schemas

def schema_diff(old: T.StructType, new: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """SRC14: (column, change, old type, new type) for added, removed and
    retyped columns.  Works on schema metadata only."""
    o = {f.name: f.dataType.simpleString() for f in old.fields}
    n = {f.name: f.dataType.simpleString() for f in new.fields}
    out = []
    for c in n:
        if c not in o:
            out.append((c, "added", None, n[c]))
        elif o[c] != n[c]:
            out.append((c, "retyped", o[c], n[c]))
    for c in o:
        if c not in n:
            out.append((c, "removed", o[c], None))
    return out


def schema_diff_df(spark: SparkSession, old: T.StructType, new: T.StructType) -> DataFrame:
    return spark.createDataFrame(schema_diff(old, new),
                                 "column string, change string, old_type string, new_type string")


def scan(spark: SparkSession, name_or_path: str) -> DataFrame:
    """SRC15: a registered table by name, else a Parquet path (one with a
    slash is a path without asking the catalog)."""
    if "/" not in name_or_path and spark.catalog.tableExists(name_or_path):
        return spark.table(name_or_path)
    return spark.read.parquet(name_or_path)


def materialize(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """SNK1: a view (lazy, re-planned by every reader) or a table written to
    ``path`` and read back (lineage cut, reused by many readers)."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if path is None:
        raise ValueError("a table needs a path in the shared folder")
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.parquet(path)
    out.createOrReplaceTempView(name)
    return out
