"""Order-dependent operators: forward fill (WIN1), latest-wins dedupe (WIN2),
previous/next row values (WIN4, WIN5).

Skew.  A plain window over one entity key puts every row of a hot entity in
one task.  Here the window key is (entity, day): rows are split by day, the
within-day step is an ordinary window, and the step across days runs on a
small table of one row per (entity, day), built from the input with a partial
(map-side) aggregate.  That table per entity is bounded by the number of
distinct days, not by the number of rows, so a key holding a third of all rows
is spread over as many tasks as it has days.  The input is read by both
branches: materialise it first if it is costly to compute.

The forward fill, which runs over all rows, does so for hot keys only: a sketch
tells which they are, and the rows of any other key stay together in one window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import null_safe_keys


# A key of more rows than this is hot.
HOT_ROWS = 500_000


def _asc(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def _with_day(df: DataFrame, col: str, prefix: str) -> tuple[DataFrame, list[str]]:
    """Add the split unit of ``col``: whether it is NULL (those rows come
    last) and its day.  Both are never NULL, so tables can join back on them."""
    undated, day = f"{prefix}z", f"{prefix}b"
    return df.withColumns({undated: F.col(col).isNull(),
                           day: F.coalesce(F.col(col).cast("date"), F.lit("1970-01-01").cast("date"))}), [undated, day]


def _is_hot(rows: DataFrame, kcols: Sequence[str]) -> Column:
    """Whether the row's key holds more than ``HOT_ROWS`` rows.  Of a sketch
    that sends one row per task; it misses no key of more than 1/4,000 of all
    rows besides.  Only the balance depends on it: a key that is taken for hot,
    or not, has the same result."""
    key = F.xxhash64(*kcols)
    top = F.call_function("approx_top_k", key, F.lit(1000), F.lit(10_000))
    hot = F.transform(F.filter(top, lambda x: x["count"] > HOT_ROWS), lambda x: x["item"])
    return F.coalesce(F.array_contains(rows.agg(hot.alias("hot")).scalar(), key), F.lit(False))


def forward_fill(df: DataFrame, value_col: str, keys: Sequence[str], order_col: str,
                 tiebreak: str, out_col: str | None = None, bucket_col: str | None = None) -> DataFrame:
    """Last non-NULL ``value_col`` per ``keys`` ordered by (order_col, tiebreak),
    rows from the start up to the current row (NULLs of order_col sort last).

    ``bucket_col`` (default: ``order_col``) is the split unit of hot keys; it
    must be monotone in ``order_col``.  The last value of each day needs no
    window: it is one aggregate over the narrow input."""
    out_col = out_col or value_col
    bucket_col = bucket_col or order_col
    # Rows that have a value keep it: they lend it to the rows without, as
    # narrow rows, and are themselves neither shuffled nor sorted.
    empty = F.col(value_col).isNull()
    whole = df.withColumn("_ff_row", F.when(empty, F.struct(*df.columns)))
    rows, kcols = null_safe_keys(whole, list(keys), "_ffk")
    hot = _is_hot(rows, kcols)
    rows, day = _with_day(rows, bucket_col, "_ff")
    part = kcols + day
    # All rows of a key that is not hot are of one unit.
    none = {day[0]: F.lit(False), day[1]: F.lit("1970-01-01").cast("date")}
    rows = rows.withColumn("_ff_hot", hot).select(
        *kcols, *[F.when(F.col("_ff_hot"), F.col(d)).otherwise(none[d]).alias(d) for d in day], "_ff_hot",
        *dict.fromkeys([order_col, tiebreak, value_col]), "_ff_row")

    w_in = (Window.partitionBy(*part).orderBy(_asc(order_col), F.col(tiebreak).asc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled_in = (rows.withColumn("_ff_in", F.last(value_col, ignorenulls=True).over(w_in))
                 .filter(F.col("_ff_row").isNotNull()).select(*part, "_ff_row", "_ff_in"))
    # Last value of each (hot key, day): one row per day, map-side combined.
    # Rows without a value have a NULL order, which max_by passes over.
    at = F.when(F.col(value_col).isNotNull(), F.struct(F.col(order_col), F.col(tiebreak)))
    tails = rows.filter("_ff_hot").groupBy(*part).agg(F.max_by(F.col(value_col), at).alias("_ff_tail"))
    w_carry = (Window.partitionBy(*kcols).orderBy(*day)
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = (tails.withColumn("_ff_carry", F.last("_ff_tail", ignorenulls=True).over(w_carry))
               .select(*part, "_ff_carry"))
    filled = (filled_in.join(carried, part, "left")
              .select("_ff_row.*", F.coalesce("_ff_in", "_ff_carry").alias("_ff_out"))
              .withColumn(out_col, F.col("_ff_out")).drop("_ff_out"))
    return df.filter(~empty).withColumn(out_col, F.col(value_col)).unionByName(filled)


def dedupe_latest(df: DataFrame, keys: Sequence[str | Column], order_desc: Sequence[str],
                  tiebreak_desc: Sequence[str] = ()) -> DataFrame:
    """DED1 / WIN2: keep one row per key, the greatest by ``order_desc`` then
    ``tiebreak_desc``.

    Planned as row_number() = 1, which Spark turns into a partial
    WindowGroupLimit before the shuffle: each task keeps only its best row
    per key, so a hot key sends one row per task over the network."""
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    order = [F.col(c).desc_nulls_last() for c in list(order_desc) + list(tiebreak_desc)]
    w = Window.partitionBy(*key_cols).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def with_previous(df: DataFrame, keys: Sequence[str], order_col: str, tiebreak: str,
                  cols: Sequence[str], prefix: str = "previous_") -> DataFrame:
    """WIN4: add ``prefix + c`` = value of ``c`` on the previous row of the
    same key, ordered by (order_col, tiebreak); NULL on the first row."""
    df, kcols = null_safe_keys(df, list(keys), "_pvk")
    df, day = _with_day(df, order_col, "_pv")
    part = kcols + day
    w = Window.partitionBy(*part).orderBy(_asc(order_col), F.col(tiebreak).asc())
    vals = F.struct(*[F.col(c) for c in cols])
    inner = (df.withColumn("_pv_lag", F.lag(vals).over(w))
               .withColumn("_pv_first", F.row_number().over(w) == 1))
    tails = (df.groupBy(*part)
               .agg(F.max_by(vals, F.struct(F.col(order_col), F.col(tiebreak))).alias("_pv_tail")))
    w_b = Window.partitionBy(*kcols).orderBy(*day)
    prev_tail = (tails.withColumn("_pv_prev_tail", F.lag("_pv_tail").over(w_b))
                      .select(*part, "_pv_prev_tail"))
    out = inner.join(prev_tail, part, "left")
    prev = F.when(F.col("_pv_first"), F.col("_pv_prev_tail")).otherwise(F.col("_pv_lag"))
    out = out.withColumn("_pv", prev).withColumns({f"{prefix}{c}": F.col("_pv")[c] for c in cols})
    return out.drop(*part, "_pv_lag", "_pv_first", "_pv_prev_tail", "_pv")


def with_next_start(df: DataFrame, keys: Sequence[str], start_col: str, tiebreak: str,
                    out_col: str = "valid_to") -> DataFrame:
    """WIN5: ``out_col`` = ``start_col`` of the next row of the same key
    ordered by (start_col, tiebreak); NULL on the last row.

    A start that several rows share gives a zero-length interval, as the
    source does.  Starts may be dates or timestamps: the last row of a day
    gets the earliest start of the next day that has one."""
    df, kcols = null_safe_keys(df, list(keys), "_nxk")
    df, day = _with_day(df, start_col, "_nx")
    part = kcols + day
    w = Window.partitionBy(*part).orderBy(_asc(start_col), F.col(tiebreak).asc())
    inner = df.withColumn("_nx_in", F.lead(start_col).over(w))
    first = df.groupBy(*part).agg(F.min(start_col).alias("_nx_first"))
    w_b = Window.partitionBy(*kcols).orderBy(*day)
    nxt = first.select(*part, F.lead("_nx_first").over(w_b).alias("_nx_next"))
    out = inner.join(nxt, part, "left").withColumn(out_col, F.coalesce("_nx_in", "_nx_next"))
    return out.drop(*part, "_nx_in", "_nx_next")
