"""History dimensions: type-2 from events (SCD1), type-2 snapshots (SNP1) and
the unknown member (DIM1)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import UNKNOWN_ID, UNKNOWN_KEY, UNKNOWN_VALID_FROM
from .ordered import dedupe_latest, with_next_start, with_previous


def last_of_day(df: DataFrame, key: str, ts: str, tiebreak: str, cols: Sequence[str]) -> DataFrame:
    """key, ts, tiebreak and ``cols`` of the last row of each key and day.
    Undated rows are a day of their own.  A partial aggregate: a hot key
    sends one row per task and day."""
    day = F.col(ts).cast("date")
    row = F.struct(ts, tiebreak, *cols)
    # Undated rows have no time to be the greatest by, only a tie-break.
    at = F.struct(F.coalesce(F.col(ts).cast("timestamp"), F.lit("1970-01-01").cast("timestamp")), F.col(tiebreak))
    last = df.groupBy(key, day.alias("_day")).agg(F.max_by(row, at).alias("_last"))
    return last.select(key, "_last.*")


def outside_band(rows: DataFrame, key: str, ts: str, tiebreak: str, changed: str,
                 bands: dict[str, float]) -> DataFrame:
    """The rows, in (ts, tiebreak) order of their key, that open a version: the
    first of the key, those marked ``changed``, and those of which a column of
    ``bands`` is farther from its value *in the last version* than that share
    of it, or is NULL where that is not.

    What a row is compared with depends on all rows before it, which no lag
    can say: each task folds its keys in order and holds the last version of
    one key only."""
    schema, cols = rows.schema, list(bands)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, kept = object(), None
        for batch in batches:
            values = list(zip(*(batch.column(f"_band_{c}").to_pylist() for c in cols), strict=True))
            opens = batch.column(changed).to_pylist()
            for i, k in enumerate(batch.column(key).to_pylist()):
                if own != k or opens[i] or any(
                        a != b and (a is None or b is None or abs(a - b) > bands[c] * abs(b))
                        for c, a, b in zip(cols, values[i], kept, strict=True)):
                    own, kept, opens[i] = k, values[i], True
            yield batch.filter(pa.array(opens, pa.bool_())).select(schema.names)

    numbers = {f"_band_{c}": F.col(c).cast("double") for c in cols}
    ordered = rows.withColumns(numbers).repartition(key).sortWithinPartitions(
        key, F.col(ts).asc_nulls_last(), F.col(tiebreak).asc())
    return ordered.mapInArrow(run, schema)


def scd2_from_events(df: DataFrame, key: str, attrs: Sequence[str], ts: str, tiebreak: str,
                     surrogate_col: str, ignore_values: Sequence[str] = (), first_by: str = "value",
                     one_per_day: bool = False, tolerance: dict[str, float] | None = None) -> DataFrame:
    """SCD1: a version starts on a row whose first attribute's previous value
    is NULL, or where any attribute ``is distinct from`` its previous value
    (previous = the prior row of the key in (ts, tiebreak) order).

    Output: key, attrs, valid_from, valid_to (exclusive, NULL = open),
    ``surrogate_col`` = key-valid_from, is_current.

    ``ignore_values``: attribute values treated as "no information" (e.g.
    'unknown' from an export without that column) — they are replaced by the
    previous known value before comparing, so they open no version.
    ``first_by``: 'value' as above; 'row_number' takes only the key's first
    row for the first, so a first attribute that stays NULL opens one version
    and not one per row.
    ``one_per_day``: of the rows of a day only the last counts, so no version
    has no length and surrogate keys are unique.
    ``tolerance``: attribute -> share of its value in the last version by
    which it may differ and open no version, however far it drifted from row
    to row.  Needs ``one_per_day``: then a key has at most one row per day to
    be folded in order, whatever its share of all rows."""
    if first_by not in ("value", "row_number"):
        raise ValueError(f"first_by is 'value' or 'row_number', not {first_by!r}")
    if tolerance and not one_per_day:
        raise ValueError("a tolerance needs one_per_day")
    attrs = list(attrs)
    src = df
    if ignore_values:
        from .ordered import forward_fill
        for a in attrs:
            src = src.withColumn(f"_raw_{a}", F.when(~F.col(a).isin(list(ignore_values)), F.col(a)))
            src = forward_fill(src, f"_raw_{a}", [key], ts, tiebreak, out_col=f"_ff_{a}")
            src = src.withColumn(a, F.coalesce(F.col(f"_ff_{a}"), F.col(a))).drop(f"_raw_{a}", f"_ff_{a}")
    if one_per_day:
        src = last_of_day(src, key, ts, tiebreak, attrs)
    tolerance = tolerance or {}
    exact = [a for a in attrs if a not in tolerance]
    prev = with_previous(src.withColumn("_row", F.lit(True)), [key], ts, tiebreak, [*attrs, "_row"], prefix="_prev_")
    changed = F.col("_prev__row" if first_by == "row_number" else f"_prev_{attrs[0]}").isNull()
    for a in exact:
        changed = changed | ~F.col(a).eqNullSafe(F.col(f"_prev_{a}"))
    if tolerance:
        marked = prev.select(key, *attrs, ts, tiebreak, changed.alias("_changed"))
        opening = outside_band(marked, key, ts, tiebreak, "_changed", tolerance)
    else:
        opening = prev.filter(changed)
    versions = opening.select(key, *attrs, F.col(ts).alias("valid_from"), tiebreak)
    closed = with_next_start(versions, [key], "valid_from", tiebreak, "valid_to")
    return closed.select(
        key, *attrs, "valid_from", "valid_to",
        F.concat_ws("", F.col(key).cast("string"), F.lit("-"),
                    F.col("valid_from").cast("string")).alias(surrogate_col),
        F.col("valid_to").isNull().alias("is_current"),
    )


def with_unknown_member(dim: DataFrame, key: str, surrogate_col: str,
                        defaults: dict[str, object]) -> DataFrame:
    """DIM1: append the member every unmatched fact row points to:
    id -1, key '-1-unknown', valid from 1900-01-01, open, current."""
    spark = dim.sparkSession
    values: dict[str, Column] = {
        key: F.lit(UNKNOWN_ID),
        "valid_from": F.lit(UNKNOWN_VALID_FROM).cast("date"),
        "valid_to": F.lit(None).cast("date"),
        surrogate_col: F.lit(UNKNOWN_KEY),
        "is_current": F.lit(True),
    }
    for c, v in defaults.items():
        values[c] = F.lit(v)
    types = dict(dim.dtypes)
    row = spark.range(1).select(*[values[c].cast(types[c]).alias(c) for c in dim.columns])
    return dim.unionByName(row)


def scd2_snapshot(state: DataFrame | None, current: DataFrame, key: str,
                  check_cols: Sequence[str], run_ts: datetime | str | Column) -> DataFrame:
    """SNP1: one run of a type-2 snapshot with the check strategy.

    ``state``: previous snapshot (key, check_cols, valid_from, valid_to) or
    None on the first run.  ``current``: one row per key.  New keys are
    inserted, changed keys get their open version closed at ``run_ts`` and a
    new one opened, unchanged and missing keys are kept as they are.

    Plan: the open versions meet ``current`` in one full outer join on the
    key; closed history is carried through untouched (no join)."""
    ts = run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp")
    cols = list(check_cols)
    cur = current.select(key, *cols)
    if state is None:
        return cur.select(key, *cols, ts.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    history = state.filter(F.col("valid_to").isNotNull())
    open_ = state.filter(F.col("valid_to").isNull())
    o = open_.select(key, *[F.col(c).alias(f"_o_{c}") for c in cols], F.col("valid_from").alias("_o_from"))
    c = cur.select(F.col(key).alias("_c_key"), *[F.col(x).alias(f"_c_{x}") for x in cols])
    j = o.join(c, o[key] == c["_c_key"], "full_outer")
    same = F.lit(True)
    for x in cols:
        same = same & F.col(f"_o_{x}").eqNullSafe(F.col(f"_c_{x}"))
    in_old, in_new = F.col(key).isNotNull(), F.col("_c_key").isNotNull()
    j = j.withColumn("_changed", in_old & in_new & ~same)
    kept_or_closed = (j.filter(in_old).select(
        F.col(key), *[F.col(f"_o_{x}").alias(x) for x in cols], F.col("_o_from").alias("valid_from"),
        F.when(F.col("_changed"), ts).cast("timestamp").alias("valid_to")))
    opened = (j.filter(in_new & (~in_old | F.col("_changed"))).select(
        F.col("_c_key").alias(key), *[F.col(f"_c_{x}").alias(x) for x in cols],
        ts.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to")))
    return history.select(key, *cols, "valid_from", "valid_to").unionByName(kept_or_closed).unionByName(opened)


def latest_per_key(df: DataFrame, key: str, order_col: str, tiebreak: str) -> DataFrame:
    """WIN6: the latest row of each key (row_number = 1 by order desc)."""
    return dedupe_latest(df, [key], [order_col], [tiebreak])
