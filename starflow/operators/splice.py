"""Late events spliced into a type-2 dimension (SCD1, incremental)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .joins import null_safe_keys
from .scd import scd2_from_events

_LEAD = "_splice_"


def _reach(batch: DataFrame, key: str, ts: str, one_per_day: bool) -> DataFrame:
    """One row per key of the batch: the time from which its history changes."""
    since = F.min(F.col(ts).cast("timestamp"))
    if one_per_day:
        since = F.date_trunc("day", since)
    keyed, names = null_safe_keys(batch.select(key, ts), [key], f"{_LEAD}k")
    return keyed.groupBy(*names).agg(since.alias(f"{_LEAD}since"))


def splice_events(dim: DataFrame, history: DataFrame, batch: DataFrame, key: str, attrs: Sequence[str], ts: str,
                  tiebreak: str, surrogate_col: str, first_by: str = "value", one_per_day: bool = False,
                  tolerance: dict[str, float] | None = None) -> DataFrame:
    """The dimension that ``scd2_from_events(history + batch, ...)`` gives, from
    ``dim``, which it gave for ``history`` with the same options.

    Events of the batch may be late: earlier than versions that are known.
    Keys without one keep their versions.  Of the others, versions that ended
    before the key's first event in the batch stay; the version in force then
    is what the events from there on are folded on, so older events are not
    read into any window.  A version alone does not say when a value was seen
    again, hence ``history``: its rows of the touched keys since then are the
    only ones that are ordered anew.

    Rows without a time belong to no place in the order and are not read, in
    ``history`` and ``batch``; ``dim`` has none of them either.  A null key is a
    key.  An empty batch gives the dimension as it is; an empty ``dim`` and
    ``history`` the batch's versions.  Other columns are not read.

    Plan: the batch's keys, one row each, are written and meet the dimension
    and the history in equi-joins, which AQE broadcasts while the keys are few
    and splits where a key is hot."""
    attrs = list(attrs)
    since = F.col(f"{_LEAD}since")
    rows = [df.select(key, *attrs, ts, tiebreak).filter(F.col(ts).isNotNull()) for df in (history, batch)]
    reach = materialise(_reach(rows[1], key, ts, one_per_day), "reach")

    def touched(df: DataFrame, keep: Column, how: str = "inner") -> DataFrame:
        keyed, names = null_safe_keys(df, [key], f"{_LEAD}k")
        return keyed.join(reach, names, how).filter(keep).select(*[F.col(f"`{c}`") for c in df.columns])

    start, end = F.col("valid_from").cast("timestamp"), F.col("valid_to").cast("timestamp")
    in_force = (start < since) & (end.isNull() | (end >= since))
    kept = touched(dim, since.isNull() | (start < since) & ~in_force, "left")
    base = touched(dim, in_force).select(
        key, *attrs, F.col("valid_from").cast(rows[0].schema[ts].dataType).alias(ts),
        F.lit(None).cast(rows[0].schema[tiebreak].dataType).alias(tiebreak))
    later = touched(rows[0], F.col(ts).cast("timestamp") >= since)
    again = materialise(base.unionByName(later).unionByName(rows[1]), "splice")
    spliced = scd2_from_events(again, key, attrs, ts, tiebreak, surrogate_col, first_by=first_by,
                               one_per_day=one_per_day, tolerance=tolerance)
    return kept.unionByName(spliced.select(*dim.columns))
