"""As-of join (JN7): each left row gets the latest right row of its key at or
before its time.

An inequality join would pair every left row with all earlier right rows, and
a dense calendar would make a row per key and day.  Here the left side's
distinct (key, time) points and the right rows are united and the right value
is carried forward over them, in two steps so that no key lands in one task:

* inside a bucket of time (a month, by default) with a window over (key,
  bucket), so a hot key is dealt out by its buckets;
* across buckets over one row per (key, bucket), which a partial aggregate
  makes; there are as many as the key has buckets with rows, not as the span
  of time has.

The left rows then meet their points in one equi-join on (key, time); the
points are written first, so adaptive execution can split a point that a
third of all rows share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


def asof_points(points: DataFrame, right: DataFrame, keys: Sequence[str], time: str, value: str,
                bucket: str = "month", strict: bool = False) -> DataFrame:
    """(keys, time, ``value``) for the distinct ``points`` (keys, time): the
    latest ``value`` of ``right`` (keys, time, value; one row per key and
    time) at or before the time, before it if ``strict``; NULL if none."""
    keys = list(keys)
    # At the same time a right row comes first, or last where it must not count.
    none = F.lit(None).cast(right.schema[value].dataType)
    united = points.select(*keys, time, none.alias(value), F.lit(True).alias("_is_point"), F.lit(1).alias("_side")).unionByName(
        right.select(*keys, time, value, F.lit(False).alias("_is_point"), F.lit(2 if strict else 0).alias("_side")))
    united = united.withColumn("_bucket", F.date_trunc(bucket, F.col(time)))
    part = [*keys, "_bucket"]
    inside = (Window.partitionBy(*part).orderBy(time, "_side")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = united.withColumn("_in", F.last(value, ignorenulls=True).over(inside)).filter("_is_point")
    tails = united.groupBy(*part).agg(F.max_by(value, F.when(~F.col("_is_point"), F.col(time))).alias("_tail"))
    across = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = tails.select(*part, F.last("_tail", ignorenulls=True).over(across).alias("_before"))
    return carried.join(before, part, "left").select(*keys, time, F.coalesce("_in", "_before").alias(value))


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
              values: Sequence[str], tiebreak: Sequence[str] = (), bucket: str = "month", strict: bool = False,
              within: str | None = None, prefix: str = "") -> DataFrame:
    """All rows and columns of ``left``, with ``prefix + v`` of each of
    ``values`` and ``prefix + right_time`` of the latest row of ``right`` that
    has equal ``keys`` and a time at or before ``left_time`` (before it, if
    ``strict``); NULL where there is none.

    Of right rows of one key and time the greatest by ``tiebreak`` and then by
    ``values`` counts.  ``within`` is the most that a right row may be older,
    as an interval ('14 days'); an older one is no match, and nothing before
    it is looked for.  A NULL key or time matches nothing.  ``bucket`` is a
    unit of ``date_trunc``: the smaller, the more tasks a hot key is dealt
    to.  Times are dates or timestamps, of one type on both sides.
    """
    keys, values = list(keys), list(values)
    k = [f"_asof_k{i}" for i in range(len(keys))]
    known = [F.col(c).isNotNull() for c in keys]

    def all_of(conditions: Sequence[Column]) -> Column:
        out = F.lit(True)
        for c in conditions:
            out = out & c
        return out

    row = F.struct(F.col(right_time).alias("t"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    order = F.struct(*[F.col(c) for c in [*tiebreak, *values]])
    quotes = (right.filter(all_of([*known, F.col(right_time).isNotNull()]))
              .groupBy(*[F.col(c).alias(a) for c, a in zip(keys, k, strict=True)], F.col(right_time).alias("_asof_t"))
              .agg(F.max_by(row, order).alias("_asof_v")))
    points = (left.filter(all_of([*known, F.col(left_time).isNotNull()]))
              .select(*[F.col(c).alias(a) for c, a in zip(keys, k, strict=True)], F.col(left_time).alias("_asof_t"))
              .distinct())
    found = asof_points(points, quotes, k, "_asof_t", "_asof_v", bucket, strict).filter("_asof_v IS NOT NULL")
    if within is not None:
        found = found.filter(F.col("_asof_v.t") >= F.col("_asof_t") - F.expr(f"INTERVAL {within}"))
    found = materialise(found, "asof-points")
    on = all_of([left[c] == found[a] for c, a in zip(keys, k, strict=True)] + [left[left_time] == found["_asof_t"]])
    joined = left.join(found, on, "left")
    return joined.select(*[left[c] for c in left.columns],
                         *[F.col("_asof_v")[f"v{i}"].alias(prefix + v) for i, v in enumerate(values)],
                         F.col("_asof_v")["t"].alias(prefix + right_time))
