"""All declared checks of a table in one scan (CHK1-5, CHK7 as a suite).

The checks of ``operators/quality.py`` each read the table for the rows that
fail.  A suite asks how many fail which check, and reads it once:

* the row checks of a row (not null, accepted values, any predicate) become
  the bits of one number, and rows are counted by that pattern;
* the unique checks put the row's values beside it, and all of them go through
  the same exchange as the patterns;
* freshness is the maximum of a time column on the way.

A partial aggregate leaves one row per pattern and task, so a pattern that
nearly all rows share costs nothing; a value that a third of all rows share
is one row per task.  Examples are the least and the greatest example value of
the rows that fail; a fixed-width one (a number, a date) lets the aggregate
stay a hash aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A pattern is a long; the sign is left alone.
MOST_ROW_CHECKS = 62


@dataclass(frozen=True)
class Check:
    """One declared check: a failing predicate per row, a value that must be
    unique, or a time that must be recent."""
    name: str
    fails: Column | None = field(default=None, compare=False)
    unique: Column | None = field(default=None, compare=False)
    latest: Column | None = field(default=None, compare=False)
    warn_hours: float = 0.0
    error_hours: float = 0.0


def not_null(col: str) -> Check:
    return Check(f"not_null_{col}", fails=F.col(col).isNull())


def accepted(col: str, values: Sequence[str]) -> Check:
    """NULL passes."""
    return Check(f"accepted_{col}", fails=F.col(col).isNotNull() & ~F.col(col).isin(list(values)))


def expect(name: str, fails: Column) -> Check:
    """Any predicate of rows that fail; NULL passes."""
    return Check(name, fails=fails)


def unique(col: str) -> Check:
    """Counts the values seen more than once; NULL is none."""
    return Check(f"unique_{col}", unique=F.col(col))


def fresh(col: str, warn_hours: float, error_hours: float) -> Check:
    return Check(f"fresh_{col}", latest=F.col(col).cast("timestamp"), warn_hours=warn_hours, error_hours=error_hours)


def run_checks(df: DataFrame, checks: Sequence[Check], table: str, example: str,
               as_of: Column | None = None) -> DataFrame:
    """One row per check: table_name, check_name, n_failing, status,
    first_example, last_example.

    ``n_failing`` counts failing rows, or values that are not unique; status
    is 'pass' or 'fail'.  The examples are the least and greatest ``example``
    (a column) of the rows that fail, as text.  For freshness the status is
    'pass', 'warn' or 'error' by the age at ``as_of`` (default: now), the last
    example the latest time, and ``n_failing`` 1 unless it passes; an empty
    table is an 'error'.  Other checks pass on an empty table.
    """
    by_row = [c for c in checks if c.fails is not None]
    uniques = [c for c in checks if c.unique is not None]
    times = [c for c in checks if c.latest is not None]
    if len(by_row) > MOST_ROW_CHECKS:
        raise ValueError(f"{len(by_row)} row checks; split them into suites of {MOST_ROW_CHECKS}")
    zero = F.lit(0).cast("long")
    bits = reduce(lambda a, b: a.bitwiseOR(b), (
        F.when(c.fails, F.lit(1 << i).cast("long")).otherwise(zero) for i, c in enumerate(by_row)), zero)
    # One line per row for the patterns, and one per unique check.
    lines = F.array(F.struct(F.lit(-1).alias("u"), F.lit(None).cast("string").alias("key")), *[
        F.struct(F.lit(i).alias("u"), c.unique.cast("string").alias("key")) for i, c in enumerate(uniques)])
    narrow = df.select(F.col(example).alias("x"), bits.alias("bits"), lines.alias("lines"),
                       *[c.latest.alias(f"t{i}") for i, c in enumerate(times)])
    if uniques:
        narrow = narrow.select("*", F.inline("lines")).filter("u < 0 OR key IS NOT NULL")
    else:
        narrow = narrow.select("*", F.lit(-1).alias("u"), F.lit(None).cast("string").alias("key"))
    pattern = F.when(F.col("u") < 0, F.col("bits")).otherwise(zero)
    groups = narrow.groupBy("u", "key", pattern.alias("bits")).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"),
        *[F.max(f"t{i}").alias(f"t{i}") for i in range(len(times))])

    aggregates, results = [], []
    for i, c in enumerate(by_row):
        hit = (F.col("u") < 0) & (F.col("bits").bitwiseAND(F.lit(1 << i).cast("long")) != 0)
        aggregates += [F.coalesce(F.sum(F.when(hit, F.col("n"))), zero).alias(f"r{i}n"),
                       F.min(F.when(hit, F.col("lo"))).alias(f"r{i}lo"), F.max(F.when(hit, F.col("hi"))).alias(f"r{i}hi")]
        results.append((c.name, f"r{i}"))
    for i, c in enumerate(uniques):
        hit = (F.col("u") == i) & (F.col("n") > 1)
        aggregates += [F.count_if(hit).alias(f"u{i}n"), F.min(F.when(hit, F.col("lo"))).alias(f"u{i}lo"),
                       F.max(F.when(hit, F.col("hi"))).alias(f"u{i}hi")]
        results.append((c.name, f"u{i}"))
    aggregates += [F.max(f"t{i}").alias(f"t{i}") for i in range(len(times))]
    one = groups.agg(*(aggregates or [F.count(F.lit(1))]))

    def row(name: str, n: Column, status: Column, lo: Column, hi: Column) -> Column:
        return F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("check_name"), n.alias("n_failing"),
                        status.alias("status"), lo.cast("string").alias("first_example"),
                        hi.cast("string").alias("last_example"))

    out = [row(name, F.col(f"{p}n"), F.when(F.col(f"{p}n") > 0, "fail").otherwise("pass"), F.col(f"{p}lo"),
               F.col(f"{p}hi")) for name, p in results]
    now = F.current_timestamp() if as_of is None else as_of.cast("timestamp")
    for i, c in enumerate(times):
        hours = (F.unix_timestamp(now) - F.unix_timestamp(f"t{i}")) / F.lit(3600.0)
        status = (F.when(hours.isNull() | (hours > c.error_hours), "error").when(hours > c.warn_hours, "warn")
                  .otherwise("pass"))
        out.append(row(c.name, F.when(status == "pass", 0).otherwise(1).cast("long"), status, F.lit(None),
                       F.col(f"t{i}")))
    return one.select(F.inline(F.array(*out)))
