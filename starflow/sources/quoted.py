"""Records of delimited text whose quoted fields hold line breaks (SRC1).

A line break ends a record where the quotes before it in the file are even in
number.  That depends on all lines before, yet files stay split: the quotes of
each split are counted, the counts added up over the splits of a file (one row
each), and only splits with such a line or a start inside quotes are looked
at line by line, each under its own start."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


class UnbalancedQuotes(ValueError):
    """Files with an odd number of quotes: where their records end is not known."""


def whole_records(lines: DataFrame, counted: Column | None = None) -> DataFrame:
    """``lines`` (value, _f file, _b start of the split, _id order in the
    split), each record one row: lines of one record are joined by a line feed
    and stand at the first one's place.  ``counted``: the lines whose quotes
    count; others are rows of their own, as a banner is.

    A quote inside a quoted field is doubled; an unquoted field has none.  A
    record may reach over any number of splits.  A null line is empty.  Files
    whose quotes don't come out even raise UnbalancedQuotes: their rest would
    be one record.  An empty table gives an empty one.  Splits are as large as
    ``spark.sql.files.maxPartitionBytes``, and a task orders one at a time."""
    value = F.coalesce("value", F.lit(""))
    odd = (F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))) % 2
    if counted is not None:
        odd = F.when(counted, odd).otherwise(0)
    lines = lines.select(value.alias("value"), "_f", "_b", "_id", odd.cast("int").alias("_odd"))
    earlier = Window.partitionBy("_f").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("_f", "_b").agg(F.sum("_odd").alias("_n"))
    splits = materialise(splits.withColumn("_open", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) % 2), "splits")
    bad = splits.groupBy("_f").agg((F.sum("_n") % 2).alias("_n")).filter("_n = 1").select("_f").limit(5).collect()
    if bad:
        raise UnbalancedQuotes(", ".join(r[0] for r in bad))

    broken = splits.filter("_n > 0 OR _open = 1").select("_f", "_b", "_open")
    marked = lines.join(broken, ["_f", "_b"], "left")
    whole = marked.filter(F.col("_open").isNull()).select("value", "_f", "_b", "_id")
    in_split = Window.partitionBy("_f", "_b").orderBy("_id")
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("_odd").over(before), F.lit(0)) + F.col("_open")) % 2 == 1
    parts = marked.filter(F.col("_open").isNotNull()).withColumn("_first", F.when(~inside, F.struct("_b", "_id")))
    parts = materialise(parts.withColumn("_record", F.last("_first", ignorenulls=True).over(
        in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_odd", "_open", "_first"), "parts")
    # The head of a split may belong to the last record of a split before it.
    carried = parts.groupBy("_f", "_b").agg(F.max("_record").alias("_record")).select(
        "_f", "_b", F.last("_record", ignorenulls=True).over(earlier).alias("_carried"))
    owned = parts.join(carried, ["_f", "_b"], "left").withColumn("_record", F.coalesce("_record", "_carried"))
    joined = owned.groupBy("_f", "_record").agg(
        F.sort_array(F.collect_list(F.struct("_b", "_id", "value"))).alias("_lines"))
    return whole.unionByName(joined.select(
        F.array_join(F.transform("_lines", lambda x: x["value"]), "\n").alias("value"), "_f",
        F.col("_record._b").alias("_b"), F.col("_record._id").alias("_id")))
