"""Native helpers for operators on spans of text: Column in, Column out.

Positions are code points from 0, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,s:string>>"


def text_column(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as array of struct(start, end, s).

    The pieces between matches and the matches themselves alternate, so the
    running sum of their lengths gives the positions in one pass; texts
    without a match are only searched once.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.transform(found, lambda m, i: F.struct(
        F.length(F.get(between, i)).alias("gap"), F.length(m).alias("n")))
    starts = F.aggregate(
        pairs, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, p: F.struct((acc["at"] + p["gap"] + p["n"]).alias("at"),
                                F.concat(acc["out"], F.array(acc["at"] + p["gap"])).alias("out")),
        lambda acc: acc["out"])
    spans = F.transform(F.arrays_zip(starts.alias("start"), found.alias("s")), lambda x: F.struct(
        x["start"].alias("start"), (x["start"] + F.length(x["s"])).alias("end"), x["s"].alias("s")))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPAN))


def between(text: Column, pattern: str) -> Column:
    """The pieces of the text between the matches, as array of struct(start,
    s); empty ones are among them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.transform(F.split(text, pattern, -1), lambda p, i: F.struct(
        p.alias("s"), F.coalesce(F.length(F.get(found, i)), F.lit(0)).alias("gap")))
    return F.aggregate(
        pieces, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,s:string>>").alias("out")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["s"]) + p["gap"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct(acc["at"].alias("start"), p["s"].alias("s")))).alias("out")),
        lambda acc: acc["out"])


def labelled(spans: Column, kind: str, rank: int) -> Column:
    """Spans as struct(start, rank, end, kind), which sort by start and then kind."""
    return F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind")))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def outside(spans: Column, others: Column) -> Column:
    """The spans that lie in none of ``others``."""
    return F.filter(spans, lambda x: ~F.exists(
        others, lambda o: (o["start"] <= x["start"]) & (x["end"] <= o["end"])))
