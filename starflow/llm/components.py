"""Connected components of a table of links, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.session import materialise


def _digest(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id that has a link (columns a, b); the
    component is its smallest id.

    Alternating stars: each id hands its larger neighbours to its smallest
    one, then its smaller ones, until every id points at the smallest of its
    component.  Each step is a grouped minimum and a join on the id, written
    to the shared folder, so a lost executor costs one step.  Null ids and
    links of an id with itself are ignored; repeated links count once; no
    links give no rows.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialise(edges, "component-edges")
    seen = _digest(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written first: a join of two tables can split the edges of a hub.
        least = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")),
                            "component-least")
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialise(large, "component-edges")
        least = materialise(large.groupBy("a").agg(F.min("b").alias("m")), "component-least")
        small = (large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        edges = materialise(small, "component-edges")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        roots.join(edges.select(F.col("a").alias("id")), "id", "left_anti")).distinct()
