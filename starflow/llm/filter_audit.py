"""Filter interaction audit by contingency tensor contractions (operator 13).

Several filters judge each document; which of them removes what depends on
the order in which they run.  One pass over the texts gives every document
one bit per filter.  Per part of the corpus the documents are then counted by
their bits: a contingency table of 2^k cells, reshaped to a tensor with one
axis per filter (0 pass, 1 fail).  Every figure of every order and step is a
contraction of that tensor with one vector per axis, which selects those that
pass (1, 0), those that fail (0, 1) or all (1, 1), so no order of the filters
reads a document again.

On Spark the texts are read once and leave a narrow row; everything after
that moves no text.  Copies are found by the text's SHA-256.  The counts are
combined on the map side, so a part with a third of all documents sends at
most 2^k rows per task, and the task that contracts a part holds 2^k counts.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.session import materialise

FILTERS = "ABCDE"
MEASURES = ("docs", "good", "toxic")
MIN_WORDS = 100
_SPACE = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

OUT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
       "good_lost long, toxic_lost long, shapley long")


def text_failures(text: Column) -> list[Column]:
    """Whether a text (not null) fails A, B, C and D: few words, few distinct
    words, many capitals, marks of code or markup."""
    # Only the first and the last piece can be empty.
    words = F.array_remove(F.split(text, _SPACE), "")
    capitals = F.length(text) - F.length(F.translate(text, _UPPER, ""))
    return [F.size(words) < MIN_WORDS,
            F.lit(100) * F.size(F.array_distinct(words)) < F.lit(80) * F.size(words),
            F.lit(100) * capitals.cast("long") > F.lit(10) * F.length(text).cast("long"),
            text.rlike("[#$%&*|]")]


def _bits(fails: list[Column]) -> Column:
    """The failures as a number, the first in the highest place."""
    out = F.lit(0)
    for f in fails:
        out = out * 2 + f.cast("int")
    return out


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, bits, good, toxic of each row of ``docs``; ``bits`` is a number
    of five bits, A in the highest place, 1 where the document fails."""
    text = F.coalesce(F.col("text"), F.lit(""))
    facts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
                        _bits(text_failures(text)).alias("bits"), F.unhex(F.sha2(text, 256)).alias("sha"))
    facts = materialise(facts, "audit-facts")
    # The copy with the smallest doc_id passes E.  It is met again by doc_id,
    # not by text: a text that a third of all rows share is no hot key there.
    known = facts.filter("doc_id IS NOT NULL")
    first = known.groupBy("sha").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
             .filter("doc_id IS NOT NULL").groupBy("doc_id")
             .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    judged = (known.join(marks, "doc_id", "left").join(first, ["doc_id", "sha"], "left")
              .select("part", (F.col("bits") * 2 + F.when(F.col("is_first"), 0).otherwise(1)).alias("bits"),
                      F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")))
    # No doc_id is smaller than none, and no label belongs to it.
    unnamed = facts.filter("doc_id IS NULL").select("part", (F.col("bits") * 2).alias("bits"),
                                                    F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    return judged.unionByName(unnamed)


def contingency(rows: DataFrame) -> DataFrame:
    """part, bits and the number of documents, good ones and toxic ones."""
    return rows.groupBy("part", "bits").agg(F.count(F.lit(1)).alias("docs"), F.count_if("good").alias("good"),
                                            F.count_if("toxic").alias("toxic"))


PASS, FAIL, ALL = (np.array(v, np.int64) for v in ((1, 0), (0, 1), (1, 1)))


def contract(tensor: np.ndarray, selections: list[list[np.ndarray]]) -> np.ndarray:
    """Sums of ``tensor`` (measures first, then one axis per filter) for each
    of ``selections``, which give one vector per filter: measures x rows."""
    chosen = np.array(selections)
    return np.einsum("mabcde,ra,rb,rc,rd,re->mr", tensor, *np.moveaxis(chosen, 1, 0), optimize=True)


def steps(filters: str = FILTERS) -> list[tuple[str, int]]:
    """(order, step) of all orders of the filters."""
    return [("".join(p), s) for p in itertools.permutations(filters) for s in range(1, len(filters) + 1)]


def audit_tensor(tensor: np.ndarray) -> dict[str, np.ndarray]:
    """The figures of all orders and steps, in the order of ``steps()``."""
    kept, removed, fails, alone, own = [], [], [], [], []
    for order, step in steps():
        here, before = order[step - 1], order[:step - 1]
        kept.append([PASS if f in order[:step] else ALL for f in FILTERS])
        removed.append([FAIL if f == here else PASS if f in before else ALL for f in FILTERS])
        fails.append([FAIL if f == here else ALL for f in FILTERS])
        alone.append([FAIL if f == here else PASS for f in FILTERS])
        own.append(FILTERS.index(here))
    gone = contract(tensor, removed)
    shapley = np.zeros(len(FILTERS), np.int64)
    np.add.at(shapley, own, gone[0])
    return {"kept": contract(tensor, kept)[0], "removed": gone[0], "redundant": contract(tensor, fails)[0] - gone[0],
            "unique_fails": contract(tensor, alone)[0], "good_lost": gone[1], "toxic_lost": gone[2],
            "shapley": shapley[own]}


def _audit_part(table: pa.Table) -> pa.Table:
    tensor = np.zeros((len(MEASURES), 1 << len(FILTERS)), np.int64)
    bits = np.asarray(table.column("bits"))
    for m, name in enumerate(MEASURES):
        tensor[m, bits] = np.asarray(table.column(name))
    figures = audit_tensor(tensor.reshape(len(MEASURES), *[2] * len(FILTERS)))
    order, step = zip(*steps(), strict=True)
    return pa.table({"part": pa.array([table.column("part")[0].as_py()] * len(order)), "filter_order": pa.array(order),
                     "step": pa.array(step, pa.int32()), **{k: pa.array(v) for k, v in figures.items()}})


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (``lang``; null is the empty string), order of the
    five filters and step: part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley.

    A null text is empty: it fails A, and E where another empty text has a
    smaller doc_id.  Rows without a doc_id pass E, make nobody else fail it
    and have no labels.  Rows repeated with doc_id and text are counted as
    often as they are there; none makes the other fail E.  A document with
    several rows in ``labels`` is good (toxic) if one of them says so.  Other
    columns are not read.  An empty table gives no rows.
    """
    counts = contingency(verdicts(docs, labels))
    return counts.groupBy("part").applyInArrow(_audit_part, OUT)
