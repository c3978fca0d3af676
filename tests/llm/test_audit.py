"""Filter interaction audit against a simulation of every order."""

import itertools
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from starflow.llm import filter_audit, queries
from starflow.llm.sql import ORACLE_SQL

from .conftest import SPACE, make_docs

LABELS = "doc_id long, quality int, toxic int"


def failures(doc_id, text, ids_of):
    """The filters that one document fails."""
    t = text or ""
    words = [w for w in SPACE.split(t) if w]
    capitals = sum("A" <= c <= "Z" for c in t)
    return {f for f, fails in {
        "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * capitals > 10 * len(t),
        "D": any(c in t for c in "#$%&*|"),
        "E": doc_id is not None and any(i < doc_id for i in ids_of[t])}.items() if fails}


def brute_audit(docs, labels):
    """Every order run filter by filter over the documents that are left."""
    ids_of = defaultdict(set)
    for d in docs:
        if d.doc_id is not None:
            ids_of[d.text or ""].add(d.doc_id)
    good = {r.doc_id for r in labels if r.quality == 1 and r.doc_id is not None}
    toxic = {r.doc_id for r in labels if r.toxic == 1 and r.doc_id is not None}
    parts = defaultdict(list)
    for d in docs:
        parts[d.lang or ""].append((d.doc_id, failures(d.doc_id, d.text, ids_of)))
    out = {}
    for part, rows in parts.items():
        shapley, here = Counter(), {}
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                fail = sum(f in d[1] for d in rows)
                here[part, "".join(order), step] = [
                    len(left), len(gone), fail - len(gone), sum(d[1] == {f} for d in rows),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone)]
                shapley[f] += len(gone)
        out.update({k: tuple([*v, shapley[k[1][k[2] - 1]]]) for k, v in here.items()})
    return out


def as_table(rows):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}


WORDS = " ".join(f"w{i}" for i in range(120))
TEXTS = [WORDS, WORDS, WORDS + " $", WORDS.upper(), "w " * 120, "SHORT", "", None, "a\u000bb c # É", WORDS + "\n",
         "A" + "b" * 9, "A" + "b" * 8, " ".join(f"w{i % 80}" for i in range(100)), "lang gone", "x"]


def test_op13_cells(spark, no_docs):
    docs = make_docs(spark, TEXTS, extra=[(0, WORDS), (None, WORDS), (None, None), (None, WORDS)])
    docs = docs.withColumn("lang", F.when(F.col("text") == "lang gone", F.lit(None)).when(
        F.col("doc_id") % 3 == 0, "de").when(F.col("text") == "x", "").otherwise("en"))
    for name in ("part", "bits", "sha", "good", "toxic", "is_first", "quality", "a.b"):
        docs = docs.withColumn(name, F.lit("clash"))
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 1), (1, 0, 0), (2, None, None), (3, 0, 1), (None, 1, 1),
                                    (99, 1, 1), (6, 1, None)], LABELS)
    rows = filter_audit.audit(docs, labels).collect()
    assert as_table(rows) == brute_audit(docs.select("doc_id", "text", "lang").collect(), labels.collect())
    assert len(rows) == 3 * 600
    assert filter_audit.audit(no_docs, labels).count() == 0
    none = spark.createDataFrame([], LABELS)
    assert all(r.good_lost == 0 and r.toxic_lost == 0 for r in filter_audit.audit(docs, none).collect())


def test_op13_contractions():
    """Every figure of random tensors by adding up their cells."""
    rng = np.random.default_rng(5)
    tensor = rng.integers(0, 1 << 40, (3, 2, 2, 2, 2, 2))
    got = filter_audit.audit_tensor(tensor)
    cells = list(itertools.product((0, 1), repeat=5))
    for at, (order, step) in enumerate(filter_audit.steps()):
        if at % 37:
            continue
        axis = {f: i for i, f in enumerate("ABCDE")}
        here = [axis[f] for f in order[:step]]
        kept = [c for c in cells if not any(c[i] for i in here)]
        gone = [c for c in cells if c[here[-1]] and not any(c[i] for i in here[:-1])]
        assert got["kept"][at] == sum(int(tensor[0][c]) for c in kept)
        assert got["removed"][at] == sum(int(tensor[0][c]) for c in gone)
        assert got["toxic_lost"][at] == sum(int(tensor[2][c]) for c in gone)


@pytest.mark.parametrize("sf", [SF001])
def test_op13_query(spark, sf):
    rows = queries.op13_filter_audit(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = brute_audit(docs, spark.read.parquet(f"{sf}/labels.parquet").collect())
    assert as_table(rows) == want
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    res = con.execute(ORACLE_SQL["op13_filter_audit"])
    at = [[x[0] for x in res.description].index(c) for c in rows[0].__fields__]
    assert sorted(tuple(r) for r in rows) == sorted(tuple(r[i] for i in at) for r in res.fetchall())
