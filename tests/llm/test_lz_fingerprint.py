"""Lempel-Ziv phrase fingerprints against phrases kept as a set of strings."""

import hashlib

import numpy as np
from conftest import SF001
from pyspark.sql import functions as F

from starflow.llm import lz_fingerprint as L
from starflow.llm import queries

from .conftest import EDGE_TEXTS, make_docs


def brute_phrases(text):
    data, known, start = (text or "").encode(), set(), 0
    for i in range(1, len(data) + 1):
        if data[start:i] not in known:
            known.add(data[start:i])
            start = i
    return known


def brute_jaccard(a, b):
    x, y = brute_phrases(a), brute_phrases(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def brute_edits(docs):
    """(doc_id, text, edited, next text) of each row, last document first."""
    own = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (doc_id, text) in enumerate(own):
        text, after = text or "", own[(i + 1) % len(own)][1] or ""
        n = len(text) // 3
        out.append((doc_id, text, text[:len(text) - n] + after[:n], after))
    return out


def check(rows, docs, tolerance=0.2):
    """Each row against exact phrase sets; signatures of few phrases are
    exact."""
    want = {d[0]: d for d in brute_edits(docs)}
    assert len(rows) == len(docs) and {r.doc_id for r in rows} == set(want)
    for r in rows:
        _, text, edited, after = want[r.doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == L.fingerprint(text) and r.edited_fingerprint == L.fingerprint(edited)
        for got, other in ((r.near_edited, edited), (r.near_next, after)):
            exact = brute_jaccard(text, other)
            few = len(brute_phrases(text) | brute_phrases(other)) <= L.SLOTS
            assert abs(got - exact) < (1e-12 if few else tolerance), (r.doc_id, got, exact)


def test_op11_phrases():
    """Phrases are those of a dictionary of strings, also when a parse is
    carried on from a copy."""
    for t in [x or "" for x in EDGE_TEXTS] + ["abababababab", "é" * 50]:
        data = t.encode()
        for cut in (0, 1, len(data) // 2, len(data)):
            first = L.Parse().feed(data[:cut])
            again = first.copy()
            first.feed(b"something else " * 20)
            ends = again.feed(data[cut:]).ends
            got = [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            assert len(set(got)) == len(got) and set(got) == brute_phrases(t)
            assert len(set(L.phrase_hashes(data, ends).tolist())) == len(got)
            k = len(ends) // 2
            assert (L.phrase_hashes(data, ends)[k:] == L.phrase_hashes(data, ends, k)).all()


def test_op11_signatures():
    rng = np.random.default_rng(1)
    for n in (0, 5, 127, 128, 129, 2000):
        a, b = (rng.integers(0, 3000, n).astype(np.uint32) for _ in range(2))
        sa, sb = L.signature(a), L.signature(b)
        assert sa.tolist() == sorted(set(a.tolist()))[:L.SLOTS]
        assert (L.decode(L.encode(sa)) == sa).all()
        union = sorted(set(a.tolist()) | set(b.tolist()))[:L.SLOTS]
        both = set(a.tolist()) & set(b.tolist())
        assert L.likeness(sa, sb) == (sum(x in both for x in union) / len(union) if union else 1.0)


def test_op11_cells(spark, no_docs):
    """Every bucket size gives the same rows: one document a bucket, some, one
    bucket in all."""
    docs = make_docs(spark, EDGE_TEXTS)
    for name in ("h", "place", "fingerprint", "near_next", "a.b"):
        docs = docs.withColumn(name, docs["lang"])
    plain = list(enumerate(EDGE_TEXTS))
    seen = []
    for bucket_rows in (1, 3, 1000):
        rows = L.edited_likeness(docs, bucket_rows=bucket_rows).collect()
        check(rows, plain)
        seen.append(sorted(map(tuple, rows)))
    assert seen[0] == seen[1] == seen[2]
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].fingerprint == "" == by_id[1].fingerprint and by_id[12].fingerprint == by_id[13].fingerprint
    assert L.edited_likeness(no_docs).count() == 0
    one = L.edited_likeness(make_docs(spark, ["just one text here"])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert sorted(map(tuple, L.fingerprints(docs).collect())) == sorted((r.doc_id, r.fingerprint) for r in rows)


def test_op11_repeated_rows_and_missing_ids(spark, edge_docs):
    """Rows without a doc_id come last, equal ones follow one another."""
    seen = []
    for bucket_rows in (1, 2, 1000):
        rows = L.edited_likeness(edge_docs, bucket_rows=bucket_rows).collect()
        assert len(rows) == edge_docs.count()
        seen.append(sorted(map(tuple, rows), key=str))
    assert seen[0] == seen[1] == seen[2]
    twice = [r for r in rows if r.doc_id == 13]
    assert len(twice) == 2 and max(r.near_next for r in twice) == 1.0


def test_op11_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    rows = queries.op11_lz_fingerprint(spark, SF001).collect()
    check(rows, docs)
    assert sum(r.near_edited > r.near_next for r in rows if r.n_chars > 30) > 0.95 * sum(r.n_chars > 30 for r in rows)
    many = L.edited_likeness(spark.read.parquet(f"{SF001}/documents.parquet"), bucket_rows=7)
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, rows))
    assert many.filter(F.col("near_edited").between(0, 1) & F.col("near_next").between(0, 1)).count() == len(rows)
