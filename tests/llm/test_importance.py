"""Importance resampling against a plain reading of its definition."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from conftest import SF001

from starflow.llm import importance, queries

from .conftest import EDGE_TEXTS, make_docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_features(text, longest=2):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def brute(docs, items):
    """(doc_id, n_features, weight, score, rank) of all rows, sorted."""
    source, target = Counter(), Counter()
    for _, t in docs:
        source.update(brute_features(t)[1])
    for t in items:
        target.update(brute_features(t)[1])
    s_all, t_all = sum(source.values()), sum(target.values())
    gain = [math.floor(1000 * math.log((target[b] + 1) * (s_all + 10000) / ((source[b] + 1) * (t_all + 10000))))
            for b in range(10000)]
    rows = []
    for i, t in docs:
        n_words, f = brute_features(t)
        weight = math.floor(sum(gain[b] for b in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(f), weight, score, n_words))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = able[:25 * len(able) // 100]
    left = able[len(drawn):] + [r for r in rows if r[4] < 20]
    return sorted([(*r[:4], k) for k, r in enumerate(drawn, 1)] + [(*r[:4], None) for r in left], key=str)


def plain(rows):
    return sorted([(r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in rows], key=str)


ODD = ["A-B_c9ß É中文 x", "\x00\x1f/0:@AZ[`az{\x7f\u0080", "don't STOP 3.14", "é" * 30 + " É", "  a b",
       " ".join(f"w{i}" for i in range(19)), " ".join(f"w{i}" for i in range(20)), "w1 w2 " * 4000]


def test_op12_features(monkeypatch):
    """Runs of words, also across slices."""
    for size in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(importance, "SLICE", size)
        for longest in (1, 2, 3):
            for t in [x or "" for x in EDGE_TEXTS + ODD]:
                words, crcs = 0, []
                for n, here in importance.feature_crcs(t[:4000].encode(), longest):
                    words, crcs = words + n, crcs + here
                assert (words, sorted(c % 10000 for c in crcs)) == (
                    brute_features(t[:4000], longest)[0], sorted(brute_features(t[:4000], longest)[1]))


def test_op12_cells(spark, no_docs):
    texts = EDGE_TEXTS + ODD + [" ".join(f"w{(i * j) % 31}" for i in range(25)) for j in range(30)]
    docs = make_docs(spark, texts, extra=[(3, "word"), (None, "w1 w2 " * 20), (None, "w3 w4 " * 15), (30, texts[30])])
    for name in ("n_words", "rank", "score", "_at", "bucket", "a.b"):
        docs = docs.withColumn(name, docs["lang"])
    items = spark.createDataFrame([(0, "w1 w2 w3 w1 w2"), (1, None), (2, "x y z")], "item_id long, text string")
    rows = importance.resample(docs, items).collect()
    assert plain(rows) == brute([(d.doc_id, d.text) for d in docs.collect()], [r.text for r in items.collect()])
    assert sorted(r.rank for r in rows if r.rank) == list(range(1, 1 + sum(r.rank is not None for r in rows)))
    assert importance.resample(no_docs, items).count() == 0
    assert importance.resample(docs, items.limit(0)).count() == docs.count()


def test_op12_draws_what_looks_like_the_target(spark):
    """Documents in the target's words are drawn more often than others."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"{'ab'[i % 2]}{w}" for w in rng.integers(0, 200, 40)) for i in range(400)]
    target = spark.createDataFrame([(0, " ".join(f"a{w}" for w in rng.integers(0, 200, 2000)))],
                                   "item_id long, text string")
    rows = importance.resample(make_docs(spark, texts), target).collect()
    drawn = [r.doc_id % 2 for r in rows if r.rank]
    assert len(drawn) == 100 and drawn.count(0) > 60


def test_op12_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    assert plain(queries.op12_importance(spark, SF001).collect()) == brute(docs, items)
