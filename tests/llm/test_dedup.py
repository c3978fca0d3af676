"""Exact and near duplicates and components against brute force."""

import hashlib
import random
from collections import defaultdict

import pyarrow as pa
import pytest
from conftest import SF001
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import LongType

import corpus_pipeline as CP
from starflow.llm import exact_dedup, ngram_join, queries
from starflow.llm.components import components

from .conftest import SPACE, make_docs


def brute_exact(texts):
    """{doc_id: (keep_id, group_size, kept, sha)} of (doc_id, text)."""
    groups = defaultdict(set)
    for i, t in texts:
        groups[SPACE.sub(" ", t or "")].add(i)
    return {i: (min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest())
            for t, g in groups.items() for i in g}


def rows_of(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


def test_fingerprints_compose():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(3 * exact_dedup.LANE + 17))
    whole = exact_dedup.fingerprint(data)
    assert whole == sum(b * pow(exact_dedup.X, len(data) - 1 - i, exact_dedup.P) for i, b in enumerate(data)
                        ) % exact_dedup.P
    for cut in (0, 1, 4096, 5000, len(data)):
        u, v = data[:cut], data[cut:]
        assert whole == (exact_dedup.fingerprint(u) * pow(exact_dedup.X, len(v), exact_dedup.P)
                         + exact_dedup.fingerprint(v)) % exact_dedup.P


@pytest.mark.parametrize("chunk", [7, exact_dedup.CHUNK_CHARS])
def test_op1_edges(edge_docs, no_docs, chunk):
    texts = [(r.doc_id, r.text) for r in edge_docs.filter("doc_id IS NOT NULL").collect()]
    got = exact_dedup.exact_groups(edge_docs.filter("doc_id IS NOT NULL AND length(text) < 6000 OR text IS NULL "
                                                    "AND doc_id IS NOT NULL"), chunk)
    assert rows_of(got) == brute_exact([(i, t) for i, t in texts if len(t or "") < 6000])
    assert exact_dedup.exact_groups(no_docs).count() == 0


def test_op1_colliding_fingerprints(monkeypatch, edge_docs):
    """Groups of one fingerprint are split by their texts."""
    @F.arrow_udf(LongType())
    def same(chunk: pa.Array, after: pa.Array) -> pa.Array:
        return pa.array([7] * len(chunk), pa.int64())

    monkeypatch.setattr(exact_dedup, "chunk_term", same)
    docs = edge_docs.filter("doc_id IS NOT NULL")
    assert rows_of(exact_dedup.exact_groups(docs)) == brute_exact([(r.doc_id, r.text) for r in docs.collect()])


def test_drop_copies(edge_docs):
    kept = exact_dedup.drop_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect()]
    assert sorted(ids) == sorted(i for i, v in brute_exact(
        [(r.doc_id, r.text) for r in edge_docs.filter("doc_id IS NOT NULL").collect()]).items() if v[2])
    assert kept.filter("doc_id IS NULL").count() == 2


def test_copies_of_a_doc_id_with_two_texts(spark):
    a, b = "one text that is there twice", "another text of the same document"
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(1, a), (5, a), (5, b), (5, b), (None, a), (None, a), (None, None), (7, None), (8, "")]
    docs = make_docs(spark, [], extra=rows)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id or 0, r.text or "") for r in kept.collect())) == [
        (0, ""), (0, a), (0, a), (1, a), (5, b), (7, "")]
    docs = make_docs(spark, [], extra=[(1, near), (5, near + " end"), (5, b), (None, near), (3, b + " "), (9, "")])
    kept = ngram_join.keep_one_each(docs, 4, 85)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id or 0, r.text) for r in kept.collect())) == [(0, near), (1, near), (3, b + " "), (9, "")]
    docs = make_docs(spark, [], extra=[(1, near), (5, near + " end"), (5, b)])
    assert sorted((r.doc_id, r.text) for r in ngram_join.keep_one_each(docs, 4, 85).collect()) == [(1, near), (5, b)]


def shingles(text, k):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = [x for x in SPACE.split(low) if x]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute_components(texts, k, percent):
    sets = {i: shingles(t, k) for i, t in texts}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_texts(rng, families=12, copies=6, words=60):
    """Families of copies with a few words changed, on either side of the
    threshold, quoting common passages."""
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=30)
    out = []
    for _ in range(families):
        base = rng.choices(vocabulary, k=rng.randint(2, words))
        if rng.random() < 0.5:
            base = base + passage
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(text))
                text[at:at + 1] = rng.choices(vocabulary, k=rng.randint(0, 2)) or ["end"]
            out.append(" ".join(text).title() if rng.random() < 0.3 else " ".join(text))
    return out


@pytest.mark.parametrize("k,percent,frequent", [(4, 85, 16), (4, 85, 2), (2, 60, 2), (5, 80, 3)])
def test_op9_against_brute_force(spark, monkeypatch, k, percent, frequent):
    """Also with nearly all tokens frequent, so that combinations are indexed,
    and with clusters of many blocks."""
    monkeypatch.setattr(ngram_join, "FREQUENT_FROM", frequent)
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", 2000)
    texts = list(enumerate(near_texts(random.Random(frequent * k))))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs, k, percent).collect()}
    assert got == brute_components(texts, k, percent)


@pytest.mark.parametrize("seed", range(6))
def test_index_never_misses_a_link(seed):
    """Any two sets that link share an index entry, whichever tokens are frequent."""
    import numpy as np
    rng = np.random.default_rng(seed)
    percent, end = int(rng.choice([60, 80, 85])), ngram_join._region_end()
    for _ in range(300):
        n = int(rng.integers(1, 120))
        both = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
        drop = rng.integers(0, max(1, n // 5) + 1)
        a = np.unique(both)
        b = np.unique(np.concatenate([both[drop:], rng.integers(0, 2**63, rng.integers(0, 3), dtype=np.uint64)]))
        common = rng.random(len(a) + len(b)) < rng.choice([0.0, 0.5, 1.0])
        frequent = set(np.concatenate([a, b])[common].tolist())
        shared = len(np.intersect1d(a, b))
        if not len(b) or 100 * shared < percent * (len(a) + len(b) - shared):
            continue
        entries = [ngram_join.signatures(
            s, (s < end) & np.array([x not in frequent for x in s.tolist()], bool), percent) for s in (a, b)]
        assert np.array_equal(a, b) or len(np.intersect1d(*entries))


def short_sets(n, own=1, size=20):
    """Sets of one template: all tokens but the last ``own`` are common."""
    import numpy as np
    rng = np.random.default_rng(3)
    common = rng.integers(0, 2**63, size - own, dtype=np.uint64)
    return [np.unique(np.concatenate([common, rng.integers(0, 2**63, own, dtype=np.uint64)])) for _ in range(n)]


def test_blocks_of_short_sets_take_little_memory():
    import tracemalloc

    import numpy as np
    sets, ids = short_sets(7000), np.arange(7000)
    tracemalloc.start()
    links = ngram_join.block_links(ids, sets, np.zeros(7000, bool), 85)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    root = list(range(7000))
    for a, b in sorted(links):
        root[a] = min(root[a], root[b])
    assert root == [0] * 7000
    assert peak < 600 << 20


@pytest.mark.parametrize("block_sets", [7, 64, 4096])
def test_blocks_are_bounded_in_sets(spark, block_sets):
    """Blocks of few sets link what one block does, over all size levels."""
    sets = [s for size in (5, 8, 9, 10, 11, 12, 30) for s in short_sets(40, size=size)]
    rows = [(i, bytearray(s.tobytes())) for i, s in enumerate(sets)]
    table = spark.createDataFrame(rows, "doc_id long, set binary")
    clusters = spark.createDataFrame([(i, 0) for i in range(len(sets))], "id long, component long")
    links = ngram_join.linked_blocks(clusters, table, 80, 2 << 20, block_sets)
    got = {r.id: r.component for r in components(links).collect()}
    root = list(range(len(sets)))
    own = [set(s.tolist()) for s in sets]
    for x in range(len(sets)):
        for y in range(x):
            both = len(own[x] & own[y])
            if 100 * both >= 80 * (len(own[x]) + len(own[y]) - both):
                p, q = sorted((root[x], root[y]))
                root = [p if r == q else r for r in root]
    assert [got.get(i, i) for i in range(len(sets))] == root


def test_short_texts_of_one_template_share_no_hub():
    """Texts too short to link when they differ in the last word."""
    import numpy as np
    met = {}
    for x, s in enumerate(short_sets(200, size=9)):
        rare = np.zeros(9, bool)
        for sig, hub in zip(*ngram_join.entries_of(s, rare, 85), strict=True):
            met.setdefault(int(sig), []).append((x, hub))
    assert max(len(m) for m in met.values()) == 200
    assert not any(any(h for _, h in m) for m in met.values() if len(m) > 1)


def test_op9_short_texts_of_one_template(spark):
    rng = random.Random(8)
    texts = []
    for words in (6, 9, 11, 14, 18, 25):
        base = [f"t{words}x{i}" for i in range(words)]
        texts += [" ".join([*base[:-1], f"u{words}y{i}"]) for i in range(40)]
        texts += [" ".join(base[:-1]), " ".join(base), " ".join(base[rng.randint(1, 2):])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs).collect()}
    assert got == brute_components(list(enumerate(texts)), 4, 85)


def test_op9_frequent_tokens_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT_FROM", 2)
    monkeypatch.setattr(ngram_join, "FREQUENT_TOKENS", 5)
    docs = spark.createDataFrame(list(enumerate(near_texts(random.Random(2)))), "doc_id long, text string")
    tokens, least = ngram_join.frequent_tokens(docs, 4)
    assert len(tokens) <= 5 and least > 2
    rows = ngram_join.jaccard_components(docs).collect()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_components(texts, 4, 85)


def test_op9_edges(edge_docs, no_docs):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(edge_docs).collect()}
    texts = [(r.doc_id, r.text) for r in edge_docs.filter("doc_id IS NOT NULL").collect()]
    want = {(i, *v) for i, v in brute_components(texts, 4, 85).items()}
    assert {r for r in got if r[0] is not None} == want
    assert {r for r in got if r[0] is None} == {(None, 1, None), (None, 0, None)}
    assert ngram_join.jaccard_components(no_docs).count() == 0
    kept = ngram_join.keep_one_each(edge_docs, 4, 85)
    assert kept.columns == edge_docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, c in want if i == c} | {None}


def test_op9_query(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op9_ngram_join(spark, SF001).collect()}
    assert got == brute_components([(r.doc_id, r.text) for r in docs], 4, 85)


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(i, i + 1) for i in range(1000, 1040)] + [(2000, 2000 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        if a is not None and a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    df = spark.createDataFrame(links, "a long, b long")
    assert {(r.id, r.component) for r in components(df).collect()} == {(i, find(i)) for i in list(root)}
    assert components(df.limit(0)).count() == 0


def test_shared_runs_of_entries():
    """Entries with a hub and several nodes, however the rows are cut."""
    for trial in range(400):
        rng = random.Random(trial)
        rows = [(s, node * 7 + s, 5, role) for s in range(rng.randrange(1, 8)) for node in range(rng.choice([1, 1, 2, 6]))
                for role in [rng.choice([-1, 0, 3])] for _ in range(rng.choice([1, 1, 2, 4]))]
        rows.sort(key=lambda r: (r[0], -r[3], r[1]))
        runs = [[r for r in rows if r[0] == s] for s in {r[0] for r in rows}]
        want = {r for g in runs if g[0][3] >= 0 and len({r[1] for r in g}) > 1 for r in g}
        cuts = sorted(rng.sample(range(len(rows) + 1), min(len(rows), rng.randrange(0, 6))))
        batches = [pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows[a:b]], t) for i, t in enumerate([pa.int64()] * 2 + [pa.int32()] * 2)],
            names=["sig", "node", "n", "singles"]) for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
        got = [tuple(r.values()) for b in ngram_join._shared_runs(iter(batches)) for r in b.to_pylist()]
        assert len(got) == len(set(got)) and set(got) == want


CLASHES = ["_sha", "_row", "_key", "sha", "row", "key", "gone_id", "GONE_SHA", "a.b", "`", "component_id", "kept",
           "text_sha256", "first", "rep", "sig"]


@pytest.mark.parametrize("texts", [["x y z w v", "x y z w v", "a b c d e f g h", None, ""], []])
@pytest.mark.parametrize("twice", [False, True])
def test_columns_of_any_name_come_back_unchanged(spark, texts, twice):
    """Through every stage of the pipeline that keeps rows, also where a
    doc_id has two texts."""
    rows = [(i, t, *[f"{c}{i}" for c in CLASHES]) for i, t in enumerate(texts)]
    if twice and rows:
        rows += [(2, "another text of it", *[f"{c}2b" for c in CLASHES]), (None, "no id", *["none"] * len(CLASHES))]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           *[T.StructField(c, T.StringType()) for c in CLASHES]])
    docs = spark.createDataFrame(rows, schema)
    for name, stage in CP.STAGES[:-1]:
        if name == "quality":
            continue  # a filter, asked below
        out = stage(spark, docs, SF001)
        assert out.schema == docs.schema
        got = [tuple(r) for r in out.collect()]
        assert set(got) <= set(rows) and len(got) >= len(rows) - 2, name
    assert CP.STAGES[0][1](spark, docs, SF001).schema == docs.schema
