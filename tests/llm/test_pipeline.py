"""The pipeline's stages one by one against brute force."""

from conftest import SF001

import corpus_pipeline as CP
from starflow.llm import packing, quality

from .test_dedup import brute_components, brute_exact
from .test_text import brute_leaks
from .test_tokens import check_pieces, library  # noqa: F401


def test_stages(spark, library, tmp_path):  # noqa: F811
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, table = docs.columns, {}
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    for name, stage in CP.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, SF001)
        out.write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        table[name] = (docs, before, after)
        if name != "packing":
            assert after.columns == columns
            docs = after

    def ids(df):
        return sorted(r.doc_id for r in df.select("doc_id").collect())

    first, before, after = table["quality"]
    scored = {r.doc_id: r.predicted for r in quality.classify(first, labels).collect()}
    assert ids(after) == sorted(i for i, _ in before if scored[i])
    _, before, after = table["exact_dedup"]
    assert ids(after) == sorted(i for i, v in brute_exact(before).items() if v[2])
    _, before, after = table["near_dedup"]
    assert ids(after) == sorted(
        i for i, v in brute_components(before, CP.NEAR_SHINGLE, CP.NEAR_PERCENT).items() if v[1] == i)
    _, before, after = table["decontamination"]
    gone = {d for d, _ in brute_leaks([(i, t) for i, t in before if len(t) < 8000], items)}
    assert gone == {i for i, t in before if len(t) < 8000} - set(ids(after))
    _, before, after = table["packing"]
    check_pieces(after.collect(), before, library, packing.CAPACITY)


def test_run_over_edge_cases(spark, edge_docs, no_docs):
    """Nulls, empty and repeated rows, and an empty table, through each stage."""
    for docs in (edge_docs, no_docs):
        for _, stage in CP.STAGES[:-1]:
            out = stage(spark, docs, SF001)
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert CP.STAGES[-1][1](spark, docs, SF001).count() >= docs.count()


def test_run(spark):
    rows = CP.run(spark, SF001).collect()
    assert rows and {r.doc_id for r in rows} <= {
        r.doc_id for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
