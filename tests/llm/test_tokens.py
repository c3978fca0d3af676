"""Encoding, token shards, token counts and packing against the libraries."""

import io
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF001
from starflow.llm import bpe, packing, queries, token_counts, wavelet

SPACE = re.compile(r"[\x20\x09-\x0D]+")
ODD = ["a b", "  Hello World!! it's don't 3.14 foo_bar", "", None, "İstanbul ÉCOLE é ﬁn Σας ΣΑΣ x<|endoftext|>y z",
       "a\x0bb c d\x1ce \x85f  .. ., a.,b hello.'s hello,.\x00 ŉ ǆ Ǆ ß ẞ 中文 🎉 ª º", "<|ENDOFTEXT|> <|EndOfText|>"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.default_tokenizer_path())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("cached", [3, 1000])
def test_batch_encoder_is_the_library(library, cached):
    enc = bpe.BatchEncoder(bpe.default_tokenizer_path(), cached_words=cached)
    for _ in range(2):
        ids, n = enc.encode(pa.array(ODD))
        ends = np.cumsum(n)
        for t, e, c in zip(ODD, ends, n, strict=True):
            assert ids[e - c:e].tolist() == ids_of(library, t)


def test_slices_cover_all_rows():
    texts = pa.array(["a" * k for k in (0, 5, 50, 3, 3, 3)] + [None])
    parts = list(bpe.text_slices(texts, 6))
    assert [i for a, b in parts for i in range(a, b)] == list(range(7))


class Memory(io.BytesIO):
    def read_at(self, n, offset):
        self.seek(offset)
        return self.read(n)


@pytest.mark.parametrize("n,top,block", [(0, 1, 8), (1, 1, 8), (7, 2, 8), (500, 3, 8), (3000, 49408, 16),
                                         (70_000, 70_000, 64)])
def test_wavelet_matrix(n, top, block):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n).astype(np.uint32)
    shard = wavelet.Shard(Memory(wavelet.build(ids, np.array([5, 9]), np.array([n, 0]), block)))
    assert shard.doc_ids.tolist() == [5, 9] and shard.counts.tolist() == [n, 0]
    assert shard.decode().tolist() == ids.tolist()
    for i in rng.integers(0, n, 20).tolist() if n else []:
        assert shard.access(i) == ids[i]
        v = int(ids[i])
        assert shard.rank(v) == (ids == v).sum()
        assert shard.rank(v, i) == (ids[:i] == v).sum()
        k = int((ids[:i] == v).sum())
        assert shard.select(v, k) == i
    assert shard.rank(top + 1) == 0
    with pytest.raises(IndexError):
        shard.access(n)
    with pytest.raises(IndexError):
        shard.select(top + 1, 0)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_shards(rows, texts, library):
    at = 0
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows), key=lambda r: (r[1], r[2]))
    want = []
    for i, t in texts:
        ids = [*ids_of(library, t), 1]
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    assert got == want


def test_op2_round_trip(spark, library):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    rows = queries.op2_token_shards(spark, SF001).collect()
    check_shards(rows, [(r.doc_id, r.text) for r in docs], library)


def test_op2_small_shards(spark, library, edge_docs, no_docs, tmp_path):
    manifest = wavelet.write_shards(edge_docs.filter("doc_id IS NOT NULL"), f"file://{tmp_path}/s",
                                    bpe.default_tokenizer_path(), shard_ids=50)
    assert manifest.count() > 2
    texts = sorted((r.doc_id, r.text or "") for r in edge_docs.collect() if r.doc_id is not None)
    check_shards(wavelet.read_documents(manifest).collect(), texts, library)
    assert wavelet.encode_to_shards(spark, no_docs).count() == 0
    assert wavelet.encode_to_shards(spark, edge_docs).filter("doc_id IS NULL").count() == 2


def test_best_fit_decreasing():
    rng = random.Random(3)
    for cap in (1, 10, 64):
        sizes = [rng.randint(1, cap) for _ in range(400)]
        got = packing.best_fit_decreasing(sizes, cap)
        assert sorted(k for w in got for k in w) == list(range(len(sizes)))
        rooms, want = [], []
        for k in sorted(range(len(sizes)), key=lambda j: -sizes[j]):
            fits = [r for r in rooms if r >= sizes[k]]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - sizes[k])
            else:
                rooms.append(cap - sizes[k])
        want = sorted(cap - r for r in rooms)
        assert sorted(sum(sizes[k] for k in w) for w in got) == want
    with pytest.raises(ValueError):
        packing.best_fit_decreasing([5], 4)


def check_pieces(rows, texts, library, capacity):
    ids = {i: [*ids_of(library, t), 2] for i, t in texts}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == crc(ids[r.doc_id][r.start:r.start + r.length])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    for i, p in pieces.items():
        at = 0
        for start, length in sorted(p):
            assert start == at and length > 0
            at += length
        assert at == len(ids[i])
    padding = 0
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def test_op5_packing(spark, library):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op5_packing(spark, SF001).collect()
    padding = check_pieces(rows, [(r.doc_id, r.text) for r in docs], library, packing.CAPACITY)
    assert padding < 0.02 * sum(r.length for r in rows)


@pytest.mark.parametrize("block", [10, 1 << 20])
def test_op5_edges(spark, library, edge_docs, no_docs, block):
    docs = edge_docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = packing.pack(docs, capacity=64, block_ids=block).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()], library, 64)
    assert packing.pack(edge_docs).count() >= edge_docs.count()
    assert packing.pack(no_docs).count() == 0


def reference_count(words):
    """Best segmentation by the tokenizers library's unigram model."""
    from tokenizers import Tokenizer, models
    pieces = token_counts.read_pieces(token_counts.default_piece_path())
    model = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces.items()], 0, False))
    out = []
    for w in words:
        s = token_counts.WORD_START + w
        e = model.encode(s, add_special_tokens=False)
        out.append(sum(len(s[a:b].encode()) if i == 0 else 1 for (a, b), i in zip(e.offsets, e.ids, strict=True)))
    return out


def test_op4_counts(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(40).collect()
    words = [[w for w in SPACE.split(r.text) if w] for r in docs]
    counts = dict(zip({w: 0 for ws in words for w in ws}, reference_count({w: 0 for ws in words for w in ws}),
                      strict=True))
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in queries.op4_token_counts(spark, SF001).collect()}
    assert len(got) == spark.read.parquet(f"{SF001}/documents.parquet").count()
    for r, ws in zip(docs, words, strict=True):
        assert got[r.doc_id] == (len(ws), sum(counts[w] for w in ws))


def test_op4_edges(spark, edge_docs, no_docs):
    got = token_counts.count_tokens(edge_docs).collect()
    assert len(got) == edge_docs.count() and token_counts.count_tokens(no_docs).count() == 0
    by_id = {r.doc_id: r for r in got}
    assert (by_id[0].n_words, by_id[0].n_tokens, by_id[2].n_tokens) == (0, 0, 0)
    assert by_id[12].n_words == 3 and by_id[9].n_words == 8000
    counter = token_counts.TokenCounter(token_counts.default_piece_path(), cached_words=2)
    words = ["ab", "abc", "b", "ab", "中文", "a\x00b"]
    assert counter.count(pa.array(words))[1].tolist() == reference_count(words)
    assert sum(counter.count(pa.array([" ".join(words)]))[1]) == sum(reference_count(words))


def test_words_learnt_in_groups_give_the_same_ids(library, monkeypatch):
    import pyarrow as pa
    texts = pa.array(["one two, three; 4 five's É 中文 <|x|> " * 3, None, "", "six seven eight nine ten\televen"])
    asked = []
    whole = bpe.BatchEncoder(bpe.default_tokenizer_path()).encode(texts)
    monkeypatch.setattr(bpe, "LEARNT_AT_ONCE", 3)
    enc = bpe.BatchEncoder(bpe.default_tokenizer_path())
    word_ids = enc._word_ids
    enc._word_ids = lambda words: asked.append(len(words)) or word_ids(words)
    ids, counts = enc.encode(texts)
    assert ids.tolist() == whole[0].tolist() and counts.tolist() == whole[1].tolist()
    assert len(asked) > 1 and max(asked) <= 3
