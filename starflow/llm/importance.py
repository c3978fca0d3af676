"""Target-distribution importance resampling (operator 12).

Documents that look like the target (the benchmark) are drawn more often.  A
document is a bag of hashed n-grams; a bucket's gain is the logarithm of how
much likelier it is in the target than in the corpus, a document's weight the
mean gain of its features.  Gumbel noise, fixed by seed and doc_id, turns the
highest scores into a sample without replacement.

*Features.*  A table of 256 bytes turns A-Z into a-z and every separator into
a blank; no separator is part of a longer UTF-8 sequence, so whole texts are
translated and split as bytes.  ``zlib.crc32`` takes the value of what came
before as its seed, so an n-gram's value is that of its first n - 1 words
carried on by a blank and the last word: each word is hashed once per length
of run and no n-gram is ever written out.

*On Spark.*  The texts are scanned twice and never shuffled: once to count
buckets (each task sends one row per bucket at most), once to score with the
table of gains, which has one number per bucket however large the corpus.
The draw ranks narrow rows: they are dealt by range of (score, doc_id) and
sorted, each gets its place among its partition's, and the partitions' sizes
(one number each) make it a rank.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.session import materialise

BUCKETS = 10_000
LONGEST = 2
SEED = 7
LEAST_WORDS = 20
PERCENT = 25
# Bytes of a text that are split at a time.
SLICE = 1 << 20

OUT = "doc_id long, n_features long, weight long, score long, rank long"
_SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def _byte_table() -> bytes:
    """Digits, a-z and all bytes of longer sequences stay, A-Z become a-z,
    everything else a blank."""
    lower = bytes(range(256)).lower()
    return bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in lower)


TABLE = _byte_table()


def words_of(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, slice by slice; no word is cut."""
    if len(data) <= SLICE:
        yield data.translate(TABLE).split()
        return
    rest = b""
    for at in range(0, len(data), SLICE):
        part = rest + data[at:at + SLICE].translate(TABLE)
        end = part.rfind(b" ") + 1
        if end:
            yield part[:end].split()
            rest = part[end:]
        else:
            rest = part
    yield rest.split()


def feature_crcs(data: bytes, longest: int = LONGEST) -> Iterator[tuple[int, list[int]]]:
    """(number of words, crc32 of each feature) per slice of a text: of all
    runs of 1 to ``longest`` words, also those across slices."""
    # open_[n]: value of the run of n + 1 words that ends with the last word.
    open_: list[int] = []
    for words in words_of(data):
        if not words:
            continue
        own = list(map(zlib.crc32, words))
        out, spaced, before = own[:], [b" " + w for w in words], own
        tails = [own[-1]]
        for n in range(1, longest):
            # Runs of n + 1 words carry on those of n that end one word earlier.
            seeds = [*open_[n - 1:n], *before[:-1]]
            before = list(map(zlib.crc32, spaced[len(words) - len(seeds):], seeds))
            out += before
            if not before:
                break
            tails.append(before[-1])
        open_ = tails
        yield len(words), out


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features of all texts by bucket.  Each task sends at most one row per
    bucket; only their sums reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                for _, crcs in feature_crcs((text.as_py() or "").encode(), longest):
                    total.update((np.array(crcs, np.int64) % buckets).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.int32()),
                                          pa.array(list(total.values()), pa.int64())], names=["bucket", "n"])

    sums = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():  # one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed likelihood ratio) of each bucket."""
    n, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise of a document in thousandths, the same wherever and how
    often it is asked for."""
    named = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(named.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of each row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            rows = np.zeros((4, len(batch)), np.int64)
            for i, text in enumerate(batch.column("text")):
                n_words = n = total = 0
                for k, crcs in feature_crcs((text.as_py() or "").encode(), longest):
                    n_words, n = n_words + k, n + len(crcs)
                    total += int(table[np.array(crcs, np.int64) % len(table)].sum())
                weight = total // n if n else 0
                rows[:, i] = n_words, n, weight, weight + noise(doc_ids[i], seed)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(r) for r in rows)],
                                             names=["doc_id", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, _SCORED)


def ranked(rows: DataFrame, order: list) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... in the given order, without a task
    that sees them all.  They are written sorted by range, with their place
    in their partition; only the partitions' sizes are collected."""
    spark = rows.sparkSession
    # The id counts the rows of a partition from its number times 2**33.
    placed = materialise(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_at", F.monotonically_increasing_id()), "importance-order")
    part = F.shiftright("_at", 33)
    sizes = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    starts, before = [], 0
    for p, n in sizes:
        starts.append((p, before))
        before += n
    offsets = spark.createDataFrame(starts, "_part long, _start long")
    place = F.col("_at").bitwiseAND((1 << 33) - 1)
    return (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn("rank", F.col("_start") + place + 1).drop("_part", "_start", "_at"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_features, weight, score, rank.

    ``percent`` of the N documents with ``least_words`` words or more are
    drawn (rounded down), those of the highest scores; ``rank`` is their place
    (1 is the highest, ties go to the smaller doc_id), null where undrawn.

    A null or empty text has no features and weight 0.  A repeated row counts
    each time; of rows with one doc_id and one score, that with fewer features
    goes first.  A row without a doc_id has the noise of the empty name and
    loses ties.  An empty ``target`` is taken as even over all buckets.  Other
    columns are not read.  An empty table gives an empty result.
    """
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    scored = materialise(scores(docs, gain, longest, seed), "importance-scores")
    able = F.col("n_words") >= least_words
    drawn = scored.filter(able).count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc()]
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    cols = ["doc_id", "n_features", "weight", "score"]
    return (ranked(scored.filter(able), order).select(*cols, rank.alias("rank"))
            .unionByName(scored.filter(~able).select(*cols, F.lit(None).cast("long").alias("rank"))))
