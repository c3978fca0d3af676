"""Quality classifier: regularised quadratic discriminant (operator 8).

Each text is reduced to a dozen statistics, transformed to be roughly normal
(logs of sizes, smoothed log-odds of shares).  Per class the mean and
covariance follow from sums over the training rows, which Spark adds up, so
all labelled rows are used and only one small matrix per class reaches the
driver.  Covariances are shrunk towards their pooled value and a multiple of
the identity.  A score is the difference of the two Mahalanobis log-densities,
computed with the classes' cached Cholesky factors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from starflow.llm import bpe, words
from starflow.session import materialise

FOLDS = 5
POOL, RIDGE = 0.2, 0.02
PREDICT_FROM = 0.3
SLICE = 1 << 20
FEATURES = ["log_words", "distinct", "repeated", "top_word", "distinct_pairs", "word_bytes",
            "spaces", "lines", "letters", "upper", "digits", "marks", "other_bytes"]


def _byte_class() -> np.ndarray:
    """0 white space but line ends, 1 line end, 2 lower, 3 upper, 4 digit, 5 mark, 6 other."""
    kind = np.full(256, 6, np.uint8)
    kind[33:127] = 5
    kind[97:123], kind[65:91], kind[48:58] = 2, 3, 4
    kind[[32, 9, 11, 12, 13]] = 0
    kind[10] = 1
    return kind


_CLASS = _byte_class()


# Shares are smoothed by some words' or bytes' worth of ordinary prose, so
# that a short text is not judged by the extremes that few words bring.
WORDS_OF_PROSE, BYTES_OF_PROSE = 20, 120
PROSE = {"distinct": 0.8, "repeated": 0.01, "top_word": 0.08, "distinct_pairs": 0.97, "spaces": 0.15, "lines": 0.005,
         "letters": 0.78, "upper": 0.03, "digits": 0.005, "marks": 0.03, "other_bytes": 0.03}


def _odds(name: str, part: np.ndarray, whole: np.ndarray, weight: int) -> np.ndarray:
    share = PROSE[name]
    return np.log((part + weight * share) / (whole - part + weight * (1 - share)))


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES per text (no nulls)."""
    data, offsets = words.buffers(texts)
    starts, ends = words.word_bounds(data, offsets)
    hashes = words.hash_words(data, starts, ends)
    firsts = np.searchsorted(starts, offsets)
    n, n_words, n_bytes = len(texts), np.diff(firsts), np.diff(offsets)
    kind = _CLASS[data]
    per_class = np.zeros((7, n))
    for k in range(7):
        through = np.concatenate([[0], np.cumsum(kind == k)])
        per_class[k] = through[offsets[1:]] - through[offsets[:-1]]
    distinct, top, pairs, repeated = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for i in np.flatnonzero(n_words):
        h = hashes[firsts[i]:firsts[i + 1]]
        s = np.sort(h)
        new = np.flatnonzero(s[1:] != s[:-1])
        distinct[i] = len(new) + 1
        top[i] = np.diff(np.concatenate([[-1], new, [len(s) - 1]])).max()
        if len(h) > 1:
            repeated[i] = np.count_nonzero(h[1:] == h[:-1])
            p = np.sort(h[1:] * np.uint64(3) + h[:-1])
            pairs[i] = np.count_nonzero(p[1:] != p[:-1]) + 1
    n_pairs = np.maximum(n_words - 1, 0)
    def of_words(name, part, whole):
        return _odds(name, part, whole, WORDS_OF_PROSE)

    def of_bytes(name, part):
        return _odds(name, part, n_bytes, BYTES_OF_PROSE)

    in_words = n_bytes - per_class[0] - per_class[1]
    return np.stack([
        np.log1p(n_words), of_words("distinct", distinct, n_words), of_words("repeated", repeated, n_pairs),
        of_words("top_word", top, n_words), of_words("distinct_pairs", pairs, n_pairs),
        np.log((in_words + 5 * WORDS_OF_PROSE) / (n_words + WORDS_OF_PROSE)),
        of_bytes("spaces", per_class[0]), of_bytes("lines", per_class[1]),
        of_bytes("letters", per_class[2] + per_class[3]), of_bytes("upper", per_class[3]),
        of_bytes("digits", per_class[4]), of_bytes("marks", per_class[5]), of_bytes("other_bytes", per_class[6])],
        axis=1)


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, x (array of FEATURES) of every row; a null text is empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, doc_ids = pc.fill_null(batch.column("text"), ""), batch.column("doc_id")
            for a, b in bpe.text_slices(texts, SLICE):
                x = statistics(texts.slice(a, b - a))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * x.shape[1], pa.int32()),
                                                 pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([doc_ids.slice(a, b - a), lists], names=["doc_id", "x"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Model:
    """Per class: log prior plus log-determinant term, mean and the inverse
    Cholesky factor of the shrunk covariance."""

    offsets: list
    means: list
    factors: list
    scale: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """log p(1 | x) - log p(0 | x)."""
        density = []
        for c, m, f in zip(self.offsets, self.means, self.factors, strict=True):
            z = (x - m) @ f.T
            density.append(c - 0.5 * np.einsum("ij,ij->i", z, z))
        return density[1] - density[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log-odds, softened by ``scale`` so that sure cases still differ.
        The posterior PREDICT_FROM keeps its place."""
        at = np.log(PREDICT_FROM / (1 - PREDICT_FROM))
        z = (self.log_odds(x) - at) / self.scale + at
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def fit_moments(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], pool: float = POOL,
                ridge: float = RIDGE) -> Model | None:
    """A model from {class: (n, sum of x, sum of x x')}; None unless both
    classes have rows."""
    if any(k not in moments or not moments[k][0] for k in (0, 1)):
        return None
    total = sum(moments[k][0] for k in (0, 1))
    means = [moments[k][1] / moments[k][0] for k in (0, 1)]
    covs = [moments[k][2] / moments[k][0] - np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = sum(moments[k][0] * covs[k] for k in (0, 1)) / total
    # Shrink on the scale of the pooled standard deviations, so that the unit
    # of a statistic doesn't matter.
    sd = np.sqrt(np.maximum(np.diag(pooled), 1e-9))
    offsets, factors = [], []
    for k in (0, 1):
        c = ((1 - pool) * covs[k] + pool * pooled) / np.outer(sd, sd)
        c = (1 - ridge) * c + ridge * max(np.trace(c) / len(sd), 1e-6) * np.eye(len(sd))
        factor = np.linalg.cholesky(c)
        factors.append(np.linalg.inv(factor) / sd)
        offsets.append(np.log(moments[k][0] / total) - np.log(np.diag(factor)).sum())
    return Model(offsets, means, factors, float(len(sd)))


def held_out(doc_id: str = "doc_id"):
    """crc32 of the decimal doc_id is a multiple of FOLDS."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def class_moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Sums over rows (x, label) per class; one row per class is collected."""
    p = len(FEATURES)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: np.zeros(1 + p + p * p) for k in (0, 1)}
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(-1, p)
            y = np.asarray(batch.column("label"))
            for k in (0, 1):
                own = x[y == k]
                sums[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k in (0, 1) for _ in sums[k]], pa.int32()),
             pa.array([i for k in (0, 1) for i in range(len(sums[k]))], pa.int32()),
             pa.array(np.concatenate([sums[0], sums[1]]))], names=["label", "i", "v"])

    added = (rows.select("x", "label").mapInArrow(partial, "label int, i int, v double")
             .groupBy("label", "i").agg(F.sum("v").alias("v")).collect())
    out = {}
    for k in (0, 1):
        v = np.zeros(1 + p + p * p)
        for r in added:
            if r["label"] == k:
                v[r["i"]] = r["v"]
        out[k] = (v[0], v[1:1 + p], v[1 + p:].reshape(p, p))
    return out


def train(stats: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on the labelled rows outside the held-out fold.  Labels other than
    0 and 1 are ignored; a document labelled more than once counts each time."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col("quality").cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    return fit_moments(class_moments(stats.join(known, "doc_id")))


def apply_model(stats: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score, predicted.  Without a model (a class has no
    labelled row) every score is 0.5."""
    p = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(-1, p)
            s = model.scores(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], names=["doc_id", "score"])

    scored = stats.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"))


def score_column(model: Model | None):
    """The score as a column function of the text, for filters that move no
    row: ``score_column(model)(F.col("text"))``."""
    @F.arrow_udf(DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        texts = pc.fill_null(texts, "")
        parts = [model.scores(statistics(texts.slice(a, b - a))) if model else np.full(b - a, 0.5)
                 for a, b in bpe.text_slices(texts, SLICE)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score


def keep_good(docs: DataFrame, labels: DataFrame, least: float = PREDICT_FROM) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score ``least`` or
    more after training as in ``classify``."""
    model = train(materialise(document_statistics(docs), "quality-statistics"), labels)
    return docs.filter(score_column(model)(F.col("text")) >= least)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text) after training on ``labels``
    (doc_id, quality).

    A null text is empty; an empty text is scored by its statistics like any
    other.  Repeated rows are scored one by one and, if labelled, train once
    each.  A null doc_id is carried through and never trains.  Other columns
    are not read.  An empty table gives an empty result.
    """
    stats = materialise(document_statistics(docs), "quality-statistics")
    return apply_model(stats, train(stats, labels))
