"""Exact deduplication by composable polynomial fingerprints (operator 1).

Texts are equal when they are the same after each run of ASCII white space is
replaced by one space.  The fingerprint of a byte string ``b`` is
``sum(b[i] * X**(n - 1 - i)) mod P`` with P = 2**61 - 1, so that of a
concatenation follows from those of its parts::

    H(uv) = H(u) * X**len(v) + H(v)

A text is cut into chunks; each chunk is a row, hashed wherever it lies, and
a chunk's term ``H(chunk) * X**(bytes after it)`` no longer depends on its
neighbours, so the terms of a huge document are simply added up.

Equal fingerprints are then compared: the chunks at one place of all texts
with one fingerprint are streamed through ``min`` and ``max``.  They are the
same text exactly if both agree at every place.  The comparison is combined
on the map side, so a group of copies that holds a third of all rows sends
one chunk per task, and no task ever holds a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from starflow.llm.columns import free_names, own_columns
from starflow.session import materialise

P = (1 << 61) - 1
X = 0x0F3A_91C5_27D4_6B1D % P
LANE = 4096
CHUNK_CHARS = 1 << 18

# A run that is not already one plain space: the result is that of replacing
# every run, at far fewer replacements.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """White space runs as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def _lane_powers() -> np.ndarray:
    """X**(LANE - 1 - i) mod P as (low 31 bits, high 30 bits), in float64."""
    out, p = np.zeros((LANE, 2)), 1
    for i in range(LANE - 1, -1, -1):
        out[i] = p & 0x7FFFFFFF, p >> 31
        p = p * X % P
    return out


_POWERS = _lane_powers()
_LANE_SHIFT = pow(X, LANE, P)
_INVERSE = pow(X, -1, P)


def fingerprint(data: bytes | memoryview) -> int:
    """H(data).  Lanes of 4096 bytes are hashed as one matrix product, which
    is exact (8 + 31 + 12 bits < 2**53), and combined by shifts."""
    a = np.frombuffer(data, np.uint8)
    h, n = 0, len(a)
    full = n // LANE * LANE
    for at in range(0, full, LANE * 64):
        lanes = a[at:min(at + LANE * 64, full)].reshape(-1, LANE).astype(np.float64) @ _POWERS
        for lo, hi in lanes.tolist():
            h = (h * _LANE_SHIFT + int(lo) + (int(hi) << 31)) % P
    if n > full:
        lo, hi = a[full:].astype(np.float64) @ _POWERS[LANE - (n - full):]
        h = (h * pow(X, n - full, P) + int(lo) + (int(hi) << 31)) % P
    return h


@F.arrow_udf(LongType())
def chunk_term(chunk: pa.Array, after: pa.Array) -> pa.Array:
    """``H(chunk) * X**after`` of each chunk, ``after`` being the number of
    bytes that follow it in its text."""
    offsets = np.frombuffer(chunk.buffers()[1], np.int32, len(chunk) + 1, 4 * chunk.offset).tolist()
    data = memoryview(chunk.buffers()[2] or b"")
    out = []
    for a, b, n in zip(offsets, offsets[1:], after.to_pylist(), strict=False):
        h = fingerprint(data[a:b])
        out.append(h * pow(X, n, P) % P if n else h)
    return pa.array(out, pa.int64())


def chunk_table(docs: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """doc_id, text_sha256, n_bytes, pos, chunk, term: all chunks of all texts."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("t"))
    starts = F.sequence(F.lit(0), F.greatest(F.length("t") - 1, F.lit(0)), F.lit(chunk_chars))
    one = F.length("t") <= chunk_chars
    parts = F.when(one, F.array("t")).otherwise(
        F.transform(starts, lambda s: F.substring(F.col("t"), s + 1, F.lit(chunk_chars))))
    sizes = text.withColumn("parts", parts).select(
        "doc_id", F.sha2(F.col("t"), 256).alias("text_sha256"), F.octet_length("t").cast("long").alias("n_bytes"),
        "parts", F.transform("parts", lambda c: F.octet_length(c).cast("long")).alias("sizes"))
    rows = sizes.select("doc_id", "text_sha256", "n_bytes", "sizes", F.posexplode("parts").alias("pos", "chunk"))
    through = F.aggregate(F.slice("sizes", 1, F.col("pos") + 1), F.lit(0).cast("long"), lambda a, b: a + b)
    return rows.select("doc_id", "text_sha256", "n_bytes", "pos", "chunk",
                       chunk_term(F.col("chunk"), F.col("n_bytes") - through).alias("term"))


def fingerprints(chunks: DataFrame) -> DataFrame:
    """doc_id, text_sha256, n_bytes, fp: the terms of each document added up.

    Terms are below 2**61: they are summed as decimals and reduced once.  A
    row that is there r times brings each of its chunks r times; the sum is
    then r times the fingerprint's."""
    wide = "decimal(38,0)"
    times = (F.count(F.lit(1)) / (F.max("pos") + 1)).cast("decimal(10,0)")
    total = F.sum(F.col("term").cast(wide))
    return (chunks.groupBy("doc_id", "text_sha256", "n_bytes")
            .agg(((total % (times * F.lit(P).cast("decimal(20,0)")).cast(wide)) / times).cast("long").alias("fp")))


def exact_groups(docs: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest doc_id stays.  A null text is
    empty; empty texts are equal.  ``doc_id`` is the key of a document: if a
    row is repeated with its doc_id, one row comes out for each distinct
    (doc_id, text).  Other columns of ``docs`` are not read.  An empty table
    gives an empty result.

    Should two texts share fingerprint and length without being equal, their
    group is split by SHA-256.
    """
    chunks = materialise(chunk_table(docs, chunk_chars), "dedup-chunks")
    docs_fp = materialise(fingerprints(chunks.select("doc_id", "text_sha256", "n_bytes", "pos", "term")), "dedup-fp")
    key = ["fp", "n_bytes"]
    # A document of one chunk has its term as its fingerprint; only the rare
    # longer ones need a join to learn it.
    whole = F.length("chunk") < chunk_chars
    single = chunks.filter(whole & (F.col("pos") == 0) & (F.octet_length("chunk") == F.col("n_bytes")))
    rest = chunks.filter(~(whole & (F.col("pos") == 0) & (F.octet_length("chunk") == F.col("n_bytes"))))
    placed = single.select(F.col("term").alias("fp"), "n_bytes", "pos", "chunk").unionByName(
        rest.drop("n_bytes").join(docs_fp.select("doc_id", "fp", "n_bytes"), "doc_id")
        .select("fp", "n_bytes", "pos", "chunk"))
    compared = placed.groupBy(*key, "pos").agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi"))
    unequal = compared.filter("lo <> hi").select(*key).distinct()
    groups = docs_fp.groupBy(*key).agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Only groups of several documents are met again.  They are written first:
    # a join of two tables can split a group that a third of all rows share.
    several = materialise(groups.filter("group_size > 1").join(unequal.withColumn("split", F.lit(True)), key, "left"),
                          "dedup-groups")
    joined = docs_fp.join(several, key, "left")
    # Fingerprints that different texts share: by the text's SHA-256 instead.
    split = joined.filter("split").drop("keep_id", "group_size")
    by_text = split.groupBy(*key, "text_sha256").agg(F.min("doc_id").alias("keep_id"),
                                                     F.count(F.lit(1)).alias("group_size"))
    split = split.join(by_text, [*key, "text_sha256"])
    keep_id = F.coalesce("keep_id", "doc_id")
    cols = ["doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
            (F.col("doc_id") == keep_id).alias("kept"), "text_sha256"]
    return joined.filter("split IS NULL").select(*cols).unionByName(split.select(*cols))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, without the documents of
    whose text another with a smaller doc_id has a copy.

    Rows repeated with doc_id and text are one row afterwards.  Rows without a
    doc_id stay, all of them; of a doc_id with several texts only those go
    that are copies.
    """
    sha, row, gone_id, gone_sha = free_names(docs, "sha", "row", "gone_id", "gone_sha")
    gone = exact_groups(docs).filter(~F.col("kept")).select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias(gone_id), F.col("text_sha256").alias(gone_sha))
    # Rows are dealt by doc_id and hash once, for both steps.
    keyed = docs.withColumn(sha, F.sha2(normalised(F.col("text")), 256))
    left = keyed.join(gone, (F.col("doc_id") == F.col(gone_id)) & (F.col(sha) == F.col(gone_sha)), "left_anti")
    left = left.withColumn(row, F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()))
    return left.dropDuplicates(["doc_id", sha, "text", row]).select(*own_columns(docs))
