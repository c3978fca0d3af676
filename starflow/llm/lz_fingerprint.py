"""Document fingerprints of Lempel-Ziv phrases (operator 11).

A document is parsed as a dictionary compressor would: each phrase is the
longest one known plus one byte, and is known from then on.  Documents that
would compress each other well have phrases in common, so their likeness is
that of their phrase sets.  The fingerprint keeps the SLOTS smallest hashes of
the set (a minimum-hash signature); of two fingerprints, the share of the
SLOTS smallest hashes of both that is in either one estimates the Jaccard
similarity.  With SLOTS phrases or fewer it is exact.

The dictionary is a trie whose edges are one integer each, so a byte costs one
look-up however long its phrase is, and what is parsed before an edit is
parsed once for both texts: the parse of the edited text goes on from a copy
of the trie at the edit.

*Neighbours on Spark.*  The edited text takes its end from the next document
by doc_id, so neighbours must meet.  Documents are dealt by doc_id into
buckets of about equal size whose bounds are keys of the table itself: the
first document of a bucket, known by its key, is sent to the bucket before it
as well, behind that one's last.  One exchange, no window over the table; a
task streams its sorted bucket and holds two documents.  The bounds are the
only keys that reach the driver, about BUCKETS * PER_BUCKET sampled ones at most,
whatever the size of the corpus; they decide the buckets' sizes, never the
result.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from starflow.llm import words

SLOTS = 128
# Documents a bucket should have, the most buckets there are, and the keys
# that are sampled for each of them.
BUCKET_ROWS = 4096
BUCKETS = 20_000
PER_BUCKET = 20

OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")
_CODES = words.mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))


class Parse:
    """The phrases of a text so far; can be carried on, also from a copy."""

    def __init__(self):
        self.trie: dict[int, int] = {}
        self.node, self.at, self.ends = 0, 0, []

    def copy(self) -> Parse:
        out = Parse()
        out.trie, out.node, out.at, out.ends = self.trie.copy(), self.node, self.at, self.ends[:]
        return out

    def feed(self, data: bytes) -> Parse:
        trie, node, ends = self.trie, self.node, self.ends
        get, new = trie.get, len(trie) + 1
        for i, byte in enumerate(data, self.at + 1):
            edge = node << 8 | byte
            node = get(edge)
            if node is None:
                trie[edge] = new
                new += 1
                ends.append(i)
                node = 0
        self.node, self.at = node, self.at + len(data)
        return self


def phrase_hashes(data: bytes, ends: list[int], skip: int = 0) -> np.ndarray:
    """One 32-bit hash per phrase, but for the first ``skip``: phrases follow
    one another from 0 on.  What is left after the last phrase is one that is
    known."""
    if len(ends) == skip:
        return np.zeros(0, np.uint32)
    begin = ends[skip - 1] if skip else 0
    bounds = np.array([begin, *ends[skip:]], np.int64) - begin
    own = np.frombuffer(data, np.uint8)[begin:ends[-1]]
    return (words.hash_words(own, bounds[:-1], bounds[1:], _CODES) >> np.uint64(32)).astype(np.uint32)


def signature(hashes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """The ``slots`` smallest distinct hashes, ascending."""
    if len(hashes) > 8 * slots:
        # Enough of the smallest: equal hashes are rare.
        few = np.unique(np.partition(hashes, 4 * slots)[:4 * slots])
        if len(few) >= slots:
            return few[:slots]
    return np.unique(hashes)[:slots]


def encode(sig: np.ndarray) -> str:
    return base64.b64encode(sig.astype("<u4").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def likeness(a: np.ndarray, b: np.ndarray, slots: int = SLOTS) -> float:
    """Estimated Jaccard similarity of two phrase sets by their signatures;
    two empty sets are equal."""
    both = np.concatenate([a, b])
    both.sort()
    if not len(both):
        return 1.0
    first = np.concatenate([[True], both[1:] != both[:-1]])
    twice = np.concatenate([both[1:] == both[:-1], [False]])
    return float(np.count_nonzero(twice[first][:slots])) / min(slots, int(np.count_nonzero(first)))


def text_signature(text: str, slots: int = SLOTS) -> np.ndarray:
    data = text.encode()
    return signature(phrase_hashes(data, Parse().feed(data).ends), slots)


def fingerprint(text: str, slots: int = SLOTS) -> str:
    """The fingerprint of one text; an empty text has an empty one."""
    return encode(text_signature(text, slots))


def fingerprints(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id and fingerprint of each row of ``docs``: a scan.  A null text
    is empty; equal texts have equal fingerprints."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [fingerprint(t.as_py() or "", slots) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own, pa.string())],
                                             names=["doc_id", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


class _Open:
    """A document that waits for the next one: parsed up to the edit."""

    def __init__(self, doc_id: int | None, text: str, slots: int):
        self.doc_id, self.n_chars, self.slots = doc_id, len(text), slots
        self.cut = self.n_chars // 3
        self.data = text[:self.n_chars - self.cut].encode()
        parse = Parse().feed(self.data)
        # The parse up to the edit is kept, a copy of it goes to the end.
        self.parse = parse.copy() if self.cut else parse
        tail = text[self.n_chars - self.cut:].encode()
        known = len(parse.ends)
        hashes = phrase_hashes(self.data + tail, parse.feed(tail).ends)
        self.sig, self.hashes = signature(hashes, slots), hashes[:known]

    def close(self, text: str, sig: np.ndarray) -> tuple:
        """The row of this document, given the next one."""
        part = text[:self.cut].encode()
        data = self.data + part
        edited = self.sig
        if self.cut:
            new = phrase_hashes(data, self.parse.feed(part).ends, len(self.hashes))
            edited = signature(np.concatenate([self.hashes, new]), self.slots)
        return (self.doc_id, self.n_chars, hashlib.sha256(data).hexdigest(), encode(self.sig), encode(edited),
                likeness(self.sig, edited, self.slots), likeness(self.sig, sig, self.slots))


def _key(doc_id: int | None, h: int) -> tuple:
    """Sorts as the documents do: doc_id descending, nulls last, then hash."""
    return doc_id is None, 0 if doc_id is None else -doc_id, -h


def bucket_bounds(keys: DataFrame, bucket_rows: int) -> list[tuple]:
    """Keys of ``keys`` (doc_id, h) at which buckets begin, ascending; the
    first is the first key of all."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("h").desc()]
    first = keys.orderBy(*order).first()
    if first is None:
        return []
    n = keys.count()
    buckets = max(1, min(BUCKETS, n // bucket_rows))
    if buckets == 1:
        return [_key(*first)]
    sampled = keys.sample(min(1.0, buckets * PER_BUCKET / n), seed=11).collect()
    known = sorted(_key(r["doc_id"], r["h"]) for r in sampled)
    step = max(1, len(known) // buckets)
    return sorted({_key(*first), *known[step::step]})


def edited_likeness(docs: DataFrame, slots: int = SLOTS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_chars, the
    SHA-256 of its edited text, its fingerprint and that of the edited text,
    and the likeness of its fingerprint to the edited text's (near_edited) and
    to the next document's (near_next).

    The edited text has the last third of its characters (rounded down)
    replaced by as many from the beginning of the next document, or all of it
    if that is shorter.  The next document is that of the next smaller doc_id;
    after the last comes the first.  Rows without a doc_id follow all others;
    equal doc_ids follow one another by a hash of their text, then by the text
    itself, and a repeated row is a document each time.  A single document is
    its own next.  A null text is empty: its fingerprint is empty, which is
    like another empty one (1) and unlike all others (0).  Other columns are
    not read.  An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    bounds = bucket_bounds(rows.select("doc_id", "h"), bucket_rows)
    n = len(bounds)

    @F.arrow_udf(ArrayType(IntegerType()))
    def places(doc_ids: pa.Array, hashes: pa.Array) -> pa.Array:
        """The bucket, and for its first document that before it too, as
        -1 - bucket: there it comes after all."""
        out = []
        for doc_id, h in zip(doc_ids.to_pylist(), hashes.to_pylist(), strict=True):
            key = _key(doc_id, h)
            b = max(bisect.bisect_right(bounds, key) - 1, 0)
            out.append([b, -1 - (b - 1) % n] if bounds[b] == key else [b])
        return pa.array(out, pa.list_(pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "place"))
            for doc_id, text, place in zip(*columns, strict=True):
                if place >= 0:
                    new = _Open(doc_id, text, slots)
                    if waiting:
                        out.append(waiting.close(text, new.sig))
                    waiting = new
                elif waiting:
                    out.append(waiting.close(text, text_signature(text, slots)))
                    waiting = None
            yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, r, strict=True)) for r in out], _SCHEMA)

    placed = rows.withColumn("place", F.explode(places(F.col("doc_id"), F.col("h"))))
    bucket = F.when(F.col("place") < 0, -1 - F.col("place")).otherwise(F.col("place"))
    placed = placed.repartitionById(max(n, 1), bucket).sortWithinPartitions(
        bucket, F.col("place") < 0, F.col("doc_id").desc_nulls_last(), F.col("h").desc(), F.col("text").desc())
    return placed.select("doc_id", "text", "place").mapInArrow(run, OUT)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                     ("near_edited", pa.float64()), ("near_next", pa.float64())])
_NAMES = _SCHEMA.names
