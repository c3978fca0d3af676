"""Token-id files: one wavelet matrix per shard (operator 2).

A shard holds the ids of a contiguous run of documents.  Its file has the bit
planes of the ids, most significant first; the ids are stably partitioned by
each plane's bit before the next plane is taken.  With the number of ones
before each block, any plane answers *rank* with one block read, and rank
alone gives

* ``access(i)``   - the id at a position,
* ``rank(v, i)``  - how often an id occurs before a position,
* ``select(v, k)``- where its k-th occurrence lies,
* ``decode()``    - all ids, plane by plane.

Layout (little-endian)::

    magic "STARWM01" | u32 planes | u32 block bytes | u64 ids | u64 documents
    documents: i64 doc_id[documents], u32 n_ids[documents]   (one zstd frame)
    per plane: u64 zeros, u64 ones before each block, u64 file offset of each
               block and of the end
    blocks: zstd frames of the plane's packed bits

Only the header and the blocks that a query touches are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starflow.llm import bpe
from starflow.session import materialise, work_dir

MAGIC = b"STARWM01"
_HEAD = struct.Struct("<8sIIQQ")
BLOCK_BYTES = 1 << 14
SHARD_IDS = 4 << 20


def build(ids: np.ndarray, doc_ids: np.ndarray, counts: np.ndarray, block_bytes: int = BLOCK_BYTES) -> bytes:
    """The bytes of a shard file."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1)
    n = len(ids)
    planes = max(1, int(ids.max()).bit_length()) if n else 1
    n_blocks = -(-(-(-n // 8)) // block_bytes)
    docs = pack.compress(doc_ids.astype("<i8").tobytes() + counts.astype("<u4").tobytes())
    seq = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    zeros, ones, blocks = [], [], []
    for p in range(planes - 1, -1, -1):
        bit = (seq >> p) & 1 != 0
        ones_at = np.flatnonzero(bit)
        zeros.append(n - len(ones_at))
        ones.append(np.searchsorted(ones_at, np.arange(n_blocks) * (block_bytes * 8)))
        packed = np.packbits(bit, bitorder="little")
        blocks.append([pack.compress(packed[i * block_bytes:(i + 1) * block_bytes]) for i in range(n_blocks)])
        if p:
            seq = np.concatenate([seq[~bit], seq[ones_at]])
    at = _HEAD.size + 8 + len(docs) + planes * 8 * (2 + 2 * n_blocks)
    out = [_HEAD.pack(MAGIC, planes, block_bytes, n, len(doc_ids)), struct.pack("<Q", len(docs)), docs]
    for z, o, bs in zip(zeros, ones, blocks, strict=True):
        ends = at + np.cumsum([0] + [len(b) for b in bs])
        at = int(ends[-1])
        out += [struct.pack("<Q", z), o.astype("<u8").tobytes(), ends.astype("<u8").tobytes()]
    return b"".join(out + [b for bs in blocks for b in bs])


class Shard:
    """Reads a shard file.  ``source`` has ``read_at(n, offset)``, as pyarrow's
    random-access files do."""

    def __init__(self, source):
        import zstandard

        self.unpack = zstandard.ZstdDecompressor()
        self.source = source
        magic, self.planes, self.block_bytes, self.n, n_docs = _HEAD.unpack(source.read_at(_HEAD.size, 0))
        if magic != MAGIC:
            raise ValueError("not a shard file")
        at = _HEAD.size
        size, = struct.unpack("<Q", source.read_at(8, at))
        raw = self.unpack.decompress(source.read_at(size, at + 8)) if n_docs else b""
        self.doc_ids = np.frombuffer(raw, "<i8", n_docs)
        self.counts = np.frombuffer(raw, "<u4", n_docs, 8 * n_docs)
        n_blocks = -(-(-(-self.n // 8)) // self.block_bytes)
        width = 2 + 2 * n_blocks
        head = np.frombuffer(source.read_at(self.planes * 8 * width, at + 8 + size), "<u8").astype(np.int64)
        head = head.reshape(self.planes, width)
        self.zeros, self.ones, self.ends = head[:, 0], head[:, 1:1 + n_blocks], head[:, 1 + n_blocks:]
        self._blocks: dict[tuple[int, int], np.ndarray] = {}

    def _block(self, plane: int, k: int) -> np.ndarray:
        if (plane, k) not in self._blocks:
            if len(self._blocks) >= 256:
                self._blocks.clear()
            a, b = self.ends[plane, k], self.ends[plane, k + 1]
            raw = self.unpack.decompress(self.source.read_at(int(b - a), int(a)))
            self._blocks[plane, k] = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")
        return self._blocks[plane, k]

    def _rank1(self, plane: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        k, r = divmod(i, self.block_bytes * 8)
        if not r:
            return int(self.ones[plane, k]) if k < self.ones.shape[1] else self.n - int(self.zeros[plane])
        return int(self.ones[plane, k]) + int(self._block(plane, k)[:r].sum())

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for p in range(self.planes):
            k, r = divmod(i, self.block_bytes * 8)
            bit = int(self._block(p, k)[r])
            ones = self._rank1(p, i)
            i = int(self.zeros[p]) + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _interval(self, value: int, i: int) -> tuple[int, int]:
        """Where occurrences of ``value`` start on the last level, and the end
        of those from before position ``i``."""
        lo = 0
        for p in range(self.planes):
            a, b = self._rank1(p, lo), self._rank1(p, i)
            if value >> (self.planes - 1 - p) & 1:
                lo, i = int(self.zeros[p]) + a, int(self.zeros[p]) + b
            else:
                lo, i = lo - a, i - b
        return lo, i

    def rank(self, value: int, i: int | None = None) -> int:
        """Occurrences of ``value`` among the first ``i`` ids (all by default)."""
        if value < 0 or value >> self.planes or not self.n:
            return 0
        lo, hi = self._interval(value, self.n if i is None else i)
        return hi - lo

    def select(self, value: int, k: int) -> int:
        """Position of occurrence ``k`` (from 0) of ``value``."""
        if not 0 <= k < self.rank(value):
            raise IndexError(k)
        i = self._interval(value, 0)[0] + k
        for p in range(self.planes - 1, -1, -1):
            one = value >> (self.planes - 1 - p) & 1
            want = i - int(self.zeros[p]) if one else i
            i = self._select_bit(p, one, want)
        return i

    def _select_bit(self, plane: int, one: int, k: int) -> int:
        starts = np.arange(self.ones.shape[1]) * (self.block_bytes * 8)
        before = self.ones[plane] if one else starts - self.ones[plane]
        b = int(np.searchsorted(before, k, side="right")) - 1
        bits = self._block(plane, b)
        return int(starts[b]) + int(np.flatnonzero(bits == one)[k - int(before[b])])

    def decode(self) -> np.ndarray:
        """All ids: the partitions are undone from the last plane to the first."""
        dtype = np.uint16 if self.planes <= 16 else np.uint32
        seq = np.zeros(self.n, dtype)
        for p in range(self.planes - 1, -1, -1):
            a = int(self.ends[p, 0])
            raw = self.source.read_at(int(self.ends[p, -1]) - a, a)
            cut = self.ends[p] - a
            packed = b"".join(self.unpack.decompress(raw[cut[k]:cut[k + 1]]) for k in range(len(cut) - 1))
            bit = np.unpackbits(np.frombuffer(packed, np.uint8), count=self.n, bitorder="little").view(bool)
            z = int(self.zeros[p])
            out = np.empty(self.n, dtype)
            out[~bit] = seq[:z]
            out[bit] = seq[z:] | dtype(1 << (self.planes - 1 - p))
            seq = out
        return seq


_MANIFEST = "path string, first_doc_id long, n_docs long, n_ids long"


def write_shards(docs: DataFrame, out_dir: str, tokenizer_path: str, end_id: int = 1,
                 shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write shard files; returns their
    manifest (path, first_doc_id, n_docs, n_ids), which runs the job.

    Documents are dealt by ranges of doc_id and sorted inside a range, so
    shards in the order of their first doc_id hold all ids in ascending doc_id
    order.  A task holds one shard of about ``shard_ids`` ids at a time.  A
    file's name is its range and its place there, and its content depends on
    the rows alone: a task that runs again writes the same file.  It is
    written under a name of its own first and then moved.

    A null text is empty and has the end id only; an empty table gives an
    empty manifest.  Rows with a null doc_id come first; repeated rows are
    all kept, in any order among equal doc_ids.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = bpe.encoder(tokenizer_path)
        fs, root = pafs.FileSystem.from_uri(out_dir)
        fs.create_dir(root, recursive=True)
        task = TaskContext.get()
        held_ids, held_docs, held_counts, held, k = [], [], [], 0, 0

        def flush():
            nonlocal held_ids, held_docs, held_counts, held, k
            d = np.concatenate(held_docs)
            data = build(np.concatenate(held_ids), d, np.concatenate(held_counts))
            name = f"{root}/shard-{task.partitionId():06d}-{k:04d}.wm"
            own = f"{name}.{task.taskAttemptId()}"
            with fs.open_output_stream(own) as f:
                f.write(data)
            fs.move(own, name)
            path = f"{out_dir}/{name.rsplit('/', 1)[1]}"
            row = pa.RecordBatch.from_arrays([pa.array([path]), pa.array([int(d[0])], pa.int64()),
                                              pa.array([len(d)], pa.int64()), pa.array([held], pa.int64())],
                                             names=["path", "first_doc_id", "n_docs", "n_ids"])
            held_ids, held_docs, held_counts, held, k = [], [], [], 0, k + 1
            return row

        for batch in batches:
            texts = batch.column("text")
            doc_ids = np.asarray(batch.column("doc_id").fill_null(np.iinfo(np.int64).min))
            for a, b in bpe.text_slices(texts, min(bpe.SLICE_BYTES, 3 * shard_ids)):
                ids, counts = enc.encode(texts.slice(a, b - a))
                full = np.insert(ids, np.cumsum(counts), end_id)
                held_ids.append(full.astype(np.uint16 if len(enc.is_end) <= 1 << 16 else np.uint32))
                held_docs.append(doc_ids[a:b])
                held_counts.append(counts + 1)
                held += len(full)
                if held >= shard_ids:
                    yield flush()
        if held_docs:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return materialise(ranged.mapInArrow(write, _MANIFEST), "shard-manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """Adds ``start``: the ids in all earlier shards.  One row per shard file
    passes through the window, never documents or ids."""
    w = Window.orderBy("first_doc_id", "path").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(w), F.lit(0)))


def read_documents(manifest: DataFrame) -> DataFrame:
    """One row per document, read back from the shard files: doc_id, start,
    n_tokens, ids_crc32."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                fs, name = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(name) as f:
                    shard = Shard(f)
                    data = memoryview(shard.decode().astype("<u4")).cast("B")
                counts = shard.counts.astype(np.int64)
                ends = np.cumsum(counts)
                crc = [zlib.crc32(data[4 * (e - c):4 * e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                none = np.iinfo(np.int64).min
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, mask=shard.doc_ids == none), pa.array(start + ends - counts),
                     pa.array(counts), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = with_starts(manifest).select("path", "start")
    # One shard per task at a time; the paths are few and small.
    spread = files.repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism * 4), "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_to_shards(spark: SparkSession, docs: DataFrame, tokenizer_path: str | None = None,
                     out_dir: str | None = None) -> DataFrame:
    """Write ``docs`` as shard files and return what they hold per document."""
    out_dir = out_dir or work_dir(spark, "token-shards")
    return read_documents(write_shards(docs, out_dir, tokenizer_path or bpe.default_tokenizer_path()))
