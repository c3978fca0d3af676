"""Packing documents into training sequences by best-fit decreasing (operator 5).

A document longer than a window is first cut into full windows, each a
sequence of its own.  What remains of every document is placed, longest
first, in the open window whose remaining capacity fits it most tightly; a
segment tree over the remaining capacities finds that window in
log2(capacity) steps.

Packing needs no row from another task: every input partition packs its own
documents, in blocks of bounded size, and windows that a block leaves badly
filled are packed again with the next block.  So there is no shuffle, no key
that could be hot, and a partition that runs again gives the same pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm import bpe

CAPACITY = 4096
BLOCK_IDS = 2 << 20
SLICE = 2 << 20
END_ID = 2
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class OpenWindows:
    """Open windows by remaining capacity.

    A segment tree counts the windows under each node; the tightest window
    for a need is the first non-empty leaf from ``need`` on.
    """

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.count = [0] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _change(self, room: int, by: int):
        i = room + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def add(self, room: int, window: int):
        self.windows[room].append(window)
        self._change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, window) of the tightest window with ``need`` left, removed."""
        count = self.count
        i = need + self.size
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i <<= 1
                if not count[i]:
                    i += 1
        room = i - self.size
        self._change(room, -1)
        return room, self.windows[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows as lists of item numbers; equal lengths keep their order."""
    windows: list[list[int]] = []
    open_ = OpenWindows(capacity)
    for k in sorted(range(len(lengths)), key=lambda j: -lengths[j]):
        n = lengths[k]
        if not 0 < n <= capacity:
            raise ValueError(f"an item of {n} does not fit")
        found = open_.take(n)
        if found is None:
            found = (capacity, len(windows))
            windows.append([])
        windows[found[1]].append(k)
        if found[0] > n:
            open_.add(found[0] - n, found[1])
    return windows


class _Packer:
    """Packs one partition, block by block."""

    def __init__(self, partition: int, capacity: int):
        self.capacity = capacity
        self.next_id = partition << 40
        self.items: list[tuple] = []  # (doc_id, start, doc_tokens, ids)
        self.held = 0
        self.rows: list[tuple] = []

    def _emit(self, doc_id, start, ids, doc_tokens, offset):
        self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4")), doc_tokens, self.next_id, offset))

    def add(self, doc_id, ids: np.ndarray):
        n, cap = len(ids), self.capacity
        full = n // cap * cap
        for a in range(0, full, cap):
            self._emit(doc_id, a, ids[a:a + cap], n, 0)
            self.next_id += 1
        if n > full:
            self.items.append((doc_id, full, n, ids[full:].copy()))
            self.held += n - full

    def pack(self, last: bool):
        """Emit the windows of the items held; if more may come, those under
        seven eighths full are kept for the next block."""
        items, self.items, self.held = self.items, [], 0
        for window in best_fit_decreasing([len(x[3]) for x in items], self.capacity):
            used = sum(len(items[k][3]) for k in window)
            if used < self.capacity * 7 // 8:
                if not last:
                    self.items += [items[k] for k in window]
                    self.held += used
                    continue
                self._powers([items[k] for k in window], used)
                continue
            at = 0
            for k in window:
                doc_id, start, n, ids = items[k]
                self._emit(doc_id, start, ids, n, at)
                at += len(ids)
            self.next_id += 1

    def _powers(self, items: list[tuple], used: int):
        """A badly filled last window as sequences of powers of two, which
        need no padding; pieces are cut where a sequence ends."""
        left, at = 1 << (used.bit_length() - 1), 0
        for doc_id, start, n, ids in items:
            a = 0
            while a < len(ids):
                part = ids[a:a + left - at]
                self._emit(doc_id, start + a, part, n, at)
                a, at, used = a + len(part), at + len(part), used - len(part)
                if at == left:
                    self.next_id += 1
                    at = 0
                    left = 1 << (used.bit_length() - 1) if used else 0


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY,
         end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Pieces of all documents (doc_id, text) with their sequence and place.

    A null or empty text still has its end id and so one piece.  Repeated rows
    are packed one by one.  A null doc_id is carried through.  Other columns
    are not read.  An empty table gives no piece.
    """
    path = tokenizer_path or bpe.default_tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # What earlier stages freed in this worker goes back first.
        pa.default_memory_pool().release_unused()
        enc = bpe.encoder(path)
        packer = _Packer(TaskContext.get().partitionId(), capacity)
        kinds = [pa.int64()] * 7
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

        def out():
            rows, packer.rows = packer.rows, []
            cols = zip(*rows, strict=True) if rows else [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id").to_pylist()
            for a, b in bpe.text_slices(texts, SLICE):
                ids, counts = enc.encode(texts.slice(a, b - a))
                ids = np.insert(ids, np.cumsum(counts), end_id)
                ends = np.cumsum(counts + 1)
                for k, (e, c) in enumerate(zip(ends.tolist(), (counts + 1).tolist(), strict=True)):
                    packer.add(doc_ids[a + k], ids[e - c:e])
                if packer.held >= block_ids:
                    packer.pack(last=False)
                yield out()
        packer.pack(last=True)
        yield out()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, SCHEMA)
