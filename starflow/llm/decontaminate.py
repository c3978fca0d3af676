"""Benchmark decontamination by edit distance (operator 10).

A document leaks an item if some stretch of it is within ``rate`` word edits
per word of the item.  Words are runs of letters and digits, in lower case.

1. *Windows.*  Every word of a document, and some places ahead of the first,
   start a window for each item length.
   For an item of m words, k = floor(rate * m) edits are allowed, so m - k of
   the m words from a stretch's start on are words of the benchmark; other
   starts are left out by that count, exactly.  An item of over ``LONGEST``
   words is searched by its parts: if all were beyond the rate, so were the item.
2. *Embedding.*  The CGK random walk reads a window word by word and repeats
   or advances by a random bit that depends on the step and the word.  Two
   windows at a small edit distance fall back into step, so their embeddings
   are at a small Hamming distance.
3. *LSH.*  Each table is keyed by a few sampled positions of the embedding.
   A walk does not depend on where its window ends, so lengths of one level
   (within a fifth of each other) share their tables: positions are sampled
   from the steps in which the shortest of them is still being read, and an
   item that has run out by then is left out of that table.  Windows are
   looked up in every table.  Tables are repeated, over several walks, until a
   window at the design distance collides with probability ``recall``.
4. *Verification.*  Items that a window meets are aligned with the text around
   it by dynamic programming, with free ends in the document; the minimum is
   the distance.

Items are sent to the tasks in blocks of bounded size, whatever the size of
the benchmark; documents are only read and never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from starflow.llm import bpe, words

RATE = 0.2
RECALL = 0.995
SAMPLED = 3
# Share of embedded positions at which a window at the edit bound may differ
# from its item: the design distance of the tables.
DESIGN_HAMMING = 0.52
WALKS = 8
STRETCH = 3
# A level's positions are sampled from this many steps per word.
STEPS_PER_WORD = 1.6
LEVEL_RATIO = 1.2
LONGEST = 64
BLOCK_ITEMS = 20_000
BLOCK_WINDOWS = 1 << 14
VERIFY_CELLS = 1 << 22
SLICE = 1 << 22

_GAP = np.ones(256, bool)
_GAP[48:58] = _GAP[65:91] = _GAP[97:123] = False
_GAP[128:] = False
_CODES = np.where(_GAP, np.uint64(0), words.CODES)
_PAD = np.uint64(0)
_MULT = np.uint64(0x9E3779B97F4A7C15)


def folded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, first word of each text); null as empty.

    Letters of the Latin-1 block (two bytes from C3 80 on) are folded too."""
    data, offsets = words.buffers(pc.fill_null(texts, ""))
    if len(data):
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        data = data.copy()
        data[1:][capital] += 0x20
    starts, ends = words.word_bounds(data, offsets, _GAP)
    return words.hash_words(data, starts, ends, _CODES), np.searchsorted(starts, offsets)


def tables_needed(recall: float = RECALL, hamming: float = DESIGN_HAMMING, sampled: int = SAMPLED) -> int:
    """Tables for a window at the design distance to collide at ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (1 - hamming) ** sampled))


def walk(windows: np.ndarray, seed: int, steps: int | None = None) -> np.ndarray:
    """CGK embeddings of the rows of ``windows``, three times as long or of
    ``steps`` positions.  A position does not depend on the words behind it."""
    n, m = windows.shape
    steps = STRETCH * m if steps is None else steps
    padded = np.concatenate([windows, np.full((n, 1), _PAD)], axis=1).ravel()
    at = np.arange(n) * (m + 1)
    return _walk_from(padded, at, seed, steps, at + m).T


def _walk_from(hashes: np.ndarray, starts: np.ndarray, seed: int, steps: int, last: np.ndarray | None = None):
    """Walks from ``starts``, a row per step.  Each stays at its ``last`` word;
    without, there are at least ``steps`` words from each start on."""
    at = starts.copy()
    out = np.empty((steps, len(at)), np.uint64)
    bit = np.empty(len(at), np.uint64)
    signed = bit.view(np.int64)
    for j, key in enumerate(words.mix(np.arange(steps, dtype=np.uint64) + np.uint64(seed * 1_000_003 + 1))):
        np.take(hashes, at, out=out[j], mode="clip")
        np.bitwise_xor(out[j], key, out=bit)
        np.multiply(bit, _MULT, out=bit)
        np.right_shift(signed, 63, out=signed)
        at -= signed
        if last is not None:
            np.minimum(at, last, out=at)
    return out


def levels() -> list[int]:
    """Least lengths of the levels, up to ``LONGEST``."""
    out = [1]
    while (longer := max(out[-1] + 1, int(out[-1] * LEVEL_RATIO))) <= LONGEST:
        out.append(longer)
    return out


def span(level: int) -> int:
    """Steps of a walk that the tables of a level sample."""
    return max(level, int(STEPS_PER_WORD * level))


@cache
def tables(level: int, rate: float = RATE, recall: float = RECALL) -> list[np.ndarray]:
    """Sampled positions by walk, a row per table.  The first table of a walk
    samples positions that no item of the level has run out by; it alone is
    needed where no edit is allowed."""
    rng = np.random.default_rng(level)
    n = min(SAMPLED, level)
    first = [rng.choice(level, n, replace=False) for _ in range(WALKS)]
    if int(rate * level * LEVEL_RATIO + 1e-9) == 0:
        return [np.array(first[:1])]
    more = -(-tables_needed(recall) // WALKS) - 1
    return [np.array([f, *(rng.choice(span(level), n, replace=False) for _ in range(more))]) for f in first]


def table_keys(embedded: np.ndarray, sampled: np.ndarray, seed: int, rows: np.ndarray | slice) -> np.ndarray:
    """Keys of some of the walks (a row per step), one row of keys per table."""
    t, n = sampled.shape
    odd = words.mix(np.arange(t * n, dtype=np.uint64) + np.uint64(seed * 4096 + 1)).reshape(t, n) | np.uint64(1)
    out = np.stack([sum(embedded[j][rows] * o for j, o in zip(at, by, strict=True))
                    for at, by in zip(sampled.tolist(), odd, strict=True)])
    # A multiple's upper bits depend on all bits of the sum.
    return (out ^ out >> np.uint64(32)) * _MULT


class Marks:
    """A bitmap over the leading bits of hashes: no false negatives."""

    def __init__(self, hashes: np.ndarray):
        bits = max(16, int(16 * len(hashes)).bit_length())
        self.shift = np.uint64(64 - min(bits, 26))
        self.bits = np.zeros(1 << min(bits, 26), bool)
        self.bits[hashes >> self.shift] = True

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        return self.bits[hashes >> self.shift]


def edit_distances(items: np.ndarray, regions: np.ndarray) -> np.ndarray:
    """Least word edit distance of row i of ``items`` to any stretch of row i
    of ``regions`` (padded with 0, which matches nothing)."""
    n, r = regions.shape
    steps = np.arange(r + 1)
    row = np.zeros((n, r + 1), np.int32)
    for i in range(items.shape[1]):
        other = (regions != items[:, i:i + 1]) | (regions == _PAD)
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, :-1] + other, row[:, 1:] + 1)
        row = np.minimum.accumulate(new - steps, axis=1) + steps
    return row.min(axis=1)


class ItemIndex:
    """The items in hash tables of their sampled embeddings."""

    def __init__(self, item_ids: np.ndarray, hashes: np.ndarray, firsts: np.ndarray, rate: float = RATE):
        self.item_ids, self.hashes, self.firsts, self.rate = item_ids, hashes, firsts, rate
        self.sizes = np.diff(firsts)
        self.edits = self._allowed(self.sizes)
        item = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.members = np.unique(words.mix(hashes) ^ words.mix(item))
        # Parts of items: all of an item of up to LONGEST words.
        n_parts = -(-self.sizes // LONGEST)
        self.part_item = np.repeat(np.arange(len(self.sizes)), n_parts)
        nth = bpe.ranges(np.zeros(len(n_parts), np.int64), n_parts)
        m, n = self.sizes[self.part_item], n_parts[self.part_item]
        self.part_at = nth * m // n
        self.part_size = (nth + 1) * m // n - self.part_at
        self.tables = {level: self._fill(own, level) for level, own in self._by_level()}

    def _allowed(self, sizes: np.ndarray) -> np.ndarray:
        return np.floor(self.rate * sizes + 1e-9).astype(np.int64)

    def _by_level(self) -> Iterator[tuple[int, np.ndarray]]:
        """Levels that hold parts, with those parts."""
        steps = np.array(levels())
        of = steps[np.searchsorted(steps, self.part_size, side="right") - 1]
        for level in np.unique(of).tolist():
            yield level, np.flatnonzero(of == level)

    def _fill(self, own: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys over all tables of a level, and their parts."""
        at = np.arange(span(level))
        inside = at < self.part_size[own][:, None]
        start = self.firsts[self.part_item[own]] + self.part_at[own]
        windows = np.where(inside, self.hashes[np.minimum(start[:, None] + at, len(self.hashes) - 1)], _PAD)
        keys, parts = [], []
        for w, sampled in enumerate(tables(level, self.rate)):
            embedded = walk(windows, w, span(level))
            own_keys = table_keys(embedded.T, sampled, w, slice(None))
            for s, key in zip(sampled, own_keys, strict=True):
                read = (embedded[:, s] != _PAD).all(axis=1)
                keys.append(key[read])
                parts.append(own[read])
        keys, parts = np.concatenate(keys), np.concatenate(parts)
        order = np.argsort(keys, kind="stable")
        return keys[order], parts[order]

    @cached_property
    def _marks(self) -> dict[int, Marks]:
        return {level: Marks(keys) for level, (keys, _) in self.tables.items()}

    @cached_property
    def _known(self) -> Marks:
        return Marks(np.unique(self.hashes))

    def _starts(self, hashes: np.ndarray) -> dict[int, np.ndarray]:
        """Per level, whether each word may start a window: enough of the
        words from it on are words of some item."""
        n = len(hashes)
        count = np.zeros(n + 1 + LONGEST, np.int32)
        np.cumsum(self._known(hashes), out=count[1:n + 1])
        count[n + 1:] = count[n]
        out = {}
        for level, own in self._by_level():
            may = np.zeros(n, bool)
            sizes = np.unique(self.part_size[own])
            for m, k in zip(sizes.tolist(), self._allowed(sizes).tolist(), strict=True):
                may |= count[m:m + n] - count[:n] >= m - k
            out[level] = may
        return out

    def hits(self, hashes: np.ndarray, firsts: np.ndarray) -> Iterator[np.ndarray]:
        """Columns (text, item, start) of items whose windows collide with a
        window of a text, by blocks of windows; a start is relative to its
        text and may lie before it."""
        # Each text has room before it for windows that start ahead of it; a
        # window may read on into the next text: it is verified in its own.
        room = int(self._allowed(np.array([LONGEST]))[0])
        blocks = firsts[:-1] + np.arange(len(firsts) - 1) * room
        spaced = np.full(len(hashes) + (len(firsts) - 1) * room, _PAD)
        n_words = np.diff(firsts)
        spaced[bpe.ranges(blocks + room, n_words)] = hashes
        may = self._starts(spaced)
        # Windows of one block have about the same longest level to read.
        longest = np.zeros(len(spaced), np.uint8)
        for level, ok in may.items():
            longest[ok] = level
        starts = np.flatnonzero(longest)
        starts = starts[np.argsort(longest[starts], kind="stable")]
        padded = np.append(spaced, np.full(span(LONGEST), _PAD))
        for b in range(0, len(starts), BLOCK_WINDOWS):
            at = starts[b:b + BLOCK_WINDOWS]
            text = np.searchsorted(blocks, at, side="right") - 1
            rows = {level: np.flatnonzero(ok[at]) for level, ok in may.items()}
            rows = {level: r if len(r) < len(at) else slice(None) for level, r in rows.items() if len(r)}
            steps = span(int(longest[at[-1]]))
            found = []
            for w in range(WALKS):
                if any(w < len(tables(level, self.rate)) for level in rows):
                    embedded = _walk_from(padded, at, w, steps)
                    for level, r in rows.items():
                        if w < len(tables(level, self.rate)):
                            row, part = self._look_up(level, table_keys(embedded, tables(level, self.rate)[w], w, r))
                            row = row if isinstance(r, slice) else r[row]
                            found.append(np.stack([text[row], self.part_item[part],
                                                   at[row] - blocks[text[row]] - room - self.part_at[part]]))
            yield np.unique(np.concatenate(found, axis=1), axis=1)

    def _look_up(self, level: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, part) of equal keys; ``keys`` has a row per table."""
        known, parts = self.tables[level]
        table, near = np.nonzero(self._marks[level](keys))
        keys = keys[table, near]
        lo = np.searchsorted(known, keys)
        n = np.searchsorted(known, keys, side="right") - lo
        return np.repeat(near, n), parts[bpe.ranges(lo, n)]

    def leaks(self, hashes: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, item, start, edits) of windows within the bound."""
        padded, n_words = np.append(hashes, _PAD), np.diff(firsts)

        def cut(text, start, length):
            """Words of windows; positions outside the text are padding."""
            at = start[:, None] + np.arange(length)
            inside = (at >= 0) & (at < n_words[text][:, None])
            return padded[np.where(inside, at + firsts[text][:, None], len(hashes))]

        for hits in self.hits(hashes, firsts):
            for m in np.unique(self.sizes[hits[1]]).tolist():
                own = hits[:, self.sizes[hits[1]] == m]
                k = int(self.edits[own[1, 0]])
                block = max(1, VERIFY_CELLS // (m + 4 * k))
                for b in range(0, own.shape[1], block):
                    t, i, s = own[:, b:b + block]
                    region = cut(t, s - 2 * k, m + 4 * k)
                    # Words of the item must be near in number.
                    near = words.mix(region) ^ words.mix(i)[:, None]
                    at = np.minimum(np.searchsorted(self.members, near), len(self.members) - 1)
                    ok = (self.members[at] == near).sum(axis=1) >= m - k
                    t, i, s, region = t[ok], i[ok], s[ok], region[ok]
                    if not len(t):
                        continue
                    exact = self.hashes[self.firsts[i][:, None] + np.arange(m)]
                    d = edit_distances(exact, region)
                    ok = d <= k
                    yield t[ok], i[ok], np.maximum(s[ok], 0), d[ok]


def _blocks(benchmark: DataFrame, size: int) -> Iterator[ItemIndex]:
    """Indexes of at most ``size`` items each; one block at a time is held."""
    ids, texts = [], []

    def index():
        hashes, firsts = folded_words(pa.array(texts, pa.string()))
        return ItemIndex(np.array(ids, np.int64), hashes, firsts)

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id IS NOT NULL")
    for r in rows.toLocalIterator():
        ids.append(r["item_id"])
        texts.append(r["text"])
        if len(ids) == size:
            yield index()
            ids, texts = [], []
    if ids:
        yield index()


_SCHEMA = "doc_id long, item_id long, start_word long, edits long, item_words long"


def leaks(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """One row per document and item it leaks: doc_id, item_id, start_word
    (word of the document at which the closest window starts), edits,
    item_words.

    Null and empty texts and items leak nothing, and neither do items without
    a letter or digit.  Repeated rows of a document give one row per item; a
    null doc_id is reported as null, a null item_id never.  Other columns are
    not read; empty tables give an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = []
    for index in _blocks(benchmark, block_items):
        sent = spark.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = sent.value
            for batch in batches:
                texts, doc_ids = batch.column("text"), batch.column("doc_id")
                for a, b in bpe.text_slices(texts, SLICE):
                    hashes, firsts = folded_words(texts.slice(a, b - a))
                    for t, i, s, d in own.leaks(hashes, firsts):
                        yield pa.RecordBatch.from_arrays(
                            [doc_ids.take(pa.array(t + a)), pa.array(own.item_ids[i]), pa.array(s.astype(np.int64)),
                             pa.array(d.astype(np.int64)), pa.array(own.sizes[i])],
                            names=["doc_id", "item_id", "start_word", "edits", "item_words"])

        parts.append(rows.mapInArrow(search, _SCHEMA))
    if not parts:
        return spark.createDataFrame([], _SCHEMA)
    best = F.min(F.struct("edits", "start_word", "item_words")).alias("best")
    return (reduce(DataFrame.unionByName, parts).groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", "best.start_word", "best.edits", "best.item_words"))


def drop_leaking(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that leak no item.  No
    row moves: each block of items is a filter on the text."""
    for index in _blocks(benchmark, block_items):
        docs = docs.filter(_leaks_none(docs.sparkSession.sparkContext.broadcast(index))(F.col("text")))
    return docs


def _leaks_none(sent):
    """A column function: whether a text leaks none of the items sent."""
    @F.arrow_udf(BooleanType())
    def clean(texts: pa.Array) -> pa.Array:
        ok = np.ones(len(texts), bool)
        for a, b in bpe.text_slices(texts, SLICE):
            for t, *_ in sent.value.leaks(*folded_words(texts.slice(a, b - a))):
                ok[t + a] = False
        return pa.array(ok)

    return clean
