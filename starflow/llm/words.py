"""Words of many texts at once, as 64-bit hashes.

A word is a run of bytes other than ``[\\x20\\x09-\\x0D]``; A-Z count as a-z.
Everything works on the Arrow buffers of a batch: no Python object is made
per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MULT = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_codes() -> np.ndarray:
    """A pseudo-random code per byte; white space has 0, A-Z that of a-z."""
    codes = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _MULT)
    codes[65:91] = codes[97:123]
    codes[[32, 9, 10, 11, 12, 13]] = 0
    return codes


CODES = _byte_codes()
BLOCK = 1 << 20
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without nulls."""
    wide = pa.types.is_large_string(texts.type)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind, len(texts) + 1, texts.offset * kind().itemsize).astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; words do not cross texts.  ``gap`` marks
    the bytes between words."""
    n = len(data)
    word = ~gap[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    starts, ends = word.copy(), word.copy()
    if n:
        starts[1:] &= ~word[:-1] | cut[1:n]
        ends[:-1] &= ~word[1:] | cut[1:n]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = CODES) -> np.ndarray:
    """One hash per word: a polynomial over random byte codes, mixed.  Bytes
    between words must have code 0.  Works through blocks of bytes, so that a
    huge text needs little more memory than its word hashes."""
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, first + BLOCK, side="right")))
        own, last = starts[at:stop] - first, int(ends[stop - 1]) - first
        reach = np.append(own[1:], last) - own
        place = np.arange(last, dtype=np.int64) - np.repeat(own, reach)
        powers = np.ones(int(reach.max()), np.uint64)
        powers[1:] = _MULT
        terms = codes[data[first:first + last]] * np.cumprod(powers, dtype=np.uint64)[place]
        out[at:stop] = np.add.reduceat(terms, own)
        at = stop
    return mix(out ^ ((ends - starts).astype(np.uint64) * _MULT))


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, first word of each text and the total)."""
    data, offsets = buffers(texts)
    starts, ends = word_bounds(data, offsets)
    return hash_words(data, starts, ends), np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, firsts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, and the first of each text.

    A text of fewer words, but at least one, has its whole sequence as its
    only shingle.
    """
    n_words = np.diff(firsts)
    whole = np.maximum(n_words - (k - 1), 0)
    short = (n_words > 0) & (n_words < k)
    counts = whole + short
    first_shingle = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(int(counts.sum()), np.uint64)
    text = np.repeat(np.arange(len(counts)), counts)
    at = firsts[text] + np.arange(len(out)) - first_shingle[text]
    size = np.minimum(n_words[text], k)
    full = size == k
    for j in range(k):
        odd = mix(np.array([j + 1], np.uint64) * _MULT)[0] | np.uint64(1)
        here = full if full.all() else size > j
        part = words[at[here] + j] * odd
        if here.all():
            out += part
        else:
            out[here] += part
    return mix(out ^ (size.astype(np.uint64) * _MULT)), first_shingle
