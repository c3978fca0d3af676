"""Batch encoding with a public word-level BPE file of the tokenizers library.

The vocabulary file is a parameter; nothing is trained and no vocabulary is
copied.  ``BatchEncoder`` gives exactly the ids of
``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` but asks
the library once per distinct word instead of once per text: white space
always ends a pre-token in these files, so the ids of a text are the ids of
its white-space separated words, one after the other.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER_FILE = "word_bpe_49k.json"
SLICE_BYTES = 6 << 20
LEARNT_AT_ONCE = 1 << 13
CACHED_WORDS = 1_000_000
_TAIL = re.compile(r"[.,;:!?]+\Z")


def default_tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER_FILE)


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text (one row at least)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    ends = np.cumsum(sizes)
    at, n = 0, len(sizes)
    while at < n:
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield at, stop
        at = stop


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of ``[s, s + n)`` for each pair, concatenated."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    firsts = np.cumsum(lengths) - lengths
    return np.repeat(starts - firsts, lengths) + np.arange(total)


class BatchEncoder:
    """Ids of whole texts, with a bounded cache of word ids.

    The cache keeps at most ``cached_words`` words and starts afresh when it
    is full, so memory stays bounded on any input.
    """

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        # The same model for words that the file's own normaliser and splitter
        # would leave whole: many of them go through in one call.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.full.get_vocab()
        self.is_end = np.zeros(max(vocab.values()) + 1, bool)
        self.is_end[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.cached_words = cached_words
        self._clear()

    def _clear(self):
        self.words = pa.array([], pa.string())
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def _word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each distinct word."""
        cores: dict[str, int] = {}
        tails: dict[str, int] = {"": 0}
        odd: list[str] = []
        # Each word is two pieces: letters and closing marks, or an odd word
        # (index below zero) and nothing.
        first, second = [], []
        for w in words:
            low = w.lower()
            tail = ""
            if not low.isalpha():
                m = _TAIL.search(low)
                if m:
                    low, tail = low[:m.start()], m.group()
            # Lower-case letters below U+0180: no composition, one pre-token.
            if low.isalpha() and (low.isascii() or max(low) < "\u0180"):
                first.append(cores.setdefault(low, len(cores)))
                second.append(tails.setdefault(tail, len(tails)))
            else:
                odd.append(w)
                first.append(-len(odd))
                second.append(0)
        flat = np.zeros(0, np.uint32)
        ends = np.zeros(0, np.int64)
        if cores:
            flat = np.array(self.plain.encode_batch_fast([" ".join(cores)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.is_end[flat]) + 1
            if len(ends) != len(cores):
                raise ValueError("each word must end in one word-end token")
        rest = [x.ids for x in self.full.encode_batch_fast([*tails, *odd], add_special_tokens=False)]
        sizes = np.concatenate([np.diff(ends, prepend=0), np.array([len(x) for x in rest], np.int64)])
        pieces = np.concatenate([flat, np.array([i for x in rest for i in x], np.uint32)])
        starts = np.cumsum(sizes) - sizes
        a, b = np.array(first, np.int64), np.array(second, np.int64)
        a = np.where(a < 0, len(cores) + len(tails) - 1 - a, a)
        pair = np.stack([a, b + len(cores)], axis=1)
        lengths = sizes[pair].sum(axis=1)
        return pieces[ranges(starts[pair].ravel(), sizes[pair].ravel())], lengths

    def _learn(self, words: pa.Array):
        # In groups: the library's answer takes far more room than the ids.
        new = [self._word_ids(words.slice(a, LEARNT_AT_ONCE).to_numpy(zero_copy_only=False).tolist())
               for a in range(0, len(words), LEARNT_AT_ONCE)]
        ids, lengths = (np.concatenate(x) for x in zip(*new, strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])
        self.words = pa.concat_arrays([self.words, words.cast(pa.string())])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` in order, and their number per text.

        A null text has no ids.
        """
        texts = pc.fill_null(texts, "")
        # Ids don't depend on the case of A-Z, but for the literal special
        # tokens, which are matched before the text is lower-cased.
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten()
        n_words = np.asarray(pc.list_value_length(lists)).astype(np.int64)
        found = pc.index_in(words, value_set=self.words)
        at = np.asarray(pc.fill_null(found, -1)).astype(np.int64)
        missed = np.flatnonzero(at < 0)
        if len(missed):
            new = words.take(pa.array(missed)).dictionary_encode()
            if len(self.words) + len(new.dictionary) > self.cached_words:
                self._clear()
                missed = np.arange(len(words))
                new = words.dictionary_encode()
            base = len(self.words)
            self._learn(new.dictionary)
            at[missed] = base + np.asarray(new.indices)
        lengths = self.lengths[at]
        ids = self.ids[ranges(self.starts[at], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        word_ends = np.concatenate([[0], np.cumsum(n_words)])
        return ids, np.diff(ends[word_ends])


_ENCODERS: dict[str, BatchEncoder] = {}


def encoder(path: str) -> BatchEncoder:
    """One encoder per Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = BatchEncoder(path)
    return _ENCODERS[path]
