"""Token counts by trie-shared dynamic programming (operator 4).

A text is cut at white space; each word, with the mark for a word's start
before it, is a pre-token.  Its tokens are its best segmentation under a
unigram model: the pieces of a public vocabulary file, with log-probabilities
from a Zipf law over their rank in that file (nothing is trained).

The distinct pre-tokens of a slice of texts are inserted in a trie in
lexicographic order.  A node's forward score (best sum of log-probabilities
up to it) and the number of tokens on that way are computed once, when the
node is made, and shared by all pre-tokens below it; a terminal node's number
is its pre-token's count.  As insertion follows the order of a depth-first
walk, only the nodes of the current path are held.

Counts of known pre-tokens are kept between slices in a cache of bounded
size.  Documents are only read: nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm import bpe

PIECE_FILE = "piece_bpe_32k.model"
WORD_START = "▁"
# A character in no piece is spelled in bytes, at this much less than the
# least probable piece.
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 1_000_000


def default_piece_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(PIECE_FILE)


def read_pieces(path: str) -> dict[str, float]:
    """{piece: log-probability} of the file's ordinary pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    norm = math.log(sum(1 / (r + 1) for r in range(len(pieces))))
    return {p: -math.log(r + 1) - norm for r, p in enumerate(pieces)}


class PrefixTrie:
    """Forward scores over the trie of pre-tokens inserted in order."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        # A longer piece can only end here if all its endings are endings of
        # some piece: the search for pieces stops at the first that is not.
        self.endings = {p[i:] for p in pieces for i in range(len(p))}
        self.unknown = min(pieces.values()) - UNKNOWN_PENALTY

    def counts(self, words: list[str]) -> list[int]:
        """Tokens of each word; ``words`` ascending and distinct."""
        pieces, endings = self.pieces, self.endings
        score, tokens = [0.0], [0]  # of the nodes on the path
        out, path = [], ""
        for word in words:
            shared, most = 0, min(len(path), len(word))
            if word.startswith(path):
                shared = most
            else:
                while shared < most and path[shared] == word[shared]:
                    shared += 1
            del score[shared + 1:], tokens[shared + 1:]
            for d in range(shared + 1, len(word) + 1):
                best = score[d - 1] + self.unknown
                n = tokens[d - 1] + len(word[d - 1].encode("utf-8", "replace"))
                if word[d - 1] in pieces:
                    best = -math.inf
                for a in range(d - 1, -1, -1):
                    part = word[a:d]
                    if part not in endings:
                        break
                    p = pieces.get(part)
                    if p is not None and score[a] + p > best:
                        best, n = score[a] + p, tokens[a] + 1
                score.append(best)
                tokens.append(n)
            out.append(tokens[len(word)])
            path = word
        return out


class TokenCounter:
    """Counts of whole texts with a bounded cache of pre-token counts."""

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        self.trie = PrefixTrie(read_pieces(path))
        self.cached_words = cached_words
        self._clear()

    def _clear(self):
        self.words, self.known = pa.array([], pa.string()), np.zeros(0, np.int64)

    def _learn(self, words: pa.Array):
        order = pc.sort_indices(words)
        ascending = words.take(order).to_numpy(zero_copy_only=False).tolist()
        counts = np.zeros(len(words), np.int64)
        counts[np.asarray(order)] = self.trie.counts([WORD_START + w for w in ascending])
        self.words = pa.concat_arrays([self.words, words.cast(pa.string())])
        self.known = np.concatenate([self.known, counts])

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(pre-tokens, tokens) of each text; a null text has none."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = lists.flatten()
        per_text = np.asarray(pc.list_value_length(lists)).astype(np.int64)
        at = np.asarray(pc.fill_null(pc.index_in(words, value_set=self.words), -1)).astype(np.int64)
        missed = np.flatnonzero(at < 0)
        if len(missed):
            new = words.take(pa.array(missed)).dictionary_encode()
            if len(self.words) + len(new.dictionary) > self.cached_words:
                self._clear()
                missed, new = np.arange(len(words)), words.dictionary_encode()
            base = len(self.words)
            self._learn(new.dictionary)
            at[missed] = base + np.asarray(new.indices)
        # White space at the ends of a text leaves empty words.
        filled = np.asarray(pc.binary_length(words)).astype(np.int64) > 0
        ends = np.concatenate([[0], np.cumsum(per_text)])
        n_words = np.concatenate([[0], np.cumsum(filled)])
        n_tokens = np.concatenate([[0], np.cumsum(np.where(filled, self.known[at], 0))])
        return np.diff(n_words[ends]), np.diff(n_tokens[ends])


_COUNTERS: dict[str, TokenCounter] = {}


def count_tokens(docs: DataFrame, piece_path: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_tokens.

    A null or empty text has no tokens.  Repeated rows are counted one by
    one, a null doc_id is carried through, other columns are not read, an
    empty table gives an empty result.
    """
    path = piece_path or default_piece_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:
            _COUNTERS[path] = TokenCounter(path)
        counter = _COUNTERS[path]
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id")
            for a, b in bpe.text_slices(texts):
                n_words, n_tokens = counter.count(texts.slice(a, b - a))
                yield pa.RecordBatch.from_arrays([doc_ids.slice(a, b - a), pa.array(n_words), pa.array(n_tokens)],
                                                 names=["doc_id", "n_words", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_tokens long")
