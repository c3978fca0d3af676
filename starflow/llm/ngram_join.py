"""N-gram Jaccard join with token-combination prefixes (operator 9).

A document is the set of its distinct word shingles ("tokens").  Two documents
link when their sets have a Jaccard similarity of ``percent`` or more.

*Candidates.*  Tokens are rare or frequent by their number of documents, which
is counted over all documents for the tokens whose hash lies in a fixed region
of hash space; all other tokens count as frequent.

* A set of n tokens may lack at most ``t = n - ceil(percent * n / 100)`` tokens
  in a linked partner.  A set with more than t rare tokens is indexed by the
  first t + 1 of them in hash order, one by one: a passage that many documents
  quote never enters the index through it.
* Any other set is indexed by all its rare tokens, and its prefix is extended
  to all its frequent tokens, in combinations: these are dealt by hash into
  classes, so many that two linked sets which share no rare token differ by
  one token at most in some class.  Indexed are the combination of all c
  tokens of each class and its c combinations of c - 1 tokens.  Copies with
  many changes share none of these, unlike single tokens or pairs, of which a
  large family of loosely similar documents has many in common.  Two sets
  that meet by combinations alone differ by all their rare tokens and by those
  that combinations leave out.  An entry is a hub's if its own part of that is
  no more than half of what its size level allows: of a linked pair one is a
  hub, so an entry without hubs proposes nothing.

The number of classes depends on the sizes of the sets; a set is indexed for
every size level in which it can have a partner.  Either way a linking pair
shares an entry of the index, whichever tokens are called frequent.

*Verification.*  The members of an entry with few sets are compared pair by
pair, if they share enough entries: of the one whose single tokens end first
in hash order, all that are not shared are missing in the other.  Entries with
many (only combinations can have them) are joined to
clusters, and a cluster is compared in blocks: if it is more than one, its sets
are dealt by size level into blocks of bounded bytes and number of sets, and
each task gets two blocks of levels that can be partners, counts the common
tokens of TILE x TILE sets at once and hands on one link per set, tile and
group it finds.  No task holds a cluster or a matrix of more than a tile, and
no row is made per pair.  So every candidate pair is verified.

Equal sets are one node throughout.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm import bpe, words
from starflow.llm.columns import free_names, own_columns
from starflow.llm.components import components
from starflow.session import materialise

SHINGLE = 4
PERCENT = 85
SLICE = 1 << 20
# The region of hash space in which frequencies are counted: twice the share
# that a prefix of single tokens takes.
REGION = 0.3
# A token is frequent from this number of documents on.  Should more than
# FREQUENT_TOKENS tokens be frequent, the number is doubled until they fit:
# the set sent to all tasks stays below 8 MB whatever the size of the corpus,
# and any choice of frequent tokens gives the same links.
FREQUENT_FROM = 16
FREQUENT_TOKENS = 1 << 20
# Copies of a set are dropped where a task meets them again; it remembers up
# to this many sets.
REMEMBERED = 1 << 20
BLOCK_BYTES = 2 << 20
BLOCK_SETS = 4096
# Sets a side of the dense matrix of common tokens: 16 MB of float32.
TILE = 2048
COLUMNS = 1024


def token_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of each text, ascending, and where each text's begin."""
    hashes, firsts = words.shingle_hashes(*words.hashed_words(texts), k)
    sets = [np.unique(hashes[a:b]) for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
    counts = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else hashes), np.concatenate([[0], np.cumsum(counts)])


def _sets_of(batch: pa.RecordBatch, k: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    texts, doc_ids = pc.fill_null(batch.column("text"), ""), batch.column("doc_id")
    for a, b in bpe.text_slices(texts, SLICE):
        yield (doc_ids.slice(a, b - a), *token_sets(texts.slice(a, b - a), k))


def _sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    through = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return through[firsts[1:]] - through[firsts[:-1]]


def fingerprints(tokens: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that identify each set."""
    return (_sums(words.mix(tokens + np.uint64(1)), firsts).view(np.int64),
            _sums(words.mix(~tokens), firsts).view(np.int64))


def _missing(n: int, percent: int) -> int:
    """Tokens of a set of ``n`` that a linked partner may lack."""
    return n - -(-percent * n // 100)


def size_levels(percent: int, to: int) -> list[int]:
    """Smallest size of each level: a level's sizes can all be partners."""
    out = [1]
    while out[-1] <= to:
        out.append(max(out[-1] + 1, 100 * out[-1] // percent))
    return out


def _differences(level: int, levels: list[int], percent: int) -> int:
    """Most tokens that are in one set only, of a linked pair whose smaller
    set is of this level."""
    n = levels[level + 1] - 1
    return (n + 100 * n // percent) * (100 - percent) // (100 + percent)


def entries_of(tokens: np.ndarray, rare: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index entries of one set, ascending, and which of them are a hub's:
    ``tokens`` ascending, ``rare`` their mask."""
    n = len(tokens)
    lack = _missing(n, percent)
    single = tokens[rare]
    if len(single) > lack:
        return single[:lack + 1], np.ones(lack + 1, bool)
    out, hubs, rest = [single], [np.ones(len(single), bool)], tokens[~rare]
    codes = words.mix(rest)
    levels = size_levels(percent, n)
    lowest = bisect.bisect_right(levels, -(-percent * n // 100)) - 1
    for level in range(lowest, bisect.bisect_right(levels, n)):
        differ = _differences(level, levels, percent)
        if not differ:
            continue  # only equal sets link, and those are one node
        classes = differ // 2 + 1
        of = (rest % np.uint64(classes)).astype(np.int64)
        whole = np.zeros(classes, np.uint64)
        np.add.at(whole, of, codes)
        tags = words.mix(np.arange(classes, dtype=np.uint64) + np.uint64((level + 1) << 40))
        out += [words.mix(whole + tags), words.mix(whole[of] - codes + tags[of])]
        hubs += [np.full(classes, len(single) <= differ // 2), np.full(len(of), len(single) < differ // 2)]
    # Of equal entries the first is kept, and those of whole classes come first.
    entries, first = np.unique(np.concatenate(out), return_index=True)
    return entries, np.concatenate(hubs)[first]


def signatures(tokens: np.ndarray, rare: np.ndarray, percent: int) -> np.ndarray:
    """Index entries of one set: ``tokens`` ascending, ``rare`` their mask."""
    return entries_of(tokens, rare, percent)[0]


def _region_end() -> np.uint64:
    return np.uint64(int(REGION * 2.0**64))


def document_sets(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n (size of the set), f1, f2 (identify the set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, tokens, firsts in _sets_of(batch, k):
                f1, f2 = fingerprints(tokens, firsts)
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(np.diff(firsts)), pa.array(f1), pa.array(f2)],
                                                 names=["doc_id", "n", "f1", "f2"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, f1 long, f2 long")


def _new_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(tokens, firsts, f1) of the sets of a partition, most copies left out:
    they need the same entries.  A set that is forgotten and met again only
    costs its entries once more."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        for _, tokens, firsts in _sets_of(batch, k):
            f1, f2 = fingerprints(tokens, firsts)
            keep = np.zeros(len(f1), bool)
            for i, key in enumerate(zip(f1.tolist(), f2.tolist(), strict=True)):
                if key not in seen:
                    keep[i] = True
                    seen.add(key)
            if len(seen) > REMEMBERED:
                seen.clear()
            sizes = np.where(keep, np.diff(firsts), 0)
            yield (tokens[np.repeat(keep, np.diff(firsts))],
                   np.concatenate([[0], np.cumsum(sizes[keep])]), f1[keep])


def frequent_tokens(docs: DataFrame, k: int) -> tuple[np.ndarray, int]:
    """The frequent tokens of the region, ascending, at most FREQUENT_TOKENS,
    and the number of documents from which a token is one of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, _, _ in _new_sets(batches, k):
            yield pa.RecordBatch.from_arrays([pa.array(tokens[tokens < _region_end()].view(np.int64))],
                                             names=["token"])

    counted = (docs.select("doc_id", "text").mapInArrow(run, "token long").groupBy("token")
               .agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= FREQUENT_FROM))
    counted = materialise(counted, "frequent-tokens")
    doubled = F.floor(F.log2(F.col("df") / FREQUENT_FROM)).cast("int")
    sizes = {r["d"]: r["n"] for r in counted.groupBy(doubled.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    from_, total = 0, 0
    for d in sorted(sizes, reverse=True):
        total += sizes[d]
        if total > FREQUENT_TOKENS:
            from_ = d + 1
            break
    least = FREQUENT_FROM << from_
    kept = counted.filter(F.col("df") >= least).select("token").toPandas()
    return np.sort(kept["token"].to_numpy(np.int64).view(np.uint64)), least


def index_entries(docs: DataFrame, k: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """sig, node, n, singles: all index entries of all sets.  A node is a
    set's f1; ``singles`` is the number of its entries if they are single
    tokens only, else 0, or -1 where the entry is not a hub's."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, end = sent.value, _region_end()
        for tokens, firsts, f1 in _new_sets(batches, k):
            rare = tokens < end
            if len(common):
                at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
                rare &= common[at] != tokens
            out, singles, counts = [], [], np.zeros(len(f1), np.int64)
            for i, (a, b) in enumerate(zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)):
                if b > a:
                    own, hubs = entries_of(tokens[a:b], rare[a:b], percent)
                    lack = _missing(b - a, percent)
                    of_single = lack + 1 if np.count_nonzero(rare[a:b]) > lack else 0
                    out.append(own)
                    singles.append(np.where(hubs, of_single, -1).astype(np.int32))
                    counts[i] = len(own)
            sig = np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)
            columns = [np.repeat(c, counts) for c in (f1, np.diff(firsts).astype(np.int32))]
            columns.append(np.concatenate(singles) if singles else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (sig, *columns)],
                                             names=["sig", "node", "n", "singles"])

    return docs.select("doc_id", "text").mapInArrow(run, "sig long, node long, n int, singles int")


def _shared_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by entry, hubs first, then node: one row per entry and
    node of the entries that have a hub and more than one node.

    No run is held: its first row tells whether it has a hub, and at most that
    row waits for a second node."""
    names = ["sig", "node", "n", "singles"]
    # Of the run that the last batch ended with: its entry, whether it has a
    # hub, whether it is known to have several nodes, and its last node.
    sig0, hub0, several0, node0 = None, False, False, None
    held = [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.int32)] * 2
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [np.concatenate([h, np.asarray(batch.column(c))]) for h, c in zip(held, names, strict=True)]
        waited = len(held[0]) > 0
        sig, node = rows[0], rows[1]
        new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])])
        new[0] = waited or (int(sig[0]), int(node[0])) != (sig0, node0)
        rows = [r[new] for r in rows]
        sig, node = rows[0], rows[1]
        if not len(sig):
            continue  # repeats of the last row
        goes_on = not waited and int(sig[0]) == sig0
        starts = np.concatenate([[0], np.flatnonzero(sig[1:] != sig[:-1]) + 1])
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(sig))))
        hub = rows[3][starts] >= 0
        several = np.maximum.reduceat(node != node[starts][run], starts)
        if goes_on:
            hub[0], several[0] = hub0, several0 or several[0]
        keep = hub & several
        held = [r[starts[-1]:] if hub[-1] and not several[-1] else r[:0] for r in rows]
        sig0, node0, hub0, several0 = int(sig[-1]), int(node[-1]), bool(hub[-1]), bool(several[-1])
        out = keep[run]
        yield pa.RecordBatch.from_arrays([pa.array(r[out]) for r in rows], names=names)


def shared_entries(entries: DataFrame) -> DataFrame:
    """The entries (sig, node, n, singles) that propose something: those of
    several nodes, one of them a hub, each node once.  One exchange by entry
    and one pass over its sorted rows."""
    ordered = entries.repartition("sig").sortWithinPartitions("sig", F.col("singles").desc(), "node")
    return ordered.mapInArrow(_shared_runs, entries.schema)


def needed_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """doc_id, set: the tokens of the documents in ``ids``, as bytes."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, tokens, firsts in _sets_of(batch, k):
                sets = [tokens[a:b].tobytes() for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(sets, pa.binary())], names=["doc_id", "set"])

    return docs.select("doc_id", "text").join(ids, "doc_id").mapInArrow(encode, "doc_id long, set binary")


def linked_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of documents that link, by their whole sets."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = batch.column("set_a"), batch.column("set_b")
            keep = np.zeros(len(batch), bool)
            for i in range(len(batch)):
                x, y = np.frombuffer(xs[i].as_buffer(), np.uint64), np.frombuffer(ys[i].as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep[i] = 100 * shared >= percent * (len(x) + len(y) - shared)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)),
                                              batch.column("b").filter(pa.array(keep))], names=["a", "b"])

    with_a = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("set_a")), "a")
    with_b = with_a.join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("set_b")), "b")
    return with_b.select("a", "b", "set_a", "set_b").mapInArrow(compare, "a long, b long")


def common_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Number of common tokens of each of ``x`` with each of ``y``."""
    sizes = [len(s) for s in x + y]
    row = np.repeat(np.arange(len(sizes)), sizes)
    tokens, col, times = np.unique(np.concatenate(x + y), return_inverse=True, return_counts=True)
    col = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[col]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((len(x), len(y)), np.float32)
    for c in range(0, int(col[-1]) + 1 if len(col) else 0, COLUMNS):
        own = slice(*np.searchsorted(col, [c, c + COLUMNS]))
        dense = np.zeros((len(sizes), COLUMNS), np.float32)
        dense[row[own], col[own] - c] = 1
        out += dense[:len(x)] @ dense[len(x):].T
    return out.astype(np.int64)


def _tile_links(ids: np.ndarray, sets: list[np.ndarray], one: np.ndarray, two: np.ndarray,
                percent: int) -> list[tuple[int, int]]:
    """Links that join what the sets at ``one`` and those at ``two`` join."""
    sizes = np.array([len(s) for s in sets])
    common = common_counts([sets[i] for i in one], [sets[i] for i in two])
    linked = 100 * common >= percent * (sizes[one][:, None] + sizes[two] - common)
    i, j = np.nonzero(linked)
    i, j = one[i], two[j]
    label = ids.copy()
    while True:
        # The smallest label of any neighbour, until nothing changes.
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        if (new == label).all():
            return [(a, b) for a, b in zip(ids.tolist(), label.tolist(), strict=True) if a != b]
        label = new


def block_links(ids: np.ndarray, sets: list[np.ndarray], second: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join what two blocks' sets join: (member, smallest member),
    for each two tiles of them.

    ``second`` marks the second block; without one, the first is compared
    with itself."""
    one, two = np.flatnonzero(~second), np.flatnonzero(second)
    out = []
    for a in range(0, len(one), TILE):
        others, from_ = (two, 0) if len(two) else (one, a)
        for b in range(from_, len(others), TILE):
            out += _tile_links(ids, sets, one[a:a + TILE], others[b:b + TILE], percent)
    return out


def partner_blocks(sizes: DataFrame, block_bytes: int, block_sets: int) -> DataFrame:
    """component, levels: (level, blocks) of each size level of a cluster, of
    ``sizes`` (component, level, bytes, sets).  A cluster that fits into one
    block has no levels."""
    blocks = F.ceil(F.greatest(F.col("bytes") / block_bytes, F.col("sets") / block_sets)).cast("long")
    small = (F.sum("bytes") <= block_bytes) & (F.sum("sets") <= block_sets)
    return sizes.withColumn("blocks", blocks).groupBy("component").agg(
        F.when(~small, F.collect_list(F.struct("level", "blocks"))).alias("levels"))


def linked_blocks(clusters: DataFrame, sets: DataFrame, percent: int, block_bytes: int,
                  block_sets: int = BLOCK_SETS) -> DataFrame:
    """Links (a, b) within clusters (columns id, component)."""
    def compare(table: pa.Table) -> pa.Table:
        ids = np.asarray(table.column("doc_id")).astype(np.int64)
        own = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("set")]
        second = np.asarray(table.column("block")) != np.asarray(table.column("lo"))
        links = block_links(ids, own, second, percent)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()),
                         "b": pa.array([b for _, b in links], pa.int64())})

    # A little over the largest ratio of partners' sizes, so that these are of
    # the same or neighbouring levels however logarithms are rounded.
    step = max(math.log(100 / percent), 0.01) * (1 + 1e-6)
    level = F.floor(F.log(F.octet_length("set") / 8) / step)
    placed = clusters.withColumnRenamed("id", "doc_id").join(sets, "doc_id").withColumn("level", level)
    sizes = placed.groupBy("component", "level").agg(F.sum(F.octet_length("set")).alias("bytes"),
                                                     F.count(F.lit(1)).alias("sets"))
    dealt = placed.join(partner_blocks(sizes, block_bytes, block_sets), "component")
    # A block's number is its level and its place in it.
    near = F.filter("levels", lambda x: F.abs(x.level - F.col("level")) <= 1)
    others = F.flatten(F.transform(near, lambda x: F.transform(
        F.sequence(F.lit(0).cast("long"), x.blocks - 1), lambda b: F.shiftleft(x.level, 40) + b)))
    blocks = F.filter("levels", lambda x: x.level == F.col("level"))[0].blocks
    block = F.shiftleft("level", 40) + F.pmod(F.xxhash64("doc_id"), blocks)
    zero = F.lit(0).cast("long")
    dealt = dealt.withColumn("block", F.when(F.col("levels").isNull(), zero).otherwise(block))
    other = dealt.withColumn("other", F.explode(
        F.when(F.col("levels").isNull(), F.array(zero)).otherwise(others)))
    keyed = other.select("component", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                         "block", "doc_id", "set")
    return keyed.groupBy("component", "lo", "hi").applyInArrow(compare, "a long, b long")


def _pairs(few: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b, of the sets that share an entry (sig, x, n, singles) and
    may link by their sizes and the number of entries they share."""
    other = few.select("sig", F.col("x").alias("y"), F.col("n").alias("ny"), F.col("singles").alias("sy"))
    fits = F.lit(100) * F.least("n", "ny") >= F.lit(percent) * F.greatest("n", "ny")
    hub = F.greatest("singles", "sy") >= 0
    met = few.join(other, "sig").filter(F.col("x") < F.col("y")).filter(fits).filter(hub)
    met = met.withColumns({c: F.greatest(F.col(c), F.lit(0)) for c in ("singles", "sy")})
    shared = met.groupBy("x", "y", "n", "ny", "singles", "sy").agg(F.count(F.lit(1)).alias("shared"))
    both = F.ceil(F.lit(percent) * (F.col("n") + F.col("ny")) / F.lit(100 + percent))

    def missing(size, singles):
        return (F.col(singles) > 0) & (F.col(singles) - F.col("shared") <= F.col(size) - both)

    possible = (F.col("singles") + F.col("sy") == 0) | missing("n", "singles") | missing("ny", "sy")
    return shared.filter(possible).select(F.col("x").alias("a"), F.col("y").alias("b"))


def jaccard_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id (smallest doc_id reachable by links, itself included).

    A null or empty text, or one of white space, has an empty set and is
    linked with nothing.  A text of fewer than ``k`` words is one token.
    Repeated rows have equal sets and are one node; ``doc_id`` is expected to
    name one text.  A row with a null doc_id links nothing and keeps a null
    component.  Other columns are not read; an empty table gives an empty
    result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = materialise(document_sets(docs, k), "jaccard-documents")
    named = sets.filter("n > 0 AND doc_id IS NOT NULL")
    nodes = materialise(named.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep")), "jaccard-nodes")
    by_node = nodes.select(F.col("f1").alias("node"), "n", "rep")

    known = docs.filter(F.col("doc_id").isNotNull())
    frequent, from_ = frequent_tokens(known, k)
    # An entry that only one set has, or no hub, proposes nothing.
    shared = shared_entries(index_entries(known, k, percent, frequent))
    members = materialise(shared.join(by_node, ["node", "n"]).select("sig", F.col("rep").alias("x"), "n", "singles"),
                          "jaccard-entries")
    sizes = members.groupBy("sig").agg(F.count(F.lit(1)).alias("size"), F.min("x").alias("least"))
    # A single token has fewer sets than a frequent one, so all its entries
    # are compared pair by pair and pairs see all the single tokens they share.
    pairs = _pairs(members.join(sizes.filter(F.col("size") <= from_).select("sig"), "sig"), percent)
    many = members.join(sizes.filter(F.col("size") > from_), "sig")
    clusters = components(many.select(F.col("x").alias("a"), F.col("least").alias("b")))
    clusters = materialise(clusters, "jaccard-clusters")
    # Pairs within a cluster are compared there.
    of_a, of_b = (clusters.select(F.col("id").alias(c), F.col("component").alias(f"cluster_{c}")) for c in "ab")
    apart = F.coalesce(F.col("cluster_a") != F.col("cluster_b"), F.lit(True))
    pairs = pairs.join(of_a, "a", "left").join(of_b, "b", "left").filter(apart).select("a", "b")
    pairs = materialise(pairs, "jaccard-pairs")
    # Written, so that Spark knows its size when it plans the join with the texts.
    ids = materialise(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).unionByName(
        clusters.select(F.col("id").alias("doc_id"))).distinct(), "jaccard-ids")
    token_sets_ = materialise(needed_sets(docs, ids, k), "jaccard-sets")
    links = materialise(linked_pairs(pairs, token_sets_, percent).unionByName(
        linked_blocks(clusters, token_sets_, percent, BLOCK_BYTES)), "jaccard-links")
    final = components(links)

    reps = nodes.join(final.withColumnRenamed("id", "rep"), "rep", "left").select(
        "f1", "f2", "n", F.coalesce("component", "rep").alias("component"))
    empty = sets.filter("n = 0 OR doc_id IS NULL").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return named.join(reps, ["f1", "f2", "n"]).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id")).unionByName(empty)


def keep_one_each(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The rows of ``docs``, with all their columns, of one document of each
    component: that with the smallest doc_id.  Rows without a doc_id stay.
    Each text of a doc_id that names several is a document of its own."""
    id_type = docs.schema["doc_id"].dataType
    gone_id, gone_sha, sha = free_names(docs, "gone_id", "gone_sha", "sha")
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    if ids.filter("rows > 1").isEmpty():
        found = jaccard_components(docs, k, percent).filter("component_id <> doc_id")
        gone = found.select(F.col("doc_id").cast(id_type).alias(gone_id))
        return docs.join(gone, F.col("doc_id") == F.col(gone_id), "left_anti").select(*own_columns(docs))
    # A doc_id with several rows may name several texts: these get keys.
    keyed = docs.withColumn(sha, F.sha2(F.coalesce("text", F.lit("")), 256))
    texts = keyed.select("doc_id", F.col(sha).alias("sha"), "text").filter("doc_id IS NOT NULL")
    keys = materialise(texts.select("doc_id", "sha").distinct().withColumn("key", F.monotonically_increasing_id()),
                       "jaccard-keys")
    found = jaccard_components(texts.join(keys, ["doc_id", "sha"]).select(F.col("key").alias("doc_id"), "text"),
                               k, percent)
    placed = materialise(found.select(F.col("doc_id").alias("key"), "component_id").distinct().join(keys, "key"),
                         "jaccard-placed")
    first = placed.groupBy("component_id").agg(F.min(F.struct("doc_id", "sha", "key"))["key"].alias("first"))
    gone = placed.join(first, "component_id").filter("first <> key").select(
        F.col("doc_id").alias(gone_id), F.col("sha").alias(gone_sha))
    return keyed.join(gone, (F.col("doc_id") == F.col(gone_id)) & (F.col(sha) == F.col(gone_sha)),
                      "left_anti").select(*own_columns(docs))
