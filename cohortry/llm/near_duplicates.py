"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

A document is the set of its runs of five words. Texts with one set are copies: one of them, the class of copies,
goes on for all. Every tree of the forest labels a set with ``DEPTH`` MinHash values of ``WIDTH`` bytes; sorted, the labels are a
prefix trie, and its nodes at one depth are the groups of equal prefixes. Two sets meet in a tree if they share a node.

Prefixes are the longest with which a pair just at the threshold still meets with the wanted odds (``prefix_length``); nothing is
estimated on a part of the texts. The links the forest may miss come from an exact filter over all sets (``sharing_sets``): a pair
it leaves out cannot be linked. So the depth divides the work between the two, and no link hangs on it.

Sets that meet, directly or through others, make a neighbourhood, found as a connected component over one edge per set
and trie node or shared name, so no node's pairs are ever listed. Each neighbourhood gathers its word sets once and verifies
all its pairs exactly with matrix products; a large one is split into blocks, and pairs of blocks are separate groups.
Verified links are counted per set and reduced to a spanning star per block pair, never written out as pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortry import session
from cohortry.llm.base import Texts, documents_of, map_batches, mix64, shielded, small_batches

SHINGLE, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 20, 8, 0.999
WIDTH = 2
"""Bytes of a MinHash value in a label."""
COMBINED, SPARE = 0.7, 1.2
"""From which threshold on the exact filter names parts of sets, and how many parts there are for each that has to be named."""
NAME_BYTES = 5
"""Of a name's hash; names are compared within a bucket only."""
BUCKET_MEMBERS, FLUSH_MEMBERS = 2_000_000, 500_000
"""About how many names one bucket of the exact filter holds, and how many a task gathers before it deals them out."""
BLOCK, BLOCKS = 400, 16
"""Sets of one neighbourhood that are compared in one group; larger neighbourhoods become pairs of blocks, up to this many."""
BLOCK_SETS, BLOCK_SHINGLES = 4000, 4_000_000
"""What a block holds at most, about; only neighbourhoods that exceed it have more blocks."""
TILE = 400
"""Sets that are compared at once."""
LISTED, PAIRS, GROUP_PLACES = 1000, 100_000, 100_000
"""Sets of a name whose pairs are listed to compare their sketches, pairs listed at once, and sets of names that a group holds."""
GROUP_SHINGLES = 1_000_000
"""About how many set members one group of small neighbourhoods holds."""


def materialize(df: DataFrame, label: str) -> DataFrame:
    """A scratch table; texts and sets are shuffled for several, so none leaves its shuffled files behind."""
    return session.materialize(df, label, drop_shuffled=True)


def meeting_odds(similarity: float, trees: int = TREES, depth: int = DEPTH) -> np.ndarray:
    """The probability that two sets of this Jaccard similarity share a prefix in some tree, for prefixes of 1 to ``depth`` values."""
    return 1 - (1 - similarity ** np.arange(1, depth + 1)) ** trees


def prefix_length(pairs: float, met: np.ndarray, expected: np.ndarray, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """The longest prefix with which enough linked pairs meet.

    ``met``: how many of the ``pairs`` share a prefix of 1, 2, ... values; ``expected``: the sum of their odds to do so. Both have to reach
    ``recall``; to the odds those of one more pair, just at the threshold, are added, which alone decide where no pairs are given.
    """
    odds = (expected + meeting_odds(threshold, depth=len(met))) / (pairs + 1)
    enough = np.flatnonzero((met >= recall * pairs) & (odds >= recall))
    return int(enough[-1]) + 1 if len(enough) else 1


def shingle_sets(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct word runs of all texts, text by text, and where each text's start.

    A text of one to four words is one run of all its words; one without words has none.
    """
    words = texts.word_hash()
    value, first = texts.window_hash(words, SHINGLE)
    owner = texts.text_of_word()[first]
    short = np.flatnonzero((texts.n_words > 0) & (texts.n_words < SHINGLE))
    if len(short):
        whole = [int(mix64(np.array([hash_run(words[texts.word_offsets[i] : texts.word_offsets[i + 1]])], np.uint64))[0]) for i in short]
        value, owner = np.concatenate((value, np.array(whole, np.uint64))), np.concatenate((owner, short))
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(texts.n + 1))


def hash_run(words: np.ndarray) -> int:
    total = len(words)
    for w in words.tolist():
        total = (total * 0x9E3779B97F4A7C15 + w) % (1 << 64)
    return total


def _signed(value: np.ndarray) -> np.ndarray:
    return value.astype(np.uint64).view(np.int64)


def label_sets(value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The labels of every text: (text, tree, MinHash value); zeros for a text without a set."""
    have = np.flatnonzero(np.diff(starts))
    labels = np.zeros((len(starts) - 1, TREES, DEPTH), dtype=f">u{WIDTH}")
    rng = np.random.default_rng(2)
    for tree in range(TREES if len(have) else 0):
        for level in range(DEPTH):
            factor, shift = rng.integers(0, 1 << 63, 2, dtype=np.uint64)
            # High bits of an odd multiple order the members at random.
            ordered = (value ^ shift) * (factor * np.uint64(2) + np.uint64(1))
            labels[have, tree, level] = mix64(np.minimum.reduceat(ordered, starts[have])) & np.uint64((1 << 8 * WIDTH) - 1)
    return labels


def set_keys(value: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Two hashes of every text's set."""
    total = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(value + np.uint64(k)), dtype=np.uint64))) for k in (1, 2)]
    return [_signed(t[starts[1:]] - t[starts[:-1]]) for t in total]


class Probe:
    """Texts that the texts of a batch are compared with exactly, to see at which depth linked ones meet: measures the forest alone."""

    def __init__(self, texts: list[str], threshold: float):
        value, starts = shingle_sets(Texts(pa.array(texts, pa.string())))
        self.threshold = threshold
        self.sizes = np.diff(starts)
        self.labels = label_sets(value, starts)
        order = np.argsort(value, kind="stable")
        self.owner = np.repeat(np.arange(len(texts)), self.sizes)[order]
        self.member, first = np.unique(value[order], return_index=True)
        self.first = np.append(first, len(value))

    def compare(self, value: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Per text: linked pairs with other sets of the sample, how many met at depth 1, 2, ..., and the sums of their odds."""
        seen = np.zeros((len(starts) - 1, 1 + 2 * DEPTH))
        if not len(self.member) or not len(value):
            return seen
        at = np.minimum(np.searchsorted(self.member, value), len(self.member) - 1)
        hit = self.member[at] == value
        hits = np.diff(np.concatenate(([0], np.cumsum(hit)))[starts])
        sizes = np.diff(starts)
        # A linked set holds at least the threshold's share of the text's members.
        for i in np.flatnonzero((sizes > 0) & (hits >= self.threshold * sizes - 1e-6)):
            mine = at[starts[i] : starts[i + 1]][hit[starts[i] : starts[i + 1]]]
            shared = np.zeros(len(self.sizes), dtype=np.int64)
            for member in np.array_split(mine, len(mine) // 4096 + 1):
                n = self.first[member + 1] - self.first[member]
                inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                shared += np.bincount(self.owner[np.repeat(self.first[member], n) + inside], minlength=len(self.sizes))
            union = sizes[i] + self.sizes - shared
            for j in np.flatnonzero((shared >= self.threshold * union - 1e-6) & (shared < union)):
                deepest = int(np.logical_and.accumulate(labels[i] == self.labels[j], axis=1).sum(axis=1).max())
                seen[i, 0] += 1
                seen[i, 1 : 1 + deepest] += 1
                seen[i, 1 + DEPTH :] += meeting_odds(shared[j] / union[j])
        return seen


def size_bounds(largest: int, threshold: float) -> np.ndarray:
    """Where the classes of set sizes start: linked sets are of one class or of neighbouring ones. The last class is empty."""
    bounds = [1]
    while bounds[-1] <= largest:
        bounds.append(int(bounds[-1] * max(threshold**-2, 1.25)) + 1)
    return np.array([*bounds, 2 * bounds[-1]])


def most_different(sizes: np.ndarray, largest: np.ndarray, threshold: float) -> np.ndarray:
    """Members that a set of this size and a linked one of at most ``largest`` do not share, those of both together."""
    other = np.minimum(np.floor(sizes / threshold + 1e-5), largest)
    return np.floor((1 - threshold) / (1 + threshold) * (sizes + other) + 1e-5).astype(np.int64)


class Signer:
    """Names parts of sets such that linked sets have at least one name in common.

    Sets of one class of sizes, and those of the class below that can be linked with one, are cut into as many parts by hash, a few more
    than two linked sets can differ in members, so some parts of both are equal. All parts are taken in order of how many members they
    hold, the fullest first; as equal parts have equal places in this order, two sets that differ in d members share one of the first d + 1
    of either. So those are named, and parts of one or no member hardly ever: texts that share single runs do not meet.
    Below ``COMBINED`` linked sets differ too much for that: there the lowest members themselves are the names, of which linked sets share one.

    ``sets``: how many sets each class holds; it only decides how the names are dealt into buckets.
    """

    def __init__(self, bounds: np.ndarray, sets: np.ndarray, threshold: float):
        self.threshold, self.combined = threshold, threshold >= COMBINED
        self.bounds = bounds if self.combined else np.array([1, np.iinfo(np.int64).max])
        self.last = self.bounds[1:] - 1
        if self.combined:
            self.parts = np.ceil(SPARE * (most_different(self.last, self.last, threshold) + 1)).astype(np.int64)
            held = sets + np.concatenate(([0], sets[:-1]))
        else:
            self.parts, held = np.array([1 << 16]), np.array([sets.sum()])
        # Parts of many sets are buckets of their own, dealt out further by name; parts of few sets share one.
        self.slices = np.maximum(1, -(-held // BUCKET_MEMBERS))
        self.joint = np.clip(BUCKET_MEMBERS // np.maximum(held, 1), 1, self.parts)
        n = -(-self.parts // self.joint) * self.slices
        self.first = np.cumsum(n) - n

    def _cut(self, value: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of sets, side by side and in order of hash, the text, part and name of all parts to be named under the classes ``at``."""
        parts = self.parts[at]
        text = np.repeat(np.arange(len(sizes)), sizes)
        if not self.combined:
            place = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            low = place < (sizes - np.maximum(np.ceil(self.threshold * sizes - 1e-6), 1) + 1)[text]
            name = mix64(value[low])
            return text[low], (name & np.uint64(0xFFFF)).astype(np.int64), mix64(name)
        end = np.cumsum(parts)
        first = end - parts
        part = first[text] + np.minimum((value.astype(np.float64) / 2**64 * parts[text]).astype(np.int64), parts[text] - 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(value + np.uint64(3)), dtype=np.uint64)))
        edges = np.searchsorted(part, np.arange(end[-1] + 1 if len(end) else 1))
        owner = np.repeat(np.arange(len(sizes)), parts)
        fullest = np.lexsort((-np.diff(edges), owner))
        place = np.arange(len(owner)) - first[owner]  # of the sorted parts, too: those of a text stay together
        named = np.sort(fullest[place < (most_different(sizes, self.last[at], self.threshold) + 1)[owner]])
        part = place[named]
        name = mix64(total[edges[named + 1]] - total[edges[named]] + part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return owner[named], part, name

    def names(self, value: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of sets, side by side and each in order of hash: the text, the bucket and a hash of every name."""
        own = np.searchsorted(self.bounds, sizes, side="right") - 1
        found = []
        for above in (0, 1) if self.combined else (0,):
            # The class above is asked where a linked set can be of it.
            asked = np.floor(sizes / self.threshold + 1e-5) >= self.bounds[own + above] if above else np.ones(len(sizes), dtype=bool)
            at = own[asked] + above
            text, part, name = self._cut(value[np.repeat(asked, sizes)], sizes[asked], at)
            at = at[text]
            bucket = self.first[at] + part // self.joint[at] * self.slices[at] + (name % self.slices[at].astype(np.uint64)).astype(np.int64)
            found.append((np.flatnonzero(asked)[text], bucket, name))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _deal(signer: Signer) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's sets' names, packed by bucket: (bucket, sets, counts, names) with the sets, their numbers of names and these as bytes."""

    def packed(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        bucket, owner, name = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(bucket, kind="stable")
        bucket, owner, name = bucket[order], owner[order], name[order]
        new = np.ones(len(bucket), dtype=bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])
        run = np.flatnonzero(new)
        owner, count = owner[run], np.diff(np.append(run, len(bucket))).astype(np.uint32)
        there, first = np.unique(bucket, return_index=True)
        names = np.ascontiguousarray(name.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - NAME_BYTES :])
        row = np.searchsorted(run, first)

        def column(values: np.ndarray, starts: np.ndarray) -> pa.Array:
            ends = [*starts[1:].tolist(), len(values)]
            return pa.array([values[low:high].tobytes() for low, high in zip(starts.tolist(), ends, strict=True)], pa.binary())

        columns = [pa.array(there, pa.int64()), column(owner, row), column(count, row), column(names, first)]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "sets", "counts", "names"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, known = [], 0, np.zeros(0, np.int64)
        for batch in batches:
            value, starts = shingle_sets(Texts(batch.column("text")))
            keys, sizes = set_keys(value, starts)[0], np.diff(starts)
            # Copies end here, so a task sends a set once.
            first = np.unique(keys, return_index=True)[1]
            new = np.sort(first[(sizes[first] > 0) & ~np.isin(keys[first], known)])
            known = np.concatenate((known, keys[new]))
            if not len(new):
                continue
            inside = np.zeros(len(sizes), dtype=bool)
            inside[new] = True
            text, bucket, name = signer.names(value[np.repeat(inside, sizes)], sizes[new])
            parts.append((bucket, keys[new][text], name))
            held += len(name)
            if held >= FLUSH_MEMBERS:
                yield packed(parts)
                parts, held = [], 0
        if parts:
            yield packed(parts)

    return deal


def _sharing(table: pa.Table) -> pa.Table:
    """The different lists of sets that share a name of the bucket, a row for each set: (place, set1), the place a hash of the list."""
    owner, count, raw = (
        np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("sets", np.int64), ("counts", np.uint32), ("names", np.uint8))
    )
    name = np.zeros((len(raw) // NAME_BYTES, 8), np.uint8)
    name[:, 8 - NAME_BYTES :] = raw.reshape(-1, NAME_BYTES)
    name, owner = name.view(">u8").ravel().byteswap(inplace=True).view(np.uint64), np.repeat(owner, count)
    order = np.lexsort((owner, name))
    name, owner = name[order], owner[order]
    new = np.ones(len(name), dtype=bool)
    new[1:] = (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])
    name, owner = name[new], owner[new]
    start = np.flatnonzero(np.concatenate((np.ones(min(1, len(name)), dtype=bool), name[1:] != name[:-1])))
    n = np.diff(np.append(start, len(name)))
    lists = np.add.reduceat(mix64(owner.view(np.uint64)), start) if len(start) else np.zeros(0, np.uint64)
    several = np.flatnonzero(n > 1)
    several = several[np.unique(lists[several], return_index=True)[1]]
    held = np.zeros(len(start), dtype=bool)
    held[several] = True
    rows = np.repeat(held, n)
    return pa.table({"place": _signed(np.repeat(lists, n)[rows]), "set1": owner[rows]})


def set_sketches(value: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """Per text a bit for each residue of its members' hashes: whether an odd number of them has it. As many bits as members or up to twice that.

    A member that only one of two sets holds changes one bit, so the sketches differ in no more bits than the sets in members. One of twice
    the bits becomes one of half of them if its halves are added.
    """
    sizes = np.diff(starts)
    bits = 1 << np.ceil(np.log2(np.maximum(sizes, 64))).astype(np.int64)
    end = np.cumsum(bits)
    text = np.repeat(np.arange(len(sizes)), sizes)
    residue = (mix64(value + np.uint64(4)) & (bits[text] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount((end - bits)[text] + residue, minlength=int(end[-1]) if len(end) else 0) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return [packed[(e - b) // 8 : e // 8] for e, b in zip(end.tolist(), bits.tolist(), strict=True)]


class _Sketches:
    """Sketches by their place in a list, compared at the smaller one's width."""

    def __init__(self, sketches: list[bytes]):
        self.words = np.array([len(x) // 8 for x in sketches], np.int64)
        self.row = np.zeros(len(sketches), np.int64)
        self.known = {}
        for w in np.unique(self.words).tolist():
            at = np.flatnonzero(self.words == w)
            self.row[at] = np.arange(len(at))
            self.known[w, w] = np.frombuffer(b"".join(sketches[i] for i in at.tolist()), np.uint64).reshape(-1, w)

    def _folded(self, w: int, to: int) -> np.ndarray:
        if (w, to) not in self.known:
            wide = self._folded(w, 2 * to)
            self.known[w, to] = wide[:, :to] ^ wide[:, to:]
        return self.known[w, to]

    def differ(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """In how many bits the sketches of each pair differ."""
        found = np.zeros(len(left), np.int64)
        widths = self.words[left] * (1 << 32) + self.words[right]
        for width in np.unique(widths).tolist():
            a, b = width >> 32, width & 0xFFFFFFFF
            to, pairs = min(a, b), np.flatnonzero(widths == width)
            one, two = self._folded(a, to), self._folded(b, to)
            for at in np.array_split(pairs, len(pairs) * to // (1 << 20) + 1):
                found[at] = np.bitwise_count(one[self.row[left[at]]] ^ two[self.row[right[at]]]).sum(axis=1)
        return found


def _alike(threshold: float) -> Callable[[pa.Table], pa.Table]:
    """Edges (a, b) between the sets of every place of different neighbourhoods (column ``root``) whose sketches let them be linked."""

    def alike(table: pa.Table) -> pa.Table:
        place, owner, root, size = (table.column(c).to_numpy() for c in ("place", "set1", "root", "size"))
        sketches = _Sketches(table.column("sketch").to_pylist())
        order = np.lexsort((owner, place))
        new = np.ones(len(order), dtype=bool)
        new[1:] = place[order][1:] != place[order][:-1]
        start = np.flatnonzero(new)
        n = np.diff(np.append(start, len(order)))
        # The sets of a place that very many share are one neighbourhood, its pairs are not listed.
        crowded = np.repeat(n > LISTED, n)
        first = np.repeat(start, n)
        edges = [(owner[order[crowded]], owner[order[first[crowded]]])]
        later = np.where(crowded, 0, np.repeat(start + n, n) - np.arange(len(order)) - 1)
        total = np.concatenate(([0], np.cumsum(later)))
        for low in range(0, int(total[-1]), PAIRS):
            pair = np.arange(low, min(low + PAIRS, int(total[-1])))
            at = np.searchsorted(total, pair, side="right") - 1
            left, right = order[at], order[at + 1 + pair - total[at]]
            least, most = np.minimum(size[left], size[right]), np.maximum(size[left], size[right])
            open_ = (root[left] != root[right]) & (least >= threshold * most - 1e-6)
            left, right = left[open_], right[open_]
            limit = np.floor((1 - threshold) / (1 + threshold) * (size[left] + size[right]) + 1e-5)
            near = sketches.differ(left, right) <= limit
            edges.append((owner[left[near]], owner[right[near]]))
        a, b = (np.concatenate(c) for c in zip(*edges, strict=True))
        return pa.table({"a": a[a != b], "b": b[a != b]})

    return alike


def sharing_sets(texts: DataFrame, sets: DataFrame, near: DataFrame, threshold: float) -> DataFrame:
    """Edges (a, b) that, with the neighbourhoods (node, root) in ``near``, connect every linked pair of the sets of ``texts``.

    Linked sets share a name (``Signer``). Names of a few members are shared by chance, too, the more so the more texts there are, so
    sets that share one are compared by their sketches, which no linked pair fails: the edges grow with the sets that are much alike.
    ``sets``: (set1, size, sketch) of all different sets.
    """
    bounds = size_bounds(sets.agg(F.max("size")).first()[0] or 0, threshold)
    below = sets.agg(*(F.count_if(F.col("size") < int(b)).alias(f"n{k}") for k, b in enumerate(bounds))).first()
    signer = Signer(bounds, np.diff(np.array(below, dtype=np.int64)), threshold)
    dealt = texts.select("text").mapInArrow(_deal(signer), "bucket long, sets binary, counts binary, names binary")
    found = materialize(dealt.groupBy("bucket").applyInArrow(_sharing, "place long, set1 long"), "sharing").distinct()
    rooted = found.join(near, F.col("set1") == F.col("node"), "left").select("place", "set1", F.coalesce("root", "set1").alias("root"))
    own = Window.partitionBy("place")
    apart = rooted.withColumns({"low": F.min("root").over(own), "high": F.max("root").over(own)}).where("low < high")
    apart = materialize(apart.select("place", "set1", "root"), "apart")
    groups = max(1, -(-apart.count() // GROUP_PLACES))
    sketched = apart.join(sets, "set1").withColumn("crowd", F.pmod(F.xxhash64("place"), F.lit(groups)))
    return materialize(sketched.groupBy("crowd").applyInArrow(_alike(threshold), "a long, b long"), "alike")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the undirected edges (a, b) is connected with.

    In every round each node points to its smallest neighbour, and to that one's; then the edges are contracted: ends are
    replaced by where they point, and edges within one node and repeated ones go. So each round works on what is left of the
    graph, at most about half of its nodes, and the rounds' pointers are followed from the last one back.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    left = materialize(both.distinct(), "edges")
    rounds: list[DataFrame] = []
    while not rounds or not left.isEmpty():
        low = left.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("low"))
        low = materialize(low, "lowest")
        top = low.select(F.col("node").alias("low"), F.col("low").alias("root"))
        rounds.append(materialize(low.join(top, "low").select("node", "root"), "pointers"))
        ends = [rounds[-1].select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("a", "b")]
        moved = left.join(ends[0], "a").join(ends[1], "b").where("a_root != b_root")
        left = materialize(moved.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct(), "edges")
    found = rounds.pop()
    for pointers in reversed(rounds):
        above = found.select(F.col("node").alias("root"), F.col("root").alias("top"))
        found = pointers.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return found


def _met(places: DataFrame) -> DataFrame:
    """Edges (a, b) from the sets of every node to its first one."""
    nodes = places.groupBy("node").agg(F.min("set1").alias("first"), F.max("set1").alias("last")).where(F.col("first") < F.col("last"))
    return places.join(nodes, "node").where(F.col("set1") != F.col("first")).select(F.col("set1").alias("a"), F.col("first").alias("b"))


def _tile(sets: list[np.ndarray], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The sets of a tile: their rows; all their members in order of hash, with the place of the set in the tile; the different members."""
    owner = np.repeat(np.arange(len(rows)), [len(sets[i]) for i in rows])
    member = np.concatenate([sets[i] for i in rows])
    order = np.argsort(member, kind="stable")
    member, owner = member[order], owner[order]
    return rows, member, owner, member[np.concatenate(([True], member[1:] != member[:-1]))]


def _shared(left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...]) -> np.ndarray:
    """How many members each set of one tile shares with each of another, or of the same."""
    both = np.intersect1d(left[3], right[3], assume_unique=True) if left is not right else left[3]
    if left is right:  # what one set alone holds is shared with none but itself
        again = left[1][1:][left[1][1:] == left[1][:-1]]
        both = again[np.concatenate(([True], again[1:] != again[:-1]))] if len(again) else again
    shared = np.zeros((len(left[0]), len(right[0])), dtype=np.float32)
    for low in range(0, len(both), 8192):
        part = both[low : low + 8192]
        dense = []
        for _, member, owner, _ in (left, right) if left is not right else (left,):
            at = slice(np.searchsorted(member, part[0]), np.searchsorted(member, part[-1], side="right"))
            column = np.searchsorted(part, member[at])
            held = part[column] == member[at]
            dense.append(np.zeros((len(left[0]) if not dense else len(right[0]), len(part)), dtype=np.float32))
            dense[-1][owner[at][held], column[held]] = 1
        shared += dense[0] @ dense[-1].T
    return shared


def _verify(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links between the sets of one neighbourhood's pair of blocks: per set the linked documents, and a spanning star."""
    sets, copies, ids = rows["shingles"].to_list(), rows["copies"].to_numpy(), rows["set1"].to_numpy()
    sizes = np.array([len(s) for s in sets])
    own = rows["block"].to_numpy() == rows["low"].to_numpy()
    one = own.all()  # a block with itself
    sides = [np.flatnonzero(own), np.flatnonzero(own if one else ~own)]
    if not all(map(len, sides)):
        return pd.DataFrame({"set1": rows["set1"], "set2": rows["set2"], "size": sizes, "links": 0, "root": ids})
    left = [_tile(sets, sides[0][k : k + TILE]) for k in range(0, len(sides[0]), TILE)]
    right = left if one else [_tile(sets, sides[1][k : k + TILE]) for k in range(0, len(sides[1]), TILE)]
    links = np.zeros(len(sets), dtype=np.int64)
    linked = np.zeros((len(sides[0]), len(sides[1])), dtype=bool)
    for i, a in enumerate(left):
        for j, b in enumerate(right[i:] if one else right, i if one else 0):
            shared = _shared(a, b)
            near = shared >= threshold * (sizes[a[0]][:, None] + sizes[b[0]][None, :] - shared) - 1e-6
            if a is b:
                np.fill_diagonal(near, False)
            links[a[0]] += near @ copies[b[0]]
            linked[i * TILE : i * TILE + len(a[0]), j * TILE : j * TILE + len(b[0])] = near
            if a is not b:
                links[b[0]] += near.T @ copies[a[0]]
                if one:
                    linked[j * TILE : j * TILE + len(b[0]), i * TILE : i * TILE + len(a[0])] = near.T
    by_id = np.argsort(ids, kind="stable")
    top = np.argsort(by_id, kind="stable")  # the lowest place by id of what a set is linked with
    while True:
        low = top.copy()
        for rows_, cols, found in ((sides[0], sides[1], linked), (sides[1], sides[0], linked.T)):
            for k in range(0, len(rows_), TILE):
                best = np.where(found[k : k + TILE], top[cols][None, :], len(sets)).min(axis=1)
                low[rows_[k : k + TILE]] = np.minimum(low[rows_[k : k + TILE]], best)
        low = low[by_id[low]]
        if (low == top).all():
            break
        top = low
    return pd.DataFrame({"set1": rows["set1"], "set2": rows["set2"], "size": sizes, "links": links, "root": ids[by_id[top]]})


def _classified(documents: DataFrame, threshold: float, recall: float, by_id: bool) -> tuple[DataFrame, DataFrame]:
    """The rows with an id, (doc_id, text_key, set1, set2, size), and their different sets, (set1, set2, size, first, copies, links).

    ``first`` is the smallest (doc_id, text_key) of the class that the set's links lead to; with ``by_id`` sets of one id are of one class.
    """
    spark = documents.sparkSession
    small_batches(spark)
    texts = documents.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    label_bytes = DEPTH * WIDTH

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        value, starts = shingle_sets(Texts(batch.column("text")))
        labels = label_sets(value, starts)
        keys = set_keys(value, starts)
        sizes = np.diff(starts)
        n_labels = len(labels) * TREES
        ends = pa.py_buffer(np.arange(0, n_labels * label_bytes + 1, label_bytes, dtype=np.int32))
        label = pa.Array.from_buffers(pa.binary(), n_labels, [None, ends, pa.py_buffer(labels.tobytes())])
        listed = pa.ListArray.from_arrays(pa.array(np.arange(0, n_labels + 1, TREES), pa.int32()), label)
        columns = [batch.column("doc_id"), batch.column("text_key"), *(pa.array(k) for k in keys), pa.array(sizes, pa.int64()), listed]
        columns.append(pa.array(set_sketches(value, starts), pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "set1", "set2", "size", "labels", "sketch"])

    signature = "doc_id long, text_key long, set1 long, set2 long, size long, labels array<binary>, sketch binary"
    signed = materialize(map_batches(texts, sign, signature), "signatures")
    no_pairs = np.zeros(DEPTH)
    length = prefix_length(0, no_pairs, no_pairs, threshold, recall)
    of_set = ["set1", "set2", "size"]
    # Equal sets have equal labels and sketches, so any row's will do.
    smallest = F.min(F.struct("doc_id", "text_key")).alias("smallest")
    reps = signed.where("size > 0").groupBy(*of_set).agg(smallest, F.count(F.lit(1)).alias("copies"), F.first("labels").alias("labels"), F.first("sketch").alias("sketch"))
    reps = reps.select(*of_set, F.col("smallest.doc_id").alias("rep"), F.col("smallest.text_key").alias("text_key"), "copies", "labels", "sketch")
    reps = materialize(reps, "representatives")

    # Neighbourhoods are made of sets, not of ids: an id with many texts brings only those together that meet.
    places = reps.select("set1", F.posexplode("labels").alias("tree", "label"))
    places = places.select("set1", F.xxhash64("tree", F.substring("label", 1, length * WIDTH)).alias("node"))
    met = materialize(components(_met(places)), "met")
    alike = sharing_sets(texts, reps.select("set1", "size", "sketch"), met, threshold)
    around = components(met.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a != b").union(alike))

    members = reps.drop("labels", "sketch").join(around, F.col("set1") == F.col("node")).drop("node")
    counted = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"))
    # Every set is repeated for each block of its neighbourhood, so there are few of them, each as large as a task can hold.
    most = (F.least(F.ceil(F.col("n") / BLOCK), F.lit(BLOCKS)), F.ceil(F.col("n") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    counted = counted.withColumn("blocks", F.greatest(*most).cast("int"))
    total = counted.agg(F.sum("shingles")).first()[0] or 0
    groups = max(1, -(-total // GROUP_SHINGLES))
    planned = members.join(counted.select("root", "blocks"), "root").withColumn("block", F.pmod(F.xxhash64("set1", "set2"), "blocks").cast("int"))
    planned = materialize(planned.select("rep", "text_key", "set1", "set2", "copies", "root", "blocks", "block"), "neighbourhoods")

    def gather(batch: pa.RecordBatch) -> pa.RecordBatch:
        value, starts = shingle_sets(Texts(batch.column("text")))
        sets = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(_signed(value)))
        kept = [c for c in batch.schema.names if c != "text"]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), sets], names=[*kept, "shingles"])

    # One row for each text of an id, however often it stands there: repeats end in the task that reads them.
    single = texts.withColumnRenamed("doc_id", "rep").groupBy("rep", "text_key").agg(F.first("text").alias("text"))
    # The sets are dealt out by id and text at every size; a broadcast of the plan would only fit small corpora.
    wanted = planned.hint("merge").join(single, ["rep", "text_key"]).select("rep", "set1", "set2", "copies", "root", "blocks", "block", "text")
    gathered = map_batches(wanted, gather, "rep long, set1 long, set2 long, copies long, root long, blocks int, block int, shingles array<long>")
    # A set goes to every pair of blocks that its own is part of.
    paired = gathered.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = paired.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    crowd = F.when(F.col("blocks") > 1, F.xxhash64("root", "low", "high")).otherwise(F.pmod(F.xxhash64("root"), F.lit(groups)))

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        found = [_verify(part, threshold) for _, part in rows.groupby(["root", "low", "high"], sort=False)]
        return pd.concat(found, ignore_index=True)

    columns = ["root", "low", "high", "block", "rep", "set1", "set2", "copies", "shingles"]
    checked = paired.withColumn("crowd", crowd).select("crowd", *columns).groupBy("crowd")
    checked = materialize(checked.applyInPandas(verify, "set1 long, set2 long, size long, links long, root long"), "links")
    links = checked.groupBy(*of_set).agg(F.sum("links").alias("links"))
    joins = checked.where("set1 != root").select(F.col("set1").alias("a"), F.col("root").alias("b"))
    if by_id:
        worded = signed.where("size > 0")
        several = worded.groupBy("doc_id").agg(F.min("set1").alias("low"), F.max("set1").alias("high")).where("low < high").select("doc_id", "low")
        joins = joins.union(worded.join(several, "doc_id").where("set1 != low").select(F.col("set1").alias("a"), F.col("low").alias("b")))
    classes = reps.select(*of_set, "rep", "text_key", "copies").join(components(joins), F.col("set1") == F.col("node"), "left").drop("node")
    classes = materialize(classes.withColumn("root", F.coalesce("root", "set1")), "classes")
    first = classes.groupBy("root").agg(F.min(F.struct(F.col("rep").alias("doc_id"), "text_key")).alias("first"))
    decided = classes.join(first, "root").join(links, of_set, "left")
    return signed, decided.select(*of_set, "first", "copies", F.coalesce("links", F.lit(0)).alias("links"))


def near_classes(documents: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, n_copies, n_links) of every row with an id.

    ``class_id`` is the smallest id of the documents that links (Jaccard similarity of the sets of five-word runs at least
    ``threshold``) connect, directly or through others; ``n_links`` counts the other documents linked directly, copies
    included; ``n_copies`` the documents with the same set, itself included. A document without words (null and empty texts)
    stands alone. Texts of one to four words are one run. Rows without an id are left out; rows that share an id and are
    copies come back as often as they stand there and count as copies, those of different texts are documents of their own
    that fall into one class. Very long texts are compared whole; an empty table gives no rows.
    Other columns are not read.
    """
    signed, decided = _classified(documents, threshold, recall, by_id=True)
    of_set = ["set1", "set2", "size"]
    own = signed.select("doc_id", *of_set).join(decided, of_set, "left")
    copies = F.coalesce("copies", F.lit(1))
    return own.select(
        "doc_id",
        F.coalesce("first.doc_id", "doc_id").alias("class_id"),
        copies.alias("n_copies"),
        (F.coalesce("links", F.lit(0)) + copies - 1).alias("n_links"),
    )


def keep_one_of_each(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` that stay: of every class the document with the smallest id; rows without an id all stay.

    Rows that share an id are documents of their own: those whose texts are not linked all stay, of rows equal in id and text one. Of
    documents without words one row of each id and text stays.
    """
    documents, restored = shielded(documents, "doc_id", "text")
    signed, decided = _classified(documents, threshold, RECALL, by_id=False)
    chosen = decided.select("first.doc_id", "first.text_key").union(signed.where("size = 0").select("doc_id", "text_key")).distinct()
    keyed = documents.withColumn("_text_key", F.xxhash64("text"))
    chosen = keyed.join(chosen.withColumnRenamed("text_key", "_text_key"), ["doc_id", "_text_key"], "left_semi")
    order = Window.partitionBy("doc_id", "_text_key").orderBy("text")
    single = chosen.withColumn("_row", F.row_number().over(order)).where("_row = 1").select(*documents.columns)
    return restored(single.unionByName(documents.where(F.col("doc_id").isNull())))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(documents_of(spark, sf_dir))


OP6_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
runs AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(words) >= 5
    THEN list_transform(range(1, len(words) - 3), lambda k: array_to_string(words[k:k + 4], ' '))
    ELSE [array_to_string(words, ' ')] END)) AS run
  FROM w WHERE len(words) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM runs a JOIN runs b ON a.run = b.run AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT s.a, s.b, s.n = x.n AND s.n = y.n AS same FROM shared s JOIN sizes x ON s.a = x.doc_id JOIN sizes y ON s.b = y.doc_id
  WHERE 10 * s.n >= 8 * (x.n + y.n - s.n)),
reach AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.root = l.a)
SELECT r.node AS doc_id, min(r.root) AS class_id,
  1 + (SELECT count(*) FROM links WHERE a = r.node AND same) AS n_copies, (SELECT count(*) FROM links WHERE a = r.node) AS n_links
FROM reach r GROUP BY r.node
"""
