"""SimHash fingerprints and the components of fingerprints that differ in a few bits.

Only distinct fingerprints are compared.  The space of pairs is cut by blocks of the bits
(pigeonhole: with at most ``distance`` differing bits and ``distance + spare`` blocks, at least
``spare`` blocks agree), which is how the work is partitioned; the blocks are the same at every size.  In each partition the fingerprints
are sorted by Gray rank and put under a hierarchy of nodes: a node stores the bits that all
fingerprints below it share (mask and pattern).  A pair of nodes whose shared patterns already
differ in more than ``distance`` bits is dropped with everything below it.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .common import joined_bytes, materialise, runs_of, small_batches

_BATCH_BYTES = 1 << 20
_FAN = 8
_FRONTIER = 1 << 18

#: white space between words: 0x20 and 0x09-0x0D
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: byte value -> eight 8-bit lanes, lane b is bit b
_LANES = np.array([sum(((v >> b) & 1) << (8 * b) for b in range(8)) for v in range(256)], np.uint64)


def _bit_counts(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Number of set bits per document and bit position; ``counts`` hashes belong to each document."""
    out = np.zeros((len(counts), 64), np.int64)
    if not len(hashes):
        return out
    chunks = -(-counts // 255)
    doc = np.repeat(np.arange(len(counts)), chunks)
    starts = np.concatenate(([0], np.cumsum(counts)))[:-1]
    within = np.arange(len(doc)) - np.repeat(np.concatenate(([0], np.cumsum(chunks)))[:-1], chunks)
    at = starts[doc] + within * 255
    octets = hashes.view(np.uint8).reshape(-1, 8)
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    for k in range(8):
        lanes = np.add.reduceat(_LANES[octets[:, k]], at)
        part = lanes.view(np.uint8).reshape(-1, 8).astype(np.int64)
        out[doc[first], 8 * k : 8 * k + 8] = np.add.reduceat(part, first, axis=0)
    return out


def fingerprint_array(texts: pa.Array, width: int = 4, seed: int = 42) -> np.ndarray:
    """SimHash of every text: words between white space, A-Z lower-cased, shingles of ``width`` words."""
    data, offsets = joined_bytes(texts)
    flags = np.zeros(len(data) + len(offsets), bool)  # a break after each document
    place = np.arange(len(data)) + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    flags[place] = ~_SPACE[data]
    low = np.full(len(flags), 32, np.uint8)
    low[place] = _LOWER[data]
    starts, ends = runs_of(flags)
    keep = flags.copy()
    keep[ends] = True  # one space after each word
    low[ends] = 32
    moved = np.cumsum(keep) - 1
    plain = low[keep].tobytes()
    starts, ends = moved[starts], moved[ends]
    limits = offsets + np.arange(len(offsets))
    owner = np.searchsorted(limits[1:], np.flatnonzero(keep)[starts], "right") if len(starts) else starts
    words = np.bincount(owner, minlength=len(offsets) - 1).astype(np.int64)
    counts = np.where(words >= width, words - width + 1, np.minimum(words, 1))
    firsts = np.concatenate(([0], np.cumsum(words)))[:-1]
    doc = np.repeat(np.arange(len(counts)), counts)
    i = firsts[doc] + np.arange(len(doc)) - np.repeat(np.concatenate(([0], np.cumsum(counts)))[:-1], counts)
    j = np.minimum(i + width - 1, firsts[doc] + words[doc] - 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(plain[a:b], seed) for a, b in zip(starts[i].tolist(), ends[j].tolist())), np.uint64, len(i))
    bits = _bit_counts(hashes, counts) * 2 > counts[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel() if len(counts) else np.zeros(0, np.uint64)


def fingerprints(docs: DataFrame, text: str = "text", width: int = 4, seed: int = 42, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and ``fp`` (the fingerprint's bits as a signed long) for every row of ``docs``.

    A bit is 1 if it is set in more than half of the shingles' XXH64 values.  A text with fewer
    words than ``width`` has one shingle, all its words; one without words, or null, has
    fingerprint zero.  Rows are never merged: repeated rows give repeated fingerprints.
    """
    slim = docs.select(*keys, F.col(text).alias("__text"))
    schema = slim.drop("__text").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "__text", _BATCH_BYTES):
            fp = fingerprint_array(batch.column("__text"), width, seed)
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keys] + [pa.array(fp.view(np.int64))], names=[*keys, "fp"])

    return slim.mapInArrow(run, schema)


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of a 64-bit word in the reflected Gray sequence."""
    out = values.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    return out


class _Index:
    """Nodes over Gray-sorted fingerprints, level by level, one root for each group."""

    def __init__(self, values: np.ndarray, groups: np.ndarray):
        self.pattern, self.mask, self.child = [values], [np.full(len(values), ~np.uint64(0))], [None]
        group = groups
        while True:
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            if len(starts) == len(group) and len(self.child) > 1:
                break
            size = np.diff(np.append(starts, len(group)))
            rank = np.arange(len(group)) - np.repeat(starts, size)
            cut = np.flatnonzero(rank % _FAN == 0)
            ones, some = np.bitwise_and.reduceat(self.pattern[-1], cut), np.bitwise_or.reduceat(self.pattern[-1], cut)
            shared = np.bitwise_and.reduceat(self.mask[-1], cut)
            self.child.append(np.append(cut, len(group)))
            self.mask.append(shared & ~(ones ^ some))
            self.pattern.append(ones)
            group = group[cut]

    def links(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs i < k of rows of one group that differ in 1 to ``distance`` bits."""
        top = len(self.child) - 1
        roots = np.arange(len(self.pattern[top]))
        stack = [(top, roots, roots)]
        while stack:
            level, a, b = stack.pop()
            if len(a) > _FRONTIER:
                stack += [(level, a[s : s + _FRONTIER], b[s : s + _FRONTIER]) for s in range(0, len(a), _FRONTIER)]
                continue
            shared = self.mask[level][a] & self.mask[level][b]
            apart = np.bitwise_count((self.pattern[level][a] ^ self.pattern[level][b]) & shared)
            near = apart <= distance
            a, b = a[near], b[near]
            if not len(a):
                continue
            if level == 0:
                real = a < b
                yield a[real], b[real]
                continue
            child = self.child[level]
            na, nb = child[a + 1] - child[a], child[b + 1] - child[b]
            pair = np.repeat(np.arange(len(a)), na * nb)
            k = np.arange(len(pair)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
            x, y = child[a][pair] + k // nb[pair], child[b][pair] + k % nb[pair]
            keep = (a[pair] != b[pair]) | (x <= y)
            stack.append((level - 1, x[keep], y[keep]))


def _forest(values: np.ndarray, groups: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of rows that are joined by what is linked in each group: at most one edge for each row.

    The members of a tree are joined as a chain, so that no row is in more than two edges.
    """
    parent = np.arange(len(values))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in _Index(values, groups).links(distance):
        while True:  # compress all paths, then look at links between different trees only
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        open_ = parent[a] != parent[b]
        roots = np.unique(np.stack([parent[a[open_]], parent[b[open_]]], 1), axis=0)
        for x, y in roots.tolist():
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    for i in range(len(parent)):
        parent[i] = root(i)
    order = np.argsort(parent, kind="stable")
    same = np.flatnonzero(parent[order[1:]] == parent[order[:-1]])
    return order[same], order[same + 1]


def near_links(distinct: DataFrame, distance: int = 4, spare: int = 2, chunk: int = 4096) -> DataFrame:
    """Edges ``src``, ``dst`` of a forest with the components of "differs in <= distance bits".

    ``distinct`` has one row for each ``fp``, and ``node``, which stands for it in the edges.  The 64
    bits are cut into ``distance + spare`` blocks, of which ``spare`` agree in every near pair; each
    choice of ``spare`` blocks is a key, the same number of them at every size (15 by default, of 21
    bits).  Groups of one key with over ``chunk`` fingerprints are dealt as pairs of chunks to
    different tasks; every pair of the group meets in one.
    """
    blocks = distance + spare
    edges = [64 * b // blocks for b in range(blocks + 1)]
    masks = [((1 << e) - 1) ^ ((1 << s) - 1) for s, e in itertools.pairwise(edges)]
    keys = [sum(masks[b] for b in some) for some in itertools.combinations(range(blocks), spare)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in keys]
    keyed = distinct.select("fp", "node", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("part", "key"))
    hot = materialise(keyed.groupBy("part", "key").count().where(F.col("count") > chunk), "simhash-hot")
    chunks = F.ceil(F.col("count") / chunk).cast("int")
    own = F.pmod(F.xxhash64("fp"), chunks.cast("long")).cast("int")
    # at most keys x fingerprints / chunk groups are hot: few enough for Spark to choose the join by size
    dealt = keyed.join(hot, ["part", "key"], "left").withColumn("chunks", F.coalesce(chunks, F.lit(1))).withColumn("own", F.coalesce(own, F.lit(0)))
    dealt = dealt.select("fp", "node", "part", "key", F.explode(F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: F.struct(F.least(o, F.col("own")).alias("lo"), F.greatest(o, F.col("own")).alias("hi")))).alias("pair"))
    dealt = dealt.select("fp", "node", F.xxhash64("part", "key", "pair.lo", "pair.hi").alias("group"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(rows: pa.Table) -> pa.RecordBatch:
            group, values = rows.column("group").to_numpy(), rows.column("fp").to_numpy().view(np.uint64)
            order = np.lexsort((gray_rank(values), group))
            number = np.cumsum(np.diff(group[order], prepend=group[order][0]) != 0)
            src, dst = _forest(values[order], number, distance)
            node = rows.column("node").combine_chunks()
            return pa.RecordBatch.from_arrays([node.take(pa.array(order[src])), node.take(pa.array(order[dst]))], names=["src", "dst"])

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= 1 << 16:
                rows = pa.Table.from_batches(held)
                group = rows.column("group").to_numpy()
                cut = int(np.searchsorted(group, group[-1]))  # the last group may go on
                if cut:
                    yield links(rows.slice(0, cut))
                held, size = rows.slice(cut).combine_chunks().to_batches(), len(group) - cut
        if size:
            yield links(pa.Table.from_batches(held))

    kind = distinct.schema["node"].dataType.simpleString()
    return dealt.repartition("group").sortWithinPartitions("group").mapInArrow(run, f"src {kind}, dst {kind}").distinct()


def near_components(fps: DataFrame, distance: int = 4, key: str = "doc_id") -> DataFrame:
    """``fps`` with ``component_id``: the smallest ``key`` that is reachable over links.

    Rows link when their fingerprints differ in ``distance`` bits or fewer (equal ones too).  A
    fingerprint stands in the links as its smallest key and itself, so that the smallest node of a
    component names it and nothing is joined by component.  A null key is larger than any other: a
    component has a null id only when all of its keys are null.
    """
    least = F.struct(F.col("least").isNull().alias("none"), "least", "fp").alias("node")
    groups = materialise(fps.groupBy("fp").agg(F.min(key).alias("least")).select("fp", least), "simhash-groups")
    edges = materialise(near_links(groups, distance), "simhash-links")
    labels = connected_components(edges)  # node, root
    linked = labels.select(F.col("node.fp").alias("fp"), F.col("root.least").alias("root"), F.lit(True).alias("linked"))
    of = groups.join(linked, "fp", "left").select("fp", F.when(F.col("linked"), F.col("root")).otherwise(F.col("node.least")).alias("component_id"))
    return fps.join(materialise(of, "simhash-components"), "fp", "left")
