"""MinHash near-duplicates by an inverted join over signature coordinates, confirmed on full sets.

A document is the set of its distinct word shingles; equal sets are one class.  Each class is posted
under its coordinate-value pairs.  Two classes whose sets have a Jaccard similarity s share each
coordinate with probability s, so that links are looked for where enough coordinates collide:

* prefix: of the first ``POSTED`` coordinates at least ``SHARED`` must collide.  Pairs that occur once
  are no collisions, a class with fewer than ``SHARED`` others goes, and of the rest a class is posted
  under all but the ``SHARED`` - 1 most frequent ones, since it must meet every partner there;
* merge: of the classes under one pair, those are kept together whose whole signatures collide in
  ``MATCHED`` of ``COORDINATES`` places (a byte of each).  What is merged already is skipped: only rows outside the
  largest part so far are compared with all others;
* what is kept together is confirmed on the full sets in the same way: by parts, so that no pair within
  a part is looked at, and a row joins a part only by a pair whose exact similarity is high enough.

At a similarity of 0.8 a pair fails the counts with a probability of 2e-8 (prefix) and 9e-8 (match).
Groups over a size are dealt to chunks: every chunk meets the first one, then rows outside a group's largest
part meet all of it, chunk by chunk; so a group of near copies of any size costs about two passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RollingHash, byte_values, joined_bytes, materialise, mix64, small_batches
from .components import connected_components

COORDINATES, MATCHED = 128, 77
POSTED, SHARED = 32, 12
_BATCH_BYTES = 1 << 20
_U64 = np.uint64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_WORD = RollingHash(0xD1342543DE82EF95)
_LETTERS = byte_values(21)
_LETTERS[ord("A") : ord("Z") + 1] = _LETTERS[ord("a") : ord("z") + 1]
_FACTORS = byte_values(22)[:COORDINATES]
_ORDER = byte_values(23)


def shingle_sets(texts: pa.Array, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit hashes of the word shingles of each text, sorted, end to end, and their bounds.

    Words are what stands between white space, A-Z lower-cased; fewer words than ``width`` are one
    shingle; a text without words, or null, has none.
    """
    data, offsets = joined_bytes(texts)
    rows = len(offsets) - 1
    inside = ~_SPACE[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    filled = offsets[:-1] < offsets[1:]
    before[offsets[:-1][filled]] = False
    after[offsets[1:][filled] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    word = _WORD.slices(_WORD.prefix(_LETTERS[data]), starts, ends)
    counts = np.bincount(np.searchsorted(offsets[1:], starts, "right"), minlength=rows)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    doc = np.repeat(np.arange(rows), n)
    at = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    limit = (first + counts)[doc]
    with np.errstate(over="ignore"):
        value = np.zeros(len(doc), _U64)
        for k in range(width):
            own = np.minimum(at + k, len(word) - 1)
            value += np.where(at + k < limit, word[own] * _ORDER[k], _U64(k)) if len(doc) else value
        value = mix64(value)
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    sizes = np.bincount(doc[new], minlength=rows)
    return value[new], np.concatenate(([0], np.cumsum(sizes)))


def _names(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of each set (zero if empty)."""
    out = np.zeros((2, len(bounds) - 1), _U64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        for k, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
            with np.errstate(over="ignore"):
                out[k, full] = mix64(np.add.reduceat(mix64(values ^ _U64(salt)), bounds[full]))
    return out[0].view(np.int64), out[1].view(np.int64)


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """``key``, ``tie`` (a hash of the text), ``n`` (set size), ``a`` and ``b`` (names of the set), ``posted`` (coordinate-value pairs) and ``signature``."""
    slim = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("tie"), F.col(f"`{text}`").alias("text"))
    kind = slim.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", _BATCH_BYTES):
            values, bounds = shingle_sets(batch.column("text"), width)
            a, b = _names(values, bounds)
            full = np.flatnonzero(np.diff(bounds))
            least = np.zeros((batch.num_rows, COORDINATES), _U64)
            if len(full):
                with np.errstate(over="ignore"):
                    for k in range(COORDINATES):
                        least[full, k] = np.minimum.reduceat(values * _FACTORS[k], bounds[full])
            least = mix64(least)
            posted = (least[:, :POSTED] >> _U64(32)).astype(np.int64) | (np.arange(POSTED, dtype=np.int64) << 32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(posted) + 1) * POSTED, pa.int32()), pa.array(posted.ravel()))
            said = (least & _U64(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("tie"), pa.array(np.diff(bounds)), pa.array(a), pa.array(b), lists, pa.array([x.tobytes() for x in said], pa.binary())], names=["key", "tie", "n", "a", "b", "posted", "signature"])

    return slim.mapInArrow(run, f"key {kind}, tie long, n long, a long, b long, posted array<long>, signature binary")


def _matches(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Collisions of signatures, row by row (either may be a single one)."""
    return (one == other).sum(-1)


class _Parts:
    """Rows of a group and the parts that they are in."""

    def __init__(self, labels: np.ndarray):
        self.labels = labels
        self.edges: list[tuple[int, int]] = []

    def join(self, row: int, hits: np.ndarray) -> None:
        for hit in hits.tolist():
            if self.labels[hit] != self.labels[row]:
                self.labels[self.labels == self.labels[hit]] = self.labels[row]
                self.edges.append((row, hit))

    def largest(self) -> int:
        values, counts = np.unique(self.labels, return_counts=True)
        return int(values[counts.argmax()])


def _merge(labels: np.ndarray, asked: np.ndarray, hits_of: Callable[[int, np.ndarray, np.ndarray], Iterator[np.ndarray]], pivots: int = 16) -> list[tuple[int, int]]:
    """Edges that join rows to the components of "is a hit of", beginning with ``labels``.

    ``hits_of(row, others, labels)`` yields hits of a row among others, one array after the other; ``labels`` are
    the parts by then, so that it may skip what is merged meanwhile.  Only ``asked`` rows need to meet
    all others.  A few of them meet all rows first; then the others do, but for the largest part's if all are
    asked, since each pair has an end outside of it.
    """
    parts = _Parts(labels.copy())
    done = np.zeros(len(labels), bool)

    def meet(row: int) -> None:
        done[row] = True
        others = np.flatnonzero((parts.labels != parts.labels[row]) & ~done)
        for hits in hits_of(row, others, parts.labels):
            parts.join(row, hits)

    for _ in range(min(pivots, len(labels) // 4)):
        rest = np.flatnonzero(asked & ~done & (parts.labels != parts.largest())) if parts.edges else np.flatnonzero(asked & ~done)
        if not len(rest):
            break
        meet(int(rest[0]))
    rest = asked & (parts.labels != parts.largest()) if asked.all() else asked
    for row in np.flatnonzero(rest).tolist():
        if not done[row]:
            meet(row)
    return parts.edges


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of whole groups (by the sorted column ``slot``) of at least 4096 rows or 32 MB."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= 4096 or sum(b.nbytes for b in held) >= 32 << 20:
            rows = pa.Table.from_batches(held).combine_chunks()
            slot = rows.column("slot").to_numpy()
            cut = int(np.searchsorted(slot, slot[-1]))  # the last group may go on
            if cut:
                yield rows.slice(0, cut)
            held = rows.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _bytes_of(column: pa.ChunkedArray, width: int) -> np.ndarray:
    data, _ = joined_bytes(column)
    return data.reshape(-1, width)


_SMALL = 64


def _small_forest(signature: np.ndarray, first: np.ndarray, size: np.ndarray, matched: int) -> tuple[np.ndarray, np.ndarray]:
    """Chains over the candidate components of many small groups at once (``first`` rows and sizes of the groups)."""
    row = np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    later = np.repeat(first + size, size) - row - 1  # rows after this one in its group
    a = np.repeat(row, later)
    b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(later) - later, later)
    near = np.concatenate([_matches(signature[a[k : k + 65536]], signature[b[k : k + 65536]]) >= matched for k in range(0, len(a), 65536)] or [np.zeros(0, bool)])
    a, b = a[near], b[near]
    label = np.arange(len(signature))
    while True:
        least = np.minimum(label[a], label[b])
        if (label[a] == least).all() and (label[b] == least).all():
            break
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
    row = row[np.argsort(label[row], kind="stable")]
    same = np.flatnonzero(label[row[1:]] == label[row[:-1]])
    return row[same], row[same + 1]


def _edges_of(rows: pa.Table, matched: int, similar: tuple[int, int] | None) -> tuple[list[int], list[int]]:
    """Rows that are joined in each slot: by signature, or (``similar`` = numerator, denominator) by set as well."""
    slot = rows.column("slot").to_numpy()
    signature = _bytes_of(rows.column("signature"), COORDINATES)
    first = np.flatnonzero(np.diff(slot, prepend=slot[0] ^ 1))
    size = np.diff(np.append(first, len(slot)))
    src, dst = [], []
    asked, label = rows.column("asked").to_numpy(), rows.column("label").to_numpy()
    easy = np.zeros(len(first), bool)
    if similar is None:
        easy = (size <= _SMALL) & (size > 1) & (np.add.reduceat(asked.astype(np.int64), first) == size)
        a, b = _small_forest(signature, first[easy], size[easy], matched)
        src, dst = a.tolist(), b.tolist()
    else:
        data, bounds = joined_bytes(rows.column("shingles"))
        sets = [data[x:y].view(np.int64) if not x % 8 else np.frombuffer(data[x:y].tobytes(), np.int64) for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        n = np.diff(bounds) // 8
    for at, count in zip(first[~easy].tolist(), size[~easy].tolist()):
        if count < 2:
            continue
        own = signature[at : at + count]

        def alike(row: int, others: np.ndarray, parts: np.ndarray, own: np.ndarray = own, at: int = at) -> Iterator[np.ndarray]:
            near = others[_matches(own[row], own[others]) >= matched]
            if similar is None:
                yield near
                return
            up, down = similar
            x = sets[at + row]
            near = near[(down * np.minimum(n[at + near], len(x)) >= up * np.maximum(n[at + near], len(x)))]
            for k in near.tolist():
                if parts[k] == parts[row]:
                    continue
                y = sets[at + k]
                both = len(np.intersect1d(x, y, assume_unique=True))
                if down * both >= up * (len(x) + len(y) - both):
                    yield np.array([k])

        # rows that stand for one class twice are in one part from the start
        a = _merge(label[at : at + count], asked[at : at + count].astype(bool), alike)
        src += [at + x for x, _ in a]
        dst += [at + y for _, y in a]
    return src, dst


def _find(rows: DataFrame, matched: int, similar: tuple[int, int] | None) -> DataFrame:
    """``src``, ``dst`` (columns ``cid``): what is joined in each slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _slots(batches):
            src, dst = _edges_of(some, matched, similar)
            cid = some.column("cid").combine_chunks()
            yield pa.RecordBatch.from_arrays([cid.take(pa.array(src, pa.int64())), cid.take(pa.array(dst, pa.int64()))], names=["src", "dst"])

    return rows.repartition("slot").sortWithinPartitions("slot").mapInArrow(run, "src long, dst long").where("src <> dst").distinct()


def joined_within(rows: DataFrame, most: int, matched: int = MATCHED, similar: tuple[int, int] | None = None, name: str = "minhash", sizes: DataFrame | None = None) -> DataFrame:
    """``src``, ``dst`` (``cid``): a forest with the components of what is alike within each group.

    ``rows`` has ``group``, ``cid``, ``weight``, ``signature`` (and ``shingles``); ``sizes`` has the first three where they
    are cheaper to read alone.  Groups over ``most`` in weight are dealt to chunks.  First each chunk meets itself and the group's first chunk; then, chunk by
    chunk, the rows outside the group's largest part so far meet all rows.  With that every pair of
    the group has met or is in one part.
    """
    sizes = (rows if sizes is None else sizes).groupBy("group").agg(F.sum("weight").alias("w"))
    hot = materialise(sizes.where(F.col("w") > most).select("group", F.ceil(F.col("w") / most).alias("chunks")), f"{name}-hot")
    any_hot = hot.limit(1).count() > 0
    columns = [c for c in rows.columns if c not in ("group", "weight")]
    all_asked = [F.lit(1).cast("byte").alias("asked"), F.col("cid").alias("label")]
    if not any_hot:
        return materialise(_find(rows.select(F.col("group").alias("slot"), *columns, *all_asked), matched, similar), f"{name}-edges")

    rows = materialise(rows, f"{name}-rows")

    def dealt(some: DataFrame) -> DataFrame:
        own = F.pmod(F.xxhash64("cid"), F.col("chunks"))
        return some.withColumn("chunks", F.coalesce("chunks", F.lit(1).cast("long"))).withColumn("own", own)

    def range_(n: Column) -> Column:
        return F.sequence(F.lit(0).cast("long"), n - 1)

    slots = F.when(F.col("own") == 0, range_(F.col("chunks"))).otherwise(F.array("own"))
    begun = dealt(rows.join(hot, "group", "left")).withColumn("place", F.explode(slots))
    slot = F.when(F.col("chunks") == 1, F.col("group")).otherwise(F.xxhash64("group", "place", F.lit("first"))).alias("slot")
    edges = materialise(_find(begun.select(slot, *columns, *all_asked), matched, similar), f"{name}-edges")
    labels = materialise(connected_components(edges), f"{name}-labels")
    members = rows.select("group", "cid", "weight").join(hot, "group").join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("root", "cid")).drop("root")
    members = materialise(members.distinct(), f"{name}-members")
    main = members.groupBy("group", "label").agg(F.sum("weight").alias("w")).groupBy("group").agg(F.max_by("label", F.struct("w", "label")).alias("main"))
    placed = members.join(main, "group").withColumn("outside", F.col("label") != F.col("main"))
    beyond = placed.where("outside").groupBy("group").agg(F.ceil(F.sum("weight") / most).alias("others"))
    beyond = materialise(beyond, f"{name}-outside")
    if not beyond.limit(1).count():
        return edges
    own = placed.join(beyond, "group").select("group", "cid", "label", "outside", "chunks", "others")
    full = dealt(rows.drop("weight").join(own, ["group", "cid"]))
    asked = F.lit(1).cast("byte")
    left = full.withColumn("place", F.explode(range_(F.col("others")))).select(F.xxhash64("group", "own", "place").alias("slot"), *columns, (asked - 1).cast("byte").alias("asked"), "label")
    right = full.where("outside").withColumn("mine", F.pmod(F.xxhash64("cid", F.lit(1)), F.col("others"))).withColumn("place", F.explode(range_(F.col("chunks")))).select(F.xxhash64("group", "place", "mine").alias("slot"), *columns, asked.alias("asked"), "label")
    more = materialise(_find(left.union(right), matched, similar), f"{name}-more")
    return edges.union(more)


def _with_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``wanted(key, tie, ...)`` with ``shingles``, the sets of the documents it names (a row for each task that finds one)."""
    said = docs.join(wanted, docs.key.eqNullSafe(wanted["key"]) & (docs.tie == wanted["tie"])).select(docs.text, *[wanted[c] for c in wanted.columns if c not in ("key", "tie")])
    names = [c for c in said.columns if c != "text"]
    schema = said.drop("text").withColumn("shingles", F.lit(b"")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # of repeated rows one is enough
        for batch in batches:
            cids = batch.column("cid").to_pylist()
            new = [k for k, c in enumerate(cids) if not (c in seen or seen.add(c))]
            for some in small_batches([batch.take(pa.array(new, pa.int64()))], "text", _BATCH_BYTES):
                values, bounds = shingle_sets(some.column("text"), width)
                raw = [values[x:y].tobytes() for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays([*[some.column(c) for c in names], pa.array(raw, pa.binary())], names=[*names, "shingles"])

    return said.mapInArrow(run, schema)


def candidates(classes: DataFrame, most: int = 4096) -> DataFrame:
    """``node``, ``root`` (``cid``): components of classes whose signatures collide often enough."""
    posts = classes.select("cid", F.explode("posted").alias("pair"))
    often = posts.groupBy("pair").agg(F.count("*").alias("df")).where("df > 1")
    met = posts.join(often, "pair").groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("df", "pair"))).alias("pairs")).where(F.size("pairs") >= SHARED)
    prefix = met.select("cid", F.slice("pairs", F.lit(1), F.size("pairs") - SHARED + 1)["pair"].alias("prefix"))
    posted = materialise(prefix.join(classes.select("cid", "signature"), "cid"), "minhash-prefixes")
    rows = posted.select(F.explode("prefix").alias("group"), "cid", F.lit(1).cast("long").alias("weight"), "signature")
    return connected_components(joined_within(rows, most, name="minhash-candidates"))


def near_components(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, similar: tuple[int, int] = (80, 100), most: int = 4 << 20) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs``.

    Rows link when their sets of distinct word shingles have an intersection of at least ``similar`` (a
    share: numerator, denominator; 0.8 or more) of their union; ``component_id`` is the smallest key
    that is reachable over links, the row's own included (a null key is the largest: null only if
    all are), and ``kept`` says whether it is the row's own.  A row without words is linked with nothing and is its own
    component.  Repeated rows, and different ones with one key, are rows of their own.  ``most`` bounds the shingles that one task
    compares at once (twice as many, or one row's).
    """
    up, down = similar
    if 10 * up < 8 * down:
        raise ValueError("the counts of collisions are made for a similarity of 0.8 or more")
    rows = materialise(signatures(docs, key, text, width), "minhash-rows")
    least = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "tie")).alias("least")
    each = rows.where("n > 0").groupBy("a", "b", "n").agg(least, F.first("posted").alias("posted"), F.first("signature").alias("signature"))
    classes = materialise(each.withColumn("cid", F.monotonically_increasing_id()), "minhash-classes")
    clusters = materialise(candidates(classes), "minhash-clusters")
    wanted = classes.join(clusters, F.col("cid") == F.col("node")).select(F.col("least.key").alias("key"), F.col("least.tie").alias("tie"), F.col("root").alias("group"), "cid", F.col("n").alias("weight"), "signature")
    slim = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("tie"), F.col(f"`{text}`").alias("text"))
    sets = _with_sets(slim, wanted, width)
    node = F.struct("least.none", "least.key", "cid")
    edges = joined_within(sets, most, similar=similar, name="minhash-links", sizes=wanted)
    of = classes.select("cid", node.alias("node"))
    named = edges.join(of.select(F.col("cid").alias("src"), F.col("node").alias("x")), "src").join(of.select(F.col("cid").alias("dst"), F.col("node").alias("y")), "dst")
    labels = materialise(connected_components(named.select(F.col("x").alias("src"), F.col("y").alias("dst"))), "minhash-labels")
    roots = labels.select(F.col("node.cid").alias("cid"), F.col("root.key").alias("root"), F.lit(True).alias("linked"))
    component = F.when(F.col("linked"), F.col("root")).otherwise(F.col("least.key")).alias("component")
    found = materialise(classes.join(roots, "cid", "left").select("a", "b", "n", component, F.lit(True).alias("found")), "minhash-components")
    out = rows.select("key", "n", "a", "b").join(found, ["a", "b", "n"], "left")
    component_id = F.when(F.col("found"), F.col("component")).otherwise(F.col("key"))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component_id.alias("component_id"), F.col("key").eqNullSafe(component_id).alias("kept"))
