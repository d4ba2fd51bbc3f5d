"""Product-quantisation codes of vectors, by Lloyd rounds over partition-local cover trees.

A vector is cut into equal consecutive parts, and the parts of one position share a codebook.  Vectors
are held in chunks; each chunk has one cover tree for each position, built once.  A node covers a run
of the chunk's points in tree order, with a centre (one of them), the largest distance from it, and
the sum over the run as a difference of two cumulative sums.  In a round, a node whose nearest
codebook entry is nearer than the second one by more than twice its radius gives its whole run to that
entry (triangle inequality); only the others descend, in the end to exact comparisons of points.
What a round shuffles is one sum and count for each position, entry and task.

All arithmetic is on integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: vectors of a chunk, and points that a node is not split below
CHUNK, _BUCKET = 1024, 8
#: largest magnitude of a component: squared distances of 64 such components still fit a long
LIMIT = 1 << 27
_EXACT = 1 << 53


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``, exactly, as int64."""
    most = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if 4 * most * most * max(1, a.shape[1]) < _EXACT:  # every step is exact in doubles
        x, y = a.astype(np.float64), b.astype(np.float64)
        return ((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)).astype(np.int64)
    out = np.zeros((len(a), len(b)), np.int64)
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return out


class CoverTree:
    """Nodes over points: ``centre`` (a point's place in tree order), ``low`` and ``high`` (its run), ``radius``,
    and the range ``child`` to ``last`` of its children (none: a bucket of points)."""

    NAMES = ("order", "centre", "low", "high", "child", "last", "radius")

    def __init__(self, **arrays: np.ndarray):
        for name in self.NAMES:
            setattr(self, name, arrays[name])

    @classmethod
    def build(cls, points: np.ndarray) -> CoverTree:
        """Level by level: the points of a node are covered by balls of half its radius, whose centres are
        taken greedily in the order of the points, so that centres of one node are further apart than that."""
        far = np.sqrt(_squares(points, points).astype(np.float64))
        order = np.arange(len(points))
        radius = float(far[0].max(initial=0.0)) if len(points) else 0.0
        nodes = [[0, 0, len(points), radius, 0, 0]] if len(points) else []
        k = 0
        while k < len(nodes):
            centre, low, high, radius, _, _ = nodes[k]
            own = order[low:high].copy()
            if len(own) > _BUCKET and radius > 0:
                nodes[k][4] = len(nodes)
                left, at, own_centre = own, low, order[centre]
                while len(left):
                    c = own_centre if at == low else left[0]  # the node's centre is its own first child's
                    d = far[c, left]
                    near = d <= radius / 2
                    some = left[near]
                    order[at : at + len(some)] = some
                    place = at + int(np.flatnonzero(some == c)[0])
                    nodes.append([place, at, at + len(some), float(d[near].max()), 0, 0])
                    at, left = at + len(some), left[~near]
                nodes[k][5] = len(nodes)
            k += 1
        # a node's centre keeps its place in its run only until the run is dealt out: find it again
        table = np.array([n[:3] + n[4:] for n in nodes], np.int64).reshape(-1, 5)
        radii = np.array([n[3] for n in nodes])
        first = table[:, 3]
        for k in range(len(nodes) - 1, -1, -1):
            if table[k, 4] > first[k]:
                table[k, 0] = table[first[k], 0]  # the first child has the same centre
        return cls(order=order, centre=table[:, 0], low=table[:, 1], high=table[:, 2], child=table[:, 3], last=table[:, 4], radius=radii)

    def assign(self, points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest entry of each point (in tree order; ties to the lower index), and for each entry the number of
        points that whole nodes gave it; ``points`` are in tree order too.

        Returns the entries, the flags of points that were compared on their own, and the number of nodes
        looked at.
        """
        entry = np.zeros(len(points), np.int64)
        alone = np.zeros(len(points), bool)
        nodes, seen = np.arange(min(1, len(self.low))), 0
        while len(nodes):
            seen += len(nodes)
            squares = _squares(points[self.centre[nodes]], book)
            best = squares.argmin(1)
            d = np.sqrt(squares.astype(np.float64))
            nearest = d[np.arange(len(nodes)), best]
            d[np.arange(len(nodes)), best] = np.inf
            radius = self.radius[nodes]
            sure = (d.min(1) - nearest > 2 * radius * (1 + 1e-9) + 1e-6) | (radius == 0)  # equal points are their centre
            for n, e in zip(nodes[sure].tolist(), best[sure].tolist()):
                entry[self.low[n] : self.high[n]] = e
            open_ = nodes[~sure]
            leaf = self.last[open_] == 0
            for n in open_[leaf].tolist():
                alone[self.low[n] : self.high[n]] = True
            inner = open_[~leaf]
            counts = self.last[inner] - self.child[inner]
            nodes = np.repeat(self.child[inner], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        if alone.any():
            entry[alone] = _squares(points[alone], book).argmin(1)
        return entry, alone, seen


def _pack(x: np.ndarray) -> bytes:
    return x.astype("<f8" if x.dtype.kind == "f" else "<i8").tobytes()


def _unpack(raw: bytes, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(raw, kind)


def chunks(vectors: DataFrame, parts: int, size: int = CHUNK) -> DataFrame:
    """``id``, ``label`` (lists), ``points`` (binary) and one ``trees`` struct of binaries for each position: a row
    for up to ``size`` rows of ``vectors(id, label, v)``, ``v`` an array of longs."""
    id_, label = (vectors.schema[c].dataType.simpleString() for c in ("id", "label"))
    tree = "struct<" + ",".join(f"{n}:binary" for n in CoverTree.NAMES) + ">"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            v = np.array(rows.column("v").to_pylist(), np.int64)
            width = v.shape[1] // parts
            trees = [CoverTree.build(v[:, p * width : (p + 1) * width]) for p in range(parts)]
            said = [[{n: _pack(getattr(t, n)) for n in CoverTree.NAMES} for t in trees]]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), rows.column(c).combine_chunks()) for c in ("id", "label")]
            kind = pa.list_(pa.struct([(n, pa.binary()) for n in CoverTree.NAMES]))
            return pa.RecordBatch.from_arrays([*lists, pa.array([_pack(v)], pa.binary()), pa.array(said, kind)], names=["id", "label", "points", "trees"])

        held, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size - n)
                held.append(part)
                at, n = at + part.num_rows, n + part.num_rows
                if n == size:
                    yield row(held)
                    held, n = [], 0
        if n:
            yield row(held)

    return vectors.select("id", "label", "v").mapInArrow(run, f"id array<{id_}>, label array<{label}>, points binary, trees array<{tree}>")


def _walk(batch: pa.RecordBatch, books: np.ndarray) -> Iterator[tuple[int, int, CoverTree, np.ndarray, np.ndarray, np.ndarray]]:
    """Row, position, tree, points in tree order, their entries, and the flags of those compared alone."""
    parts, _, width = books.shape
    for k in range(batch.num_rows):
        v = _unpack(batch.column("points")[k].as_py()).reshape(-1, parts * width)
        for p, said in enumerate(batch.column("trees")[k].as_py()):
            tree = CoverTree(**{n: _unpack(raw, "<f8" if n == "radius" else "<i8") for n, raw in said.items()})
            points = v[tree.order, p * width : (p + 1) * width]
            entry, alone, _ = tree.assign(points, books[p])
            yield k, p, tree, points, entry, alone


def _sums(held: DataFrame, books: np.ndarray) -> DataFrame:
    """``part``, ``entry``, ``n``, ``total`` (array): counts and sums of the points nearest to each entry."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for _, p, _, points, entry, _ in _walk(batch, books):
                # runs of one entry in tree order are differences of cumulative sums
                upto = np.concatenate((np.zeros((1, width), np.int64), np.cumsum(points, axis=0)))
                cut = np.flatnonzero(np.diff(entry, prepend=-1))
                end = np.append(cut[1:], len(entry))
                np.add.at(total[p], entry[cut], upto[end] - upto[cut])
                np.add.at(n[p], entry[cut], end - cut)
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(n[p, e]), pa.array(total[p, e].tolist(), pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])

    found = held.select("points", "trees").mapInArrow(run, "part int, entry int, n long, total array<long>")
    sums = [F.sum(F.col("total")[j]).alias(f"t{j}") for j in range(width)]
    return found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums)


def _moved(held: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks with each used entry replaced by the floor of its points' mean (a bounded table)."""
    out = books.copy()
    for row in _sums(held, books).collect():
        out[row.part, row.entry] = [row[f"t{j}"] // row.n for j in range(books.shape[2])]
    return out


def _codes(held: DataFrame, books: np.ndarray) -> DataFrame:
    """``id``, ``label``, ``code`` (two hex digits for each part), ``error`` (squared distances, summed over parts)."""
    id_, label = (held.schema[c].dataType.elementType.simpleString() for c in ("id", "label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
            for k, p, tree, points, entry, _ in _walk(batch, books):
                error, code = np.zeros(len(entry), np.int64), np.zeros(len(entry), np.uint8)
                error[tree.order] = ((points - books[p][entry]) ** 2).sum(1)
                code[tree.order] = entry
                found.setdefault(k, []).append((code, error))
            for k, by_part in found.items():
                codes = np.stack([c for c, _ in by_part], 1)
                said = [c.tobytes().hex() for c in codes]
                ids, labels = batch.column("id").slice(k, 1).flatten(), batch.column("label").slice(k, 1).flatten()
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(said, pa.string()), pa.array(sum(e for _, e in by_part))], names=["id", "label", "code", "error"])

    return held.mapInArrow(run, f"id {id_}, label {label}, code string, error long")


def integers(vectors: DataFrame, vector: str, scale: int = 1024) -> DataFrame:
    """``vectors`` with ``v``: floor(scale * x) of each component; rows with a null vector, a null or a non-finite
    component are left out.  Components of a magnitude over ``LIMIT`` after scaling are an error."""
    x = F.col(f"`{vector}`")
    whole = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    low = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    large = F.raise_error(F.lit(f"a vector component is larger than {LIMIT} after scaling")).cast("array<bigint>")
    kept = vectors.where(F.coalesce(whole, F.lit(False)))
    return kept.withColumn("v", F.when(F.exists(x, lambda c: F.abs(c.cast("double")) * scale >= LIMIT), large).otherwise(low))


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, size: int = CHUNK) -> tuple[DataFrame, np.ndarray]:
    """Codes of all vectors, and the codebooks (parts x entries x width).

    The codes have ``key``, ``label``, ``code`` and ``error``.  A codebook starts as the parts of the
    ``entries`` smallest keys (null is the largest; equal keys by vector; there may be fewer); each round assigns every
    part to its nearest entry (squared distance, ties to the lower index) and moves the used entries to
    the floor of their parts' mean; then parts are assigned once more.  Rows with null, null or non-finite components
    have no code; repeated rows have one each.  Vectors must be of one length, a multiple of ``parts``.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits, hence at most 256 entries")
    slim = integers(vectors.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("x")), "x", scale).drop("x")
    rows = materialise(slim, "codes-vectors")
    lengths = [r.n for r in rows.select(F.size("v").alias("n")).distinct().limit(2).collect()]
    if len(lengths) > 1 or lengths and lengths[0] % parts:
        raise ValueError(f"vectors must have one length, a multiple of {parts}")
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    width = lengths[0] // parts if lengths else 0
    books = np.array([r.v for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    held = materialise(chunks(rows, parts, size), "codes-trees")
    for _ in range(rounds if len(first) else 0):
        books = _moved(held, books)
    return _codes(held, books).withColumnsRenamed({"id": key}), books


def digest(books: np.ndarray) -> str:
    """Lowercase hex SHA-256 of all components, by part, entry and position, comma-joined."""
    return sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
