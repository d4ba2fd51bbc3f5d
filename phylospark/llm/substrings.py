"""Exact removal of byte strings of a fixed length that occur more than once in the corpus.

The scheme is that of external induced sorting, with names where it has ranks.  A sparse set of
suffixes is sampled so that every string of ``length`` bytes holds a sampled position which depends
on its own bytes alone (the part of the S* suffixes).  Each sampled suffix owns the window starts
before it for which it was chosen, as a block.  A tuple of a block carries two common-prefix values
as names: ``core``, of the bytes that all windows of the block share, and ``cover``, of all bytes
that they span.  The tuples of one level pass through Spark's external (spilling) sort and shuffle,
which stands for the disk-backed queue, and are decided there:

* a core that occurs once: no window of the block occurs elsewhere;
* a cover that occurs twice: every window of the block does;
* otherwise one tuple of each distinct cover is induced to the next level, as smaller blocks.

The last level has single windows, so the result is exact (up to 64-bit names, two of them for each
decision to remove).  Only equality matters here, so names need no order; everything is a grouped
count or an equi-join, and no group of equal strings is ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RollingHash, byte_values, joined_bytes, materialise, mix64, runs_of, small_batches

_BATCH_BYTES = 2 << 20
_CORE, _COVER = RollingHash(0x9E6C63D0676A9A99), RollingHash(0xC2B2AE3D27D4EB4F)
_CORE_BYTES, _COVER_BYTES = byte_values(11), byte_values(12)
_U64 = np.uint64


class _Names:
    """Names of slices of some bytes."""

    def __init__(self, data: np.ndarray):
        self.core, self.cover = _CORE.prefix(_CORE_BYTES[data]), _COVER.prefix(_COVER_BYTES[data])

    def of(self, at: np.ndarray, first: np.ndarray, lo: np.ndarray, hi: np.ndarray, size: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Core and cover of the windows that start ``lo`` to ``hi`` bytes before ``at``, a block that
        is aligned at ``first`` and has ``size`` windows when whole."""
        with np.errstate(over="ignore"):
            core = _CORE.slices(self.core, at - first, at - first - size + 1 + length) ^ mix64(first.astype(_U64) + _U64(1))
            cover = _COVER.slices(self.cover, at - hi, at - lo + length) ^ mix64((lo * 65536 + hi).astype(_U64) + _U64(1))
        return core.view(np.int64), cover.view(np.int64)


def sampled(data: np.ndarray, offsets: np.ndarray, length: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sampled positions and the blocks they own: ``at``, ``lo``, ``hi``.

    Window x owns itself to the leftmost of the ``reach`` positions from x on whose eight bytes have
    the least hash.  Windows do not cross the documents that ``offsets`` delimit.
    """
    none = np.zeros(0, np.int64)
    n = len(data) - length + 1
    if n <= 0:
        return none, none, none
    grams = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)[: n + reach - 1]).view("<u8").ravel()
    with np.errstate(over="ignore"):
        keys = (grams * _U64(0x9E3779B97F4A7C15) ^ (grams >> _U64(29))) * _U64(0xBF58476D1CE4E5B9) & _U64(0xFFFFFFFF00000000)
    keys |= np.arange(len(keys), dtype=_U64)
    padded = np.full(-(-len(keys) // reach) * reach, ~_U64(0))
    padded[: len(keys)] = keys
    grid = padded.reshape(-1, reach)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    chosen = (np.minimum(behind[:n], ahead[reach - 1 : reach - 1 + n]) & _U64(0xFFFFFFFF)).astype(np.int64)
    sizes = np.diff(offsets)
    x = np.flatnonzero((np.repeat(offsets[1:], sizes)[:n] - np.arange(n)) >= length)
    if not len(x):
        return none, none, none
    at = chosen[x]
    new = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(x, prepend=-9) != 1))
    last = np.append(new[1:], len(x)) - 1
    return at[new], at[new] - x[last], at[new] - x[new]


def _sample(docs: DataFrame, length: int, reach: int, piece_bytes: int) -> DataFrame:
    """Tuples of level 0: core, cover, doc, tie, at, lo, hi.

    A text beyond ``piece_bytes`` is cut, and a block that spans a cut is two tuples of one ``at``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", min(_BATCH_BYTES, piece_bytes)):
            data, offsets = joined_bytes(batch.column("text"))
            # a text beyond the piece size is worked through in pieces that overlap by a window
            for begin in range(0, max(1, len(data) - length + 1), piece_bytes):
                piece = data[begin : begin + piece_bytes + length - 1]
                cuts = np.clip(offsets - begin, 0, len(piece))
                at, lo, hi = sampled(piece, cuts, length, reach)
                core, cover = _Names(piece).of(at, np.zeros_like(at), lo, hi, reach, length)
                row = np.searchsorted(offsets, at + begin, "right") - 1
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core), pa.array(cover), batch.column("doc").take(take), batch.column("tie").take(take), pa.array((at + begin - offsets[row]).astype(np.int64)), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))],
                    names=["core", "cover", "doc", "tie", "at", "lo", "hi"],
                )

    kind = dict(docs.dtypes)["doc"]
    return docs.mapInArrow(run, f"core long, cover long, doc {kind}, tie long, at long, lo int, hi int")


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in columns])


_TUPLE = ["doc", "tie", "at", "lo", "hi"]


def _decide(rows: DataFrame, last: bool) -> tuple[list[DataFrame], DataFrame | None]:
    """Blocks whose windows all occur elsewhere, and the tuples for the next level."""
    cores = rows.groupBy("core").agg(F.count("*").alias("n"), F.min("cover").alias("least"), F.max("cover").alias("most"))
    cores = materialise(cores.where("n > 1").select("core", (F.col("least") == F.col("most")).alias("alike")), "substring-cores")
    met = rows.join(cores, "core")
    if last:
        return [met.select(*_TUPLE)], None
    mixed = materialise(met.where("not alike").select("core", "cover", *_TUPLE), "substring-mixed")
    covers = materialise(mixed.groupBy("core", "cover").agg(F.count("*").alias("n"), F.min(F.struct(*_TUPLE)).alias("one")), "substring-covers")
    repeated = mixed.join(covers.where("n > 1").select("core", "cover"), ["core", "cover"]).select(*_TUPLE)
    return [met.where("alike").select(*_TUPLE), repeated], covers.select("one.*")


def _contexts(docs: DataFrame, tuples: DataFrame, length: int) -> DataFrame:
    """The tuples with the bytes that their blocks span."""
    kind = dict(docs.dtypes)["doc"]
    of = tuples.groupBy("doc", "tie").agg(F.collect_list(F.struct("at", "lo", "hi")).alias("blocks"))
    joined = docs.join(of, _same(docs, of, ["doc", "tie"])).select(docs.doc, docs.tie, docs.text, of.blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", _BATCH_BYTES):
            data, offsets = joined_bytes(batch.column("text"))
            blocks = batch.column("blocks")
            row = np.repeat(np.arange(batch.num_rows), np.diff(blocks.offsets.to_numpy()))
            at, lo, hi = (blocks.flatten().field(k).to_numpy() for k in range(3))
            a, b = offsets[row] + at - hi, offsets[row] + at - lo + length
            raw = data.tobytes()
            said = [raw[x:y] for x, y in zip(a.tolist(), b.tolist())]
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(take), batch.column("tie").take(take), pa.array(at), pa.array(lo), pa.array(hi), pa.array(said, pa.binary())], names=["doc", "tie", "at", "lo", "hi", "bytes"])

    return joined.mapInArrow(run, f"doc {kind}, tie long, at long, lo int, hi int, bytes binary").dropDuplicates(_TUPLE)


def _induce(contexts: DataFrame, size: int, length: int) -> DataFrame:
    """Tuples of blocks of ``size`` windows out of blocks (``from``, ``to``) within contexts."""
    kind = dict(contexts.dtypes)["doc"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches((b for b in batches if b.num_rows), "bytes", _BATCH_BYTES):
            data, offsets = joined_bytes(batch.column("bytes"))
            get = lambda c: batch.column(c).to_numpy().astype(np.int64)  # noqa: B023, E731
            origin, low, high = offsets[:-1] + get("hi"), get("from"), get("to")  # where "at" stands
            parts = high // size - low // size + 1
            row = np.repeat(np.arange(batch.num_rows), parts)
            k = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            first = (low // size)[row] * size + k * size
            lo, hi = np.maximum(first, low[row]), np.minimum(first + size - 1, high[row])
            core, cover = _Names(data).of(origin[row], first, lo, hi, size, length)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(core), pa.array(cover), *[batch.column(c).take(take) for c in ("doc", "tie", "at")], pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=["core", "cover", *_TUPLE])

    return contexts.mapInArrow(run, f"core long, cover long, doc {kind}, tie long, at long, lo int, hi int")


def repeated_blocks(docs: DataFrame, length: int = 400, levels: tuple[int, ...] = (32, 4, 1), piece_bytes: int = 4 * _BATCH_BYTES) -> DataFrame:
    """``doc``, ``tie``, ``start``, ``stop``: byte ranges all of whose windows occur elsewhere too.

    ``docs`` has ``doc``, ``tie`` (a hash of the text) and ``text``.  Together the ranges cover
    exactly the bytes of windows of ``length`` bytes that start in two places or more.
    """
    reach = length * 3 // 4 + 1
    rows = materialise(_sample(docs, length, reach, piece_bytes), "substring-sample")
    found, down = _decide(rows, last=False)
    contexts = materialise(_contexts(docs, down, length), "substring-contexts")
    work = contexts.withColumns({"from": F.col("lo"), "to": F.col("hi")})
    for size in levels:
        rows = materialise(_induce(work, size, length), "substring-tuples")
        more, down = _decide(rows, last=size == 1)
        found += more
        if down is not None:
            down = down.withColumnsRenamed({"lo": "from", "hi": "to"})
            # the contexts of one "at" share no window
            within = _same(contexts, down, ["doc", "tie", "at"]) & (contexts.lo <= down["from"]) & (down["to"] <= contexts.hi)
            work = contexts.join(down, within).select(*[contexts[c] for c in contexts.columns], down["from"], down["to"])
    ranges = reduce(DataFrame.union, found)
    return ranges.select("doc", "tie", (F.col("at") - F.col("hi")).alias("start"), (F.col("at") - F.col("lo") + length).alias("stop"))


def remove_repeats(docs: DataFrame, length: int = 400, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row of ``docs``: key, n_bytes, n_removed, n_spans, kept_sha256, spans and kept (bytes).

    Each byte in a string of ``length`` bytes that starts anywhere else too (same document included,
    overlaps count, judged on the input) is removed.  Null texts are empty.  Rows may repeat: rows
    alike in key and text are two documents, and get the same result.
    """
    slim = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("tie"), F.coalesce(text, F.lit("")).alias("text"))
    of = repeated_blocks(slim, length, **options).groupBy("doc", "tie").agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))
    joined = slim.join(of, _same(slim, of, ["doc", "tie"]), "left").select(slim.doc, slim.text, of.ranges)
    kind = dict(slim.dtypes)["doc"]
    fields = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,stop:long>>, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", _BATCH_BYTES):
            data, offsets = joined_bytes(batch.column("text"))
            ranges = batch.column("ranges")
            bounds, flat = ranges.offsets.to_numpy(), ranges.values
            starts, stops = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            rows = []
            for k in range(batch.num_rows):
                own = data[offsets[k] : offsets[k + 1]]
                a, b = bounds[k], bounds[k + 1]
                if a == b:
                    raw = own.tobytes()
                    rows.append((len(own), 0, 0, sha256(raw).hexdigest(), [], raw))
                    continue
                steps = np.zeros(len(own) + 1, np.int32)
                np.add.at(steps, starts[a:b], 1)
                np.add.at(steps, stops[a:b], -1)
                gone = np.cumsum(steps[:-1]) > 0
                first, end = runs_of(gone)
                raw = own[~gone].tobytes()
                rows.append((len(own), int(gone.sum()), len(first), sha256(raw).hexdigest(), [{"start": x, "stop": y} for x, y in zip(first.tolist(), end.tolist())], raw))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.binary())
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *columns], names=[key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    return joined.mapInArrow(run, f"`{key}` {kind}, {fields}")
