"""Chroma fingerprints of a media column, and alignment of recordings by them.

A payload is 8-bit unsigned mono PCM (a RIFF/WAVE header, if there is one, is skipped).  Overlapping
frames become energies of the twelve pitch classes; rectangle filters over the integral image of
frames by classes are quantised to two bits each and packed to one integer for each place.
Recordings align where an offset collects equal integers, and match when few bits differ there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import joined_bytes, materialise, small_batches

_BATCH_BYTES = 1 << 20
RATE, FRAME, HOP, WIDTH = 8000, 256, 32, 16
#: filters: rows of (kind, first class, classes, frames), all sizes and kinds by rule
FILTERS = [(i % 4, (5 * i) % 10, 2 + 2 * ((i // 4) % 2), (4, 8, 12, 16)[i // 4]) for i in range(16)]
_STEP = 0.12  # quantiser: below -_STEP, below 0, below _STEP, or above


def _classes() -> np.ndarray:
    """Weights of the spectrum's bins for the pitch classes (A is class 0)."""
    hertz = np.fft.rfftfreq(FRAME, 1 / RATE)
    out = np.zeros((len(hertz), 12), np.float32)
    for k, f in enumerate(hertz):
        if f >= 27.5:
            out[k, int(round(12 * np.log2(f / 27.5))) % 12] = 1
    return out


_CLASSES, _WINDOW = _classes(), np.hanning(FRAME).astype(np.float32)


def chroma(samples: np.ndarray) -> np.ndarray:
    """Pitch-class energies of the frames, each frame scaled to norm 1."""
    if len(samples) < FRAME:
        return np.zeros((0, 12), np.float32)
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP]
    out = np.empty((len(frames), 12), np.float32)
    for s in range(0, len(frames), 4096):
        x = frames[s : s + 4096].astype(np.float32)
        x -= x.mean(1, keepdims=True)
        spectrum = np.fft.rfft(x * _WINDOW, axis=1)
        out[s : s + 4096] = (spectrum.real**2 + spectrum.imag**2).astype(np.float32) @ _CLASSES
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    return np.where(norm > 1e-3, out / np.maximum(norm, 1e-3), 0)


def packed(samples: np.ndarray) -> np.ndarray:
    """Packed fingerprints (uint32), one for each place of a ``WIDTH`` frame window."""
    image = chroma(samples)
    n = len(image) - WIDTH + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    total = np.zeros((len(image) + 1, 25))
    total[1:, 1:] = np.cumsum(np.cumsum(np.concatenate([image, image], 1), 0), 1)  # classes go round
    at = np.arange(n)

    def area(t0: int, t1: int, c0: int, c1: int) -> np.ndarray:
        return total[at + t1, c1] - total[at + t0, c1] - total[at + t1, c0] + total[at + t0, c0]

    out = np.zeros(n, np.uint32)
    for i, (kind, c, h, w) in enumerate(FILTERS):
        if kind == 0:  # lower against upper classes
            a, b = area(0, w, c, c + h // 2), area(0, w, c + h // 2, c + h)
        elif kind == 1:  # earlier against later frames
            a, b = area(0, w // 2, c, c + h), area(w // 2, w, c, c + h)
        elif kind == 2:  # crossed quarters
            a = area(0, w // 2, c, c + h // 2) + area(w // 2, w, c + h // 2, c + h)
            b = area(0, w // 2, c + h // 2, c + h) + area(w // 2, w, c, c + h // 2)
        else:  # the classes against the same number of others
            a, b = area(0, w, c, c + h), area(0, w, c + h, c + 2 * h)
        value = np.log((a + 0.1) / (b + 0.1))
        level = (value > -_STEP).astype(np.uint32) + (value > 0) + (value > _STEP)
        out |= (level ^ (level >> 1)).astype(np.uint32) << np.uint32(2 * i)  # neighbours differ in one bit
    return out


def _samples(raw: np.ndarray) -> np.ndarray:
    return raw[44:] if len(raw) > 44 and raw[:4].tobytes() == b"RIFF" and raw[8:12].tobytes() == b"WAVE" else raw


def fingerprints(media: DataFrame, key: str = "doc_id", payload: str = "media") -> DataFrame:
    """``key``, ``codes`` (packed integers, one for every ``HOP`` samples), and ``short`` of every recording.

    Null, empty and short payloads have no codes; ``short`` is the samples of a recording without
    codes (null payloads have none).
    """
    slim = media.select(key, F.col(payload).cast("binary").alias("media"))
    kind = dict(slim.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "media", _BATCH_BYTES):
            data, offsets = joined_bytes(batch.column("media"))
            samples = [_samples(data[a:b]) for a, b in zip(offsets, offsets[1:])]
            codes = [packed(x).view(np.int32) for x in samples]
            known = batch.column("media").is_valid().to_pylist()
            short = [x.tobytes() if k and not len(c) else None for x, c, k in zip(samples, codes, known)]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(codes, pa.list_(pa.int32())), pa.array(short, pa.binary())], names=[key, "codes", "short"])

    return slim.mapInArrow(run, f"`{key}` {kind}, codes array<int>, short binary")


class _Block:
    """Some classes of query recordings with their codes, sorted for look-up."""

    def __init__(self, names: list[int], keys: list, copies: list[int], codes: list[np.ndarray], short: list[bytes | None], overlap: int):
        self.names, self.keys, self.copies, self.codes = names, keys, copies, codes
        self.whole = {_content(c, s): i for i, (c, s) in enumerate(zip(codes, short)) if len(c) < overlap}
        sizes = [len(c) for c in codes]
        value = np.concatenate([*codes, np.zeros(0, np.int32)])
        owner = np.repeat(np.arange(len(codes)), sizes)
        place = np.concatenate([*map(np.arange, sizes), np.zeros(0, int)]).astype(np.int64)
        keep = _changes(value) | (place == 0)
        order = np.argsort(value[keep], kind="stable")
        self.value, self.owner, self.place = value[keep][order], owner[keep][order], place[keep][order]
        self.steps = np.bincount(self.owner, minlength=len(codes))

    def matches(self, codes: np.ndarray, short: bytes | None, votes: int, overlap: int, errors: float) -> list[tuple[float, int, int]]:
        """(bit error rate, query, offset) of each query that aligns with a recording."""
        if len(codes) < overlap:
            query = self.whole.get(_content(codes, short))
            return [] if query is None else [(0.0, query, 0)]
        if not len(self.value):
            return []
        own = np.flatnonzero(_changes(codes))
        steps = len(own)
        a, b = np.searchsorted(self.value, codes[own]), np.searchsorted(self.value, codes[own], "right")
        some = b > a
        own, a, n = own[some], a[some], (b - a)[some]
        if not len(own):
            return []
        at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        offset = np.repeat(own, n) - self.place[at]  # histogram of offsets for each query
        spot, count = np.unique(self.owner[at] << 32 | offset + (1 << 31), return_counts=True)
        enough = count >= np.minimum(votes, np.minimum(self.steps[spot >> 32], steps))  # a steady one cannot give more
        spot, count = spot[enough], count[enough]
        out: dict[int, tuple[float, int, int]] = {}
        for s in spot[np.argsort(-count, kind="stable")].tolist():
            query, shift = s >> 32, (s & 0xFFFFFFFF) - (1 << 31)
            other = self.codes[query]
            first, last = max(0, shift), min(len(codes), len(other) + shift)
            if last - first >= overlap:
                wrong = int(np.bitwise_count(codes[first:last] ^ other[first - shift : last - shift]).sum()) / (32 * (last - first))
                if wrong <= errors:
                    out[query] = min(out.get(query, (2.0, 0, 0)), (wrong, query, shift))
        return list(out.values())


def _changes(codes: np.ndarray) -> np.ndarray:
    """Where a code differs from the one before: a steady stretch counts once."""
    return np.concatenate(([True], codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, bool)


def _content(codes: np.ndarray, short: bytes | None) -> tuple[bytes, bytes] | None:
    """What two recordings too short to be aligned share when they are equal (None: no recording)."""
    return (codes.tobytes(), b"") if len(codes) else None if short is None else (b"", short)


_MATCH = "query_class long, query {key}, n_queries long, offset long, bit_error double"


def align(codes: DataFrame, queries: Column, *, key: str = "doc_id", votes: int = 2, overlap: int = 16, errors: float = 0.15, block: int = 1_000_000) -> DataFrame:
    """Every recording against all query recordings: key, n_codes, own_class, n_matches, best, offset, bit_error, matches.

    ``codes`` is the frame of ``fingerprints``; ``queries`` picks the queries.  Queries with the same
    codes (without codes: the same samples) are a class: ``own_class`` names it on each of its
    members, and is null where a row is no query.  ``matches`` has every class that matches a
    recording (with its smallest key and its number of queries), n_matches counts their queries;
    ``pairs`` lists them one by one.  A query matches where at least ``votes`` codes are equal at one
    offset (fewer only where one of the two has fewer changes of code), ``overlap`` places or more
    overlap, and the share of differing bits there is at most ``errors``.  A recording with fewer
    than ``overlap`` codes matches the queries that equal it.  ``best`` has the fewest differing
    bits, ``offset`` is its start within the recording in places; both are null without match.
    Queries are broadcast in blocks of about ``block`` codes; every recording meets every block.
    """
    # written once, with a number for each row: keys may repeat
    codes = materialise(codes.withColumn("row", F.monotonically_increasing_id()), "audio-codes")
    some = (F.size("codes") > 0) | F.col("short").isNotNull()
    named = codes.withColumn("own_class", F.when(queries & some, F.xxhash64("codes", "short")))
    asked = named.where("own_class is not null").groupBy("own_class", "codes", "short").agg(F.min(key).alias("q"), F.count("*").alias("copies"))
    asked = materialise(asked, "audio-queries")
    size = asked.agg(F.sum(F.size("codes") + F.coalesce(F.length("short"), F.lit(0)) / 4 + 1)).first()[0] or 0
    blocks = max(1, int(-(-size // block)))
    kind = dict(codes.dtypes)[key]
    found = []
    for b in range(blocks):
        part = asked.where(F.pmod("own_class", F.lit(blocks)) == b).orderBy("q", "own_class").toArrow()
        get = lambda c: part.column(c).to_pylist()  # noqa: B023, E731
        own = [c.values.to_numpy() for c in part.column("codes")] if part.num_rows else []
        shared = codes.sparkSession.sparkContext.broadcast(_Block(get("own_class"), get("q"), get("copies"), own, get("short"), overlap))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, first=b == 0) -> Iterator[pa.RecordBatch]:
            queries = shared.value
            for batch in batches:
                row, met = [], []
                for i, (c, s) in enumerate(zip(batch.column("codes"), batch.column("short").to_pylist())):
                    of = queries.matches(c.values.to_numpy(), s, votes, overlap, errors)
                    if of or first:  # a recording without match is a row of the first block only
                        of = [(round(e, 6), queries.keys[q], queries.names[q], q, at) for e, q, at in of]
                        row.append(i)
                        met.append([{"query_class": name, "query": k, "n_queries": queries.copies[q], "offset": at, "bit_error": e} for e, k, name, q, at in of])
                take = pa.array(row, pa.int64())
                kind = batch.schema.field(key).type
                match = pa.struct([("query_class", pa.int64()), ("query", kind), ("n_queries", pa.int64()), ("offset", pa.int64()), ("bit_error", pa.float64())])
                sizes = pa.array([len(batch.column("codes")[i]) for i in row], pa.int64())
                yield pa.RecordBatch.from_arrays([*[batch.column(c).take(take) for c in ("row", key)], sizes, batch.column("own_class").take(take), pa.array(met, pa.list_(match))], names=["row", key, "n_codes", "own_class", "matches"])

        fields = ", ".join(f.replace(" ", ": ", 1) for f in _MATCH.format(key=kind).split(", "))
        found.append(named.select("row", key, "codes", "short", "own_class").mapInArrow(run, f"row long, `{key}` {kind}, n_codes long, own_class long, matches array<struct<{fields}>>"))
    rows = found[0]
    if blocks > 1:
        rows = reduce(DataFrame.union, found).groupBy("row").agg(*[F.first(c).alias(c) for c in (key, "n_codes", "own_class")], F.flatten(F.collect_list("matches")).alias("matches"))
    best = F.array_min(F.transform("matches", lambda m: F.struct(m["bit_error"], m["query"], m["offset"])))
    total = F.aggregate("matches", F.lit(0).cast("long"), lambda n, m: n + m["n_queries"])
    rows = rows.select(key, "n_codes", "own_class", total.alias("n_matches"), best.alias("b"), F.array_sort("matches").alias("matches"))
    return rows.select(key, "n_codes", "own_class", "n_matches", F.col("b.query").alias("best"), "b.offset", "b.bit_error", "matches")


def by_class(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row for each recording and query class that matches it; a recording without match is one row."""
    rows = found.select(key, "n_codes", "own_class", "n_matches", F.explode_outer("matches").alias("m"))
    return rows.select(key, "n_codes", "own_class", "n_matches", "m.*")


def pairs(classes: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row for each query and recording that match, out of ``by_class``: key, query, offset, bit_error.

    A group of equal recordings has as many rows as the square of its size.
    """
    members = classes.where("own_class is not null")
    # a member stands in as many rows as it has matches (itself is one): the row of its own class
    members = members.where("query_class = own_class").select(F.col("own_class").alias("query_class"), F.col(key).alias("__query"))
    return classes.where("query_class is not null").join(members, "query_class").select(key, F.col("__query").alias("query"), "offset", "bit_error")
