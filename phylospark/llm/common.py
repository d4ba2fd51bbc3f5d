"""Shared helpers: table access, materialised intermediates, byte-level numpy kernels."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_U64 = np.uint64
_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark (any path Spark can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, a session of one machine uses a temporary folder; a cluster raises.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return shared or _own_folder()


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    It cuts the lineage, so that a result used twice is computed once and survives lost
    executors.  The files stay until the shared folder is cleared: the returned frame, and all
    that derives from it, is lazy.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash, elementwise."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _U64(33))
        x = x * _U64(0xFF51AFD7ED558CCD)
        x = x ^ (x >> _U64(29))
        x = x * _U64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> _U64(32))


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base & _MASK, pow(base, -1, 1 << 64)
        self.up = np.ones(1, _U64)
        self.down = np.ones(1, _U64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            with np.errstate(over="ignore"):
                for name, b in (("up", self.base), ("down", self.inverse)):
                    x = np.full(size, b, _U64)
                    x[0] = 1
                    setattr(self, name, np.cumprod(x, dtype=_U64))


class RollingHash:
    """Polynomial prefix hash of a value sequence; any slice's hash costs two look-ups.

    ``prefix(v)[j] - prefix(v)[i]``, moved to position 0 by the inverse power, depends on the
    values between i and j alone.
    """

    def __init__(self, base: int):
        self.powers = Powers(base | 1)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self.powers.need(len(values) + 1)
        out = np.zeros(len(values) + 1, _U64)
        with np.errstate(over="ignore"):
            np.cumsum(values * self.powers.up[: len(values)], out=out[1:])
        return out

    def slices(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((prefix[end] - prefix[start]) * self.powers.down[start] + (end - start).astype(_U64))


def byte_values(seed: int) -> np.ndarray:
    """A random odd 64-bit value for every byte."""
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U64) * _U64(2) + _U64(1)


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string (UTF-8) or binary array, end to end, and the offsets of its rows (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def small_batches(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``limit`` bytes; a longer row stays whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = joined_bytes(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edges = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
