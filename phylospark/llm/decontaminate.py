"""Benchmark decontamination: windows of benchmark words looked up in training texts.

The benchmark's windows go to the tasks as a sorted array of 64-bit hashes (a hash set), together
with their words, against which every hit is verified.  The broadcast is allowed up to
``max_broadcast`` bytes; a larger benchmark is joined by hash instead, with the same results.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import RollingHash, byte_values, joined_bytes, materialise, runs_of, small_batches

_BATCH_BYTES = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: a word is a run of 0-9, a-z (after lower-casing A-Z) and code points from U+0080
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_BYTES, _HASH, _WORDS = byte_values(5), RollingHash(0x9E3779B97F4A7C15), RollingHash(0xD1342543DE82EF95)


class _Words:
    """Words of some texts: the lower-cased bytes, each word's span and hash, each text's words."""

    def __init__(self, texts: pa.Array):
        data, offsets = joined_bytes(texts)
        self.low = _LOWER[data]
        # a break before each text, so that no word crosses texts
        place = np.arange(len(data)) + np.repeat(np.arange(1, len(offsets)), np.diff(offsets))
        flags = np.zeros(len(data) + len(offsets), bool)
        flags[place] = _WORD[self.low]
        start, end = runs_of(flags)
        breaks = offsets + np.arange(len(offsets))  # where text i's break stands
        text = np.searchsorted(breaks, start, "right") - 1
        self.start, self.end = start - text - 1, end - text - 1
        self.counts = np.bincount(text, minlength=len(offsets) - 1).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        self.text = text
        self.hashes = _HASH.slices(_HASH.prefix(_BYTES[self.low]), self.start, self.end)
        self.prefix = _WORDS.prefix(self.hashes)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of the windows of ``n`` words."""
        i = np.arange(max(0, len(self.text) - n + 1))
        i = i[self.text[i] == self.text[i + n - 1]]
        return i, self.hash_of(i, n)

    def hash_of(self, i: np.ndarray, n: int) -> np.ndarray:
        return _WORDS.slices(self.prefix, i, i + n)

    def said(self, i: int, n: int) -> bytes:
        return b" ".join(self.low[a:b].tobytes() for a, b in zip(self.start[i : i + n], self.end[i : i + n]))


def _item_windows(benchmark: DataFrame, item: str, text: str, n: int) -> DataFrame:
    """Distinct (n, hash, words, item) of the benchmark's windows."""
    slim = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", _BATCH_BYTES):
            words = _Words(batch.column("text"))
            items = batch.column("item").to_pylist()
            rows = []
            for k, count in enumerate(words.counts.tolist()):
                size = min(n, count)
                for i in range(int(words.first[k]), int(words.first[k]) + count - size + 1) if size else ():
                    hashed = words.hash_of(np.array([i]), size)
                    rows.append({"n": size, "hash": int(hashed.view(np.int64)[0]), "words": words.said(i, size), "item": items[k]})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("n", pa.int32()), ("hash", pa.int64()), ("words", pa.binary()), ("item", pa.string())]))

    return slim.mapInArrow(run, "n int, hash long, words binary, item string").distinct()


def _finish(n_words: int, spans: list[tuple[int, int]], items: set[str | None]) -> tuple[int, int, str, bool]:
    hit = np.zeros(n_words, bool)
    for a, b in spans:
        hit[a:b] = True
    n, items = int(hit.sum()), items - {None}
    return n, len(items), sha256(",".join(sorted(items)).encode()).hexdigest(), n > 0 and 20 * n >= n_words


_RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def contamination(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text", n: int = 13, max_broadcast: int = 64 << 20, prefix: str = "", keep_hit_text: str | None = None) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated (names after ``prefix``).

    An item's window is ``n`` consecutive words (all words of a shorter item).  A document word in
    any occurrence of a window is hit; a document is contaminated when at least a twentieth of its
    words are.  Null texts have no words; items without words have no windows; windows of items
    without id hit words, but such items are not counted or listed; an empty benchmark hits nothing.  Columns of ``docs`` that clash with a result are replaced.

    ``keep_hit_text`` names a column to which the text without its hit words' spans is written:
    "remove spans" instead of "remove documents".
    """
    windows = materialise(_item_windows(benchmark, item, item_text, n), "benchmark-windows")
    names = [prefix + f.split()[0] for f in _RESULT.split(", ")]
    kept = docs.drop(*names, *([keep_hit_text] if keep_hit_text else []))
    # a window's words, its item, and about 250 bytes of Python objects
    size = windows.agg(F.sum(F.octet_length("words") + F.coalesce(F.octet_length("item"), F.lit(0)) + 250)).first()[0] or 0
    if size <= max_broadcast:
        return _by_broadcast(kept, windows, text, names, keep_hit_text)
    return _by_join(kept, windows, text, names, keep_hit_text)


def _schema(docs: DataFrame, names: list[str], out: str | None) -> StructType:
    schema = StructType(list(docs.schema.fields))
    for name, kind in zip(names, [f.split()[1] for f in _RESULT.split(", ")]):
        schema = schema.add(name, kind)
    return schema.add(out, "string") if out else schema


def _results(texts: pa.Array, words: _Words, spans: dict[int, list[tuple[int, int]]], items: dict[int, set[str]], keep: bool) -> list[pa.Array]:
    none = _finish(0, [], set())
    rows = [_finish(int(words.counts[k]), spans[k], items[k]) if k in spans else none for k in range(len(texts))]
    cols = [pa.array(words.counts), *(pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.bool_())))]
    return cols + [pa.array(_without(texts, words, spans), pa.string())] if keep else cols


def _by_broadcast(docs: DataFrame, windows: DataFrame, text: str, names: list[str], out: str | None) -> DataFrame:
    table: dict[int, dict[int, dict[bytes, list[str]]]] = defaultdict(lambda: defaultdict(lambda: defaultdict(list)))
    for r in windows.toLocalIterator():
        table[r.n][r.hash][bytes(r.words)].append(r.item)
    shared = docs.sparkSession.sparkContext.broadcast({n: {h: dict(w) for h, w in of.items()} for n, of in table.items()})
    schema = _schema(docs, names, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = []
        for size, of in sorted(shared.value.items()):
            keys = np.sort(np.array(list(of), np.int64).view(np.uint64))
            flags = np.zeros(1 << 20, bool)
            flags[(keys >> np.uint64(44)).astype(np.int64)] = True
            sets.append((size, keys, flags, of))
        for batch in small_batches(batches, text, _BATCH_BYTES):
            words = _Words(batch.column(text))
            spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
            items: dict[int, set[str]] = defaultdict(set)
            for size, keys, flags, of in sets:
                i, hashes = words.windows(size)
                some = flags[(hashes >> np.uint64(44)).astype(np.int64)]
                i, hashes = i[some], hashes[some]
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                same = keys[at] == hashes
                for a, h in zip(i[same].tolist(), hashes[same].view(np.int64).tolist()):
                    found = of[h].get(words.said(a, size))
                    if found:
                        k = int(words.text[a])
                        spans[k].append((a - int(words.first[k]), a - int(words.first[k]) + size))
                        items[k].update(found)
            cols = _results(batch.column(text), words, spans, items, bool(out))
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, *names, *([out] if out else [])])

    return docs.mapInArrow(run, schema)


def _without(texts: pa.Array, words: _Words, spans: dict[int, list[tuple[int, int]]]) -> list[str | None]:
    """Texts with the stretches from the first to the last hit word of each hit run taken out."""
    texts = texts.to_pylist()
    _, offsets = joined_bytes(pa.array(texts, pa.string()))
    for k, of in spans.items():
        hit = np.zeros(int(words.counts[k]), bool)
        for a, b in of:
            hit[a:b] = True
        raw, done, parts = texts[k].encode(), 0, []
        for a, b in zip(*runs_of(hit)):
            parts.append(raw[done : int(words.start[words.first[k] + a] - offsets[k])])
            done = int(words.end[words.first[k] + b - 1] - offsets[k])
        texts[k] = b"".join([*parts, raw[done:]]).decode()
    return texts


def _by_join(docs: DataFrame, windows: DataFrame, text: str, names: list[str], out: str | None) -> DataFrame:
    """The same for a benchmark too large to broadcast: hashed windows of all different texts are joined."""
    sizes = sorted(r.n for r in windows.select("n").distinct().collect())
    kept = docs.columns
    key = F.sha2(F.coalesce(text, F.lit("")), 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", _BATCH_BYTES):
            words = _Words(batch.column("text"))
            for size in sizes:
                i, hashes = words.windows(size)
                k = words.text[i]
                said = [words.said(a, size) for a in i.tolist()]
                yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(k)), pa.array(i - words.first[k]), pa.array(np.full(len(i), size, np.int32)), pa.array(hashes.view(np.int64)), pa.array(said, pa.binary())], names=["key", "at", "n", "hash", "words"])

    texts = docs.select(key.alias("key"), F.col(text).alias("text")).dropDuplicates(["key"])
    hits = texts.mapInArrow(run, "key string, at long, n int, hash long, words binary").join(windows, ["n", "hash", "words"])
    # what is gathered of one text is bounded by its words
    of = hits.groupBy("key").agg(F.collect_set(F.struct("at", "n")).alias("spans"), F.collect_set("item").alias("items"))
    own = F.struct(*kept).alias("row")
    joined = docs.select(own, F.col(text).alias("text"), key.alias("key")).join(of, "key", "left").select("row", "text", "spans", "items")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", _BATCH_BYTES):
            words = _Words(batch.column("text"))
            found = {k: (s, i) for k, (s, i) in enumerate(zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())) if s}
            spans = {k: [(x["at"], x["at"] + x["n"]) for x in s] for k, (s, _) in found.items()}
            cols = _results(batch.column("text"), words, spans, {k: set(i) for k, (_, i) in found.items()}, bool(out))
            yield pa.RecordBatch.from_arrays([*batch.column("row").flatten(), *cols], names=[*kept, *names, *([out] if out else [])])

    return joined.mapInArrow(finish, _schema(docs, names, out))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    found = contamination(docs, benchmark, prefix="__bench_", **options)
    return found.where("not __bench_contaminated").select(*docs.columns)
