"""Quality classifier: naive Bayes log-count ratios under a linear hinge-loss model (NBSVM).

Features are n-gram indicators of the text alone, hashed into fixed ranges: byte trigrams, words,
pairs of word shapes, and patterns of "equals the word before" over six words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import RollingHash, byte_values, joined_bytes, runs_of, small_batches

_BATCH_BYTES = 1 << 20
_TRI, _WORD, _SHAPE, _SAME = 1 << 16, 1 << 16, 1 << 10, 1 << 7
SIZE = _TRI + _WORD + _SHAPE + _SAME
_BYTES, _HASH = byte_values(9), RollingHash(0xA0761D6478BD642F)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: bits of a word's shape: upper case, lower case, digit, other ASCII, beyond ASCII
_CLASS = np.full(256, 8, np.uint8)
_CLASS[ord("A") : ord("Z") + 1], _CLASS[ord("a") : ord("z") + 1], _CLASS[ord("0") : ord("9") + 1], _CLASS[128:] = 1, 2, 4, 16


class Features:
    """Feature numbers of the texts of a batch, document by document."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = joined_bytes(texts)
        place = np.arange(len(self.data)) + np.repeat(np.arange(1, len(self.offsets)), np.diff(self.offsets))
        flags = np.zeros(len(self.data) + len(self.offsets), bool)
        flags[place] = ~_SPACE[self.data]
        start, end = runs_of(flags)
        text = np.searchsorted(self.offsets + np.arange(len(self.offsets)), start, "right") - 1
        start, end = start - text - 1, end - text - 1
        self.first = np.searchsorted(text, np.arange(len(self.offsets)))
        hashes = _HASH.slices(_HASH.prefix(_BYTES[self.data]), start, end)
        self.words = (hashes >> np.uint64(48)).astype(np.int32) % _WORD
        shapes = np.bitwise_or.reduceat(_CLASS[np.append(self.data, 0)], np.stack([start, end], 1).ravel())[::2].astype(np.int32) if len(start) else np.zeros(0, np.int32)
        self.shapes = shapes
        self.same = np.zeros(len(hashes), np.int32)
        self.same[1:] = hashes[1:] == hashes[:-1]
        x = self.data.astype(np.uint32)
        self.tri = ((x[:-2] * 0x9E3779B1 ^ x[1:-1] * 0x85EBCA77 ^ x[2:] * 0xC2B2AE3D) * np.uint32(0x27D4EB2F) >> np.uint32(16)).astype(np.int32) if len(x) > 2 else np.zeros(0, np.int32)

    def mark(self, k: int, flags: np.ndarray) -> None:
        """Set the flags of document ``k``'s features."""
        a, b = self.offsets[k], self.offsets[k + 1]
        flags[self.tri[a : max(a, b - 2)]] = True
        a, b = self.first[k], self.first[k + 1]
        flags[_TRI + self.words[a:b]] = True
        shapes, same = self.shapes[a:b], self.same[a:b].copy()
        if len(same):
            same[0] = 0
        flags[_TRI + _WORD + shapes[:-1] * 32 + shapes[1:]] = True
        if len(shapes) == 1:
            flags[_TRI + _WORD + shapes[0]] = True
        if len(same) < 6:  # one pattern, filled up with zeros; its own range of numbers
            flags[_TRI + _WORD + _SHAPE + int(sum(int(v) << i for i, v in enumerate(same)))] = True
            return
        pattern = np.full(len(same) - 5, 64, np.int32)
        for i in range(6):
            pattern += same[i : len(same) - 5 + i] << i
        flags[_TRI + _WORD + _SHAPE + pattern] = True


@dataclass(frozen=True)
class Model:
    """``score = 1 / (1 + exp(-(slope * margin + shift)))``, margin the mean-free linear form."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, texts: pa.Array) -> np.ndarray:
        features, out = Features(texts), np.zeros(len(texts))
        flags = np.zeros(SIZE, bool)
        for k in range(len(texts)):
            flags[:] = False
            features.mark(k, flags)
            on = np.flatnonzero(flags)
            out[k] = self.weights[on].sum(dtype=np.float64) / np.sqrt(max(1, len(on))) + self.bias
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.shift, -30, 30)))


def fit(rows: list[np.ndarray], labels: np.ndarray, *, alpha: float = 1.0, cost: float = 1.0, mixing: float = 0.75, epochs: int = 20, seed: int = 7) -> Model:
    """NBSVM by dual coordinate descent over indicator rows (arrays of feature numbers).

    Classes weigh the same in the hinge loss.  With fewer than two classes the model is constant:
    1 for only good rows, 0 for only bad ones, 0.5 for none.
    """
    y = np.where(labels > 0, 1.0, -1.0)
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(SIZE, np.float32), float(y[0]) if len(y) else 0.0, 4.0, 0.0)
    sums = {s: np.full(SIZE, alpha) for s in (1.0, -1.0)}
    for r, v in zip(rows, y):
        sums[v][r] += 1  # a row's features are distinct
    ratio = np.log(sums[1.0] / sums[1.0].sum()) - np.log(sums[-1.0] / sums[-1.0].sum())
    value = lambda r: ratio[r] / np.sqrt(max(1, len(r)))
    norms = np.array([(v := value(r)) @ v + 1.0 for r in rows])
    limit = np.where(y > 0, cost * len(y) / (2 * (y > 0).sum()), cost * len(y) / (2 * (y < 0).sum()))
    w, bias, dual, order = np.zeros(SIZE), 0.0, np.zeros(len(y)), np.random.default_rng(seed)
    for _ in range(epochs):
        most = 0.0
        for i in order.permutation(len(y)):
            r = rows[i]
            v = value(r)
            gradient = y[i] * (w[r] @ v + bias) - 1
            new = min(max(dual[i] - gradient / norms[i], 0.0), limit[i])
            step = (new - dual[i]) * y[i]
            if step:
                w[r] += step * v
                bias += step
                dual[i] = new
                most = max(most, abs(step))
        if most < 1e-3:
            break
    w = mixing * w + (1 - mixing) * np.abs(w).mean() * np.sign(w)  # between the fitted form and naive Bayes
    weights = (w * ratio).astype(np.float32)
    margins = np.array([weights[r].sum(dtype=np.float64) / np.sqrt(max(1, len(r))) + bias for r in rows])
    slope, shift = _sigmoid(margins, y)
    return Model(weights, bias, slope, shift)


def _sigmoid(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the margins (Platt's targets, balanced classes)."""
    n = {1.0: (y > 0).sum(), -1.0: (y < 0).sum()}
    target = np.where(y > 0, (n[1.0] + 1) / (n[1.0] + 2), 1 / (n[-1.0] + 2))
    weight = np.where(y > 0, 0.5 / n[1.0], 0.5 / n[-1.0])
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g, h = weight * (p - target), weight * p * (1 - p)
        grad = np.array([g @ margins + 1e-4 * a, g.sum()])
        hess = np.array([[h @ margins**2 + 1e-4, h @ margins], [h @ margins, h.sum() + 1e-9]])
        step = np.linalg.solve(hess, grad)
        size = min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        a, b = a - size * step[0], b - size * step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(max(a, 1e-3)), float(b)


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = 6000) -> Model:
    """Fit on at most ``sample`` labelled rows (the smallest hashes of the key): a bounded sample.

    Rows without label, or without document, are left out; several labels of one key are averaged.
    The keys of the sample, bounded by ``sample``, are broadcast; texts are not shuffled.
    """
    picked = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg((F.avg(label) >= 0.5).cast("int").alias("__label"))
    picked = picked.orderBy(F.xxhash64(key), key).limit(sample)
    rows = docs.select(key, F.col(text).alias("__text")).join(F.broadcast(picked), key).select("__text", "__label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "__text", _BATCH_BYTES):
            features, flags, on = Features(batch.column("__text")), np.zeros(SIZE, bool), []
            for k in range(batch.num_rows):
                flags[:] = False
                features.mark(k, flags)
                on.append(np.flatnonzero(flags).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("__label"), pa.array(on, pa.list_(pa.int32()))], names=["label", "on"])

    got = rows.mapInArrow(run, "label int, on array<int>").toArrow()
    on = got.column("on").combine_chunks()
    lists = [on[i].values.to_numpy() for i in range(len(on))]
    values = got.column("label").to_numpy()
    ranks = sorted(range(len(lists)), key=lambda i: (values[i], len(lists[i]), sha256(lists[i].tobytes()).digest()))  # the same whatever the order of arrival
    return fit([lists[i] for i in ranks], values[ranks] if len(ranks) else values)


def score(docs: DataFrame, model: Model, text: str = "text", score_name: str = "score") -> DataFrame:
    """``docs`` with the model's score (0 to 1) of every whole text; null counts as empty."""
    kept = docs.drop(score_name)
    schema = StructType(list(kept.schema.fields)).add(score_name, "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text, _BATCH_BYTES):
            scores = shared.value.scores(batch.column(text))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, score_name])

    return kept.mapInArrow(run, schema)
