"""Counts over characters of sequences, by numpy within tasks.

Each task adds up its own rows and emits vectors, so that what is shuffled is a few numbers for each
site or k-mer and task, never a row for each cell.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import GENETIC_CODES

_BASES = "ACGT"
#: place of a character among the bases, 4 for any other
_CODE = np.full(256, 4, np.uint8)
for _i, _b in enumerate(_BASES):
    _CODE[ord(_b)] = _CODE[ord(_b.lower())] = _i
_UPPER_CODE = _CODE.copy()
_UPPER_CODE[[ord(b) for b in "acgt"]] = 4
#: sites of one vector, and what a task holds before it emits
_BLOCK, _HELD = 4096, 4 << 20


def _codes(seq: str, table: np.ndarray = _CODE) -> np.ndarray:
    if seq.isascii():
        return table[np.frombuffer(seq.encode(), np.uint8)]
    return table[np.minimum(np.frombuffer(seq.encode("utf-32-le", "surrogatepass"), "<u4"), 255)] | 0


def _characters(text: str) -> np.ndarray:
    """The characters as numbers: bytes of plain text, else code points."""
    return np.frombuffer(text.encode(), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _text(characters: np.ndarray) -> str:
    return characters.tobytes().decode("ascii") if characters.dtype == np.uint8 else characters.tobytes().decode("utf-32-le", "surrogatepass")


#: characters of one batch that a task emits
_EMITTED = 4 << 20


def _rewritten(batch: pa.RecordBatch, names: list[str], texts: Iterator[tuple[int, str | None]]) -> Iterator[pa.RecordBatch]:
    """The named columns of the rows that have a text, which becomes ``seq``, in batches of about ``_EMITTED`` characters.

    A batch of short rows may become one of long rows, whose texts are never held all at once.
    """
    rows, out, size = [], [], 0

    def done() -> pa.RecordBatch:
        at = pa.array(rows, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == "seq" else batch.column(batch.schema.get_field_index(c)).take(at) for c in names], names=names)

    for row, text in texts:
        rows.append(row)
        out.append(text)
        size += len(text or "")
        if size >= _EMITTED:
            yield done()
            rows, out, size = [], [], 0
    if rows:
        yield done()


def base_vectors(alignments: DataFrame) -> DataFrame:
    """``locus``, ``block``, ``counts``: numbers of A, C, G and T (either case) at the sites of a block.

    ``counts`` is binary (site by site, four little-endian longs).  A task holds counts of a bounded
    number of sites; vectors of one block are added in one pass over sorted partitions.
    """
    kind = alignments.schema["locus"].dataType.simpleString()
    schema = f"locus {kind}, block int, counts binary"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            while held:
                locus, counts = held.popitem()
                parts = [counts[at : at + _BLOCK, :4].tobytes() for at in range(0, len(counts), _BLOCK)]
                yield pa.RecordBatch.from_arrays([pa.array([locus] * len(parts), types[0]), pa.array(range(len(parts)), types[1]), pa.array(parts, types[2])], names=["locus", "block", "counts"])

        types = None
        for batch in batches:
            types = types or (batch.schema.field("locus").type, pa.int32(), pa.binary())
            for locus, seq in zip(batch.column("locus").to_pylist(), batch.column("seq").to_pylist()):
                codes = _codes(seq or "")
                counts = held.get(locus)
                if counts is None or len(counts) < len(codes):
                    grown = np.zeros((len(codes), 5), "<i4")  # fewer rows than that in a task
                    if counts is not None:
                        grown[: len(counts)] = counts
                    size += len(codes) - (0 if counts is None else len(counts))
                    held[locus] = counts = grown
                counts[np.arange(len(codes)), codes] += 1
            if size > _HELD:
                yield from flush()
                size = 0
        yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = None, np.zeros(0, np.int64)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([own[0]], types[0]), pa.array([own[1]], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["locus", "block", "counts"])

        types = None
        for batch in batches:
            types = types or (batch.schema.field("locus").type,)
            for locus, block, raw in zip(*(batch.column(c).to_pylist() for c in ("locus", "block", "counts"))):
                part = np.frombuffer(raw, "<i4").astype("<i8")
                if own != (locus, block):
                    if own is not None:
                        yield done()
                    own, total = (locus, block), part
                elif len(part) > len(total):
                    part[: len(total)] += total
                    total = part
                else:
                    total[: len(part)] += part
        if own is not None:
            yield done()

    parts = alignments.select("locus", "seq").mapInArrow(add, schema)
    return parts.repartition("locus", "block").sortWithinPartitions("locus", "block").mapInArrow(merge, schema)


def base_counts(alignments: DataFrame) -> DataFrame:
    """``locus``, ``pos`` (from 1), ``A``, ``C``, ``G``, ``T`` for every site up to the locus' longest row."""
    kind = alignments.schema["locus"].dataType.simpleString()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, (block, raw) in enumerate(zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist())):
                counts = np.frombuffer(raw, "<i8").reshape(-1, 4)
                n = len(counts)
                loci = batch.column("locus").take(pa.array(np.full(n, row)))
                yield pa.RecordBatch.from_arrays([loci, pa.array(np.arange(1, n + 1) + block * _BLOCK), *[pa.array(np.ascontiguousarray(counts[:, k])) for k in range(4)]], names=["locus", "pos", *_BASES])

    return base_vectors(alignments).mapInArrow(spread, f"locus {kind}, pos long, A long, C long, G long, T long")


#: bytes of a block's bitmap
_BYTES = _BLOCK // 8


def occupied_sites(rows: DataFrame, threshold: float) -> DataFrame:
    """``locus``, ``marks``: bitmaps by block of the sites at which the share of rows without a base is below ``threshold``."""
    kind = rows.schema["locus"].dataType.simpleString()
    counts = rows.groupBy("locus").agg(F.count("*").alias("n"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for raw, n in zip(batch.column("counts").to_pylist(), batch.column("n").to_pylist()):
                present = np.frombuffer(raw, "<i8").reshape(-1, 4).sum(1)
                bits.append(np.packbits(n - present < threshold * n).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("locus"), batch.column("block"), pa.array(bits, pa.binary())], names=["locus", "block", "bits"])

    return _by_locus(base_vectors(rows).join(counts, "locus").select("locus", "block", "counts", "n").mapInArrow(mark, f"locus {kind}, block int, bits binary"))


def marked_sites(rows: DataFrame, gap: str = "-") -> DataFrame:
    """``locus``, ``marks``: bitmaps by block of the sites at which some row has no gap.

    Each task marks its own rows' sites; its bitmaps are or-ed block by block before they are gathered.
    """
    kind = rows.schema["locus"].dataType.simpleString()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        types = None

        def flush() -> pa.RecordBatch:
            return _marks([(locus, at // _BLOCK, np.packbits(flags[at : at + _BLOCK]).tobytes()) for locus, flags in held.items() for at in range(0, len(flags), _BLOCK)], types)

        for batch in batches:
            types = batch.schema.field("locus").type
            for locus, seq in zip(batch.column("locus").to_pylist(), batch.column("seq").to_pylist()):
                own = np.frombuffer((seq or "").encode("utf-32-le", "surrogatepass"), "<u4") != ord(gap)
                flags = held.get(locus, own)
                if len(flags) < len(own):
                    flags, own = own.copy(), flags
                elif flags is own:
                    flags = own.copy()
                flags[: len(own)] |= own
                held[locus] = flags
            if sum(map(len, held.values())) > _HELD:
                yield flush()
                held = {}
        if held:
            yield flush()

    return _by_locus(_merged_marks(rows.select("locus", "seq").mapInArrow(mark, f"locus {kind}, block int, bits binary")))


def _by_locus(blocks: DataFrame) -> DataFrame:
    """An eighth of a byte for each site."""
    return blocks.groupBy("locus").agg(F.collect_list(F.struct("block", "bits")).alias("marks"))


def _merged_marks(blocks: DataFrame) -> DataFrame:
    """One bitmap for each ``locus`` and ``block``: all of them or-ed, over sorted partitions."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, bits = None, np.zeros(0, np.uint8)
        for batch in batches:
            out = []
            for locus, block, raw in zip(*(batch.column(c).to_pylist() for c in ("locus", "block", "bits"))):
                part = np.frombuffer(raw, np.uint8)
                if own != (locus, block):
                    if own is not None:
                        out.append((*own, bits.tobytes()))
                    own, bits = (locus, block), np.zeros(_BYTES, np.uint8)
                bits[: len(part)] |= part
            yield _marks(out, batch.schema.field("locus").type)
        if own is not None:
            yield _marks([(*own, bits.tobytes())], batch.schema.field("locus").type)

    return blocks.repartition("locus", "block").sortWithinPartitions("locus", "block").mapInArrow(merge, blocks.schema)


def _marks(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((kind, pa.int32(), pa.binary()))], names=["locus", "block", "bits"])


def keep_marked(rows: DataFrame, marks: DataFrame, fill: str = "-") -> DataFrame:
    """``rows`` with ``seq`` reduced to the marked sites of their locus; ``fill`` beyond a row's end.

    Loci without any marked site give no rows.
    """
    names = rows.columns
    joined = rows.join(marks, "locus").select(*names, "marks")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _rewritten(batch, names, picked(batch))

    def picked(batch: pa.RecordBatch) -> Iterator[tuple[int, str | None]]:
        known: dict = {}
        for k, (locus, seq) in enumerate(zip(batch.column("locus").to_pylist(), batch.column("seq"))):
            if locus not in known:
                blocks = batch.column("marks")[k].as_py()
                bits = np.zeros((1 + max(b["block"] for b in blocks)) * _BYTES, np.uint8)
                for b in blocks:
                    raw = np.frombuffer(b["bits"], np.uint8)
                    bits[b["block"] * _BYTES : b["block"] * _BYTES + len(raw)] |= raw
                flags = np.unpackbits(bits).astype(bool)
                if sum(len(flags) for flags, _ in known.values()) > _HELD:
                    known.clear()
                known[locus] = flags, int(flags.sum())
            flags, n = known[locus]
            text = seq.as_py()
            if not n:
                continue
            if text is None:
                yield k, None
                continue
            own = _characters(text)[: len(flags)]
            some = own[flags[: len(own)]]
            yield k, _text(some) + fill * (n - len(some))

    return joined.mapInArrow(pick, rows.schema)


def take_sites(rows: DataFrame, kept: DataFrame, fill: str = "-") -> DataFrame:
    """``rows`` with ``seq`` reduced to the listed sites of ``kept(locus, pos)``; ``fill`` beyond a row's end.

    Sites are packed block by block; loci without any give no rows.
    """
    kind = rows.schema["locus"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for sites in batch.column("sites").to_pylist():
                flags = np.zeros(_BLOCK, bool)
                flags[np.array(sites)] = True
                bits.append(np.packbits(flags).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("locus"), batch.column("block"), pa.array(bits, pa.binary())], names=["locus", "block", "bits"])

    at = F.col("pos") - 1
    sites = kept.groupBy("locus", F.floor(at / _BLOCK).cast("int").alias("block")).agg(F.collect_list((at % _BLOCK).cast("int")).alias("sites"))
    return keep_marked(rows, _by_locus(sites.mapInArrow(pack, f"locus {kind}, block int, bits binary")), fill)


def drawn_sites(locus: str, n: int, replicate: int, seed: int) -> np.ndarray:
    """Sites (from 0) of a resample: for k = 1 .. n, 32-bit mixing of k, the replicate, the seed and the locus."""
    own = int(md5(str(locus).encode()).hexdigest()[:7], 16)
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(2654435761) + np.uint64(replicate * 1597334677 + seed * 1812433253 + own)
    x &= np.uint64(0xFFFFFFFF)
    for multiplier, shift in ((2146121005, 15), (1540483477, 13)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(multiplier) & np.uint64(0xFFFFFFFF)
    return ((x ^ (x >> np.uint64(16))) % np.uint64(max(n, 1))).astype(np.int64)


def resampled(rows: DataFrame, seed: int, fill: str = "-") -> DataFrame:
    """Rows with ``locus``, ``replicate``, ``seq`` and ``__n`` (sites of the locus), ``seq`` at the drawn sites."""
    names, kept = rows.columns, [c for c in rows.columns if c != "__n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict = {}
        for batch in batches:
            yield from _rewritten(batch, kept, resample(batch, drawn))

    def resample(batch: pa.RecordBatch, drawn: dict) -> Iterator[tuple[int, str]]:
        at = [batch.column(names.index(c)).to_pylist() for c in ("locus", "replicate", "__n")]
        for k, (locus, replicate, n, seq) in enumerate(zip(*at, batch.column(names.index("seq")))):
            if (locus, replicate) not in drawn:
                if sum(map(len, drawn.values())) > _HELD:
                    drawn.clear()
                drawn[locus, replicate] = drawn_sites(locus, n, replicate, seed)
            codes = _characters((seq.as_py() or "") + fill)
            own = np.full(n, codes[-1])
            own[: len(codes) - 1] = codes[:-1]
            yield k, _text(own[drawn[locus, replicate]])

    return rows.mapInArrow(run, rows.drop("__n").schema)


#: characters that are worked on at once, so that the arrays over them stay in the processor's cache
_PIECE = 1 << 17


def _joined(batch: pa.RecordBatch, table: np.ndarray) -> Iterator[tuple[int, list[str], np.ndarray, np.ndarray]]:
    """Runs of a batch's rows: number of the first one, texts (NULL: empty), codes of all their characters, end to end, and
    the bounds of the rows.  A long row is a run of its own."""
    texts = [t or "" for t in batch.column("seq").to_pylist()]
    first = size = 0
    for k, t in enumerate([*texts, ""]):
        if k == len(texts) or size and size + len(t) > _PIECE:
            if k > first:
                some = texts[first:k]
                yield first, some, _codes("".join(some), table), np.cumsum([0, *map(len, some)])
            first, size = k, 0
        size += len(t)


def _places(bounds: np.ndarray) -> np.ndarray:
    """Each character's place in its row."""
    return (np.arange(bounds[-1]) - np.repeat(bounds[:-1], np.diff(bounds))).astype(np.int32)


def _words(codes: np.ndarray, place: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """k, the k-mers that end at each base as numbers (two bits a base), and whether they are whole and plain."""
    kind = np.int32 if longest < 16 else np.int64
    own, word, good = codes.astype(kind), np.zeros(len(codes), kind), np.ones(len(codes), bool)
    plain = codes < 4
    for k in range(1, min(longest, len(codes)) + 1):
        # the base k - 1 places before goes in front
        word[k - 1 :] += own[: len(codes) - k + 1] << 2 * (k - 1)
        good &= place >= k - 1
        good[k - 1 :] &= plain[: len(codes) - k + 1]
        yield k, word, good


def ending_kmer_counts(sequences: DataFrame, longest: int, frames: int = 3) -> DataFrame:
    """``kmer``, ``frame`` (index of its last base modulo ``frames``), ``n`` for k = 1 .. ``longest``.

    K-mers of plain bases (upper case) are counted in vectors, a batch at a time; those with other characters one by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(4**k * frames, np.int64) for k in range(1, longest + 1)]
        other: Counter = Counter()
        for _, texts, codes, bounds in (x for batch in batches for x in _joined(batch, _UPPER_CODE)):
            place = _places(bounds)
            frame = place % frames
            for k, word, good in _words(codes, place, longest):
                totals[k - 1] += np.bincount(word[good] * frames + frame[good], minlength=4**k * frames)
                odd = np.flatnonzero(~good & (place >= k - 1))
                rows = np.searchsorted(bounds, odd, "right") - 1
                for row, at in zip(rows.tolist(), place[odd].tolist()):
                    other[texts[row][at - k + 1 : at + 1], at % frames] += 1
        kmers, at, n = [], [], []
        for k, counts in enumerate(totals, 1):
            for x in np.flatnonzero(counts).tolist():
                kmers.append("".join(_BASES[x // frames >> 2 * j & 3] for j in range(k - 1, -1, -1)))
                at.append(x % frames)
                n.append(int(counts[x]))
        for (kmer, frame), count in other.items():
            kmers.append(kmer)
            at.append(frame)
            n.append(count)
        yield pa.RecordBatch.from_arrays([pa.array(kmers, pa.string()), pa.array(at, pa.int32()), pa.array(n, pa.int64())], names=["kmer", "frame", "n"])

    parts = sequences.select("seq").mapInArrow(run, "kmer string, frame int, n long")
    return parts.groupBy("kmer", "frame").agg(F.sum("n").alias("n"))


def base_totals(sequences: DataFrame) -> DataFrame:
    """``base``, ``n``: how often each of A, C, G and T (either case) occurs, all four of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(5, np.int64)
        for batch in batches:
            for _, _, codes, _ in _joined(batch, _CODE):
                n += np.bincount(codes, minlength=5)
        yield pa.RecordBatch.from_arrays([pa.array(list(_BASES)), pa.array(n[:4])], names=["base", "n"])

    return sequences.select("seq").mapInArrow(run, "base string, n long").groupBy("base").agg(F.sum("n").alias("n"))


def kmer_set(seq: str | None, k: int, step: int = 1) -> np.ndarray:
    """64-bit hashes of the distinct windows of ``k`` characters, every ``step``-th, sorted."""
    codes = _characters(seq or "").astype(np.uint64)
    n = max(0, len(codes) - k + 1)
    with np.errstate(over="ignore"):
        x = np.zeros(len(range(0, n, step)), np.uint64)
        for j in range(k):
            x = x * np.uint64(0x9E3779B97F4A7C15) + codes[j : j + n : step] + np.uint64(1)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = np.sort((x ^ (x >> np.uint64(32))).view(np.int64))  # np.unique hashes, which takes several times as long
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def kmer_sets(sequences: DataFrame, k: int, step: int = 1) -> DataFrame:
    """``seq_id``, ``kmers``: 64-bit hashes of the distinct windows of ``k`` characters, every ``step``-th, sorted."""
    kind = sequences.schema["seq_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for seq in batch.column("seq").to_pylist():
                sets.append(kmer_set(seq, k, step))
            sizes = np.cumsum([0, *map(len, sets)])
            flat = pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("seq_id"), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), flat)], names=["seq_id", "kmers"])

    return sequences.select("seq_id", "seq").mapInArrow(run, f"seq_id {kind}, kmers array<long>")


def _tables(model: DataFrame, longest: int) -> list[np.ndarray]:
    """The model's log-likelihoods by k - 1, frame and k-mer; the last place of each, for other k-mers, is 0.

    It has at most 3 * (4 + ... + 4 ** longest) rows.
    """
    rows = model.where(F.col("kmer").rlike(f"^[ACGT]{{1,{longest}}}$")).select("kmer", F.col("frame").cast("int").alias("frame"), "loglik").toArrow()
    tables = [np.zeros((3, 4**k + 1)) for k in range(1, longest + 1)]
    for kmer, frame, loglik in zip(*(rows.column(c).to_pylist() for c in ("kmer", "frame", "loglik"))):
        tables[len(kmer) - 1][frame, sum(_BASES.index(b) << 2 * j for j, b in enumerate(reversed(kmer)))] = loglik
    return tables


def frame_scores(sequences: DataFrame, model: DataFrame, order: int, id_: str) -> DataFrame:
    """``id_`` and score_1 .. score_6: sums over three frames of each strand of the log-likelihoods of
    the k-mers (of up to ``order`` + 1 bases) that end at each base; k-mers without one give 0.

    A batch of sequences is one array: one look-up a base and frame, and sums by row.
    """
    longest = order + 1
    shared = sequences.sparkSession.sparkContext.broadcast(_tables(model, longest))
    kind = sequences.schema[id_].dataType.simpleString()

    def strand(codes: np.ndarray, bounds: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        place, size = _places(bounds), np.diff(bounds)
        out, full = np.zeros((len(size), 3)), np.flatnonzero(size)
        frame = place % 3
        for k, word, good in _words(codes, place, longest):
            if k == longest:  # all bases from the frame's base ``longest`` on
                at = np.where(good, word, 4**k) + frame * (4**k + 1)
                for f in range(3):
                    value = np.roll(tables[k - 1], f, axis=0).ravel().take(at)  # a base's frame, seen from the f-th base on
                    value[place < f + k - 1] = 0.0
                    out[full, f] += np.add.reduceat(value, bounds[:-1][full])
                continue
            for f in range(3):  # the frame's k-th base has a k-mer of its first bases
                some = np.flatnonzero(size > f + k - 1)
                at = bounds[some] + f + k - 1
                some, at = some[good[at]], at[good[at]]
                out[some, f] += tables[k - 1][(k - 1) % 3, word[at]]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f"score_{k}" for k in range(1, 7)]
        for batch in batches:
            columns = np.zeros((batch.num_rows, 6))
            for first, texts, codes, bounds in _joined(batch, _UPPER_CODE):
                own = columns[first : first + len(texts)]
                own[:, :3] = strand(codes, bounds, shared.value)
                # all rows reversed at once: the rows come in the opposite order, too
                back = np.where(codes < 4, 3 - codes, 4).astype(np.uint8)[::-1]
                own[:, 3:] = strand(back, (bounds[-1] - bounds)[::-1], shared.value)[::-1]
            yield pa.RecordBatch.from_arrays([batch.column(id_), *[pa.array(np.ascontiguousarray(columns[:, k])) for k in range(6)]], names=[id_, *names])

    return sequences.select(id_, "seq").mapInArrow(run, f"`{id_}` {kind}, " + ", ".join(f"score_{k} double" for k in range(1, 7)))


def profiles(sequences: DataFrame, model: DataFrame, order: int, id_: str, cap: int | None = None) -> DataFrame:
    """``id_``, ``lik`` and ``running`` (arrays): log-likelihoods of the k-mers that end at each base, and their running sum.

    With ``cap``, only the first so many uses of one k-mer and frame in a sequence count.
    """
    longest = order + 1
    shared = sequences.sparkSession.sparkContext.broadcast(_tables(model, longest))
    kind = sequences.schema[id_].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts, codes, bounds in _joined(batch, _UPPER_CODE):
                place, size = _places(bounds), np.diff(bounds)
                lik = np.zeros(len(codes))
                used = np.full(len(codes), -1, np.int64)
                for k, word, good in _words(codes, place, longest):
                    some = np.flatnonzero(good) if k == longest else bounds[:-1][size > k - 1] + k - 1
                    some = some[good[some]]
                    lik[some] = shared.value[k - 1][place[some] % 3, word[some]]
                    used[some] = (word[some].astype(np.int64) + 4**k) * 3 + place[some] % 3
                if cap is not None and len(codes):
                    row = np.repeat(np.arange(len(size)), size)
                    order_ = np.lexsort((place, used, row))
                    new = np.flatnonzero((np.diff(used[order_], prepend=-2) != 0) | (np.diff(row[order_], prepend=-1) != 0))
                    use = np.arange(len(order_)) - np.repeat(new, np.diff(np.append(new, len(order_))))
                    lik[order_[use >= cap]] = 0.0
                total = np.cumsum(lik)
                running = total - np.repeat(np.concatenate(([0.0], total))[bounds[:-1]], size)
                lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x)) for x in (lik, running)]
                yield pa.RecordBatch.from_arrays([batch.column(id_).slice(first, len(texts)), *lists], names=[id_, "lik", "running"])

    return sequences.select(id_, "seq").mapInArrow(run, f"`{id_}` {kind}, lik array<double>, running array<double>")


#: place of A, C, G, T and others in the order TCAG of the genetic codes
_TCAG = np.array([2, 1, 3, 0, 4], np.int64)


def reading_frames(transcripts: DataFrame, least: int, acids: str) -> DataFrame:
    """``seq_id``, ``strand``, ``frame``, ``aa_start``, ``protein``, ``kind``: see :func:`phylospark.operators.coding.orfs`.

    ``acids`` are the amino acids of the 64 codons (order TCAG).  A strand is translated once by position; stops
    are looked up by frame, so that the work is in proportion to the length.
    """
    kind = transcripts.schema["seq_id"].dataType.simpleString()
    letters = np.frombuffer(acids.encode(), np.uint8)
    stop, start = ord("*"), ord("M")

    def found(codes: np.ndarray, sign: str, seq_id) -> Iterator[tuple]:
        c = _TCAG[codes]
        n = max(0, len(c) - 2)
        acid = np.full(n, ord("X"), np.uint8)
        plain = (c[:n] < 4) & (c[1 : n + 1] < 4) & (c[2 : n + 2] < 4)
        acid[plain] = letters[(c[:n] * 16 + c[1 : n + 1] * 4 + c[2 : n + 2])[plain]]
        for frame in range(3):
            own = acid[frame::3]
            ends = np.append(np.flatnonzero(own == stop), len(own))
            begins = np.concatenate(([0], ends[:-1] + 1))
            starts = np.append(np.flatnonzero(own == start), len(own))
            cut = starts[np.searchsorted(starts, begins)]
            cut[0] = 0  # the first stretch is open on the left
            for k in np.flatnonzero(ends - cut >= max(1, least)).tolist():
                protein = own[cut[k] : ends[k]].tobytes().decode()
                whole, closed = protein[0] == "M", k < len(ends) - 1
                yield seq_id, sign, frame, int(cut[k]), protein, ("complete" if closed else "3prime_partial") if whole else "5prime_partial" if closed else "internal"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["seq_id", "strand", "frame", "aa_start", "protein", "kind"]
        for batch in batches:
            types = (batch.schema.field("seq_id").type, pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string())
            for seq_id, seq in zip(batch.column("seq_id").to_pylist(), batch.column("seq").to_pylist()):
                codes = _codes(seq or "")
                back = np.where(codes < 4, 3 - codes, 4).astype(np.uint8)[::-1]
                rows = [*found(codes, "+", seq_id), *found(back, "-", seq_id)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return transcripts.select("seq_id", "seq").mapInArrow(run, f"seq_id {kind}, strand string, frame int, aa_start int, protein string, kind string")


def _code_runs(texts: pa.Array, table: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """As :func:`_joined` for many short texts: number of a run's first row, codes and bounds, read from Arrow's own buffers."""
    texts = texts.cast(pa.string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    flat = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, int(ends[first]) + _PIECE, "right")) - 1)
        last = min(last, len(texts))
        some = flat[ends[first] : ends[last]]
        if (some < 128).all():
            yield first, table[some], (ends[first : last + 1] - ends[first]).astype(np.int64)
        else:
            own = texts.slice(first, last - first).to_pylist()
            yield first, _codes("".join(own), table), np.cumsum([0, *map(len, own)])
        first = last


def _owners(batch: pa.RecordBatch, keys: list[str]) -> tuple[np.ndarray, list[tuple]]:
    """For each row the place of its values of some columns in the list of different ones."""
    place, names = np.zeros(batch.num_rows, np.int64), [()]
    for k in keys:
        coded = batch.column(k).dictionary_encode(null_encoding="encode")
        values = coded.dictionary.to_pylist()
        kinds, place = np.unique(place * len(values) + coded.indices.to_numpy(), return_inverse=True)
        names = [(*names[x // len(values)], values[x % len(values)]) for x in kinds.tolist()]
    return place, names


def window_counts(windows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``pos`` (from 0), ``A``, ``C``, ``G``, ``T``: how often each base (upper case) stands at a place of the
    ``window`` texts, for each place that has any.

    A task adds up its windows and holds a bounded number of places.
    """
    kinds = windows.schema
    schema = ", ".join([f"`{k}` {kinds[k].dataType.simpleString()}" for k in keys] + ["pos int"] + [f"{b} long" for b in _BASES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        size, types = 0, []

        def flush() -> Iterator[pa.RecordBatch]:
            while held:
                key, counts = held.popitem()
                at = np.flatnonzero(counts.any(axis=1))
                own = [pa.array([k] * len(at), t) for k, t in zip(key, types)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(at, pa.int32()), *[pa.array(counts[at, b]) for b in range(4)]], names=[*keys, "pos", *_BASES])

        for batch in batches:
            types = [batch.schema.field(k).type for k in keys]
            owners, names = _owners(batch, keys)
            for first, codes, bounds in _code_runs(batch.column(batch.schema.get_field_index("window")), _UPPER_CODE):
                lengths = np.diff(bounds)
                here, row = np.unique(owners[first : first + len(lengths)], return_inverse=True)
                width = int(lengths.max())
                # owner, place and base as one number
                cell = ((np.arange(len(codes)) + np.repeat(row * width - bounds[:-1], lengths)) * 4 + codes)[codes < 4]
                if len(here) * width * 4 <= _HELD:
                    n = np.bincount(cell, minlength=len(here) * width * 4)
                    cell = np.flatnonzero(n)
                    n = n[cell]
                else:  # a few long windows among many short ones
                    cell, n = np.unique(cell, return_counts=True)
                cuts = np.searchsorted(cell, np.arange(len(here) + 1) * width * 4)
                for k, owner in enumerate(here.tolist()):
                    some = cell[cuts[k] : cuts[k + 1]] - k * width * 4
                    if not len(some):
                        continue
                    places, counts = int(some[-1]) // 4 + 1, held.get(names[owner])
                    if counts is None or len(counts) < places:
                        grown = np.zeros((places, 4), np.int64)
                        if counts is not None:
                            grown[: len(counts)] = counts
                        size += places - (0 if counts is None else len(counts))
                        held[names[owner]] = counts = grown
                    counts.reshape(-1)[some] += n[cuts[k] : cuts[k + 1]]
                if size > _HELD // 4:
                    yield from flush()
                    size = 0
        yield from flush()

    parts = windows.select(*keys, "window").mapInArrow(run, schema)
    return parts.groupBy(*keys, "pos").agg(*[F.sum(b).alias(b) for b in _BASES])


def span_scores(windows: DataFrame, odds: np.ndarray, spans: list[tuple[int, int]], skip: tuple[int, int]) -> DataFrame:
    """The columns of ``windows`` but ``window``, and for each span of places (both ends count) ``score``, the mean of the
    ``odds`` (by ``round`` from 1, place and base, others last) without those from skip to skip, and ``n``, how many places that is.
    """
    keys = [f for f in windows.schema if f.name != "window"]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in keys], "score array<double>", "n array<int>"])
    width = odds.shape[1]
    plain = np.ones(width, bool)
    plain[skip[0] : skip[1] + 1] = False
    lows, highs = (np.array([min(x + i, width) for x in ends]) for i, ends in enumerate(zip(*spans)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rounds = np.asarray(batch.column(batch.schema.get_field_index("round"))) - 1
            for first, codes, bounds in _code_runs(batch.column(batch.schema.get_field_index("window")), _UPPER_CODE):
                lengths = np.diff(bounds)
                rows = len(lengths)
                row, at = np.repeat(np.arange(rows), lengths), np.arange(len(codes)) - np.repeat(bounds[:-1], lengths)
                some = at < width
                row, at, codes = row[some], at[some], codes[some]
                sums, n = np.zeros((rows, width + 1)), np.zeros((rows, width + 1), np.int32)
                sums[row, at + 1], n[row, at + 1] = odds[rounds[first : first + rows][row], at, codes] * plain[at], plain[at]
                sums, n = np.cumsum(sums, axis=1), np.cumsum(n, axis=1)
                n = (n[:, highs] - n[:, lows]).reshape(-1)
                score = (sums[:, highs] - sums[:, lows]).reshape(-1) / np.maximum(n, 1)
                cuts = pa.array(np.arange(rows + 1) * len(spans), pa.int32())
                own = [batch.column(batch.schema.get_field_index(f.name)).slice(first, rows) for f in keys]
                yield pa.RecordBatch.from_arrays([*own, pa.ListArray.from_arrays(cuts, pa.array(score, mask=n == 0)), pa.ListArray.from_arrays(cuts, pa.array(n, pa.int32()))], names=[*[f.name for f in keys], "score", "n"])

    return windows.mapInArrow(run, schema)


#: windows of one batch that a task emits
_WINDOWS = 1 << 15


def word_windows(sequences: DataFrame, word: str, up: int, down: int, short: bool = False) -> DataFrame:
    """``seq_id``, ``pos`` (from 1) and ``window`` of each place of a word that has ``up`` characters before and ``down`` after it.

    With ``short``, places nearer to the end come as well, with what follows them.
    """
    kind = sequences.schema["seq_id"].dataType.simpleString()
    return sequences.select("seq_id", "seq").mapInArrow(lambda batches: _word_windows(batches, word, up, down, short), f"seq_id {kind}, pos int, window string")


def _word_windows(batches: Iterator[pa.RecordBatch], word: str, up: int, down: int, short: bool = False) -> Iterator[pa.RecordBatch]:
    """Windows in batches of at most ``_WINDOWS``, however many rows come at once; one text is read at a time."""
    for batch in batches:
        rows, places, windows = [], [], []

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column("seq_id").take(pa.array(rows, pa.int64())), pa.array(places, pa.int32()), pa.array(windows, pa.string())], names=["seq_id", "pos", "window"])

        for row, text in enumerate(batch.column("seq")):
            seq = text.as_py() or ""
            at = seq.find(word, up)
            while at >= 0 and (short or at + len(word) + down <= len(seq)):
                rows.append(row)
                places.append(at + 1)
                windows.append(seq[at - up : at + len(word) + down])
                if len(rows) >= _WINDOWS:
                    yield done()
                    rows, places, windows = [], [], []
                at = seq.find(word, at + 1)
        if rows:
            yield done()


def _distinct_windows(seq: str | None, k: int) -> int:
    """How many distinct windows of ``k`` characters there are, exactly: windows are numbered one character at a time."""
    codes = _characters(seq or "")
    n = len(codes) - k + 1
    if n < 1:
        return 0
    if codes.dtype == np.uint8:
        seen = np.bincount(codes, minlength=256) > 0
        codes, kinds = (np.cumsum(seen) - 1)[codes], int(seen.sum())
    else:
        codes, names = pd.factorize(codes)
        kinds = len(names)
    x, most = codes[:n], kinds
    for j in range(1, k):
        if most * kinds >= 1 << 62:
            x, seen = pd.factorize(x)
            most = len(seen)
        x, most = x * kinds + codes[j : j + n], most * kinds
    return len(pd.unique(x))


def _once(kernel, kind: str, arrow: pa.DataType, text: Column | str) -> Column:
    """``kernel`` of each text; called nondeterministic so that a filter on its result does not run it again."""
    return F.arrow_udf(lambda texts: pa.array([kernel(t.as_py()) for t in texts], arrow), kind).asNondeterministic()(text)


def distinct_windows(seq: Column | str, k: int) -> Column:
    """The number of distinct windows of ``k`` characters of a text; 0 for NULL."""
    return _once(lambda t: _distinct_windows(t, k), "int", pa.int32(), seq)


def _kept_bases(qual: str | None, leading: int, trailing: int, window: int, mean: int, head: int, least: int) -> dict | None:
    """Where the bases of :func:`phylospark.functions.trim_quality` begin (from 1), and how many they are."""
    q = _characters(qual or "").astype(np.int64) - 33
    good, tail = np.flatnonzero(q >= leading), np.flatnonzero(q >= trailing)
    if not len(good) or not len(tail):
        return None
    first = int(good[0])
    q = q[first : int(tail[-1]) + 1]
    sums = np.concatenate(([0], np.cumsum(q)))
    low = np.flatnonzero(sums[window:] - sums[:-window] < mean * window) if len(q) >= window else q[:0]
    n = (int(low[0]) if len(low) else len(q)) - head
    return {"at": first + 1 + head, "n": n} if n >= least else None


def kept_bases(qual: Column | str, *, leading: int = 3, trailing: int = 3, window: int = 4, mean: int = 15, head: int = 8, least: int = 36) -> Column:
    """Struct ``at`` (from 1), ``n`` of what is kept of a read (Phred+33), by the steps of ``functions.trim_quality``; NULL: nothing."""
    kind = pa.struct([("at", pa.int32()), ("n", pa.int32())])
    return _once(lambda t: _kept_bases(t, leading, trailing, window, mean, head, least), "at int, n int", kind, qual)


def _acids(seq: str | None, table: np.ndarray) -> str | None:
    if seq is None:
        return None
    x = _characters(seq)
    known = np.minimum(x, 255).astype(np.uint8)[: len(x) // 3 * 3].reshape(-1, 3)
    code = _AT_TCAG[known].astype(np.int64)
    return table[np.where((code < 4).all(axis=1), code @ np.array([16, 4, 1]), 64)].tobytes().decode("ascii")


#: place of a capital among TCAG, 4 for any other character
_AT_TCAG = np.full(256, 4, np.uint8)
_AT_TCAG[[ord(b) for b in "TCAG"]] = range(4)


def translated(seq: Column | str, code: int = 1) -> Column:
    """Amino acids of frame 1, as ``functions.translate_codons`` gives them, for long sequences: a sequence at a time."""
    table = np.frombuffer((GENETIC_CODES[code] + "X").encode(), np.uint8)
    return _once(lambda t: _acids(t, table), "string", pa.string(), F.upper(seq))
