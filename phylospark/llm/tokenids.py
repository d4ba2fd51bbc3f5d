"""Token ids in grammar-compressed shards (Re-Pair) with random access.

A shard is a run of whole documents in key order.  Frequent pairs of neighbouring symbols are
replaced by nonterminals, round by round, until no pair is frequent; the shard stores the rules,
the length of each nonterminal's expansion, and the remaining symbols.  No pair crosses the end of
a document, so a document (or any range of ids) is decoded from its own symbols.

File format: Parquet rows, one for each shard, in ascending order of (part, block):
``part`` and ``block`` place the shard, ``start`` counts the ids before it in its part, ``n_ids``
its ids; ``keys`` and ``ends`` (symbols up to each document's end) are the directory; ``rules``
(pairs of little-endian uint32; rule r defines symbol ``terminals`` + r), ``lengths`` (uint32 per
rule) and ``symbols`` (uint32) are binary.
"""

from __future__ import annotations

import itertools
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RollingHash, byte_values, materialise, small_batches

_BATCH_BYTES = 2 << 20
_CACHE_WORDS = 600_000
#: Texts of these characters only are cut here as the tokenizer's own pre-tokenizer cuts them.
_PLAIN = re.compile(r"[\x00-\x7FÀ-ÖØ-öø-ÿ]*")
#: what that cutting presumes of the tokenizer file
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_HASH, _BYTES = RollingHash(0x9FB21C651E98DF25), byte_values(17)
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_CLASS, _LOWER = np.full(256, _OTHER, np.uint8), np.arange(256, dtype=np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
for _a, _b in ((0x41, 0x5A), (0xC0, 0xD6), (0xD8, 0xDE)):
    _LOWER[_a : _b + 1] += 32
    _CLASS[_a : _b + 1] = _CLASS[_a + 32 : _b + 33] = _LETTER
_CLASS[[0xDF, 0xFF]] = _LETTER


def _cut(low: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the pieces of lower-cased Latin-1 texts that end at ``ends``, end to end:
    a contraction (an apostrophe behind no other sign, and s, t, m, d, re, ve or ll), letters, one
    digit, or other signs but white space."""
    kind = _CLASS[low]
    before = np.empty_like(kind)
    before[1:] = kind[:-1]
    first = np.concatenate(([0], ends[:-1]))
    before[first[first < len(low)]] = _SPACE
    start = (kind != _SPACE) & ((kind != before) | (kind == _DIGIT))
    at = np.flatnonzero((low == ord("'")) & (before != _OTHER))
    stop = ends[np.searchsorted(ends, at, "right")]  # of the text
    one, two = (np.where(at + k < stop, low[np.minimum(at + k, len(low) - 1)], 0) for k in (1, 2))
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    for some, size in ((at[short], 2), (at[long], 3)):
        start[some + 1] = False
        rest = some + size
        rest = rest[rest < len(low)]
        start[rest] = kind[rest] != _SPACE
    edge = np.append(start | (kind == _SPACE), True)
    edge[ends] = True
    begin, edges = np.flatnonzero(start), np.flatnonzero(edge)
    return begin, edges[np.searchsorted(edges, begin, "right")] - begin


class Encoder:
    """Whole texts to little-endian uint32 ids by a tokenizers file, pieces remembered.

    White space is a border for this kind of tokenizer, and pieces are encoded one by one; so each
    distinct piece is given to the library once.  A text with characters beyond Latin-1's letters,
    or with a special token's string, goes to the library whole.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        #: the same model for pieces that are normalised and cut already
        self.of_pieces = Tokenizer.from_file(path)
        self.of_pieces.normalizer = None
        self.of_pieces.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        spec = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in spec["added_tokens"]]
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        kinds = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.by_piece = (steps[0].get("pattern") or {}).get("Regex") == _PATTERN and kinds == ["NFC", "Replace", "Lowercase"]
        self.terminals = self.tokenizer.get_vocab_size()
        self.known: dict[str, bytes] = {}
        suffix = spec["model"].get("end_of_word_suffix") or ""
        vocab = self.tokenizer.get_vocab()
        self.ending = np.zeros(max(vocab.values()) + 1, bool)
        self.ending[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        """Remember the ids of new pieces; the library gets many of them as one text, and each
        piece's last id is one that ends a word."""
        for k in range(0, len(pieces), 1024):
            part = pieces[k : k + 1024]
            ids = np.array(self.of_pieces.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ending[ids]) + 1
            if len(stops) == len(part) and (not len(stops) or stops[-1] == len(ids)):
                raw = ids.tobytes()
                at = (stops * 4).tolist()
                self.known.update(zip(part, [raw[a:b] for a, b in zip([0, *at], at)]))
            else:
                self.known.update(zip(part, self._ids(part)))

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [bool(self.by_piece and _PLAIN.fullmatch(t)) and not any(x in t for x in self.special) for t in texts]
        out = iter(self._by_piece([t for t, is_plain in zip(texts, plain) if is_plain]))
        return [next(out) if is_plain else self._ids([t])[0] for t, is_plain in zip(texts, plain)]

    def _by_piece(self, texts: list[str]) -> list[bytes]:
        low = _LOWER[np.frombuffer("".join(texts).encode("latin-1"), np.uint8)]
        ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
        if not len(low):
            return [b""] * len(texts)
        start, size = _cut(low, ends)
        one, of = self._distinct(low, start, size)
        said = low.tobytes().decode("latin-1")
        pieces = [said[a:b] for a, b in zip(start[one].tolist(), (start[one] + size[one]).tolist())]
        new = [x for x in pieces if x not in self.known]
        if len(self.known) + len(new) > _CACHE_WORDS:
            self.known, new = {}, pieces
        self._learn(new)
        found = list(map(self.known.__getitem__, pieces))
        ids = np.frombuffer(b"".join(found), "<u4")
        counts = np.array([len(x) >> 2 for x in found], np.int64)
        first, n = np.cumsum(counts) - counts, counts[of]
        stops = np.cumsum(n)
        raw = ids[np.repeat(first[of] - (stops - n), n) + np.arange(len(n) and int(stops[-1]))].tobytes()
        at = np.concatenate(([0], stops))[np.searchsorted(start, np.concatenate(([0], ends)))] * 4
        return [raw[a:b] for a, b in itertools.pairwise(at.tolist())]

    @staticmethod
    def _distinct(low: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One of each distinct piece, and for all pieces the number of theirs: by hash, then by characters."""
        _, one, of = np.unique(_HASH.slices(_HASH.prefix(_BYTES[low]), start, start + size), return_index=True, return_inverse=True)
        like = one[of]
        if (size == size[like]).all():
            here = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            if (low[here] == low[here + np.repeat(start[like] - start, size)]).all():
                return one, of
        # two pieces share a hash
        return np.unique(np.array([low[a : a + n].tobytes().hex() for a, n in zip(start, size)]), return_index=True, return_inverse=True)[1:]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker process's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def compress(ids: np.ndarray, ends: np.ndarray, terminals: int, least: int = 12, most: int = 4096) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair: ``symbols``, document ``ends`` in symbols, ``rules`` and expansion ``lengths``.

    Each round gives the most frequent pairs (``least`` times or more, ``most`` of them at once) a
    nonterminal each and replaces their occurrences; of two that overlap the more frequent pair
    wins, of equal ones the left.  A pair that keeps less than half of ``least`` so waits for the
    next round and its new count.  Rounds go on until no pair occurs ``least`` times.  A pair is
    counted again only while it may be frequent: a new one holds a new nonterminal, and one under
    ``least`` stays there.
    """
    sym = ids.astype(np.uint32)
    last = np.zeros(len(sym), bool)
    last[ends - 1] = True  # every document has an id at least
    live = ~last  # where a pair begins that may be frequent
    rules: list[np.ndarray] = []
    n = terminals
    while True:
        at = np.flatnonzero(live)
        keys = sym[at].astype(np.uint64) << np.uint64(32) | sym[at + 1]
        which, pairs, counts = _frequent(keys, least)
        live[at[which < 0]] = False
        if not len(pairs):
            break
        at, which = at[which >= 0], which[which >= 0]
        order = np.argsort(-counts, kind="stable")[:most]
        rank = np.full(len(pairs), -1, np.int64)
        rank[order] = np.arange(len(order))
        rank = rank[which]
        at, rank = at[rank >= 0], rank[rank >= 0]
        taken, free = np.zeros(len(at), bool), np.arange(len(at))
        while len(free):  # what lost to a pair that lost itself has its turn after that
            won = _apart(at[free], rank[free])
            taken[free[won]] = True
            met = won.copy()
            touch = np.diff(at[free]) == 1
            met[1:] |= won[:-1] & touch
            met[:-1] |= won[1:] & touch
            free = free[~met]
        at, rank = at[taken], rank[taken]
        got = np.bincount(rank, minlength=len(order))
        used = np.flatnonzero(got >= max(1, least // 2))  # the most frequent pair is always one of them
        number = np.full(len(order), -1, np.int64)
        number[used] = n + np.arange(len(used))
        number = number[rank]
        at, number = at[number >= 0], number[number >= 0]
        fresh = pairs[order[used]]
        rules.append(np.stack([fresh >> np.uint64(32), fresh & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        sym[at] = number.astype(np.uint32)
        n += len(used)
        last[at] = last[at + 1]
        live[at] = ~last[at]
        before = at[at > 0] - 1
        before -= np.isin(before, at + 1, assume_unique=True)  # that place goes; its pair begins one place earlier
        live[before] = ~last[before]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        sym, last, live = sym[keep], last[keep], live[keep]
    rule = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return sym, np.flatnonzero(last) + 1, rule, expansion_lengths(rule, terminals)


_SPOTS = 1 << 20


def _frequent(keys: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of each key among those that occur ``least`` times or more (else -1), these, their counts.

    A hash table counts first; keys that share a place there are told apart by sorting.
    """
    which = np.full(len(keys), -1, np.int64)
    often = np.arange(len(keys))
    if len(keys) > _SPOTS >> 4:
        with np.errstate(over="ignore"):
            spot = (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)
        full = np.bincount(spot, minlength=_SPOTS)
        often = np.flatnonzero(full[spot] >= least)
        spot, own = spot[often], keys[often]
        one = np.zeros(_SPOTS, np.uint64)
        one[spot] = own
        shared = np.zeros(_SPOTS, bool)
        shared[spot[one[spot] != own]] = True
        alone = ~shared[spot]
        places = np.flatnonzero((full >= least) & ~shared)
        number = np.zeros(_SPOTS, np.int64)
        number[places] = np.arange(len(places))
        which[often[alone]] = number[spot[alone]]
        pairs, counts = one[places], full[places]
        often = often[~alone]
    else:
        pairs, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(often):
        more, of, size = np.unique(keys[often], return_inverse=True, return_counts=True)
        real = size >= least
        number = np.where(real, len(pairs) + np.cumsum(real) - 1, -1)
        which[often] = number[of]
        pairs, counts = np.concatenate([pairs, more[real]]), np.concatenate([counts, size[real]])
    return which, pairs, counts


def _apart(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which of the pairs at ascending positions to replace: none that overlaps a more frequent
    neighbour, and of a row of overlapping equals every other one."""
    touch = np.diff(at) == 1
    before = np.full(len(at), np.iinfo(np.int64).max)
    after = before.copy()
    before[1:][touch], after[:-1][touch] = rank[:-1][touch], rank[1:][touch]
    k = np.flatnonzero((rank <= before) & (rank <= after))
    start = np.flatnonzero(np.diff(at[k], prepend=-2) != 1)
    place = np.arange(len(k)) - np.repeat(start, np.diff(np.append(start, len(k))))
    taken = np.zeros(len(at), bool)
    taken[k[place % 2 == 0]] = True
    return taken


def expansion_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    """Number of ids under each nonterminal; rules only use earlier symbols."""
    out = np.ones(len(rules), np.uint32)
    done = 0
    while done < len(rules):  # all rules whose symbols are known, at once
        part = rules[done:].astype(np.int64) - terminals
        ready = int(np.argmax(np.append((part >= done).any(1), True)))
        of = lambda s: np.where(s < 0, 1, out[np.maximum(s, 0)])
        out[done : done + ready] = of(part[:ready, 0]) + of(part[:ready, 1])
        done += ready
    return out


def expand(symbols: np.ndarray, rules: np.ndarray, terminals: int, lengths: np.ndarray | None = None) -> np.ndarray:
    """Ids under the symbols: with the rules' expansion ``lengths``, each rule is expanded once."""
    if lengths is not None and len(rules) and len(symbols) > len(rules):
        flat = expand(np.arange(terminals, terminals + len(rules)), rules, terminals)
        source = np.concatenate([flat, symbols.astype(np.uint32)])
        first = np.concatenate(([0], np.cumsum(lengths.astype(np.int64))))
        big = symbols >= terminals
        start = np.arange(len(flat), len(source))
        start[big] = first[symbols[big].astype(np.int64) - terminals]
        sizes = _sizes(symbols, lengths, terminals)
        stops = np.cumsum(sizes)
        return source[np.repeat(start - (stops - sizes), sizes) + np.arange(int(stops[-1]))]
    sym = symbols.astype(np.int64)
    while len(sym) and int(sym.max()) >= terminals:
        big = sym >= terminals
        at = np.arange(len(sym)) + np.cumsum(big) - big
        out = np.empty(len(sym) + int(big.sum()), np.int64)
        out[at[~big]] = sym[~big]
        pair = rules[sym[big] - terminals]
        out[at[big]], out[at[big] + 1] = pair[:, 0], pair[:, 1]
        sym = out
    return sym.astype(np.uint32)


def _sizes(symbols: np.ndarray, lengths: np.ndarray, terminals: int) -> np.ndarray:
    """Number of ids under each symbol."""
    known = np.concatenate(([1], lengths.astype(np.int64)))
    return known[np.maximum(symbols.astype(np.int64) - (terminals - 1), 0)]


def decode_range(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, terminals: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a shard: only the symbols that cover them are expanded."""
    ends = np.cumsum(_sizes(symbols, lengths, terminals))
    a, b = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
    before = int(ends[a - 1]) if a else 0
    return expand(symbols[a:b], rules, terminals)[start - before : stop - before]


_SHARD = "part int, block int, start long, n_ids long, terminals int, keys array<{key}>, ends array<long>, rules binary, lengths binary, symbols binary"


def encode(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", end_id: int = 1, shard_ids: int = 1 << 20) -> DataFrame:
    """Shards (one row each, the file format above) of all documents in ascending ``key`` order.

    Texts are shuffled once, by ranges of the key.  Each document's ids end with ``end_id``.  Shards
    close at the first document end after ``shard_ids`` ids, so a longer document is a shard alone.
    Null texts are empty; null keys come first; rows of one key stand in the order of their texts' hashes.
    """
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    ranged = slim.repartitionByRange(F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first(), "tie").drop("tie")
    kind = dict(slim.dtypes)["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, start = TaskContext.get().partitionId(), itertools.count(), 0
        tokens = encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        keys: list = []
        held: list[bytes] = []
        size = 0

        def shard() -> pa.RecordBatch:
            nonlocal start
            ids = np.frombuffer(b"".join(held), "<u4")
            ends = np.cumsum([len(x) // 4 for x in held])
            symbols, stops, rules, lengths = compress(ids, ends, tokens.terminals)
            row = {"part": part, "block": next(block), "start": start, "n_ids": len(ids), "terminals": tokens.terminals, "keys": keys, "ends": stops, "rules": rules.astype("<u4").tobytes(), "lengths": lengths.astype("<u4").tobytes(), "symbols": symbols.astype("<u4").tobytes()}
            start += len(ids)
            return pa.RecordBatch.from_pylist([row | {"ends": stops.tolist()}], schema=schema)

        schema = None
        for batch in small_batches(batches, "text", _BATCH_BYTES):
            schema = schema or pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()), ("terminals", pa.int32()), ("keys", pa.list_(batch.schema.field("key").type)), ("ends", pa.list_(pa.int64())), ("rules", pa.binary()), ("lengths", pa.binary()), ("symbols", pa.binary())])
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for k, ids in zip(batch.column("key").to_pylist(), tokens.encode(texts)):
                keys.append(k)
                held.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= shard_ids:
                    yield shard()
                    keys, held, size = [], [], 0
        if held:
            yield shard()

    return ranged.mapInArrow(run, _SHARD.format(key=kind))


def read_documents(shards: DataFrame, visit: Callable[[np.ndarray], dict], fields: str, key: str = "doc_id") -> DataFrame:
    """One row for each document of the files: key, ``start`` (ids before it), ``n_tokens``, and what
    ``visit`` makes of its ids (columns ``fields``)."""
    totals = shards.groupBy("part").agg(F.max(F.col("start") + F.col("n_ids")).alias("n")).orderBy("part").collect()  # one row per part
    before = dict(zip((r.part for r in totals), itertools.accumulate((r.n for r in totals), initial=0)))
    shared = shards.sparkSession.sparkContext.broadcast(before)
    kind = dict(shards.dtypes)["keys"][6:-1]
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda c: batch.column(c)[row]  # noqa: B023, E731
                rules = np.frombuffer(get("rules").as_py(), "<u4").reshape(-1, 2)
                symbols = np.frombuffer(get("symbols").as_py(), "<u4")
                terminals, at = get("terminals").as_py(), shared.value[get("part").as_py()] + get("start").as_py()
                lengths = np.frombuffer(get("lengths").as_py(), "<u4")
                ends = np.concatenate(([0], np.cumsum(_sizes(symbols, lengths, terminals))))[np.array(get("ends").values)]
                ids = expand(symbols, rules, terminals, lengths)
                seen = [visit(ids[a:b]) for a, b in zip([0, *ends[:-1]], ends)]
                counts = np.diff(ends, prepend=0)
                starts = at + ends - counts
                columns = [get("keys").values, pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), *[pa.array([s[n] for s in seen]) for n in names]]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "start", "n_tokens", *names])

    return shards.mapInArrow(run, f"{key} {kind}, start long, n_tokens long, {fields}")


def digest(ids: np.ndarray) -> dict:
    return {"ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}


def write_and_read(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the shards to the shared folder and return each document's digest from the files."""
    files = materialise(encode(docs, tokenizer, **options), "token-shards")
    return read_documents(files, digest, "ids_crc32 long")
