"""SentencePiece encoding and decoding with a merge (BPE) model, as a max-plus scan over chunks.

A sequence of pieces is what the merges make of a text exactly when merging would leave every two
neighbours as they are (each run of merges restricted to two neighbours is a run of its own).  So the
encoding is a path from border to border of pieces: a step weighs 0 where merging leaves the new
piece and the one before it apart, and minus infinity otherwise, and of all paths over a text exactly
one weighs more than minus infinity.  Texts are searched for it position by position: at each there
is at most one last piece.

A giant document is cut into chunks.  The state at a chunk's border is the piece that reaches the
border or hangs over it, and by how much.  Each chunk gives a max-plus transfer matrix between the
states of its borders (weights 0 and minus infinity, so the entries above minus infinity are listed).
Matrices are combined associatively, ``FAN`` at a time, level by level, until each document has a few;
then the states of the best path go down the levels again, and every chunk finds its own part of the
path from its two states, independently of the others.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RollingHash, materialise, mix64, small_batches

_BATCH_BYTES = 1 << 20
_MEMO = 1 << 20
_PLACES = 3
_SHORT = 40  # words up to this length are searched many at a time
_HASH = RollingHash(0xD6E8FEB86659FD93)
_BASE, _HEAD_SHIFT = np.uint64(0x8CB92BA72F3D8DD7), np.uint64(43)
#: Matrices of one document that are combined at a time.
FAN = 256
#: Weight of a step: no path takes what is not listed.
_START, _NOWHERE = -1, -2
SPACE = "▁"


def _symbols_of(codes: np.ndarray) -> np.ndarray:
    """A 64-bit value for each character's code."""
    return mix64(codes.astype(np.uint64) + np.uint64(1))


def _symbols(text: str) -> np.ndarray:
    return _symbols_of(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"))


def _distinct(codes: np.ndarray, symbols: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One of each distinct word, and for all words the number of theirs: by hash, then by characters.

    The words stand end to end in ``codes``.
    """
    hashes = _HASH.slices(_HASH.prefix(symbols), start, start + size)
    _, one, of = np.unique(hashes, return_index=True, return_inverse=True)
    like = one[of]
    if (size == size[like]).all() and (codes == codes[np.arange(len(codes)) + np.repeat(start[like] - start, size)]).all():
        return one, of
    # two words share a hash
    _, one, of = np.unique(np.array([codes[a : a + n].tobytes().hex() for a, n in zip(start, size)]), return_index=True, return_inverse=True)
    return one, of


class _Table:
    """Numbers of 64-bit keys: a few places for each slot, so that a look-up is as many comparisons."""

    def __init__(self, keys: np.ndarray):
        for shift in range(48, 38, -1):
            slot = (keys >> np.uint64(shift)).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            place = np.arange(len(order)) - np.searchsorted(slot[order], slot[order])
            if not len(order) or place.max() < _PLACES:
                break
        else:
            raise ValueError("too many keys share a slot")
        self.shift = np.uint64(shift)
        self.at = np.full((_PLACES, 1 << (64 - shift)), len(keys), np.int32)  # the last key is none's
        self.at[place, slot[order]] = order
        self.keys = np.append(keys, np.uint64(0))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers, or the number of keys for one that is not there."""
        slot = (keys >> self.shift).astype(np.int64)
        row = self.at[0][slot]
        left = np.flatnonzero(self.keys[row] != keys)
        for place in range(1, _PLACES):
            row[left] = self.at[place][slot[left]]
            left = left[self.keys[row[left]] != keys[left]]
        row[left] = len(self.keys) - 1
        return row


def _pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64))


class Pieces:
    """Pieces and merges of a model file, with the search for the path and the way back.

    Built on the driver and sent to the tasks: its size is that of the vocabulary.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = self.unpieced = model.vocab_size()  # stands for a character without piece
        self.unknown = model.unk_id()
        self.bytes = [-1] * 256
        self.said: list[bytes] = []
        self.table: dict[str, int] = {}
        scores = np.full(n, np.nan)
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.said.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.said.append(b"")
            else:
                self.table[piece] = i
                scores[i] = model.get_score(i)
                self.said.append(piece.replace(SPACE, " ").encode())
        self.reach = max(map(len, self.table))
        #: no piece goes on over a border before a space, so texts fall apart there
        self.apart = not any(SPACE in p.lstrip(SPACE) for p in self.table)
        self.prefix = " " if model.decode(model.encode("a", out_type=int)) == "a" and model.encode("a", out_type=str)[0].startswith(SPACE) else ""
        own = [ord(p) for p in self.table if len(p) == 1]
        self.single = np.zeros(max(own) + 2, bool)  # characters with a piece; the last place is for all beyond
        self.single[own] = True
        self.byte_ids = np.array(self.bytes, "<u4" if self.bytes[0] >= 0 else np.int64)
        self._merges(scores)
        names = list(self.table)
        self._index(names)
        self.name_ids = np.append(np.array([self.table[p] for p in names], np.int32), np.int32(_NOWHERE))
        self._forget()

    def _index(self, names: list[str]) -> None:
        """Tables of the pieces' hashes and of those of their beginnings (bit 0: a longer piece begins so; 1: a piece)."""
        sizes = np.array([len(p) for p in names])
        symbols, starts = _symbols("".join(names)), np.cumsum(sizes) - sizes
        self.begins, hashes = np.zeros(1 << (64 - int(_HEAD_SHIFT)), np.uint8), np.zeros(len(names), np.uint64)
        for i in range(int(sizes.max())):
            k = np.flatnonzero(sizes > i)
            with np.errstate(over="ignore"):
                hashes[k] = hashes[k] * _BASE + symbols[starts[k] + i]
            slot = (hashes[k] >> _HEAD_SHIFT).astype(np.int64)
            self.begins[slot[sizes[k] > i + 1]] |= 1
            self.begins[slot[sizes[k] == i + 1]] |= 2
        self.names = _Table(hashes)

    def heads(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether strings of these hashes may begin a longer piece, and may be a piece."""
        of = self.begins[(hashes >> _HEAD_SHIFT).astype(np.int64)]
        return (of & 1).astype(bool), of > 1

    def _merges(self, scores: np.ndarray) -> None:
        """Ranks (high scores merge first), the last merge of every piece, and all merges by pair."""
        table, n = self.table, self.unpieced
        order = {s: r for r, s in enumerate(sorted({-scores[i] for p, i in table.items() if len(p) > 1}))}
        rank = np.full(n + 1, -1, np.int64)
        for p, i in table.items():
            if len(p) > 1:
                rank[i] = order[-scores[i]]
        left, right = np.full(n + 1, n, np.int32), np.full(n + 1, n, np.int32)
        pairs: list[tuple[int, int, int]] = []
        for p, i in table.items():
            pairs += [(table[p[:k]], table[p[k:]], i) for k in range(1, len(p)) if p[:k] in table and p[k:] in table]
            parts = list(p)
            while len(parts) > 2:
                joins = [(rank[table[x + y]], k) for k, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in table]
                if not joins:
                    break
                k = min(joins)[1]
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            if len(parts) == 2 and all(x in table for x in parts):
                left[i], right[i] = table[parts[0]], table[parts[1]]
                if max(rank[left[i]], rank[right[i]]) > rank[i]:
                    raise ValueError("a piece is merged from one that is merged later")
            elif len(p) > 1 or p not in table:
                raise ValueError("a piece is not what its characters are merged to")
        self.rank, self.left, self.right = rank, left, right
        a, b, of = (np.array(x, np.int64) for x in zip(*pairs))
        self.pairs, self.pair_rank = _Table(_pair_keys(a, b)), np.append(rank[of], np.iinfo(np.int64).max)

    def _forget(self) -> None:
        self.known_pairs: dict[int, bool] = {}
        self.memo_keys, self.memo = np.full(_MEMO, np.iinfo(np.uint64).max, np.uint64), np.zeros(_MEMO, bool)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("known_pairs", "memo_keys", "memo")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    def stay_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves piece b behind piece a as it is; ids, after ``_START`` all do."""
        a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
        keys = (a + 1).astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        with np.errstate(over="ignore"):
            slot = (keys * _BASE >> np.uint64(44)).astype(np.int64)  # of _MEMO slots
        out = self.memo[slot]
        missed = np.flatnonzero(self.memo_keys[slot] != keys)
        if len(missed):
            _, first, of = np.unique(keys[missed], return_index=True, return_inverse=True)
            first = missed[first]
            fresh = self._stay_apart(a[first], b[first])
            self.memo_keys[slot[first]], self.memo[slot[first]] = keys[first], fresh
            out[missed] = fresh[of]
        return out

    def _stay_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undo the merges of both pieces, the last one first; at no time may the two symbols at the
        border have had a merge that comes before the one undone (of equals the left one is first)."""
        out = np.ones(len(a), bool)
        k = np.flatnonzero(a != _START)
        a, b, limit = a[k], b[k], np.full(len(k), np.iinfo(np.int64).max)
        while len(k):
            apart = self.pair_rank[self.pairs.find(_pair_keys(a, b))] >= limit
            out[k[~apart]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = apart & ((ra >= 0) | (rb >= 0))
            k, a, b, ra, rb = k[go], a[go], b[go], ra[go], rb[go]
            on_left = ra > rb
            a, b, limit = np.where(on_left, self.right[a], a), np.where(on_left, b, self.left[b]), np.where(on_left, ra, rb + 1)
        return out

    def plain(self, text: str) -> str:
        """Text as the pieces see it: a space before it, white-space signs for spaces."""
        return (self.prefix + text).replace(" ", SPACE) if text else ""

    def steps(self, s: str) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each size, from 1: where in ``s`` pieces of that size start, and their ids."""
        symbols, at, hashes, out = _symbols(s), np.arange(len(s)), np.zeros(len(s), np.uint64), []
        for size in range(1, min(self.reach, len(s)) + 1):
            if size > 1:
                go = alive & (at + size <= len(s))
                at, hashes = at[go], hashes[go]
            with np.errstate(over="ignore"):
                hashes = hashes * _BASE + symbols[at + size - 1]
            alive, some = self.heads(hashes)
            ids = np.full(len(at), self.unpieced if size == 1 else _NOWHERE, np.int32)
            found = self.name_ids[self.names.find(hashes[some])]
            ids[some] = np.where(found == _NOWHERE, ids[some], found)
            out.append((at[ids != _NOWHERE], ids[ids != _NOWHERE]))
        return out

    def lattice(self, s: str) -> tuple[list[list[int]], list[list[int]]]:
        """For each position of ``s``, ends and ids of the pieces that start there."""
        ends: list[list[int]] = [[] for _ in s]
        ids: list[list[int]] = [[] for _ in s]
        for size, (at, of) in enumerate(self.steps(s), 1):
            for i, x in zip(at.tolist(), of.tolist()):
                ends[i].append(i + size)
                ids[i].append(x)
        return ends, ids

    def search(self, lattice: tuple[list[list[int]], list[list[int]]], entry: int, before: int, limit: int, like: list[int] | None = None) -> list[int]:
        """The last piece up to each position (else ``_NOWHERE``) of paths from ``entry``, behind the
        piece ``before``, by pieces that start before ``limit``.

        ``like`` is such a list from another entry: what follows ``reach`` equal places is equal.
        """
        ends, ids = lattice
        last = [_NOWHERE] * (len(ends) + 1)
        last[entry] = before
        same = 0
        for i in range(entry, min(limit, len(ends))):
            if like is not None:
                same = same + 1 if last[i] == like[i] and i > entry else 0
                if same >= self.reach:
                    return last[:i] + like[i:]
            own = last[i]
            if own == _NOWHERE:
                continue
            for j, free in zip(ends[i], self._after(own, ids[i])):
                if free[0]:
                    last[j] = free[1]
        return last

    def _after(self, own: int, ids: list[int]) -> list[tuple[bool, int]]:
        """For each of some pieces whether it may follow piece ``own``."""
        if own == _START:
            return [(True, x) for x in ids]
        pairs = self.known_pairs
        new = [x for x in ids if own << 32 | x not in pairs]
        if new:
            if len(pairs) > _MEMO:
                pairs.clear()
                new = ids
            pairs.update(zip([own << 32 | x for x in new], self._stay_apart(np.full(len(new), own), np.array(new)).tolist()))
        return [(pairs[own << 32 | x], x) for x in ids]

    def size_of(self, piece: int) -> int:
        return 1 if piece == self.unpieced else len(self.said[piece].decode())

    def trace(self, s: str, last: list[int], end: int, entry: int) -> bytes:
        """Ids (little-endian uint32) of the path from ``entry`` to ``end``."""
        got: list[int] = []
        while end > entry:
            piece = last[end]
            size = self.size_of(piece)
            if piece == self.unpieced:
                raw = s[end - size : end].encode()
                got += [self.bytes[x] for x in reversed(raw)] if self.bytes[0] >= 0 else [self.unknown]
            else:
                got.append(piece)
            end -= size
        return np.array(got[::-1], "<u4").tobytes()

    def path(self, s: str) -> bytes:
        """Ids of a stretch between two borders that no piece crosses."""
        return self.trace(s, self.search(self.lattice(s), 0, _START, len(s)), len(s), 0)

    def encode_all(self, texts: list[str | None], prefix: bool = True) -> list[bytes]:
        """Ids of some texts (with the space before them), little-endian uint32.

        The texts fall apart into words where no piece crosses: before spaces, and around characters
        without piece.  Each distinct word is searched once.
        """
        plain = [(self.prefix if prefix else "") + t if t else "" for t in texts]
        codes = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), "<u4").copy()
        codes[codes == 32] = ord(SPACE)
        sizes = np.array([len(t) for t in plain], np.int64)
        ends = np.cumsum(sizes)
        if not len(codes):
            return [b""] * len(texts)
        strange = ~self.single[np.minimum(codes, len(self.single) - 1)]
        border = np.zeros(len(codes) + 1, bool)
        border[1:-1] = strange[1:] != strange[:-1]
        if self.apart:
            space = codes == ord(SPACE)
            border[1:-1] |= space[1:] & ~space[:-1]
        border[ends] = border[0] = True
        start = np.flatnonzero(border)
        start, size = start[:-1], np.diff(start)
        symbols = _symbols_of(codes)
        one, of = _distinct(codes, symbols, start, size)
        ids, counts = self._words(codes, symbols, start[one], size[one], strange[start[one]])
        first = np.cumsum(counts) - counts
        n = counts[of]
        stops = np.cumsum(n)
        raw = ids[np.repeat(first[of] - (stops - n), n) + np.arange(int(stops[-1]))].tobytes()
        at = np.concatenate(([0], stops))[np.searchsorted(start, np.concatenate(([0], ends)))] * 4
        return [raw[x:y] for x, y in itertools.pairwise(at.tolist())]

    def _words(self, codes: np.ndarray, symbols: np.ndarray, start: np.ndarray, size: np.ndarray, strange: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, end to end, and the number of each word's."""
        many = np.flatnonzero(~strange & (size <= _SHORT))
        flat, counts = self._search_many(symbols, start[many], size[many])
        n = np.zeros(len(start), np.int64)
        n[many] = counts
        rest: dict[int, np.ndarray] = {}
        for k in np.flatnonzero(strange | (size > _SHORT)).tolist():
            said = codes[start[k] : start[k] + size[k]].tobytes().decode("utf-32-le", "surrogatepass")
            rest[k] = np.frombuffer(self.unpieced_ids(said) if strange[k] else self.path(said), "<u4")
            n[k] = len(rest[k])
        ends = np.cumsum(n)
        out = np.zeros(int(ends[-1]), "<u4")
        stops = np.cumsum(counts)
        out[np.repeat((ends - n)[many] - (stops - counts), counts) + np.arange(len(flat))] = flat
        for k, ids in rest.items():
            out[ends[k] - n[k] : ends[k]] = ids
        return out, n

    def unpieced_ids(self, s: str) -> bytes:
        """Ids of characters without piece: their bytes, or the unknown piece each."""
        if self.bytes[0] < 0:
            return np.full(len(s), self.unknown, "<u4").tobytes()
        return self.byte_ids[np.frombuffer(s.encode(), np.uint8)].tobytes()

    def _search_many(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``search`` for many short words at a time: their ids, end to end, and their numbers of ids."""
        n = len(starts)
        if not n:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        order = np.argsort(-sizes, kind="stable")  # those that reach a position are the first ones
        starts, sizes = starts[order], sizes[order]
        width = int(sizes[0])
        last, take = np.full((width + 1, n), _NOWHERE, np.int32), np.zeros((width + 1, n), np.int8)
        last[0] = _START
        reach = np.searchsorted(-sizes, -np.arange(width + 2), "right")  # words of at least so many characters
        for i in range(width):
            k, hashes = np.arange(int(reach[i + 1])), np.zeros(1, np.uint64)
            for size in range(1, min(self.reach, width - i) + 1):
                if size > 1:
                    go = np.flatnonzero(alive & (k < reach[i + size]))
                    if not len(go):
                        break
                    k, hashes = k[go], hashes[go]
                with np.errstate(over="ignore"):
                    hashes = hashes * _BASE + symbols[starts[k] + (i + size - 1)]
                alive, some = self.heads(hashes)
                some = np.flatnonzero(some)
                ids = self.name_ids[self.names.find(hashes[some])]
                real = ids != _NOWHERE
                on, ids = k[some[real]], ids[real]
                apart = self.stay_apart(last[i, on], ids)
                on, ids = on[apart], ids[apart]
                last[i + size, on], take[i + size, on] = ids, size
        steps, k, at = [], np.arange(n), sizes
        counts = np.zeros(n, np.int64)
        while len(k):
            steps.append((k, last[at, k]))
            counts[k] += 1
            at = at - take[at, k]
            k, at = k[at > 0], at[at > 0]
        given = np.zeros(n, np.int64)
        given[order] = counts
        ends = np.cumsum(given)[order]
        flat = np.zeros(int(given.sum()), "<u4")
        for back, (k, ids) in enumerate(steps):
            flat[ends[k] - 1 - back] = ids
        return flat, given

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as little-endian uint32."""
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The text of some ids (without the space before it)."""
        said = self.said
        out = b"".join([said[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")
        return out[len(self.prefix) :] if out.startswith(self.prefix) else out

    # Chunks.  ``s`` is a chunk with ``lead`` characters before it and up to ``reach`` - 1 after it;
    # its own ones are ``size``.  A state is (characters hung over the border) << 32 | (piece + 1).

    def meeting(self, s: str, lead: int, size: int) -> tuple[int, int]:
        """First and last place of a chunk where all paths have a border (before a space), or -1, -1."""
        if not self.apart:
            return -1, -1
        a = s.find(SPACE, lead, lead + size)
        while 0 <= a and (a == 0 or s[a - 1] == SPACE):
            a = s.find(SPACE, a + 1, lead + size)
        b = s.rfind(SPACE, lead, lead + size)
        while 0 <= b and (b == 0 or s[b - 1] == SPACE):
            b = s.rfind(SPACE, lead, b)
        return (a, b) if a > 0 and b > 0 else (-1, -1)

    def entries(self, s: str, lead: int) -> list[int]:
        """States in which a path may come to the chunk's left border (the start of a text has one)."""
        if not lead:
            return [0]
        out = []
        for size, (at, ids) in enumerate(self.steps(s[: lead + self.reach - 1]), 1):
            over = at + size - lead
            some = (at < lead) & (over >= 0)
            out += ((over[some] << 32) | (ids[some].astype(np.int64) + 1)).tolist()
        return out

    def _exits(self, lattice: tuple[list[list[int]], list[list[int]]], last: list[int], border: int) -> list[int]:
        out = []
        for i in range(max(0, border - self.reach), border):
            if last[i] != _NOWHERE:
                out += [(j - border) << 32 | (x + 1) for j, (free, x) in zip(lattice[0][i], self._after(last[i], lattice[1][i])) if free and j >= border]
        return out

    def matrix(self, s: str, lead: int, size: int) -> tuple[list[int], list[int]]:
        """Max-plus transfer matrix of a chunk: the pairs of entry and exit state that weigh 0."""
        border = lead + size
        first, final = self.meeting(s, lead, size)
        entries = self.entries(s, lead)
        if first >= 0:
            head = self.lattice(s[lead:first])
            ok = [e for e in entries if (e >> 32) <= first - lead and self.search(head, e >> 32, (e & 0xFFFFFFFF) - 1, first - lead)[-1] != _NOWHERE]
            tail = self.lattice(s[final:])
            out = self._exits(tail, self.search(tail, 0, _START, border - final), border - final)
            return [e for e in ok for _ in out], out * len(ok)
        lattice = self.lattice(s[lead:])
        a: list[int] = []
        b: list[int] = []
        like = None
        for e in entries:
            over = e >> 32
            if over >= size:  # a piece that hangs over the whole chunk
                a.append(e)
                b.append((over - size) << 32 | (e & 0xFFFFFFFF))
                continue
            last = self.search(lattice, over, (e & 0xFFFFFFFF) - 1, size, like)
            like = like or last
            out = self._exits(lattice, [_NOWHERE] * over + last[over:], size)
            a += [e] * len(out)
            b += out
        return a, b

    def backtrace(self, s: str, lead: int, size: int, enter: int, leave: int) -> bytes:
        """Ids of the pieces of the best path that start in a chunk, given its two states."""
        over, hang = enter >> 32, leave >> 32
        if over >= size and hang == over - size:
            return b""
        border = lead + size
        first, final = self.meeting(s, lead, size)
        if first < 0:
            own = s[lead : border + hang]
            last = self.search(self.lattice(own), over, (enter & 0xFFFFFFFF) - 1, size)
            return self.trace(own, last, size + hang, over)
        head, tail = s[lead:first], s[final : border + hang]
        before = self.trace(head, self.search(self.lattice(head), over, (enter & 0xFFFFFFFF) - 1, len(head)), len(head), over)
        after = self.trace(tail, self.search(self.lattice(tail), 0, _START, border - final), len(tail), 0)
        return before + self.encode_all([s[first:final]], prefix=False)[0] + after


@functools.lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    """The pieces of a model file."""
    return Pieces(path)


def compose(a: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Max-plus product of matrices in order (listed entries): associative."""
    left, right = (np.asarray(x, np.int64) for x in a[0])
    for x, y in a[1:]:
        x, y = np.asarray(x, np.int64), np.asarray(y, np.int64)
        order = np.argsort(x, kind="stable")
        x, y = x[order], y[order]
        lo, hi = np.searchsorted(x, right, "left"), np.searchsorted(x, right, "right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        both = np.unique(np.stack([np.repeat(left, n), y[at]], 1), axis=0)
        left, right = both[:, 0], both[:, 1]
    return left, right


def resolve(a: list[tuple[np.ndarray, np.ndarray]], enter: int, leave: int | None) -> list[tuple[int, int]]:
    """Entry and exit of each of some matrices in order on the best path from ``enter`` to ``leave``
    (to the end of the text: to the exit that hangs over by nothing)."""
    ahead = [{enter}]
    maps = []
    for x, y in a:
        to: dict[int, list[int]] = {}
        for p, q in zip(np.asarray(x).tolist(), np.asarray(y).tolist()):
            to.setdefault(p, []).append(q)
        maps.append(to)
        ahead.append({q for p in ahead[-1] for q in to.get(p, ())})
    (state,) = {s for s in ahead[-1] if (s >> 32 == 0 if leave is None else s == leave)}
    out = []
    for to, before in zip(reversed(maps), reversed(ahead[:-1])):
        (origin,) = [p for p in before if state in to.get(p, ())]
        out.append((origin, state))
        state = origin
    return out[::-1]


_AT = "k string, n long"
_MATRIX = f"{_AT}, a array<long>, b array<long>"


def _matrices(rows: pa.Table) -> tuple[pa.Table, list[tuple[np.ndarray, np.ndarray]]]:
    rows = rows.sort_by("n")
    return rows, [(x.values.to_numpy(), y.values.to_numpy()) for x, y in zip(rows.column("a"), rows.column("b"))]


def _combine(key: tuple, rows: pa.Table) -> pa.Table:
    a, b = compose(_matrices(rows)[1])
    return pa.table({"k": [key[0].as_py()], "n": pa.array([key[1].as_py()], pa.int64()), "a": pa.array([a.tolist()], pa.list_(pa.int64())), "b": pa.array([b.tolist()], pa.list_(pa.int64()))})


def _states(rows: pa.Table) -> pa.Table:
    rows, of = _matrices(rows)
    leave = rows.column("leave")[0].as_py()
    states = resolve(of, rows.column("enter")[0].as_py(), leave)
    return pa.table({"k": rows.column("k"), "n": rows.column("n"), "enter": pa.array([x for x, _ in states], pa.int64()), "leave": pa.array([y for _, y in states], pa.int64())})


def _border_states(matrices: DataFrame) -> DataFrame:
    """k, n, enter, leave: the states of the best path at each chunk's borders."""
    levels = [materialise(matrices, "piece-matrices")]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    while most >= FAN:
        up = levels[-1].groupBy("k", F.expr(f"n div {FAN}").alias("of")).applyInArrow(_combine, _MATRIX)
        levels.append(materialise(up, "piece-matrices"))
        most //= FAN
    # the topmost level has at most FAN matrices a document
    top = levels.pop().withColumns({"enter": F.lit(0).cast("long"), "leave": F.lit(None).cast("long")})
    states = top.groupBy("k").applyInArrow(_states, f"{_AT}, enter long, leave long")
    for level in reversed(levels):
        above = states.select("k", F.col("n").alias("of"), "enter", "leave")
        below = level.withColumn("of", F.expr(f"n div {FAN}")).join(above, ["k", "of"])
        states = below.groupBy("k", "of").applyInArrow(_states, f"{_AT}, enter long, leave long")
    return materialise(states, "piece-states")


def _joined_ids(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("n")
    return pa.table({"k": [rows.column("k")[0].as_py()], "ids": pa.array([b"".join(rows.column("ids").to_pylist())], pa.binary())})


def _identity(key: str, text: str) -> Column:
    """128 bits of the text and the key: rows of one identity are alike."""
    return F.concat_ws("-", F.hex(F.xxhash64(text)), F.hex(F.xxhash64(F.lit(1), text)), F.col(key).cast("string"))


def _each(frame: DataFrame, model: str, column: str, schema: str, made: Callable[[Pieces, pa.RecordBatch], list[pa.Array]], kept: Iterable[str]) -> DataFrame:
    """``frame`` through ``made``, a megabyte of ``column`` at a time: ``kept`` columns and the new ones."""
    shared = frame.sparkSession.sparkContext.broadcast(pieces(model))
    kept = list(kept)
    full = ", ".join([*(f"`{c}` {frame.schema[c].dataType.simpleString()}" for c in kept), schema])
    names = [*kept, *(x.split()[0] for x in schema.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in small_batches(batches, column, _BATCH_BYTES):
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *made(p, batch)], names=names)

    return frame.mapInArrow(run, full)


def _lists(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(c).to_pylist() for c in names))


def _large(large: DataFrame, key: str, model: str, chunk: int) -> DataFrame:
    """key, text and ids of giant documents, chunk by chunk."""
    kind = large.schema[key].dataType.simpleString()
    large = materialise(large.withColumn("k", _identity(key, "text")), "piece-giants")
    reach = pieces(model).reach
    shared = large.sparkSession.sparkContext.broadcast(pieces(model))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in small_batches(batches, "text", _BATCH_BYTES):
            for k, t in _lists(batch, "k", "text"):
                plain = p.plain(t)
                for first in range(0, len(plain), 64 * chunk):
                    starts = range(first, min(len(plain), first + 64 * chunk), chunk)
                    lead = [min(reach, a) for a in starts]
                    parts = [plain[a - x : a + chunk + reach - 1] for a, x in zip(starts, lead)]
                    yield pa.RecordBatch.from_pydict({"k": [k] * len(parts), "n": pa.array([a // chunk for a in starts], pa.int64()), "lead": pa.array(lead, pa.int32()), "size": pa.array([min(chunk, len(plain) - a) for a in starts], pa.int32()), "part": pa.array(parts, pa.string())})

    # alike rows (key and text) are cut once and meet their ids again at the end
    chunks = large.dropDuplicates(["k"]).mapInArrow(cut, f"{_AT}, lead int, size int, part string").repartition("k", "n")
    chunks = materialise(chunks, "piece-chunks")

    def matrix(p: Pieces, batch: pa.RecordBatch) -> list[pa.Array]:
        made = [p.matrix(*row) for row in _lists(batch, "part", "lead", "size")]
        return [pa.array([x[i] for x in made], pa.list_(pa.int64())) for i in range(2)]

    def backtrace(p: Pieces, batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([p.backtrace(*row) for row in _lists(batch, "part", "lead", "size", "enter", "leave")], pa.binary())]

    states = _border_states(_each(chunks, model, "part", "a array<long>, b array<long>", matrix, ["k", "n"]))
    parts = _each(chunks.join(states, ["k", "n"]), model, "part", "ids binary", backtrace, ["k", "n"])
    # a document's ids are one value of the result
    whole = parts.groupBy("k").applyInArrow(_joined_ids, "k string, ids binary")
    return large.join(whole, "k").select(F.col(key).cast(kind).alias(key), "text", "ids")


def _split(docs: DataFrame, key: str, text: str, chunk: int) -> tuple[DataFrame, DataFrame]:
    slim = docs.select(F.col(key), F.col(text).alias("text")) if key != text else docs.select(F.col(key))
    giant = F.coalesce(F.length("text"), F.lit(0)) > chunk
    return slim.where(~giant), slim.where(giant)


def encode(docs: DataFrame, model: str, *, key: str = "doc_id", text: str = "text", chunk: int = 1 << 15) -> DataFrame:
    """``key``, ``text`` and ``ids`` (little-endian uint32 in a binary) for every row of ``docs``.

    The ids are those of the library for the given merge model.  Null texts stay null and have no
    ids, like empty ones; rows may repeat, and keys may be null.  Texts of over ``chunk`` characters
    are dealt out as chunks; what is gathered of one document are ``FAN`` matrices at a time, a few
    kilobytes each, and its ids, one value of the result.  Other columns of ``docs`` are not kept.
    """
    small, large = _split(docs, key, text, chunk)
    ids = lambda p, batch: [pa.array(p.encode_all(batch.column("text").to_pylist()), pa.binary())]
    return _each(small, model, "text", "ids binary", ids, [key, "text"]).unionByName(_large(large, key, model, chunk))


_SUMMARY = "n_chars long, n_tokens long, ids_crc32 long, round_trip boolean"


def _summary(p: Pieces, texts: list[str | None], ids: list[bytes]) -> list[pa.Array]:
    return [pa.array([len(t or "") for t in texts]), pa.array([len(x) // 4 for x in ids]), pa.array([zlib.crc32(x) for x in ids]), pa.array([p.decode(x) == (t or "") for x, t in zip(ids, texts)])]


def summary(docs: DataFrame, model: str, *, key: str = "doc_id", text: str = "text", chunk: int = 1 << 15) -> DataFrame:
    """Per row of ``docs``: key, n_chars, n_tokens, ids_crc32, and whether the ids decode to the text
    (they do not where it has the white-space sign U+2581 itself).  Texts are encoded and decoded in
    one pass; null counts as empty."""
    small, large = _split(docs, key, text, chunk)

    def whole(p: Pieces, batch: pa.RecordBatch) -> list[pa.Array]:
        texts = batch.column("text").to_pylist()
        return _summary(p, texts, p.encode_all(texts))

    again = lambda p, batch: _summary(p, batch.column("text").to_pylist(), batch.column("ids").to_pylist())
    return _each(small, model, "text", _SUMMARY, whole, [key]).unionByName(_each(_large(large, key, model, chunk), model, "text", _SUMMARY, again, [key]))
