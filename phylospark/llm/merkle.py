"""Merkle manifests of a table: digests of rows, a binary tree for each group, one over the groups.

Time-forward processing: a node's label is its level and place, and what a node tells another one is
a message under the receiver's label.  Spark's external (spilling) sort by label is the priority
queue: it delivers child digests to their parents in label order.  The reversed sweep goes down the
same labels and delivers to each node the suffix of its proof, from its parent to the root.

Levels are taken ``height`` at a time: a label stands for a block of up to ``2 ** height`` children,
so that there are log(n) / height rounds, no message is longer than a proof, and no task holds more
than one block.  A group of any size is many blocks.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise

HEIGHT = 10


def row_digest(columns: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the values: ``-`` if null, else UTF-8 byte count, ``:`` and value."""

    def said(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(said, columns)), 256)


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _upper(digests: list[str]) -> list[str]:
    return [_hash("".join(digests[k : k + 2])) for k in range(0, len(digests), 2)]


def _left(n: int, level: int) -> int:
    """Levels above ``level`` in a tree with n leaves."""
    return max(0, (n - 1).bit_length() - level)


def _blocks(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[list[tuple]]:
    """The rows of each (g, block), which are sorted by it."""
    own, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            if row[:2] != own:
                if held:
                    yield held
                own, held = row[:2], []
            held.append(row)
    if held:
        yield held


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``i`` (from 0, by ``order`` within ``group``) and ``n`` (rows of the group).

    All rows are sorted by ranges at once; a group's place in each range comes from the numbers of its
    rows in the ranges before, at most one number for each group and range.  Rows that are alike in
    ``order`` are numbered in any order.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [group, *order, "__row"]
    dealt = rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    placed = materialise(dealt.drop("__row").withColumn("__at", F.monotonically_increasing_id()), "merkle-sorted")
    part = F.shiftright("__at", 33)  # the range's number
    parts = placed.groupBy(group, part.alias("__part")).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    w = W.partitionBy(group)
    before = F.coalesce(F.sum("__n").over(w.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = parts.withColumn("__before", before).withColumn("n", F.sum("__n").over(w)).drop("__n")
    joined = placed.withColumn("__part", part).join(parts, [group, "__part"])
    return joined.withColumn("i", F.col("__at") - F.col("__first") + F.col("__before")).drop("__at", "__part", "__first", "__before")


def _above(level: int) -> Column:
    """Whether a group with n leaves has more than one node at a level."""
    return F.col("n") > F.lit(1 << level)


def sweep_up(leaves: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """Nodes ``g``, ``n``, ``i``, ``digest`` at the levels 0, height, 2 height, ...; a group whose tree
    ends between two of them has its root at the upper one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        names = ["g", "n", "i", "digest"]

        def batch() -> pa.RecordBatch:
            columns = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=names)

        for rows in _blocks(batches, ["g", "block", "n", "level", "digest"]):
            g, block, n, level, _ = rows[0]
            digests = [r[4] for r in rows]
            for _ in range(min(height, _left(n, level))):
                digests = _upper(digests)
            out.append((g, n, block, digests[0]))
            if len(out) >= 1024:
                yield batch()
                out = []
        if out:
            yield batch()

    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, level = [leaves.select("g", "n", "i", "digest")], 0
    while most > 1 << level:
        nodes = levels[-1].where(_above(level))
        told = nodes.select("g", F.shiftright("i", height).alias("block"), "i", "n", F.lit(level).alias("level"), "digest")
        queue = told.repartition("g", "block").sortWithinPartitions("g", "block", "i")
        levels.append(materialise(queue.mapInArrow(run, "g string, n long, i long, digest string"), "merkle-nodes"))
        level += height
    return levels


def roots(levels: list[DataFrame], height: int = HEIGHT) -> DataFrame:
    """``g``, ``digest``: the root of each group."""
    out = levels[0].where(~_above(0))
    for k, nodes in enumerate(levels[1:], 1):
        out = out.union(nodes.where(~_above(k * height)))
    return out.select("g", "digest")


def sweep_down(levels: list[DataFrame], tops: DataFrame, height: int = HEIGHT, carry: Sequence[str] = ()) -> DataFrame:
    """Proofs of the leaves: ``g``, ``i``, ``tops``' columns with ``proof`` and ``sides`` made longer, and the
    columns ``carry`` of ``levels[0]``.

    ``tops(g, proof, sides, ...)`` has the proof of each group's root in a tree above it.  ``proof`` is
    the siblings' digests end to end, from the leaf to the top; ``sides`` has a letter for each level: L or R
    where the sibling stands left or right, - where there is none.
    """
    extra = [f for f in tops.schema.fields if f.name not in ("g", "proof", "sides")]
    told = ["proof", "sides", *[f.name for f in extra]]
    suffixes = None
    for k in range(len(levels) - 1, -1, -1):
        level, kept = k * height, [] if k else list(carry)
        own = [levels[k].schema[c] for c in kept]
        schema = "g string, i long, proof string, sides string" + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in [*extra, *own])

        def run(batches: Iterator[pa.RecordBatch], kept: list[str] = kept) -> Iterator[pa.RecordBatch]:
            types, names = None, ["g", "i", *told, *kept]

            def seen() -> Iterator[pa.RecordBatch]:
                nonlocal types
                for batch in batches:
                    types = [batch.schema.field(c).type for c in names]
                    yield batch

            for rows in _blocks(seen(), ["g", "block", "i", "n", "level", "digest", *told, *kept]):
                message, children = rows[0][6 : 6 + len(told)], rows[1:]
                n, level = children[0][3], children[0][4]
                tiers = [[r[5] for r in children]]
                for _ in range(min(height, _left(n, level))):
                    tiers.append(_upper(tiers[-1]))
                found = [message[:2]]
                for tier in tiers[-2::-1]:
                    below = []
                    for j, _ in enumerate(tier):
                        proof, sides = found[j >> 1]
                        other = j ^ 1
                        below.append((tier[other] + proof, ("L" if other < j else "R") + sides) if other < len(tier) else (proof, "-" + sides))
                    found = below
                columns = [[r[0] for r in children], [r[2] for r in children], [f[0] for f in found], [f[1] for f in found], *[[x] * len(children) for x in message[2:]]]
                columns += [[r[6 + len(told) + j] for r in children] for j in range(len(kept))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        nodes = levels[k]
        done = nodes.where(~_above(level)).select("g", "i", *kept).join(tops, "g").select("g", "i", *told, *kept)
        if suffixes is None:
            suffixes = done
            continue
        none = [F.lit(None).cast("string").alias(c) for c in ("proof", "sides")] + [F.lit(None).cast(f.dataType).alias(f.name) for f in extra]
        children = nodes.where(_above(level)).select("g", F.shiftright("i", height).alias("block"), "i", "n", F.lit(level).alias("level"), "digest", *none, *kept)
        messages = suffixes.select("g", F.col("i").alias("block"), F.lit(-1).cast("long").alias("i"), F.lit(0).cast("long").alias("n"), F.lit(level).alias("level"), F.lit("").alias("digest"), *told, *[F.lit(None).cast(f.dataType).alias(f.name) for f in own])
        queue = children.union(messages).repartition("g", "block").sortWithinPartitions("g", "block", "i")
        suffixes = queue.mapInArrow(run, schema).union(done)
        if k:
            suffixes = materialise(suffixes, "merkle-suffixes")
    return suffixes


def fold(leaf: Column | str, proof: Column | str = "proof", sides: Column | str = "sides") -> Column:
    """The root that a leaf's digest and its proof lead to."""
    leaf, proof, sides = (F.col(c) if isinstance(c, str) else c for c in (leaf, proof, sides))

    def step(state: Column, k: Column) -> Column:
        side, other = F.substring(sides, k, F.lit(1)), F.substring(proof, state["at"], F.lit(64))
        both = F.when(side == "L", F.concat(other, state["digest"])).when(side == "R", F.concat(state["digest"], other)).otherwise(state["digest"])
        return F.struct(F.sha2(both, 256).alias("digest"), (state["at"] + F.when(side == "-", 0).otherwise(64)).alias("at"))

    up = F.aggregate(F.sequence(F.lit(1), F.length(sides)), F.struct(leaf.alias("digest"), F.lit(1).alias("at")), step, lambda s: s["digest"])
    return F.when(F.length(sides) == 0, leaf).otherwise(up)


def manifest(docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), key: str = "doc_id", group: str = "lang", claimed: Mapping[str, Column] | None = None, height: int = HEIGHT) -> DataFrame:
    """``key``, ``leaf``, ``claimed``, ``subroot``, ``root``, ``proof`` and ``sides`` for each row of ``docs``.

    A leaf is the :func:`row_digest` of ``columns``.  Within a group leaves ascend by ``key`` (null
    first, equal keys by digest); every two consecutive nodes, or a last one alone, become the digest of their
    digests until one is left, the subroot (a lone leaf itself).  Subroots, by group (null first,
    bytewise as text), give the root in the same way.  ``claimed`` is the digest of the row with some
    columns replaced, whose fold over the proof shows whether the claim holds (equal to ``leaf`` where
    nothing is claimed).  Repeated rows are leaves of their own.  No row: no manifest row.  Other
    columns are not looked at, whatever their names.
    """
    claimed = claimed or {}
    own = [F.col(f"`{c}`") for c in columns]
    other = [claimed.get(c, F.col(f"`{c}`")) for c in columns]
    g = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("")).alias("g")
    changed = [~x.eqNullSafe(claimed[c]) for c, x in zip(columns, own) if c in claimed]
    alike = F.lit(True)
    for c in changed:
        alike = alike & ~c
    rows = docs.select(g, F.col(f"`{key}`").alias("key"), row_digest(own).alias("digest"), F.when(~alike, row_digest(other)).alias("claimed"))
    leaves = materialise(numbered(materialise(rows, "merkle-leaves"), "g", ["key", "digest"]), "merkle-numbered")
    levels = sweep_up(leaves, height)
    subroots = materialise(roots(levels, height), "merkle-subroots")
    above = materialise(numbered(subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest"), "g", ["name"]), "merkle-groups")
    upper = sweep_up(above, height)
    end = roots(upper, height).select("g", F.lit("").alias("proof"), F.lit("").alias("sides"), F.col("digest").alias("root"))
    proofs = sweep_down(upper, end, height).join(above.select("i", "name", F.col("digest").alias("subroot")), "i")
    tops = materialise(proofs.select(F.col("name").alias("g"), "proof", "sides", "subroot", "root"), "merkle-tops")
    found = sweep_down([leaves.withColumn("leaf", F.col("digest")), *levels[1:]], tops, height, carry=("key", "leaf", "claimed"))
    return found.select(F.col("key").alias(key), "leaf", F.coalesce("claimed", "leaf").alias("claimed"), "subroot", "root", "proof", "sides")
