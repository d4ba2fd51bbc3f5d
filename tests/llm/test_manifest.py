import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from phylospark.llm import merkle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def hashed(text):
    return sha256(text.encode()).hexdigest()


def levels_of(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([hashed("".join(out[-1][k : k + 2])) for k in range(0, len(out[-1]), 2)])
    return out


def path(levels, i):
    """Siblings of a leaf (None: alone) and whether they stand left, bottom up."""
    out = []
    for level in levels[:-1]:
        other = i ^ 1
        out.append((level[other] if other < len(level) else None, other < i))
        i >>= 1
    return out


def brute_manifest(rows, tampered):
    leaf = lambda r: hashed("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    order = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in names}
    trees = {g: levels_of([leaf(r) for r in order[g]]) for g in names}
    top, out = levels_of([trees[g][-1][0] for g in names]), []
    for k, g in enumerate(names):
        for i, r in enumerate(order[g]):
            steps = path(trees[g], i) + path(top, k)
            folded = leaf((*r[:3], r[3] + 1, r[4]) if tampered(r) and r[3] is not None else r)
            for sibling, left in steps:
                folded = hashed(folded if sibling is None else sibling + folded if left else folded + sibling)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], hashed("".join(s for s, _ in steps if s)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def shown(spark, rows, height, schema="doc_id long, source string, lang string, n_chars long, text string"):
    docs = spark.createDataFrame(rows, schema)
    # extra columns whose names the operator uses itself
    docs = docs.selectExpr("*", "1 AS g", "2 AS key", "3 AS proof", "4 AS `digest`", "5 AS i", "6 AS n", "7 AS leaf", "8 AS claimed")
    claim = {"n_chars": F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    found = merkle.manifest(docs, height=height, claimed=claim).withColumn("folded", merkle.fold("claimed"))
    got = found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256), "folded", F.col("folded") == F.col("root"))
    return sorted((tuple(r) for r in got.collect()), key=str)


def is_tampered(r):
    return r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0


@pytest.mark.parametrize("height", [1, 2, 10])
def test_manifest_of_any_shape(spark, height):
    rnd = random.Random(height)
    rows = []
    for lang, n in (("en", 37), ("de", 16), ("fr", 5), (None, 3), ("", 1), ("é", 2), ("zz", 1)):
        rows += [(rnd.randrange(10**6), rnd.choice(["s", None, "ü"]), lang, rnd.choice([None, 5, 1234]), rnd.choice(["", None, "text é", "x" * 50_000])) for _ in range(n)]
    rows += [rows[0], rows[0], (None, None, None, None, None), (None, "s", "en", 1, "t"), (None, "s", "en", 1, "t")]
    got = shown(spark, rows, height)
    assert got == brute_manifest(rows, is_tampered)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_manifest_of_little(spark):
    one = [(7, "s", "en", 3, "abc")]
    assert shown(spark, one, 10) == brute_manifest(one, is_tampered)
    assert shown(spark, [], 10) == []


def test_tampering_is_seen_wherever_it_is(spark):
    rows = [(k, "s", "en", k, "text") for k in range(40)]
    docs = spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(COLUMNS, ("long", "string", "string", "long", "string"))))
    for column, value in (("text", F.lit("Text")), ("source", F.lit(None).cast("string")), ("doc_id", F.col("doc_id") + 100)):
        found = merkle.manifest(docs, claimed={column: F.when(F.col("n_chars") == 11, value).otherwise(F.col(column))})
        assert [r.doc_id for r in found.where(merkle.fold("claimed") != F.col("root")).collect()] == [11]
