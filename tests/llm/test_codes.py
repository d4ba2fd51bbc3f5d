import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from phylospark.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_codes(rows, parts, entries, rounds):
    kept = [(i, l, np.floor(1024 * np.array(v, np.float32).astype(float)).astype(np.int64)) for i, v, l in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2].tolist()))
    v = np.stack([r[2] for r in kept])
    width = v.shape[1] // parts
    cut = [v[:, p * width : (p + 1) * width] for p in range(parts)]
    books = [c[:entries].copy() for c in cut]
    for _ in range(rounds):
        near = [((c[:, None] - b[None]) ** 2).sum(2).argmin(1) for c, b in zip(cut, books)]
        for c, b, own in zip(cut, books, near):
            for e in np.unique(own):
                b[e] = c[own == e].sum(0) // (own == e).sum()
    d = [((c[:, None] - b[None]) ** 2).sum(2) for c, b in zip(cut, books)]
    code = ["".join(f"{x[k].argmin():02x}" for x in d) for k in range(len(kept))]
    return sorted(((r[0], r[1], c, int(sum(x[k].min() for x in d))) for k, (r, c) in enumerate(zip(kept, code))), key=str), np.stack(books)


def vectors(rnd, n, width):
    centres = [[rnd.uniform(-1, 1) for _ in range(width)] for _ in range(5)]
    rows = [(k, [x + rnd.gauss(0, 0.02) for x in rnd.choice(centres)], rnd.choice([1, 2, None])) for k in range(n)]
    rows += [(n, None, 1), (n + 1, [None] + [0.0] * (width - 1), 1), (n + 2, [float("nan")] * width, 2), (n + 3, [float("inf")] * width, None), (n + 4, [0.0] * width, None), (n + 4, [0.0] * width, None), (3, rows[3][1], 1), (3, rows[5][1], 1), (None, rows[2][1], 2)]
    return rows + [(500 + k, rows[7][1], 1) for k in range(60)]  # many equal ones


@pytest.mark.parametrize("size, entries", [(1024, 16), (50, 256), (7, 3)])
def test_codes_and_codebooks(spark, size, entries):
    rows = vectors(random.Random(size), 150, 8)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS v", "3 AS x", "4 AS code", "5 AS error", "6 AS points")
    got, books = codes.compress(frame, parts=4, entries=entries, rounds=3, size=size)
    want, want_books = brute_codes(rows, 4, entries, 3)
    assert (books == want_books).all()
    assert sorted((tuple(r) for r in got.select("vec_id", "label", "code", "error").collect()), key=str) == want


def test_little_and_large(spark):
    got, books = codes.compress(spark.createDataFrame([], SCHEMA))
    assert got.count() == 0 and books.size == 0
    got, _ = codes.compress(spark.createDataFrame([(1, [0.5] * 4, 1), (2, None, 1)], SCHEMA))
    assert [tuple(r) for r in got.collect()] == [(1, 1, "00000000", 0)]
    big = [(k, [float((k * 7919 + j * 104729) % 100_000) for j in range(8)], 1) for k in range(40)]  # beyond exact doubles
    got, _ = codes.compress(spark.createDataFrame(big, SCHEMA), parts=2, entries=8)
    assert sorted(tuple(r) for r in got.select("vec_id", "label", "code", "error").collect()) == sorted(brute_codes(big, 2, 8, 4)[0])
    for bad in ([(1, [1e9] * 4, 1)], [(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)], [(1, [1.0] * 6, 1)]):
        with pytest.raises((ValueError, PySparkException)):
            codes.compress(spark.createDataFrame(bad, SCHEMA))[0].collect()


def test_cover_tree_gives_whole_runs_away():
    rng = np.random.default_rng(3)
    centres = rng.integers(-5000, 5000, (12, 16))
    points = centres[rng.integers(0, 12, 900)] + rng.integers(-20, 20, (900, 16))
    tree = codes.CoverTree.build(points)
    ordered = points[tree.order]
    assert sorted(tree.order.tolist()) == list(range(900))
    for k in range(len(tree.low)):  # a node's radius is the largest distance in its run, children part it
        own = ordered[tree.low[k] : tree.high[k]]
        assert tree.low[k] <= tree.centre[k] < tree.high[k]
        assert abs(np.sqrt(((own - ordered[tree.centre[k]]) ** 2).sum(1)).max() - tree.radius[k]) < 1e-6
        if tree.last[k]:
            below = [(tree.low[c], tree.high[c]) for c in range(tree.child[k], tree.last[k])]
            assert [below[0][0], *[b for _, b in below]] == [a for a, _ in below] + [tree.high[k]] and below[0][0] == tree.low[k]
    entry, alone, seen = tree.assign(ordered, centres)
    assert (entry == ((ordered[:, None] - centres[None]) ** 2).sum(2).argmin(1)).all()
    assert alone.mean() < 0.2 and seen < len(tree.low) / 2
    # ties go to the lower index
    assert (tree.assign(ordered, np.concatenate((centres, centres)))[0] == entry).all()


def test_query_sums_errors_by_label(spark):
    from phylospark.llm import queries

    sf = "/root/testdata/sf0.001"
    got = queries.op12_codes(spark, sf)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    joined = got.join(spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label"), "vec_id")
    assert joined.groupBy("label").agg((F.sum("error") == F.max("label_error")).alias("ok"), F.count_distinct("label_error").alias("one")).where("not ok or one > 1").count() == 0
