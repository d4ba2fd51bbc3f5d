import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from test_near_and_bench import components

from phylospark.llm import minhash, queries


def shingles(text, width=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset([" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [" ".join(w)] if w else [])


def brute_components(docs):
    sets = [shingles(t) for _, t in docs]
    near = lambda x, y: bool(x) and 100 * len(x & y) >= 80 * len(x | y)
    rows = range(len(docs))
    root = components(rows, [(a, b) for a in rows for b in rows if a < b and near(sets[a], sets[b])])
    least = {r: min((d for k, (d, _) in enumerate(docs) if root[k] == r and d is not None), default=None) for r in set(root.values())}
    return sorted(((d, len(sets[k]), least[root[k]], d == least[root[k]]) for k, (d, _) in enumerate(docs)), key=str)


def near_copies(rnd, n, kinds, words, edits):
    base = [[rnd.choice("abcdefghijklmnopqrst") * rnd.randint(1, 6) for _ in range(words)] for _ in range(kinds)]
    out = []
    for _ in range(n):
        w = list(base[min(rnd.randrange(2 * kinds), kinds - 1)])  # one kind has half of all
        for _ in range(rnd.choice(edits)):
            w[rnd.randrange(words)] = f"x{rnd.randrange(60)}"
        out.append(rnd.choice([" ", "\n", " \t "]).join(w))
    return out


EDGES = [(None, "One two"), (9001, "one  two"), (9002, None), (9003, ""), (9003, ""), (9004, " \t\n"), (9005, "é"), (9006, "É"), (9007, "a b c d"), (9007, "a B c d\n"), (9007, "other words are here now"), (None, None), (None, "nothing like it at all"), (9008, "w " * 30_000), (9009, "W " * 20_000)]


@pytest.mark.parametrize("most, chunk", [(4 << 20, 4096), (2500, 60), (800, 25)])
def test_components(spark, most, chunk, monkeypatch):
    rnd = random.Random(most)
    docs = list(enumerate(near_copies(rnd, 260, 5, 120, [0, 1, 2, 3, 4, 6]))) + EDGES
    rnd.shuffle(docs)
    whole = minhash.candidates
    monkeypatch.setattr(minhash, "candidates", lambda classes: whole(classes, chunk))
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS tie", "3 AS cid", "4 AS n", "5 AS signature", "6 AS `group`")
    got = sorted((tuple(r) for r in minhash.near_components(frame, most=most).collect()), key=str)
    assert got == brute_components(docs)
    assert 20 < len({r[2] for r in got}) < len(got) - 60


def test_nothing(spark):
    assert minhash.near_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        minhash.near_components(spark.createDataFrame([], "doc_id long, text string"), similar=(7, 10))


def test_merging_loses_no_link_whoever_is_asked():
    rnd = np.random.default_rng(5)
    for case in range(30):
        n = int(rnd.integers(2, 60))
        link = rnd.random((n, n)) < rnd.choice([0.01, 0.05, 0.3])
        link |= link.T
        labels = np.where(rnd.random(n) < 0.5, 0, np.arange(n)) if case % 2 else np.arange(n)
        asked = labels != 0 if case % 2 else np.ones(n, bool)

        def hits(row, others, parts, link=link):
            yield others[link[row, others]]

        edges = minhash._merge(labels, asked, hits)
        same = [(a, b) for a in range(n) for b in range(a) if labels[a] == labels[b]]
        all_ = [(a, b) for a in range(n) for b in range(a) if link[a, b] and (asked[a] or asked[b])]
        assert components(range(n), same + edges) == components(range(n), same + all_)
        assert all(link[a, b] for a, b in edges)


def test_collisions_follow_similarity():
    rnd = random.Random(8)
    words = [f"w{k}" for k in range(3000)]
    a = " ".join(words)
    for _ in range(120):
        words[rnd.randrange(3000)] = f"y{rnd.random()}"
    both = [shingles(a), shingles(" ".join(words))]
    values, bounds = minhash.shingle_sets(pa.array([a, " ".join(words), None, "Ab\tcd"]))
    assert np.diff(bounds).tolist() == [len(both[0]), len(both[1]), 0, 1]
    one, other = values[: bounds[1]], values[bounds[1] : bounds[2]]
    assert len(np.intersect1d(one, other)) == len(both[0] & both[1])
    share = np.mean([(one * f).min() == (other * f).min() for f in minhash._FACTORS])
    assert abs(share - len(both[0] & both[1]) / len(both[0] | both[1])) < 0.12


@pytest.mark.parametrize("name, tables", [("op11_manifest", ["documents"]), ("op12_codes", ["embeddings"]), ("op13_minhash", ["documents"])])
def test_query_equals_its_sql(spark, name, tables):
    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in want.description]
    got = queries.queries()[name](spark, sf)
    assert sorted(got.columns) == sorted(names)
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(want.fetchall())
