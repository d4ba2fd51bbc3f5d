import hashlib
import random
import re

import pytest
import xxhash

from phylospark.llm import decontaminate, simhash
from phylospark.llm.common import materialise


def brute_contamination(docs, items, n=13):
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    windows = {}
    for i, t in items:
        w = words(t)
        size = min(n, len(w))
        for k in range(len(w) - size + 1) if size else ():
            windows.setdefault(tuple(w[k : k + size]), set()).update(() if i is None else (str(i),))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (of := windows.get(tuple(w[k : k + size]))) is not None:
                    hit.update(range(k, k + size))
                    found |= of
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out)


def brute_simhash(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum((sum(h >> b & 1 for h in hs) * 2 > len(hs)) << b for b in range(64)) if hs else 0


def components(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("limit", [10**6, 0])
def test_contamination(spark, limit):
    rnd = random.Random(1)
    vocab = [f"w{i}" for i in range(30)] + ["é", "Ünï", "X1"]
    say = lambda k: " ".join(rnd.choice(vocab) + rnd.choice(["", ",", ".\n", "-"]) for _ in range(k))
    items = [(i, say(rnd.choice([1, 2, 5, 12, 13, 14, 40]))) for i in range(12)] + [(50, ""), (51, None), (52, "!!"), (None, "lost words")]
    docs = [(d, say(rnd.choice([0, 1, 3, 20, 200])) + (rnd.choice(items[:12])[1].upper() if d % 3 else "")) for d in range(60)] + [(100, None), (101, ""), (102, None), (103, "some LOST words, lost: words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string").withColumn("lang", __import__("pyspark").sql.functions.lit("x")), bench, max_broadcast=limit)
    rows = sorted(tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect())
    assert rows == brute_contamination(docs, items)
    assert next(r for r in rows if r[0] == 103)[1:4] == (5, 4, 0)  # an item without id hits and is not listed
    assert decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench.limit(0)).where("n_hit > 0").count() == 0


def test_spans_are_removed(spark):
    docs = spark.createDataFrame([(1, "Keep this. One two, THREE four! And this.")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "one two three four")], "item_id long, text string")
    for limit in (1 << 20, 0):
        frame = docs.selectExpr("doc_id", "text", "7 AS key", "8 AS spans", "9 AS n_hit")
        row = decontaminate.contamination(frame, bench, keep_hit_text="clean", max_broadcast=limit).first()
        assert (row.clean, row.key, row.spans, row.n_hit) == ("Keep this. ! And this.", 7, 8, 4)
    assert decontaminate.remove_contaminated(docs, bench).count() == 0


def test_fingerprints_and_components(spark):
    rnd = random.Random(2)
    base = [" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 4) for _ in range(300)) for _ in range(8)]
    docs = []
    for d in range(120):
        w = rnd.choice(base).split(" ")
        for _ in range(rnd.choice([0, 1, 1, 2, 8])):
            w[rnd.randrange(300)] = "é" + str(rnd.random())
        docs.append((d, " ".join(w)))
    docs += [(500, None), (501, ""), (502, " \t\n"), (503, "One two"), (504, "one\ttwo "), (505, "x " * 3000), (505, "x " * 3000), (None, "one two")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    fps = materialise(simhash.fingerprints(frame), "t")
    got = [(r.doc_id, r.fp & (2**64 - 1)) for r in fps.collect()]
    assert sorted(got, key=str) == sorted(((d, brute_simhash(t)) for d, t in docs), key=str)
    known = [(d, f) for d, f in got if d is not None]
    links = [(a, b) for a, f in known for b, g in known if a < b and (f ^ g).bit_count() <= 4]
    want = components({d for d, _ in known}, links)
    assert len(set(want.values())) < len(want) - 20
    for r in simhash.near_components(fps).collect():
        assert r.component_id == (503 if r.doc_id is None else want[r.doc_id])
    assert simhash.near_components(fps.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [4096, 40])
def test_links_of_clustered_fingerprints(spark, chunk):
    rnd = random.Random(3)
    centres = [rnd.getrandbits(64) for _ in range(6)]
    values = set()
    for _ in range(500):
        v = rnd.choice(centres)
        for _ in range(rnd.randint(0, 9)):
            v ^= 1 << rnd.randrange(64)
        values.add(v)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    fps = spark.createDataFrame([(i, v) for i, v in enumerate(signed)], "doc_id long, fp long")
    distinct = fps.select("fp", fps.fp.alias("node")).distinct()
    labels = simhash.connected_components(materialise(simhash.near_links(distinct, 4, chunk=chunk), "t"), hub=20)
    got = {r.node: r.root for r in labels.collect()}
    ids = dict(enumerate(signed))
    want = components(ids, [(a, b) for a in ids for b in ids if a < b and ((ids[a] ^ ids[b]) & (2**64 - 1)).bit_count() <= 4])
    groups = lambda f: {frozenset(i for i in ids if f(i) == r) for r in {f(i) for i in ids}}
    assert groups(lambda i: got.get(ids[i], ids[i])) == groups(want.get)


def test_decontamination_equals_its_sql(spark):
    import duckdb

    from phylospark.llm import queries

    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = con.execute(queries.oracle_sql()["op5_decontaminate"])
    assert [c[0] for c in want.description] == names
    got = [tuple(r) for r in queries.op5_decontaminate(spark, sf).select(*names).collect()]
    assert sorted(got) == sorted(want.fetchall()) and any(r[5] for r in got)
