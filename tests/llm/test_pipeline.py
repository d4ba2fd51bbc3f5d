import random

import corpus_pipeline as pipe
from test_near_and_bench import brute_contamination, brute_simhash, components
from test_scans import brute_base

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "token = abcdefghijkl0123 is a secret there", "en", "s", 40), (9003, "token = abcdefghijkl0123 is a secret there", "en", "s", 40)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in pipe.STAGES[:4]:
        before = {(r.doc_id, r.text) for r in docs.collect()}
        docs = pipe.materialise(stage(spark, docs, SF), "test")
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        after = set(rows)
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            assert after <= before
            kept = {d for d, _ in after}
            assert sum((d in kept) == bool(q) for d, q in labels.items()) >= 0.95 * len(labels)
        elif name == "near_duplicates":
            fp = {d: brute_simhash(t) for d, t in before}
            root = components(fp, [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4])
            assert after == {(d, t) for d, t in before if root[d] == d} and len(rows) == len(after)
        elif name == "decontamination":
            bad = {r[0] for r in brute_contamination(sorted(before, key=lambda x: x[0]), bench) if r[5]}
            assert bad and after == {(d, t) for d, t in before if d not in bad}
        else:
            clean = {d: t for d, t in after}
            assert set(clean) == {d for d, _ in before}
            for d, t in before:
                assert not brute_base(clean[d]) and (brute_base(t) or clean[d] == t or "[SECRET]" in clean[d])
    last = pipe.STAGES[4][1](spark, docs, SF).collect()
    assert len(last) == len(rows) and all(r.round_trip for r in last)


def test_run_is_the_composition(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in pipe.STAGES:
        docs = pipe.materialise(stage(spark, docs, SF), "test")
    assert sorted(map(tuple, pipe.run(spark, SF).collect())) == sorted(map(tuple, docs.collect()))


def test_near_duplicates_keep_all_different_rows(spark):
    rnd = random.Random(6)
    say = lambda: " ".join(rnd.choice("abcdefghijklmnop") * rnd.randint(1, 9) for _ in range(200))
    a, b, c, d, e, f = (say() for _ in range(6))
    docs = [(None, a), (None, b), (None, b), (7, c), (7, d), (7, d), (8, e), (None, e), (9, e), (7, e), (10, f), (10, f)]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in pipe.near_duplicates(spark, frame, SF).collect()]
    assert sorted(got, key=str) == sorted([(None, a), (None, b), (7, c), (7, d), (7, e), (10, f)], key=str)
