import numpy as np
from pyspark.sql import functions as F

from phylospark.llm import audio, queries

SF = "/root/testdata/sf0.001"


def tune(rng, n):
    t = np.arange(n) / audio.RATE
    out = np.zeros(n)
    for a in range(0, n, 700):
        out[a : a + 700] = sum(np.sin(2 * np.pi * f * t[a : a + 700]) for f in rng.uniform(200, 3000, 3))
    return out


def as_pcm(x, rng, noise):
    x = x + rng.normal(0, noise, len(x))
    return np.clip(128 + 30 * x, 0, 255).astype(np.uint8).tobytes()


def test_recordings_align(spark):
    rng = np.random.default_rng(3)
    tunes = [tune(rng, 9000) for _ in range(6)]
    rows = [(100 * i, as_pcm(x, rng, 0.02)) for i, x in enumerate(tunes)]
    want = {}
    for i, x in enumerate(tunes):
        rows.append((100 * i + 1, as_pcm(np.concatenate([tune(rng, audio.HOP * 40), x]), rng, 0.05)))
        want[100 * i + 1] = (100 * i, 40)
        rows.append((100 * i + 2, as_pcm(tune(rng, 9000), rng, 0.05)))
    rows += [(700, None), (701, b""), (702, b"x" * 300), (703, rows[0][1])]
    codes = audio.fingerprints(spark.createDataFrame(rows, "doc_id long, media binary"))
    got = {r.doc_id: r for r in audio.align(codes, F.col("doc_id") % 100 == 0).collect()}
    assert len(got) == len(rows)
    for d, (q, at) in want.items():
        assert got[d].best == q and got[d].offset == at
    assert got[703].best == 0 and got[703].bit_error == 0 and got[700].best is None and got[702].n_codes == 0
    assert sum(got[100 * i + 2].best is not None for i in range(6)) == 0
    cut = {r.doc_id: (r.best, r.offset) for r in audio.align(codes, F.col("doc_id") % 100 == 0, block=300).collect()}
    assert cut == {d: (r.best, r.offset) for d, r in got.items()}
    assert audio.align(codes.limit(0), F.lit(True)).count() == 0


def test_recall_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.col("text").alias("media"))
    codes = {r.doc_id: np.array(r.codes, np.int32) for r in audio.fingerprints(docs).collect()}
    got = {r.doc_id: r for r in queries.op2_audio(spark, SF).collect()}
    pairs = met = 0
    for q in (d for d in codes if d % 100 == 0 and len(codes[d]) >= 16):
        for d, c in codes.items():
            other, best = codes[q], 2.0
            for shift in range(16 - len(other), len(c) - 15):
                a, b = max(0, shift), min(len(c), len(other) + shift)
                best = min(best, np.bitwise_count(c[a:b] ^ other[a - shift : b - shift]).mean() / 32)
            if best <= 0.15:
                pairs += 1
                met += got[d].n_matches > 0
    assert pairs and met >= 0.9 * pairs


def brute_pairs(codes, payloads, overlap=16, errors=0.15):
    """(recording, query) pairs; equality for what is too short."""
    out = set()
    for q in (d for d in codes if d % 100 == 0 and payloads[d] is not None):
        for d, c in codes.items():
            other = codes[q]
            if min(len(c), len(other)) < overlap:
                if len(c) == len(other) and payloads[d] is not None and ((c == other).all() if len(c) else payloads[d] == payloads[q]):
                    out.add((d, q))
                continue
            for shift in range(overlap - len(other), len(c) - overlap + 1):
                a, b = max(0, shift), min(len(c), len(other) + shift)
                if np.bitwise_count(c[a:b] ^ other[a - shift : b - shift]).mean() / 32 <= errors:
                    out.add((d, q))
                    break
    return out


def test_all_queries_and_all_partners(spark):
    rng = np.random.default_rng(5)
    x = tune(rng, 9000)
    one, two = as_pcm(x, rng, 0.02), as_pcm(x, rng, 0.05)
    short, tiny, flat = as_pcm(tune(rng, 1000), rng, 0.02), b"hello", b"x" * 4000
    rows = [(100, one), (200, two), (300, one), (301, one), (400, short), (401, short), (500, tiny), (501, tiny), (502, b"hullo"), (600, flat), (601, flat), (700, None), (701, None), (800, b""), (801, b""), (501, short)]
    codes = audio.fingerprints(spark.createDataFrame(rows, "doc_id long, media binary"))
    want = [(d, q) for d in (100, 200, 300, 301) for q in (100, 200, 300)]
    want += [(400, 400), (401, 400), (501, 400), (500, 500), (501, 500), (600, 600), (601, 600), (800, 800), (801, 800)]
    for block in (1_000_000, 300):
        found = audio.align(codes, F.col("doc_id") % 100 == 0, block=block)
        assert found.count() == len(rows)
        got = [(r.doc_id, r.query) for r in audio.pairs(audio.by_class(found)).collect()]
        assert sorted(got) == sorted(want)


def test_recall_on_pairs_over_all_queries(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.col("text").alias("media"))
    payloads = {r.doc_id: r.media for r in docs.collect()}
    codes = {r.doc_id: np.array(r.codes, np.int32) for r in audio.fingerprints(docs).collect()}
    want = brute_pairs(codes, payloads)
    got = {(r.doc_id, r.query) for r in audio.pairs(queries.op2_audio(spark, SF)).collect()}
    queried = {d for d in codes if d % 100 == 0}
    assert {q for _, q in got} == queried == {d for d, q in got if d == q}
    assert got <= want and len(got) >= 0.9 * len(want)
