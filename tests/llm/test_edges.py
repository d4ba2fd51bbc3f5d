"""Rows of every kind through operators whose own tests have ordinary ones."""

import random

import corpus_pipeline as pipe
from pyspark.sql import functions as F
from test_near_and_bench import brute_contamination, brute_simhash

from phylospark.llm import audio, decontaminate, licenses, simhash
from phylospark.llm.common import materialise

SF = "/root/testdata/sf0.001"


def test_clashing_columns_of_audio_and_fingerprints(spark):
    rows = [(1, "one text that says a little", 7), (1, "one text that says a little", 7), (2, None, 7), (3, "", 7), (None, "other", 7)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, codes int").selectExpr("*", "8 AS fp", "9 AS node", "10 AS media_", "11 AS short", "12 AS row", "13 AS own_class", "14 AS least")
    fps = materialise(simhash.fingerprints(frame), "t")
    assert sorted((r.doc_id or 0, r.fp & (2**64 - 1)) for r in fps.collect()) == sorted((d or 0, brute_simhash(t)) for d, t, _ in rows)
    assert sorted((r.doc_id or 0, r.component_id) for r in simhash.near_components(fps).collect()) == [(0, None), (1, 1), (1, 1), (2, 2), (3, 2)]
    sound = frame.withColumn("media", F.encode("text", "UTF-8"))
    found = audio.align(audio.fingerprints(sound), F.col("doc_id") == 1).collect()
    assert len(found) == 5 and [r.n_matches for r in found if r.doc_id == 1] == [2, 2]


def test_very_long_texts(spark):
    rnd = random.Random(5)
    long = " ".join(rnd.choice(["alpha", "beta", "Gamma,", "dé"]) for _ in range(300_000))
    item = " ".join(f"word{k}" for k in range(20))
    docs = [(1, long + " " + item), (2, long + " " + item), (3, item)]
    bench = [(5, item)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontaminate.contamination(frame, spark.createDataFrame(bench, "item_id long, text string"))
    assert sorted(tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()) == brute_contamination(docs, bench)
    fps = {r.doc_id: r.fp & (2**64 - 1) for r in simhash.fingerprints(frame).collect()}
    assert fps == {d: brute_simhash(t) for d, t in docs}


def test_templates_of_equal_worth(spark):
    said = "this notice shall be included in all copies of the work that are given away"
    docs = spark.createDataFrame([(1, f"before {said} between {said} after"), (2, "nothing of it")], "doc_id long, text string")
    found = licenses.scan(docs, [("A", said), ("B", said), ("A", said)]).collect()
    assert sorted((r.doc_id, r.license, r.containment, r.first_word) for r in found) == [(1, "A", 1.0, 1), (1, "B", 1.0, 1)]


def test_pipeline_of_no_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in pipe.STAGES:
        docs = materialise(stage(spark, docs, SF), f"empty-{name}")
        assert docs.count() == 0
