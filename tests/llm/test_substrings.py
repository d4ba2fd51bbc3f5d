import hashlib
import random
from collections import Counter

import pytest

from phylospark.llm import queries, substrings

SF = "/root/testdata/sf0.001"


def brute(docs, length):
    raw = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(b[i : i + length] for _, b in raw for i in range(len(b) - length + 1))
    out = []
    for d, b in raw:
        gone = [False] * len(b)
        until = 0
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                for k in range(max(i, until), i + length):
                    gone[k] = True
                until = i + length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(frame, length=400):
    got = substrings.remove_repeats(frame, length).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("length", [40, 400])
def test_planted_repeats(spark, length):
    rnd = random.Random(length)
    say = lambda k: "".join(rnd.choice("abcdefghij é") for _ in range(k))
    pool = [say(length - 60 + rnd.randint(20, 400)) for _ in range(12)] + ["ab" * length, "x" * (2 * length)]
    docs = []
    for d in range(80):
        parts = [say(rnd.randint(0, 300))]
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(pool)
            a, b = rnd.randint(0, 60), len(p) - rnd.randint(0, 60)
            parts += [p[a:b], say(rnd.choice([0, 1, 50]))]
        docs.append((d, "".join(parts)))
    docs += [(100, docs[3][1]), (101, docs[3][1]), (101, docs[3][1]), (102, None), (None, docs[5][1]), (None, docs[5][1] + "!"), (103, ""), (104, "a" * (length - 1)), (105, "q" * length), (106, "w" * (length + 1))]
    want = brute(docs, length)
    assert sum(r[2] for r in want) > 5000
    assert result(spark.createDataFrame(docs, "doc_id long, text string"), length) == want


def test_given_documents(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    rows = queries.op1_substrings(spark, SF).collect()
    got = sorted((tuple(r)[:-1] for r in rows), key=str)
    assert got == brute(docs, 400)
    texts = dict(docs)
    for r in rows:
        assert r.text == (texts[r.doc_id] or "") if not r.n_removed else len(r.text.encode("utf-8")) <= 3 * (r.n_bytes - r.n_removed)
    assert result(frame.limit(0)) == []


def test_repeats_at_the_cuts_of_a_long_text(spark):
    rnd = random.Random(8)
    say = lambda k: "".join(rnd.choice("abcdefghij ") for _ in range(k))
    length, piece = 40, 2048
    text = say(9 * piece)
    docs = [(0, text)]
    for cut in range(piece, 9 * piece, piece):  # passages that hold the windows on both sides of a cut
        a, b = cut - rnd.randint(1, 25), cut + length + rnd.randint(1, 25)
        docs.append((cut, say(30) + text[a:b] + say(30)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = substrings.remove_repeats(frame, length, piece_bytes=piece).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, length)
