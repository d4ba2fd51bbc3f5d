import random

import numpy as np
import pytest

from phylospark.llm import pieces, queries

SF = "/root/testdata/sf0.001"
PATH = queries.tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(n=300):
    rnd = random.Random(9)
    words = ["the", "of", "Ciónarcill", "thing", "édiño", "xyzzy", "日本", "😀", "tion", "  ", "\n", "A$$$", "naïve", "0123", "...", "🤷‍♀️é", "   ", " " * 9, "z" * 11, "////"]
    return [rnd.choice(["", " "]).join(rnd.choice(words) for _ in range(rnd.randint(0, 12))) for _ in range(n)] + ["", " ", "  a  b ", "a", " " * 61, "ab" * 300, "\t\t"]


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_ids_are_the_librarys(library):
    p = pieces.pieces(PATH)
    for t in texts(2000):
        assert ids_of(p.encode(t)) == library.encode(t), t
        assert p.decode(p.encode(t)) == t


def test_ids_of_given_documents_are_the_librarys(spark, library):
    rows = pieces.encode(spark.read.parquet(f"{SF}/documents.parquet"), PATH, chunk=1000).collect()
    assert len(rows) >= 200
    for r in rows:
        assert ids_of(bytes(r.ids)) == library.encode(r.text or "")


def test_neighbours_stay_apart_as_the_library_says(library):
    p = pieces.pieces(PATH)
    rnd = random.Random(4)
    names = [x for x in p.table if not x.startswith("▁")]
    pairs = [(rnd.choice(names), rnd.choice(names)) for _ in range(3000)]
    pairs += [(x[:k], x[k:]) for x in rnd.sample(names, 500) for k in range(1, len(x)) if x[:k] in p.table and x[k:] in p.table]
    got = p.stay_apart(np.array([p.table[a] for a, _ in pairs]), np.array([p.table[b] for _, b in pairs]))
    want = [library.encode("▁" + a + b)[-1:] == [p.table[b]] for a, b in pairs]
    # a piece before the pair may take from its left side, never the other way round
    assert sum(g != w for g, w in zip(got, want)) < 0.2 * len(pairs)
    for (a, b), apart in zip(pairs, got):
        assert apart == (p.path(a + b) == np.array([p.table[a], p.table[b]], "<u4").tobytes())


@pytest.mark.parametrize("chunk, fan", [(40, 256), (7, 4), (3, 4)])
def test_chunks_equal_the_whole(spark, library, monkeypatch, chunk, fan):
    monkeypatch.setattr(pieces, "FAN", fan)
    rnd = random.Random(10)
    docs = [(i, t) for i, t in enumerate(texts(60))] + [(900, None), (901, "x" * 300), (902, "".join(rnd.choice("abtheinr") for _ in range(400))), (903, texts(9)[3] * 9), (903, texts(9)[3] * 9), (None, "the thing " * 30), (None, "other thing " * 30), (904, "日本語の文章です" * 20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as k", "2 as n", "3 as ids")
    got = sorted(((r.doc_id, r.text, ids_of(bytes(r.ids))) for r in pieces.encode(frame, PATH, chunk=chunk).collect()), key=str)
    assert got == sorted(((d, t, library.encode(t or "")) for d, t in docs), key=str)


def test_matrices_are_associative_and_resolve():
    p, rnd = pieces.pieces(PATH), random.Random(1)
    text = p.plain("".join(rnd.choice(["the", "tion", "ing", "日本", "an", "q"]) for _ in range(60)))
    size = 9
    parts = [(text[a - min(p.reach, a) : a + size + p.reach - 1], min(p.reach, a), min(size, len(text) - a)) for a in range(0, len(text), size)]
    of = [p.matrix(*x) for x in parts]
    left = pieces.compose([pieces.compose(of[:5]), pieces.compose(of[5:])])
    right = pieces.compose([pieces.compose(of[:2]), pieces.compose(of[2:9]), pieces.compose(of[9:])])
    whole = lambda m: set(zip(m[0].tolist(), m[1].tolist()))
    assert whole(left) == whole(right) == whole(pieces.compose(of))
    states = pieces.resolve(of, 0, None)
    assert b"".join(p.backtrace(*x, *s) for x, s in zip(parts, states)) == p.path(text)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op7_pieces(spark, SF).collect()
    assert len(got) == docs.count() and all(r.round_trip for r in got)
    assert pieces.encode(docs.limit(0), PATH).count() == 0
