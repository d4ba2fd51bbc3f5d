import random
import re

from phylospark.llm import licenses

SF = "/root/testdata/sf0.01"


def shingles(text):
    w = [x for x in re.split(r"[\x00-/:-`{-\x7f]+", (text or "").lower()) if x]
    return [tuple(w[i : i + 3]) for i in range(len(w) - 2)]


def brute(docs, templates, more=0):
    """Best containment in stretches of the template's length, and ``more`` shingles, of those with 0.8 or more."""
    out = {}
    for d, t in docs:
        sh = shingles(t)
        for name, said in templates:
            known = set(shingles(said))
            n = len(shingles(said)) + more
            best = max((len(known & set(sh[i : i + n])) / len(known) for i in range(max(1, len(sh) - n + 1))), default=0) if sh else 0
            if best >= 0.8:
                out[d, name] = max(out.get((d, name), 0), best)
    return out


def test_planted_notices(spark):
    rnd = random.Random(8)
    say = lambda k: " ".join(rnd.choice("lorem ipsum dolor sit amet under license the of é".split()) for _ in range(k))
    docs = []
    for d in range(150):
        name, notice = rnd.choice(licenses.TEMPLATES)
        words = notice.split()
        if d % 3 == 1 and len(words) > 24:
            words[rnd.randrange(len(words))] = "changed"
        if d % 3 == 2:
            words = words[::2]
        docs.append((d, say(rnd.randint(0, 200)) + "\n" + " ".join(words) + "\n" + say(rnd.randint(0, 100))))
    docs += [(500, None), (501, ""), (502, "MIT License"), (503, docs[0][1]), (503, docs[0][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.license): r.containment for r in licenses.scan(frame).collect()}
    want = brute(docs, licenses.TEMPLATES)
    # the stretch that is verified is up to four steps longer than the template
    wide = brute(docs, licenses.TEMPLATES, 32)
    assert set(got) <= set(wide) and all(0.8 <= got[k] <= wide[k] + 1e-9 for k in got)
    assert len(set(want) - set(got)) <= 0.01 * len(want)
    assert sum(d % 3 == 0 for d, _ in want) >= 50
    assert licenses.scan(frame.limit(0)).count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {(r.doc_id, r.license) for r in licenses.scan(docs).collect()}
    lines = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Released under the MIT License.": "MIT"}
    want = {(r.doc_id, n) for r in docs.collect() for s, n in lines.items() if s in r.text}
    assert len(want) > 10 and len(want - got) <= max(1, 0.02 * len(want))


def test_long_texts_and_clashing_columns(spark):
    notice = licenses.TEMPLATES[1][1]
    rows = [(1, "word " * 200_000 + notice + " tail" * 1000, 5, 6), (2, "", 5, 6), (None, notice, 5, 6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, license int, doc int")
    got = {(r.doc_id, r.license, r.first_word) for r in licenses.scan(frame).collect()}
    assert {(1, "Apache-2.0", 200_000), (None, "Apache-2.0", 0)} <= got and all(d != 2 for d, _, _ in got)


def test_whole_texts(spark):
    """A whole text with a few changed words, at any place; half of one is no match of the whole."""
    rnd = random.Random(11)
    say = lambda k: " ".join(rnd.choice("lorem ipsum dolor sit amet software the of".split()) for _ in range(k))
    whole = [(n, t) for n, t in licenses.TEMPLATES if len(t.split()) > 60]
    assert {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Zlib", "BSL-1.0", "Unlicense", "Apache-2.0", "GPL-3.0"} <= {n for n, _ in whole}
    docs = []
    for i, (_, said) in enumerate(whole):
        for j in range(4):
            w = said.split()
            for _ in range(j):
                w[rnd.randrange(len(w))] = "changed"
            docs.append((10 * i + j, say(rnd.randint(0, 90)) + "\n/* " + "\n * ".join(w) + " */\n" + say(30)))
        docs.append((10 * i + 5, " ".join(said.split()[: len(said.split()) // 2])))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.license): r.containment for r in licenses.scan(frame, whole).collect()}
    assert set(brute(docs, whole)) <= set(got) <= set(brute(docs, whole, 32))
    for i, (name, _) in enumerate(whole):
        assert got[10 * i, name] == 1.0 and {(10 * i + j, name) for j in range(4)} <= set(got) and (10 * i + 5, name) not in got
