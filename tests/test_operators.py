"""Hand-made rows for the rules that decide correctness."""

import random
from collections import Counter
from itertools import combinations

import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from phylospark import functions as fn
from phylospark import sources
from phylospark.operators import alignment, clusters, coding, counts, genotypes, intervals, introgression, ortho, reads, stats, trees


def one(spark, column, **values):
    return spark.createDataFrame([Row(**values)]).select(column.alias("x")).first().x


ALN = "locus string, ord long, seq_id string, seq string"


def test_site_filter(spark):
    rows = spark.createDataFrame([("L", 1, "a", "ACG-T"), ("L", 2, "b", "ACGAT"), ("L", 3, "c", "ACNAT"), ("L", 4, "d", "-----")], ALN)
    got = {r.seq_id: r.seq for r in alignment.filter_sites(rows, 0.2).collect()}
    assert got == {"a": "ACT", "b": "ACT", "c": "ACT"}


def test_informative_sites_and_metrics(spark):
    rows = spark.createDataFrame([("L", i, s, q) for i, (s, q) in enumerate([("a", "AA"), ("b", "AA"), ("c", "CA"), ("d", "CC")])] + [("M", 9, "a", "ACG")], ALN)
    got = {r.locus: r for r in alignment.locus_metrics(rows).collect()}
    assert got["L"].informative_sites == 1 and got["L"].taxon_count == 4 and got["M"].missing_ratio == 0.75
    report = {(r.locus, r.metric, r.threshold): r.status for r in alignment.threshold_report(alignment.locus_metrics(rows)).collect()}
    assert report["L", "missing_ratio", "0p1"] == "PASS" and report["M", "missing_ratio", "0p2"] == "FAIL" and report["L", "avg_support", "60p0"] == "FAIL"


def test_matrices(spark):
    rows = spark.createDataFrame([("L1", 1, "x", "AC"), ("L1", 2, "y", "AG"), ("L2", 3, "x", "T")], ALN)
    assert {r.seq_id: r.seq for r in alignment.supermatrix(rows).collect()} == {"x": "ACT", "y": "AG?"}
    assert {r.seq_id: r.seq for r in alignment.intersection_matrix(rows).collect()} == {"x": "ACT"}
    parts = alignment.partitions(spark.createDataFrame([("L1", 2), ("L2", 1)], "locus string, length long"))
    assert [(r.first, r.last) for r in parts.orderBy("locus").collect()] == [(1, 2), (3, 3)]


def test_outlier_pruning(spark):
    rows = spark.createDataFrame([("L", 1, "a", "A-C"), ("L", 2, "b", "ATC"), ("M", 1, "a", "A")], ALN)
    leaves = spark.createDataFrame([("L", "a"), ("L", "b"), ("M", "z")], "locus string, leaf string")
    gone = spark.createDataFrame([("L", "b")], "locus string, seq_id string")
    assert [(r.seq_id, r.seq) for r in alignment.prune_outliers(rows, leaves, gone).collect()] == [("a", "AC")]


def test_sequence_functions(spark):
    x = lambda column, **v: one(spark, column, **v)
    assert [x(fn.gene_of_isoform("s"), s=s) for s in ("a_g1_i2", "a_b")] == ["a_g1", "a"]
    assert x(fn.gene_of_isoform("s"), s="zz") is None
    assert x(fn.back_translate("p", "c"), p="M-K*", c="ATGAAATAA") == "ATG---AAA---"
    assert x(fn.codon_positions("s"), s="ATGCCA") == ["AC", "TC", "GA"]
    assert [x(fn.iupac_code(F.split("s", "")), s=s) for s in ("AG", "A", "CGT", "AX")] == ["R", "A", "B", "N"]
    assert x(fn.reverse_complement(fn.reverse_complement("s")), s="ACGTNN-a") == "ACGTNN-a"
    assert x(fn.translate_codons("s"), s="ATGAAATAANNNA") == "MK*X"
    assert x(fn.wrap("s", 3), s="ABCDEFG") == "ABC\nDEF\nG"
    assert x(fn.triplet_parts("s", F.split("l", ",")), s="a_b_c_d", l="a_b,c,d,a") == ["a_b", "c", "d"]
    assert x(fn.taxon_name("s"), s="1 a-b") == "T1_a_b"
    assert x(fn.threshold_label("s"), s=0.1) == "0p1"
    assert x(fn.file_number("s"), s="ortho12.fa") == 12.0 and x(fn.file_number("s"), s="x") == float("inf")
    assert x(fn.unescape("s"), s="a%20b+c") == "a b+c"
    h = x(fn.orf_header("s"), s="g1 type:complete len:120 (+) contig7:10-372(+)")
    assert (h.length, h.strand, h.contig, h.start, h.stop) == (120, "+", "contig7", 10, 372)


def test_trimming(spark):
    t = one(spark, fn.trim_quality("s", "q"), s="A" * 60, q="I" * 50 + "#" * 10)
    assert t.seq == "A" * 42 and t.qual == "I" * 42  # the low tail and the head go
    t = one(spark, fn.trim_quality("s", "q"), s="A" * 70, q="I" * 50 + "$" * 10 + "I" * 10)
    assert len(t.seq) == 49 - 8  # the first low window starts at the last but one good base
    assert one(spark, fn.trim_quality("s", "q"), s="A" * 30, q="I" * 30) is None
    pairs = spark.createDataFrame([("r", 1, "A" * 50, "I" * 50), ("r", 2, "A" * 20, "I" * 20), ("s", 1, "A" * 50, "I" * 50), ("s", 2, "A" * 50, "I" * 50)], "read_id string, mate int, seq string, qual string")
    assert {r.read_id for r in reads.trim(pairs).collect()} == {"s"}


def test_orthologs(spark):
    rows = spark.createDataFrame([(1, 0.5, "s", "g1", 1), (1, 0.5, "s", "g2", 2), (2, 0.5, "s", "g1", 1), (2, 0.5, "s", "g2", 2), (2, 0.5, "s", "g3", 3)], "group_id long, alg_conn double, species string, gene_id string, ord long")
    lengths = spark.createDataFrame([("s", "g1", 5), ("s", "g2", 7)], "species string, gene_id string, length int")
    assert {r.group_id for r in ortho.keep_groups(rows, 1).collect()} == {1}
    assert {r.group_id: r.gene_id for r in ortho.longest_copy(rows, lengths).collect()}[1] == "g2"
    wide = spark.createDataFrame([("2", "3", "0.5", "a,b", "*", "c")], "`# Species` string, Genes string, `Alg.-Conn.` string, x string, y string, z string")
    assert sorted((r.species, r.gene_id) for r in ortho.unpivot_groups(wide, ["# Species", "Genes", "Alg.-Conn."]).collect()) == [("x", "a"), ("x", "b"), ("z", "c")]


def test_intervals(spark):
    rows = spark.createDataFrame([("c", i, s, e, i) for i, (s, e) in enumerate([(1, 10), (5, 20), (15, 16), (21, 30), (30, 31)])], "contig string, id long, start long, end long, ord long")
    assert sorted((r.start, r.end) for r in intervals.nonoverlapping(rows).collect()) == [(1, 10), (21, 30)]
    nest = spark.createDataFrame([("c", 1, 100), ("c", 10, 90), ("c", 1, 50)], "contig string, start long, end long")
    assert sorted((r.start, r.end) for r in intervals.not_eclipsed(nest).collect()) == [(1, 50), (1, 100)]
    exons = spark.createDataFrame([("t", "c", "-", 100, 109), ("t", "c", "-", 200, 204)], "transcript string, contig string, strand string, start long, end long")
    points = spark.createDataFrame([("t", 1), ("t", 6), ("t", 15), ("t", 16)], "transcript string, pt long")
    assert {r.pt: r.genome_pos for r in intervals.lift(points, exons).collect()} == {1: 204, 6: 109, 15: 100}
    best = intervals.greedy(rows, "contig", [-(F.col("end") - F.col("start")), F.col("id")], None)
    assert sorted(r.id for r in best.collect()) == [1, 3]


def test_coding(spark):
    pts = spark.createDataFrame([("x", 0.5, 1.0)], "category string, fpr double, tpr double")
    assert coding.auc(pts).first().auc == 0.75
    cds = spark.createDataFrame([("a", "ATGTAA"), ("b", "ATGATG")], "orf_id string, seq string")
    got = {(r.kmer, r.frame): r.n for r in coding.framed_kmers(cds, 3).collect()}
    assert got["ATG", 2] == 3 and got["A", 0] == 3 and ("TAA", 2) not in got
    orfs = coding.orfs(spark.createDataFrame([("t", "ATG" + "AAA" * 5 + "TAA" + "CC")], "seq_id string, seq string"), 5)
    assert ("+", 0, "MKKKKK", "complete") in {(r.strand, r.frame, r.protein, r.kind) for r in orfs.collect()}
    ssr = coding.repeats(spark.createDataFrame([("t", "C" + "A" * 12 + "G" + "AT" * 7)], "seq_id string, seq string"))
    assert sorted((r.unit, r.copies) for r in ssr.collect()) == [("A", 12), ("AT", 7)]


def test_consensus(spark):
    schema = "contig string, start long, stop long, ref string, alts array<string>, sample string, gt array<int>, gq int, dp int, ord long"
    rows = [("c", 0, 1, "A", ["G"], "s", [0, 0], 50, 9, 1), ("c", 1, 2, "C", ["T"], "s", [0, 1], None, 3, 2), ("c", 2, 3, "G", ["T"], "s", [0, 1], 19, 9, 3), ("c", 3, 4, "T", ["A"], "s", [1, 1], 50, 9, 4)]
    ref = spark.createDataFrame([("c", 4)], "contig string, length long")
    whole = genotypes.contig_sequences(genotypes.consensus(spark.createDataFrame(rows, schema), ref, 3))
    assert whole.first().seq == "AYNA"


def test_ages(spark):
    ages = spark.createDataFrame([("s", 80.0), ("s", 5.0), ("s", 81.0)], "sample string, age double")
    assert sorted(r.bin for r in stats.histogram(ages).collect()) == [1, 48]
    mix = stats.mixtures(spark.createDataFrame([("s", float(v)) for v in [*range(10), *range(100, 110)]], "sample string, age double")).first()
    assert mix.k == 2 and abs(mix.means[0] - 4.5) < 0.1 and abs(mix.means[1] - 104.5) < 0.1


def test_trees(spark):
    make = lambda *t: spark.createDataFrame([(str(i), x) for i, x in enumerate(t)], "tree_id string, newick string")
    ref, corpus = trees.nodes(make("((a,b),c);")), trees.nodes(make("((a,b),c);", "((a,c),b);"))
    assert {tuple(r.clade): r.percent for r in trees.clade_support(ref, corpus).collect()} == {("a", "b"): 50.0, ("a", "b", "c"): 100.0}
    conflict = {tuple(r.clade): r.conflicting for r in trees.clade_conflict(ref, corpus).collect()}
    assert conflict == {("a", "b"): 1, ("a", "b", "c"): 0}
    dup = trees.duplication_ages(trees.nodes(make("(s1++g1:7,(s1++g2:3,s2++g3:3):4);")))
    assert [(r.species, r.age) for r in dup.collect()] == [("s1", 7.0)]
    pruned = trees.prune(make("((a:1,b:2):1,(c:1,d:1):2);"), ["a", "c", "d"]).first().newick
    assert pruned == "(a:2,(c:1,d:1):2);"
    rooted = trees.reroot(make("((a:1,b:2):1,(c:1,d:1):2);"), ["a"]).first().newick
    n = trees.nodes(spark.createDataFrame([("x", rooted)], "tree_id string, newick string"))
    assert {tuple(r.leaves) for r in n.where("parent_id = 0").collect()} == {("a",), ("b", "c", "d")}
    assert trees.write(trees.parse("('it''s':1,[note]b)x:2;")) == "('it''s':1,b)x:2;"
    status = {r.tree_id: r.status for r in trees.root_by_outgroup(make("((o++1,x++1),(y++1,z++1));", "(x++1,y++1);", "((", "((o++1,x++1),(o++2,y++1));"), ["o"]).collect()}
    assert status == {"0": "success", "1": "all_non_outgroup_no_outgroup", "2": "parse_error", "3": "non_outgroup_not_monophyletic"}
    order = {r.tree_id: r.status for r in trees.root_by_order(make("((o++1,x++1),(y++1,z++1));", "(o++1,o++2);"), [["o"], ["x", "y", "z"]]).collect()}
    assert order == {"0": "success", "1": "no_ingroup_gene"}
    branches = introgression.triplet_branches(trees.pair_depths(trees.nodes(make("((a:1,b:1):2,c:3);"))))
    assert [(r.triplet, r.outgroup, r.branch) for r in branches.collect()] == [("a_b_c", "c", 2.0)]


def test_clusters(spark):
    seqs = spark.createDataFrame([("a", "ACGTACGGTCAGT" * 6), ("b", "ACGTACGGTCAGT" * 5), ("c", "TTTTGGGGCCCCAAAATGCATT" * 3)], "seq_id string, seq string")
    assert {r.seq_id for r in clusters.greedy_representatives(seqs).collect()} == {"a", "c"}
    assert {r.seq_id: r.cluster for r in clusters.near_identical(seqs).collect()} == {"a": "a", "b": "a", "c": "c"}


def _sets(rows, k, step):
    return {i: {s[a : a + k] for a in range(0, len(s) - k + 1, step)} for i, s in rows if s is not None}


def _families(seed, n):
    rnd = random.Random(seed)
    say = lambda m: "".join(rnd.choice("abcdefgh ") for _ in range(m))
    base, rows = [say(rnd.randint(40, 400)) for _ in range(6)], []
    for i in range(n):
        s = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 5, 40])):
            s[rnd.randrange(len(s))] = rnd.choice("xyz")
        rows.append((f"s{i:03}", "".join(s[: rnd.choice([len(s), len(s), len(s) // 2])])))
    return rows + [("t1", ""), ("t2", "abc"), ("t3", "abc"), ("t4", None), ("t5", "abcde"), ("t6", "abcde")]


def test_near_identical_equals_brute_force(spark):
    rows, k, identity = _families(1, 90), 5, 0.95
    kmers = _sets(rows, k, 1)
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    text = dict(rows)
    for a in text:
        for b in text:
            both = text[a] is not None and text[a] == text[b]
            if a < b and (both or (kmers.get(a) and kmers.get(b) and len(kmers[a] & kmers[b]) >= identity**k * min(len(kmers[a]), len(kmers[b])))):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = {r.seq_id: r.cluster for r in clusters.near_identical(spark.createDataFrame(rows, "seq_id string, seq string"), k, identity).collect()}
    assert got == {i: root(i) for i in text}
    assert 1 < len(set(got.values())) < len(got) - 20


def test_greedy_representatives_equal_the_sequential_pass(spark):
    rows = _families(2, 90)
    query, target, kept = _sets(rows, 5, 5), _sets(rows, 5, 1), []
    for i, s in sorted(rows, key=lambda r: (-len(r[1] or ""), r[0])):
        if not query.get(i) or all(len(query[i] & target[j]) <= 0.8 * len(query[i]) for j in kept if target.get(j)):
            kept.append(i)
    got = {r.seq_id for r in clusters.greedy_representatives(spark.createDataFrame(rows, "seq_id string, seq string")).collect()}
    assert got == set(kept) and len(got) < len(rows) - 15


def test_greedy_pass_over_a_long_chain(spark):
    n = 24  # more items in a row than a few rounds would decide
    items = spark.range(n)
    against = spark.range(1, n).selectExpr("id AS later", "id - 1 AS earlier")
    assert sorted(r.id for r in clusters.greedy_kept(items, against).collect()) == list(range(0, n, 2))


def test_greedy_intervals_equal_the_sequential_pass(spark):
    rnd = random.Random(5)
    rows = [("t" + str(rnd.randint(0, 3)), i, a, a + rnd.randint(0, 60)) for i in range(120) for a in [rnd.randint(1, 400)]]
    frame = spark.createDataFrame(rows, "t string, id long, start long, end long")
    for share in (0.1, None):
        want = []
        for t, i, a, b in sorted(rows, key=lambda r: (r[2] - r[3], r[1])):
            both = lambda x: min(b, x[3]) - max(a, x[2]) + 1  # noqa: B023, E731
            limit = lambda x: 0 if share is None else share * min(b - a + 1, x[3] - x[2] + 1)  # noqa: B023, E731
            if not any(x[0] == t and both(x) > 0 and both(x) > limit(x) for x in want):
                want.append((t, i, a, b))
        got = intervals.greedy(frame, "t", [F.col("start") - F.col("end"), F.col("id")], share, bin_size=50)
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_running_numbers_over_ranges(spark, monkeypatch):
    from phylospark.operators import places

    monkeypatch.setattr(places, "RANGES", 7)
    rows = spark.createDataFrame([(f"k{i:04}", i % 5) for i in random.Random(1).sample(range(3000), 3000)], "k string, v int")
    got = places.running_sum(places.with_place(rows, "k"), "k", F.col("v"), "total").orderBy("k").collect()
    total = 0
    for i, r in enumerate(got):
        total += r.v
        assert (r["__place"], r.total) == (i + 1, total)
    assert places.with_place(rows.limit(0), "k").count() == 0


def test_mixture_candidates_are_all_values(spark):
    rnd = random.Random(3)
    rows = [("a_b_c", "c", rnd.expovariate(1.0) + (3 if i % 3 == 0 else 0)) for i in range(150)]
    got = introgression.fit_mixtures(spark.createDataFrame(rows, "triplet string, outgroup string, branch double"), rounds=20).first()
    assert got["count"] == 150 and got.BIC2Dist < got.BIC1Dist


def test_rerooting_rules(spark):
    make = lambda *t: spark.createDataFrame([(str(i), x) for i, x in enumerate(t)], "tree_id string, newick string")
    # one outgroup gene within the in-group's clade is dropped; two are not
    one, two = "((x++1,(o++1,y++1)),(o++2,o++3));", "((x++1,(o++1,(y++1,o++4))),(o++2,o++3));"
    got = {r.tree_id: (r.status, r.newick) for r in trees.root_by_outgroup(make(one, two), ["o"]).collect()}
    assert got["0"][0] == "success_after_drop_one_outgroup" and "o++1" not in got["0"][1]
    assert got["1"] == ("non_outgroup_not_monophyletic", None)
    # the in-group is the last step whatever step roots the tree; the first gene wins ties
    tree = "((p++1,(q++1,z++1)),((p++2,z++2),q++2));"
    rooted = trees.root_by_order(make(tree), [["p"], ["q"], ["z"]]).first()
    nodes = trees.nodes(spark.createDataFrame([("x", rooted.newick)], "tree_id string, newick string"))
    assert rooted.status == "success" and {tuple(r.leaves) for r in nodes.where("parent_id = 0").collect()} >= {("p++1",)}


def test_gathered_and_paired(spark):
    rows = spark.createDataFrame([("s2", "g", "A"), ("s1", "g", "C"), ("s1", "h", "T")], "sample string, gene string, seq string")
    assert sorted((r.locus, r.ord, r.seq_id) for r in genotypes.gather_by_gene(rows).collect()) == [("g", 0, "s1"), ("g", 1, "s2"), ("h", 0, "s1")]
    pep, cds = spark.createDataFrame([("a.pep",), ("b.pep",)], "file string"), spark.createDataFrame([("a.cds",)], "file string")
    assert {(r.family, r.cds) for r in ortho.pair_partners(pep, cds, strict=False).collect()} == {("a", "a.cds"), ("b", None)}
    with pytest.raises(Exception, match="no coding file for b.pep"):
        ortho.pair_partners(pep, cds).collect()


def test_kmers_with_other_letters(spark):
    rows = [("ACGNT",), ("NAC",), ("",), (None,), ("éAC",)]
    want = Counter((s[i - k + 1 : i + 1], i % 3) for (s,) in rows if s for i in range(len(s)) for k in range(1, 4) if i - k + 1 >= 0)
    got = {(r.kmer, r.frame): r.n for r in counts.ending_kmer_counts(spark.createDataFrame(rows, "seq string"), 3).collect()}
    assert got == want


def test_site_counts_equal_brute_force(spark, monkeypatch):
    rnd = random.Random(4)
    rows = [(f"L{i % 3}", "".join(rnd.choice("ACGTacgtN-é") for _ in range(rnd.randint(0, 9000 if i < 3 else 40)))) for i in range(30)]
    want = Counter((locus, p, c.upper()) for locus, s in rows for p, c in enumerate(s, 1) if c in "ACGTacgt")
    got = {(r.locus, r.pos): (r.A, r.C, r.G, r.T) for r in counts.base_counts(spark.createDataFrame(rows, "locus string, seq string").repartition(5)).collect()}
    assert len(got) == sum(max(len(s) for x, s in rows if x == locus) for locus in ("L0", "L1", "L2"))
    assert all(v == tuple(want[locus, p, b] for b in "ACGT") for (locus, p), v in got.items())


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.fa").write_text(">a one\nACG\nT\n>b\nGG\n>a two\nTTT\n")
    got = {r.seq_id: r.seq for r in sources.read.fasta(spark, str(tmp_path / "in")).collect()}
    assert got == {"a": "TTT", "b": "GG"}
    (tmp_path / "v.vcf").write_text("##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\nc\t5\t.\tA\tG,<NON_REF>\t.\t.\t.\tGT:GQ:DP\t0/1:30:9\t./.\n")
    rows = {r.sample: r for r in sources.read.vcf(spark, str(tmp_path / "v.vcf")).collect()}
    assert rows["s1"].gt == [0, 1] and rows["s1"].gq == 30 and rows["s1"].start == 4 and rows["s2"].gt == [None, None]
    (tmp_path / "g.gtf").write_text('c\tx\texon\t1\t9\t.\t+\t.\tgene_id "g 1"; transcript_id "t";\n')
    assert sources.read.gtf(spark, str(tmp_path / "g.gtf")).first().attrs["transcript_id"] == "t"
    (tmp_path / "g.gff").write_text("#c\nc\tx\tmRNA\t1\t9\t.\t+\t.\tID=m1;Note=type:complete\n")
    assert [r.id for r in intervals.complete_ids(sources.read.gff(spark, str(tmp_path / "g.gff"))).collect()] == ["m1"]
    (tmp_path / "t.nwk").write_text("(a,b);\n\n(c,\nd);")
    assert [r.newick.replace(" ", "") for r in sources.read.newick(spark, str(tmp_path / "t.nwk")).orderBy("tree_id").collect()] == ["(a,b);", "(c,d);"]
    (tmp_path / "cv.txt").write_text("x\nchisq: (10) 3.5\nchisq: (1) 3.5\n")
    assert stats.best_smoothing(sources.read.cv_report(spark, str(tmp_path / "cv.txt"))).first().smooth == 10.0
    (tmp_path / "groups.txt").write_text("a\nb\n==\nc\n")
    assert [(r.clade, r.sample) for r in sources.read.clade_groups(spark, str(tmp_path / "groups.txt")).orderBy("sample").collect()] == [("Clade_1", "a"), ("Clade_1", "b"), ("Clade_2", "c")]
    sources.write.fasta(spark.createDataFrame([(1, "a", "ACGT" * 30)], "ord int, seq_id string, seq string"), str(tmp_path / "out"))
    back = sources.read.fasta(spark, str(tmp_path / "out")).first()
    assert back.seq == "ACGT" * 30
    exons = spark.createDataFrame([("t", "c", "+", 11, 20), ("t", "c", "+", 31, 35)], "transcript string, contig string, strand string, start long, end long")
    assert sources.write.bed12(exons).first().value == "c\t10\t35\tt\t0\t+\t10\t35\t0\t2\t10,5\t0,20"


def test_mixtures_by_ranges_equal_those_in_one_task(spark):
    rnd = random.Random(9)
    rows = [("a_b_c", t, round(rnd.expovariate(1.0) * (1 if t == "c" else 0.01) + (3 if i % 3 == 0 else 0), 4)) for t in ("a", "c") for i in range(130)] + [("a_b_c", "b", 1.0), ("a_b_d", "a", 2.0), ("a_b_d", "a", 2.0), ("a_b_d", "d", 0.0)]
    frame = spark.createDataFrame(rows, "triplet string, outgroup string, branch double")
    fits = [{(r.triplet, r.outgroup): r for r in introgression.fit_mixtures(frame, 3, in_task=k).collect()} for k in (1 << 16, 20)]
    assert set(fits[0]) == set(fits[1]) == {("a_b_c", "a"), ("a_b_c", "c"), ("a_b_d", "a")}
    for key, one in fits[0].items():
        assert all(one[c] == pytest.approx(fits[1][key][c], abs=2e-6 if c != "BIC2Dist" else 2e-4) for c in ("C2", "mixprop2", "lambda2Dist", "lambda1Dist", "BIC1Dist", "BIC2Dist", "count"))


def test_threshold_has_the_highest_expectation(spark):
    import numpy as np

    rnd = random.Random(2)
    x = np.unique([rnd.expovariate(0.7) + (2 if i % 4 == 0 else 0) for i in range(200)])
    w = np.array([float(rnd.randint(1, 4)) for _ in x])
    ll, pi, scale, c = introgression._fit_group(x, w, 1, 0.0005)
    mean = (w * x).sum() / w.sum()
    far = lambda u, c: 0.5 * np.exp(-u) * (1 + np.exp(c))
    near = lambda u, c: np.sinh(u) / np.expm1(c)
    second = lambda u, c: np.where(u >= c, far(u, c), near(u, c))
    r = 0.5 * second(x / mean, 1.0) / (0.5 * np.exp(-x / mean) + 0.5 * second(x / mean, 1.0))
    assert pi == pytest.approx((w * r).sum() / w.sum()) and scale == pytest.approx((w * (1 - r) * x).sum() / (w * (1 - r)).sum())
    u = x / scale
    assert c == pytest.approx(max(u, key=lambda t: (w * r * np.log(np.where(np.arange(len(u)) >= np.searchsorted(u, t), far(u, t), near(u, t)))).sum()))
    assert ll == pytest.approx((w * np.log(((1 - pi) * np.exp(-u) + pi * second(u, c)) / scale)).sum())


def test_age_mixtures_by_sums_equal_those_in_one_task(spark):
    rnd = random.Random(10)
    rows = [(s, round(rnd.gauss(m, 2), 3)) for s, ms in (("x", [10, 40]), ("y", [20]), ("z", [5, 25, 60])) for m in ms for _ in range(80)] + [("one", 7.0), ("same", 3.0), ("same", 3.0), ("x", None)]
    frame = spark.createDataFrame(rows, "sample string, age double")
    fits = [{r["sample"]: r for r in stats.mixtures(frame, in_task=k, rounds=6).collect()} for k in (1 << 16, 0)]
    assert {s: r.k for s, r in fits[0].items()} == {"x": 2, "y": 1, "z": 2, "one": 1, "same": 1}
    for s, one in fits[0].items():
        other = fits[1][s]
        assert (one.n, one.k) == (other.n, other.k) and one.bic == pytest.approx(other.bic, abs=2e-3)
        assert all(a == pytest.approx(b, abs=1e-4) for c in ("weights", "means", "sds") for a, b in zip(one[c], other[c]))


def test_scans_are_carried_over_ranges(spark):
    from phylospark.operators import places

    rnd = random.Random(11)
    rows = [(rnd.choice(["a", "b", None, "hot", "hot", "hot"]), i, rnd.choice([None, rnd.randint(-50, 50)])) for i in range(900)]
    frame = spark.createDataFrame(rows, "g string, k int, v int")
    for own in (True, False):
        got = places.carried(places.in_ranges(frame, ["g", "k"]), ["g"], ["k"], {"s": F.col("v")}, {"m": F.col("v")}, own).collect()
        want = []
        for g in {r[0] for r in rows}:
            seen = []
            for _, k, v in sorted(r for r in rows if r[0] == g) if g else [r for r in rows if r[0] is None]:
                before = [x for x in seen + ([v] if own else []) if x is not None]
                want.append((g, k, v, sum(before), max(before, default=None)))
                seen.append(v)
        assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_intervals_of_one_large_contig(spark):
    rnd = random.Random(12)
    rows = [(rnd.choice(["c", "c", "c", "d"]), i, a, a + rnd.randint(0, 90)) for i in range(400) for a in [rnd.randint(1, 3000)]]
    frame = spark.createDataFrame(rows, "contig string, ord long, start long, end long")
    far, want = {}, []
    for c, i, a, b in sorted(rows, key=lambda r: (r[0], r[2], r[3], r[1])):
        if a > far.get(c, 0):
            want.append(i)
        far[c] = max(far.get(c, 0), b)
    assert sorted(r.ord for r in intervals.nonoverlapping(frame).collect()) == sorted(want)
    outer = [i for c, i, a, b in rows if not any(x[0] == c and x[2] < a and x[3] > b for x in rows)]
    assert sorted(r.ord for r in intervals.not_eclipsed(frame).collect()) == sorted(outer)


def test_rooting_by_outgroup_equals_the_text_version(spark):
    rnd = random.Random(13)

    def tree(leaves):
        if len(leaves) == 1:
            return f"{leaves[0]}:{rnd.randint(1, 9)}"
        k = rnd.randint(1, len(leaves) - 1)
        return f"({tree(leaves[:k])},{tree(leaves[k:])}):{rnd.randint(1, 9)}"

    texts = []
    for i in range(60):
        inner, outer = [f"x++{k}" for k in range(rnd.randint(0, 4))], [f"o++{k}" for k in range(rnd.randint(0, 4))]
        if i % 3:
            rnd.shuffle(inner)
            rnd.shuffle(outer)
            names = inner + outer if i % 2 else outer[1:] + inner[:1] + outer[:1] + inner[1:]
        else:
            names = rnd.sample(inner + outer, len(inner + outer))
        if len(names) > 1:
            texts.append((str(i), tree(names) + ";"))
    texts.append(("bad", "(("))
    frame = spark.createDataFrame(texts, "tree_id string, newick string")
    nodes = trees.nodes(frame)
    want = {r.tree_id: r for r in trees.root_by_outgroup(frame, ["o"]).collect()}
    got = trees.outgroup_statuses(nodes, ["o"], frame)
    assert {r.tree_id: r.status for r in got.collect()} == {k: r.status for k, r in want.items()}
    assert len({r.status for r in want.values()}) == 6
    rooted = trees.nodes(spark.createDataFrame([(k, r.newick) for k, r in want.items() if r.status.startswith("success")], "tree_id string, newick string"))
    same = rooted.where("parent_id is not null").groupBy("tree_id", F.array_sort("leaves").alias("leaves")).agg(F.sum("branch_len").alias("branch_len"))

    def clades(rows):
        """Lengths by clade; both sides of the new root have one kind of genes, and only their total is fixed."""
        out = Counter()
        for r in rows.collect():
            whole = max((x for x in sides[r.tree_id] if set(r.leaves) == x), default=None, key=len)
            out[r.tree_id, "root" if whole else tuple(r.leaves)] += r.branch_len
        return {k: round(v, 6) for k, v in out.items()}

    sides = {r.tree_id: [set(r.inner) - {r.dropped}, set(r.outer) - {r.dropped}] for r in got.collect() if r.inner is not None}
    assert clades(trees.rooted_nodes_by_outgroup(nodes, got)) == clades(same)


def test_rooting_by_order_equals_the_text_version(spark):
    rnd = random.Random(15)

    def tree(leaves):
        if len(leaves) == 1:
            return f"{leaves[0]}:{rnd.randint(1, 9)}"
        k = rnd.randint(1, len(leaves) - 1)
        return f"({tree(leaves[:k])},{tree(leaves[k:])}):{rnd.randint(1, 9)}"

    texts = []
    for i in range(60):
        names = [f"{x}++{k}" for x in ("pqz" if i % 9 else "z") for k in range(3 if not i % 9 else rnd.choice([0, 1, 2, 3]) if i % 4 else rnd.choice([0, 1]))] + ["other++1"] * (i % 2)
        if i % 3:
            rnd.shuffle(names)
        if len(names) > 1:
            texts.append((str(i), tree(names) + ";"))
    frame = spark.createDataFrame([*texts, ("bad", "((")], "tree_id string, newick string")
    nodes, steps = trees.nodes(frame), [["p"], ["q"], ["z"]]
    want = {r.tree_id: r for r in trees.root_by_order(frame, steps).collect()}
    got = trees.order_statuses(nodes, steps, frame)
    assert {r.tree_id: r.status for r in got.collect()} == {k: r.status for k, r in want.items()} and len({r.status for r in want.values()}) == 4
    sides = {r.tree_id: [set(r.out), set(r.all) - set(r.out)] for r in got.collect() if r.out}

    def clades(rows):
        out = Counter()
        for r in rows.collect():
            out[r.tree_id, "root" if set(r.leaves) in sides[r.tree_id] else tuple(r.leaves)] += r.branch_len
        return {k: round(v, 6) for k, v in out.items()}

    rooted = trees.nodes(spark.createDataFrame([(k, r.newick) for k, r in want.items() if r.status == "success"], "tree_id string, newick string"))
    same = rooted.where("parent_id is not null").groupBy("tree_id", F.array_sort("leaves").alias("leaves")).agg(F.sum("branch_len").alias("branch_len"))
    assert clades(trees.rooted_nodes_by_order(nodes, got)) == clades(same)


def test_marked_sites_equal_brute_force(spark):
    rnd = random.Random(14)
    rows = [(f"L{i % 4}", i, f"s{i}", "".join(rnd.choice("ACGT-----é") if i % 4 else "-" for _ in range(rnd.choice([0, 7, 300, 9000])))) for i in range(24)]
    frame = spark.createDataFrame(rows, ALN).repartition(5)
    want = {}
    for locus in ("L1", "L2", "L3"):
        own = [r for r in rows if r[0] == locus]
        sites = [p for p in range(max(len(r[3]) for r in own)) if any(p < len(r[3]) and r[3][p] != "-" for r in own)]
        want |= {r[2]: "".join(r[3][p] if p < len(r[3]) else "-" for p in sites) for r in own}
    assert {r.seq_id: r.seq for r in alignment.filled_sites(frame).collect()} == want
    sites = spark.createDataFrame([("L1", 1), ("L1", 4097), ("L2", 3)], "locus string, pos int")
    picked = {r[2]: "".join((r[3] + "-" * 9000)[p - 1] for p in ([1, 4097] if r[0] == "L1" else [3])) for r in rows if r[0] in ("L1", "L2")}
    assert {r.seq_id: r.seq for r in alignment.select_sites(frame, sites).collect()} == picked


def test_scores_and_profiles_equal_brute_force(spark, monkeypatch):
    rnd = random.Random(16)
    rows = [(i, "".join(rnd.choice("ACGT" if i % 4 else "ACGTN") for _ in range(rnd.choice([0, 1, 3, 5, 40, 700])))) for i in range(40)] + [(99, None)]
    model = [(kmer, f, rnd.uniform(-1, 1)) for kmer in ("A", "C", "AC", "GT", "TTA", "ACG", "GTA", "TAC", "CGT") for f in range(3)]
    lik = {(k, f): v for k, f, v in model}
    frame, kmers = spark.createDataFrame(rows, "orf_id long, seq string"), spark.createDataFrame(model, "kmer string, frame int, loglik double")

    def score(s, f):
        return sum(lik.get((s[max(f, i - 2) : i + 1], (i - f) % 3), 0.0) for i in range(f, len(s)))

    got = {r.orf_id: [r[f"score_{k}"] for k in range(1, 7)] for r in counts.frame_scores(frame, kmers, 2, "orf_id").collect()}
    for i, s in rows:
        back = (s or "").translate(str.maketrans("ACGT", "TGCA"))[::-1]
        assert got[i] == pytest.approx([score(x, f) for x in (s or "", back) for f in range(3)]), i
    for cap in (None, 2):
        for r in counts.profiles(frame, kmers, 2, "orf_id", cap).collect():
            s, seen, want = dict(rows)[r.orf_id] or "", Counter(), []
            for i in range(len(s)):
                own = (s[max(0, i - 2) : i + 1], i % 3)
                seen[own] += 1
                want.append(0.0 if cap and seen[own] > cap else lik.get(own, 0.0))
            assert r.lik == pytest.approx(want) and r.running == pytest.approx([sum(want[: k + 1]) for k in range(len(want))])


def test_best_share_equals_ranks_in_one_window(spark):
    rnd = random.Random(17)
    scores = [rnd.choice([None, 0.5, rnd.randint(0, 9) / 4]) for _ in range(200)]
    frame = spark.createDataFrame(list(enumerate(scores)), "id int, score double")
    known = [(i, x) for i, x in enumerate(scores) if x is not None]
    for share in (0.0, 0.1, 0.3, 1.0):
        rank = {i: sum(y > x for _, y in known) / (len(known) - 1) for i, x in known}
        assert {r.id for r in coding.best_share(frame, "score", share).collect()} == {i for i, r in rank.items() if r <= share}
    assert coding.best_share(frame.limit(0), "score", 0.3).count() == 0


def test_long_branches_of_a_small_tree(spark):
    # a caterpillar with one long leaf; five leaves lose one
    text = "((((a:1,b:1):1,c:1):1,d:1):1,z:50);"
    rows = trees.long_branches(trees.nodes(spark.createDataFrame([("t", text), ("u", "(a:1,b:1);")], "tree_id string, newick string"))).collect()
    # the diameter is 54 (z to a); without z it is 4 (a to d)
    assert [(r.tree_id, r.leaf, r.signature) for r in rows] == [("t", "z", 54 / 4)]


def test_files_of_several_patterns(spark, tmp_path):
    for name in ("a/x.txt", "a/y.txt", "b/x.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("1")
    found = sources.read.file_list(spark, [f"{tmp_path}/a/*", f"{tmp_path}/*/x.txt"]).collect()
    assert sorted("/".join(r.path.split("/")[-2:]) for r in found) == ["a/x.txt", "a/y.txt", "b/x.txt"]


def test_blocks_of_sites(spark):
    rows = spark.createDataFrame([("L", 1, "a", "ACGTACG"), ("L", 2, "b", ""), ("L", 3, "c", "ACG"), ("L", 4, "d", None)], ALN)
    blocks = alignment.site_blocks(rows, 3)
    assert sorted((r.seq_id, r.block, r.first, r.seq) for r in blocks.where("seq is not null").collect()) == [("a", 0, 1, "ACG"), ("a", 1, 4, "TAC"), ("a", 2, 7, "G"), ("b", 0, 1, ""), ("c", 0, 1, "ACG")]
    assert {r.seq_id: r.seq for r in alignment.merged_blocks(blocks.where("seq is not null")).collect()} == {"a": "ACGTACG", "b": "", "c": "ACG"}


class Captured:
    """Stands for a DataFrame and hands out the function that tasks would run."""

    schema = None

    def __init__(self, *columns):
        self.columns = list(columns)

    def drop(self, *_):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        return run


def test_rows_that_grow_leave_in_small_batches():
    import pyarrow as pa

    n, rows = 200_000, 100
    batch = pa.RecordBatch.from_pydict({"locus": ["L"] * rows, "replicate": [1] * rows, "seq": ["ACGT"] * rows, "__n": [n] * rows})
    out = list(counts.resampled(Captured("locus", "replicate", "seq", "__n"), 1)(iter([batch])))
    assert sum(b.num_rows for b in out) == rows and len(set(x for b in out for x in b.column("seq").to_pylist())) == 1
    assert max(b.nbytes for b in out) < 6_000_000


def test_marks_of_many_tasks_are_one_bitmap(spark):
    rows = spark.createDataFrame([("L", i, f"s{i}", "A" * (i % 7) + "-" * 9) for i in range(64)] + [("M", 0, "x", "-" * 5000 + "C")], ALN).repartition(8)
    marks = {r.locus: r.marks for r in counts.marked_sites(rows).collect()}
    assert [m.block for m in marks["L"]] == [0] and sorted(m.block for m in marks["M"]) == [0, 1]
    out = {(r.locus, r.seq_id): r.seq for r in alignment.filled_sites(rows).collect()}
    assert out["L", "s3"] == "AAA---" and out["L", "s0"] == "------" and out["M", "x"] == "C" and len(out) == 65


def test_greedy_passes_keep_what_one_pass_keeps_and_list_no_pairs(spark, tmp_path, monkeypatch):
    import os

    paths = []
    monkeypatch.setattr(clusters, "shared_path", lambda _, name: paths.append(f"{tmp_path}/{name}-{len(paths)}") or paths[-1])
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abcdé") for _ in range(60)) for _ in range(12)]
    rows = [(f"s{i:03}", rnd.choice(base)[rnd.randrange(9) : 60 - rnd.randrange(9)]) for i in range(120)] + [("t1", "abc"), ("t2", None), ("t3", "")]
    seqs = {}
    for i, s in rows:
        if s is not None and len(s) >= 5:
            seqs[s] = min(i, seqs.get(s, i))
    kept = []
    for s, i in sorted(seqs.items(), key=lambda x: (-len(x[0]), x[1])):
        drawn = {s[j : j + 5] for j in range(0, len(s) - 4, 5)}
        if not any(len(drawn & k) / len(drawn) > 0.8 for _, k in kept):
            kept.append((i, {s[j : j + 5] for j in range(len(s) - 4)}))
    frame = spark.createDataFrame(rows, "seq_id string, seq string")
    for block in (100, 700, 1 << 22):
        assert sorted(r.seq_id for r in clusters.greedy_representatives(frame, block=block).collect()) == sorted([i for i, _ in kept] + ["t1", "t2", "t3"])
    assert not any("kmer" in p or "against" in p for p in paths)
    assert not any(os.path.exists(p) for p in paths if "/open-" in p)


def test_clusters_of_blocks_are_those_of_all_links_and_no_pairs_are_listed(spark, tmp_path, monkeypatch):
    paths = []
    monkeypatch.setattr(clusters, "shared_path", lambda _, name: paths.append(f"{tmp_path}/{name}-{len(paths)}") or paths[-1])
    rnd = random.Random(6)
    base = ["".join(rnd.choice("abcdé") for _ in range(80)) for _ in range(9)]
    rows = [(f"s{i:03}", (x := rnd.choice(base))[: rnd.randrange(20, 80)] + rnd.choice(["", x[:3], "zz"])) for i in range(90)] + [("t1", "abc"), ("t2", None), ("t3", "abc")]
    sets = {i: {s[j : j + 5] for j in range(len(s) - 4)} for i, s in rows if s and len(s) >= 5}
    root = {i: i for i, _ in rows} | {"t3": "t1"}
    for _ in range(len(rows)):
        was = dict(root)
        for a in sets:
            for b in sets:
                if len(sets[a] & sets[b]) / min(len(sets[a]), len(sets[b])) >= 0.95**5:
                    root[a] = root[b] = min(root[a], root[b])
        if was == root:
            break
    frame = spark.createDataFrame(rows, "seq_id string, seq string")
    for block in (600, 1 << 22):
        assert {r.seq_id: r.cluster for r in clusters.near_identical(frame, block=block).collect()} == root
    assert not any("kmer" in p for p in paths)


def test_consensus_is_written_from_gap_to_gap(spark):
    draw = random.Random(10)
    schema = "contig string, start long, stop long, ref string, alts array<string>, sample string, gt array<int>, gq int, dp int, ord long"
    called = {p: draw.choice("ACGT") for p in {0, 6, 7, 13, 41, 49, *draw.sample(range(50), 20)}} | {55: "A"}
    rows = [("c", p, p + 1, b, ["T" if b == "A" else "A"], "s", [0, 0], 50, 9, p) for p, b in called.items()]
    ref = spark.createDataFrame([("c", 50), ("d", 9)], "contig string, length long")
    blocks = genotypes.consensus(spark.createDataFrame(rows, schema), ref, 7)
    # no look-up by key for each site, which compares it with all calls of the block
    assert "map_from_entries" not in blocks._jdf.queryExecution().optimizedPlan().toString()
    got = {r.contig: r.seq for r in genotypes.contig_sequences(blocks).collect()}
    assert got == {"c": "".join(called.get(p, "N") for p in range(50)), "d": "N" * 9}


def test_trimming_kernel_equals_the_expression(spark):
    draw = random.Random(11)
    quals = ["".join(draw.choice("!55??IIIII~é") for _ in range(draw.randrange(30, 90))) for _ in range(150)] + ["", None, "I" * 44, "I" * 43, "é" * 50]
    rows = spark.createDataFrame([(i // 2, i % 2, q and "ACGT" * 30, q) for i, q in enumerate(quals)], "read_id int, mate int, seq string, qual string").cache()
    options = dict(mean=20, leading=8, trailing=12, head=3, least=20)
    want = {(r.read_id, r.mate): r.t for r in rows.select("read_id", "mate", fn.trim_quality("seq", "qual", **options).alias("t")).collect()}
    whole = {i for i, _ in want if all(t is not None for (j, _), t in want.items() if j == i)}
    trimmed = reads.trim(rows, **options)
    assert len(whole) > 5
    assert {(r.read_id, r.mate): (r.seq, r.qual) for r in trimmed.collect()} == {k: tuple(t) for k, t in want.items() if k[0] in whole}
    plan = trimmed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") // max(1, plan.count("== Initial Plan ==") + 1) <= 1 and "Join" not in plan


def test_distinct_windows_are_exact(spark):
    draw = random.Random(14)
    texts = ["".join(draw.choice(some) for _ in range(draw.randrange(200))) for some in ("ab", "abcdefgh ", "aé\U0001d11e", "".join(map(chr, range(0x4E00, 0x9E00)))) for _ in range(12)] + ["", "abcd", None]
    rows = reads.low_complexity(spark.createDataFrame(list(enumerate(texts)), "seq_id int, seq string"))
    assert "lambdafunction" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert {r.seq_id: r.kinds for r in rows.collect()} == {i: len({(t or "")[k : k + 5] for k in range(len(t or "") - 4)}) for i, t in enumerate(texts)}
    # more kinds of characters than a number holds for a whole window
    text = "".join(map(chr, range(0x4E00, 0x9E00))) * 2
    assert counts._distinct_windows(text, 9) == len({text[k : k + 9] for k in range(len(text) - 8)})


def test_translation_of_whole_sequences_equals_the_expression(spark):
    draw = random.Random(18)
    texts = ["".join(draw.choice(some) for _ in range(draw.randrange(60))) for some in ("TCAG", "tcagN", "TCAGé\U0001d11e\nß") for _ in range(15)] + ["", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "seq_id int, seq string")
    for code in (1, 2, 12):
        got = rows.select("seq_id", "seq", counts.translated("seq", code).alias("seq2"), fn.translate_codons("seq", code).alias("want"))
        assert all(r.seq2 == r.want for r in got.collect())
    checked = intervals.protein_check(rows.select("seq_id", counts.translated("seq").alias("seq")))
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and "lambdafunction" not in plan  # the filter does not translate again


def test_node_rows_come_in_small_batches():
    tree = "(" + ",".join(f"(a{k}:1,b{k}:2):1" for k in range(20)) + ");"
    part = pa.RecordBatch.from_pydict({"tree_id": [str(i) for i in range(4000)] + ["x", "y"], "newick": [tree] * 4000 + [None, "(("]})
    sizes = [(b.num_rows, len(b.column("leaves").flatten())) for b in trees._node_batches(iter([part]))]
    assert sum(n for n, _ in sizes) == 4000 * 61 and sum(n for _, n in sizes) == 4000 * 120
    assert max(n for _, n in sizes) <= trees._EMITTED + 40


def test_long_branches_equal_rounds_over_all_pairs(spark, monkeypatch):
    draw = random.Random(13)

    def some(names):
        if len(names) == 1:
            return f"{names[0]}:{draw.randrange(9)}"
        cut = draw.randrange(1, len(names))
        inner = ",".join(some(part) for part in (names[:cut], names[cut:]))
        return f"({inner}):{draw.randrange(4)}"

    texts = [some([f"n{k}" for k in draw.sample(range(60), draw.randrange(2, 40))]) + ";" for _ in range(30)] + ["(a:nan,(b:1,(c:1,(d:1,e:2):1):1):1);"]
    nodes = trees.nodes(spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "tree_id string, newick string")).cache()
    found = trees.long_branches(nodes)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {}
    for r in found.collect():
        got.setdefault(r.tree_id, {})[r.leaf] = r.signature
    far = {(r.tree_id, r.name): r.root_dist for r in nodes.where("is_leaf").collect()}
    pairs = {}
    for r in trees.pair_depths(nodes).collect():
        pairs.setdefault(r.tree_id, {})[r.a, r.b] = far[r.tree_id, r.a] + far[r.tree_id, r.b] - 2 * r.depth
    for t in map(str, range(30)):
        left, n, want = dict(pairs[t]), len({x for p in pairs[t] for x in p}), {}
        for _ in range(int(min(n // 5, 2 * n**0.5))):
            d, ends = min((-d, p) for p, d in left.items())
            after, leaf = min((max(v for p, v in left.items() if x not in p), x) for x in ends)
            want[leaf] = -d / after if after > 0 else 1.0
            left = {p: v for p, v in left.items() if leaf not in p}
        assert got.get(t, {}) == want
    assert len(got["30"]) == 1  # a length that is no number is no end
    rows = [r.asDict() for r in nodes.where("tree_id = '3'").collect()]
    whole = trees._removed(rows)
    monkeypatch.setattr(trees, "_PAIRS", 7)
    assert trees._removed(rows[::-1]) == whole and dict(whole) == got.get("3", {})


def test_triplet_branches_equal_all_triplets(spark, monkeypatch):
    draw = random.Random(16)
    pairs = [(t, a, b, float(draw.randrange(4))) for t in "uvw" for a in "abcdefgé" for b in "abcdefgé" if a < b and draw.random() < 0.9]
    frame = spark.createDataFrame(pairs, "tree_id string, a string, b string, depth double")
    found, depth, want = introgression.triplet_branches(frame), {p[:3]: p[3] for p in pairs}, set()
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    for t in "uvw":
        for x, y, z in combinations("abcdefgé", 3):
            if all((t, *p) in depth for p in ((x, y), (x, z), (y, z))):
                two, one, out = *sorted([(depth[t, x, y], z), (depth[t, x, z], y), (depth[t, y, z], x)])[1:], None
                if one[0] > two[0]:
                    want.add((t, f"{x}_{y}_{z}", one[1], one[0] - two[0]))
    assert want and {tuple(r) for r in found.collect()} == want
    some = [pa.array(c) for c in zip(*[p[1:] for p in pairs if p[0] == "u"])]
    several = [len(c[0]) for c in introgression._cherries(*some)]
    monkeypatch.setattr(introgression, "_TRIPLETS", 5)
    few = [len(c[0]) for c in introgression._cherries(*some)]
    assert sum(few) == sum(several) and max(few) < max(several)


def test_taxa_of_triplets_equal_the_expression(spark):
    names = ["a", "a_b", "b", "b_c", "c", "é_"]
    texts = ["_".join(x) for x in [(a, b, c) for a in names for b in names for c in names]] + ["", "a_b", "x_a_b", None, "a__b_c"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select(introgression.taxa_of("t", names).alias("got"), fn.triplet_parts("t", F.array(*map(F.lit, names))).alias("want")).collect()
    assert all(r.got == r.want for r in got) and sum(r.got is None for r in got) >= 4


def test_windows_of_a_word_come_in_small_batches():
    part = pa.RecordBatch.from_pydict({"seq_id": ["a", "b", "c"], "seq": ["xxATG" * 30_000, None, "ATGATGAT"]})
    got = list(counts._word_windows(iter([part]), "ATG", 2, 2))
    assert sum(b.num_rows for b in got) == 29_999 + 1
    counts_of = [b.num_rows for b in counts._word_windows(iter([pa.RecordBatch.from_pydict({"seq_id": ["a"], "seq": ["xxATG" * 100_000]})]), "ATG", 2, 2)]
    assert sum(counts_of) == 99_999 and max(counts_of) == counts._WINDOWS
    assert got[-1].to_pylist()[-1] == {"seq_id": "c", "pos": 4, "window": "TGATGAT"}


def test_window_counts_equal_brute_force(spark, monkeypatch):
    texts = [None, "", "ACGTN", "acgT", "éA\U0001f600C", "A" * 40 + "G", "GGGG"]
    rows = [(k % 3, [None, "pos", "neg"][k % 7 % 3], texts[k % 7]) for k in range(200)] + [(9, "neg", "ACGT" * 3000)]
    frame = spark.createDataFrame(rows, "round int, label string, window string")
    want = Counter((r, label, at, b) for r, label, w in rows for at, b in enumerate(w or "") if b in "ACGT")
    for held in (counts._HELD, 64):  # the small one: flushed often, and cells as a sorted list
        monkeypatch.setattr(counts, "_HELD", held)
        got = counts.window_counts(frame, ["round", "label"]).collect()
        assert {(r.round, r.label, r.pos, b): r[b] for r in got for b in "ACGT" if r[b]} == want
    own = {(r.label, r.pos, r.base): (r.n, r.prob) for r in coding.weight_matrix(frame.where("round = 9")).collect()}
    assert len(own) == 12_000 * 4 and own["neg", 0, "A"] == (1, 2 / 5) and own["neg", 0, "C"] == (0, 1 / 5)


def test_first_starts_are_found_in_one_reading(spark):
    rows = [("a", "ATGxATGxxATG"), ("b", "xxxATGx"), ("b", "xxxxxATGxxxx"), ("c", "xxATGxxxxATGxxxATG"), (None, "xxATGxxATGxx"), ("d", None)]
    seqs = spark.createDataFrame(rows, "seq_id string, seq string")
    first = coding.motif_windows(seqs, spark.createDataFrame([], "seq_id string, pos int"), 2, -3).groupBy("seq_id").agg(F.min("pos").alias("pos"))
    got, want = (Counter(map(tuple, coding.motif_windows(seqs, starts, 2, 2).collect())) for starts in (None, first))
    # the first of b is too near to the end for a window, and still makes the other one a decoy
    assert got == want and got["b", 6, "neg", "XXATGXX"] == 1 and sum(got.values()) == 6


def test_cross_scores_read_windows_once_and_equal_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(str(k), rng.randint(1, 99), "pos" if k % 4 == 0 else "neg", "".join(rng.choices("ACGT", k=33))) for k in range(300)]
    # few different numbers, so that the last test window shares its own with others
    monkeypatch.setattr(coding, "_drawn", lambda a, b, k: (F.hash(a, b, k) % 8 + 8) % 8 * 1250)
    read = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    frame = spark.createDataFrame(rows, "seq_id string, pos int, label string, window string")
    got = coding.cross_scored(frame.mapInArrow(pass_on, frame.schema), rounds=3, most=7).collect()
    assert read.value == 300
    drawn = frame.select("seq_id", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("k"), "pos").select("seq_id", "k", coding._drawn("seq_id", "pos", F.col("k")).alias("u")).collect()
    number = {(r.k, r.seq_id): r.u for r in drawn}
    for k in (1, 2, 3):
        matrix = coding.weight_matrix(frame.where(F.col("seq_id").isin([s for s, *_ in rows if number[k, s] < 7500])))
        odds = {(r.at, r.base): r.odds for r in coding._log_odds(matrix, []).collect()}
        for label in ("pos", "neg"):
            test = sorted((number[k, s], s, p, w) for s, p, x, w in rows if x == label and number[k, s] >= 7500)[:7]
            assert len(test) == 7
            for a, b in ((0, 27), (15, 32)):
                places = [at for at in range(a, b + 1) if not 20 <= at <= 22]
                mine = {(r.seq_id, r.pos): r.score for r in got if (r.round, r.first, r.last, r.label) == (k, a, b, label)}
                assert mine == pytest.approx({(s, p): sum(odds.get((at, w[at]), 0) for at in places) / len(places) for _, s, p, w in test})


def test_clusters_have_only_what_is_outside_the_largest_one_as_targets(spark, monkeypatch):
    rnd = random.Random(21)
    say = lambda n, letters: "".join(rnd.choice(letters) for _ in range(n))
    base = say(500, "abcde")
    rows = [(f"s{i:03}", base[: 500 - 3 * i]) for i in range(150)] + [("t0", base[:9]), ("u0", say(300, "fghij")), ("u1", say(300, "fghij") + base[:9]), ("u2", say(40, "klm")), ("u3", None)]
    u0 = dict(rows)["u0"]
    rows += [("u4", u0[:200]), ("u5", u0[5:]), ("a", say(150, "nop"))]
    sets = {i: {s[j : j + 5] for j in range(len(s) - 4)} for i, s in rows if s}
    root = {i: i for i, _ in rows}
    for _ in range(4):
        for a in sets:
            for b in sets:
                if len(sets[a] & sets[b]) >= 0.95**5 * min(len(sets[a]), len(sets[b])):
                    root[a] = root[b] = min(root[a], root[b])
    passes, broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, x: passes.append(x) or broadcast(self, x))
    frame = spark.createDataFrame(rows, "seq_id string, seq string")
    assert {r.seq_id: r.cluster for r in clusters.near_identical(frame, block=2400).collect()} == root
    assert root["u1"] == root["t0"] == "s000" and root["u5"] == "u0" and root["a"] == "a"
    assert len(passes) < 10  # of all 45,000 characters there would be 18 blocks at least


def test_small_tables_of_sequences_are_compared_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(clusters, "shared_path", lambda _, name, n=iter(range(99)): f"{tmp_path}/{name}-{next(n)}")
    rows = [(f"s{i:03}", f"{i:03}" * 9) for i in range(200)]
    assert clusters.near_identical(spark.createDataFrame(rows, "seq_id string, seq string")).count() == 200
    parts = [len(list(p.glob("part-*"))) for p in tmp_path.glob("sequences-*")]
    assert parts and min(parts) > 1


def test_cross_scores_are_of_all_test_windows(spark):
    rng = random.Random(8)
    rows = [(None if k % 50 == 0 else str(k), rng.randint(1, 3), "pos" if k % 2 == 0 else "neg", "".join(rng.choices("ACGTN", k=rng.choice([33, 33, 33, 40, 18])))) for k in range(10_000)]
    rows += [(s, p, x, w[::-1]) for s, p, x, w in rows[:300]]  # several windows of one place
    frame = spark.createDataFrame(rows, "seq_id string, pos int, label string, window string")
    got = coding.cross_scored(frame, rounds=2).collect()
    number = {(r.k, r.seq_id, r.pos): r.u for r in frame.select("seq_id", "pos", F.explode(F.array(F.lit(1), F.lit(2))).alias("k")).withColumn("u", coding._drawn("seq_id", "pos", F.col("k"))).collect()}
    want = {}
    for k in (1, 2):
        matrix = coding.weight_matrix(spark.createDataFrame([r for r in rows if number[k, r[0], r[1]] < 7500], frame.schema))
        odds = {(r.at, r.base): r.odds for r in coding._log_odds(matrix, []).collect()}
        for a, b in ((0, 27), (15, 32)):
            places = {}
            for s, p, x, w in rows:
                if number[k, s, p] >= 7500:
                    places.setdefault((k, a, b, s, p, x), []).extend(odds.get((at, w[at])) or 0 for at in range(a, min(b + 1, len(w))) if not 20 <= at <= 22)
            want |= {key: sum(v) / len(v) for key, v in places.items()}
    mine = {tuple(r)[:6]: r.score for r in got if (r.first, r.last) in ((0, 27), (15, 32))}
    assert all(sum(r.round == 1 and r.first == 0 and r.last == 27 and r.label == x for r in got) > 1000 for x in ("pos", "neg"))
    assert mine == pytest.approx(want) and len(got) == 2 * len(mine) * 2


def test_greedy_blocks_are_compared_by_tasks_and_decided_in_order(spark, monkeypatch):
    rnd = random.Random(31)
    say = lambda n: "".join(rnd.choice("abcdefghijklmnopq") for _ in range(n))
    long, part = say(1000), say(70)
    y = long[100:200] + part[:60]
    # x and y are in twenty sequences that the long one excludes, and y in one more, which stays
    rows = [("l", long), ("x", long[300:400] + part[:59]), ("y", y), ("e", say(200) + y)]
    rows += [(f"d{i:02}", long[:420] + part + say(5)) for i in range(20)] + [(f"r{i:02}", say(90)) for i in range(9)]
    kept = []
    for i, s in sorted(rows, key=lambda r: (-len(r[1]), r[0])):
        drawn = {s[j : j + 5] for j in range(0, len(s) - 4, 5)}
        if not any(len(drawn & k) / len(drawn) > 0.8 for _, k in kept):
            kept.append((i, {s[j : j + 5] for j in range(len(s) - 4)}))
    assert {"l", "x", "e"} <= {i for i, _ in kept} and not {"y", "d00", "d19"} & {i for i, _ in kept}
    on_driver, kmer_set = [], clusters.kmer_set
    monkeypatch.setattr(clusters, "kmer_set", lambda *a: on_driver.append(a) or kmer_set(*a))
    frame = spark.createDataFrame(rows, "seq_id string, seq string")
    assert sorted(r.seq_id for r in clusters.greedy_representatives(frame).collect()) == sorted(i for i, _ in kept)
    assert not on_driver
