"""Readers and writers on small hand-made files."""

import glob
import hashlib

from pyspark.sql import functions as F

from phylospark.sources import read, write


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def lines(path):
    return [x for f in sorted(glob.glob(f"{path}/**/part-*", recursive=True)) for x in open(f).read().splitlines()]


def test_fasta_folder_by_suffix(spark, tmp_path):
    put(tmp_path / "d/a.fa", ">x 1\nAC\nGT\n")
    put(tmp_path / "d/b.fa", ">y\r\nGG\r\n")
    put(tmp_path / "d/c.txt", ">z\nTT\n")
    got = {(r.source.split("/")[-1], r.seq_id, r.header, r.seq) for r in read.fasta(spark, str(tmp_path / "d"), "*.fa").collect()}
    assert got == {("a.fa", "x", "x 1", "ACGT"), ("b.fa", "y", "y", "GG")}


def test_alignment_gff3(spark, tmp_path):
    path = put(tmp_path / "t.gff3", "c\tx\tcDNA_match\t30\t40\t.\t-\t.\tID=1;Target=GENE^g1,TRANS^t1 11 21 +\nc\tx\tcDNA_match\t1\t10\t.\t-\t.\tID=1;Target=GENE^g1,TRANS^t1 1 10 +\nc\tx\tcDNA_match\t5\t9\t.\t+\t.\tTarget=t2 1 5 +\nc\tx\tgene\t1\t2\t.\t+\t.\tID=z\n")
    got = {r.transcript: (r.gene, r.strand, [tuple(s) for s in r.segments]) for r in read.alignment_gff3(spark, path).collect()}
    assert got == {"t1": ("g1", "-", [(1, 10), (30, 40)]), "t2": (None, "+", [(5, 9)])}


def test_tables(spark, tmp_path):
    wide = read.ortholog_table(spark, put(tmp_path / "o.tsv", "# Species\tGenes\tAlg.-Conn.\ta.pep\n2\t2\t0.5\tg1,g2\n")).first()
    assert wide["a.pep"] == "g1,g2" and wide["Genes"] == "2"
    hit = read.hits(spark, put(tmp_path / "h.tsv", "q\ts\t99.5\t100\t1\t0\t1\t100\t5\t104\t1e-50\t180.5\n")).first()
    assert (hit.query_id, hit.subject_id, hit.pident, hit.bitscore) == ("q", "s", 99.5, 180.5)
    assert read.hits(spark, put(tmp_path / "none.tsv", "")).count() == 0
    row = "PF1  acc  10  orf1  -  200  1e-5  50 0 1 1 1e-7 2e-6 40\n"
    dom = read.domains(spark, put(tmp_path / "d.txt", "# head\n" + row)).collect()
    assert [(r.orf_id, r.domain, r.accession, r.evalue) for r in dom] == [("orf1", "PF1", "acc", 2e-6)]
    score = read.score_table(spark, put(tmp_path / "s.tsv", "kmer\tframe\tloglik\nA\t0\t0.5\n"), "kmer string, frame int, loglik double").first()
    assert (score.kmer, score.frame, score.loglik) == ("A", 0, 0.5)


def test_genbank(spark, tmp_path):
    entry = 'LOCUS       x\nFEATURES             Location/Qualifiers\n     gene            complement(<5..>20)\n                     /gene="psbA"\n     CDS             join(30..40,50..\n                     60)\n                     /gene="rbcL"\n                     /translation="MK\n                     LV"\n     CDS             order(1..2,4..5,7..9)\n                     /gene="rbcL"\n                     /translation="MM"\nORIGIN\n        1 acgt\n//\n'
    path = put(tmp_path / "x.gb", entry)
    got = [(r.type, r.gene, r.strand, [tuple(s) for s in r.segments]) for r in read.genbank_features(spark, path).orderBy("ord", "i").collect()]
    assert got == [("gene", "psbA", "-", [(5, 20)]), ("CDS", "rbcL", "+", [(30, 40), (50, 60)]), ("CDS", "rbcL", "+", [(1, 2), (4, 5), (7, 9)])]
    assert [(r.gene, r.seq) for r in read.genbank_proteins(spark, path).collect()] == [("rbcL", "MKLV")]


def test_reports(spark, tmp_path):
    net = read.network_report(spark, put(tmp_path / "n.txt", "x\nVisualize in viewer : ((a,b),c);\nTotal log probability: -12.5\nVisualize again: (z);\nTotal log probability: -1\n")).first()
    assert (net.tree, net.log_probability) == ("((a,b),c);", -12.5)
    stat = read.mcmc_statistics(spark, put(tmp_path / "r.pstat", "[ID: 1]\nParameter\tMean\tminESS\tavgESS\tPSRF\nTL\t1\t150.5\t200\t1.002\nr\t1\tNA\t2\t1.01\n")).collect()
    assert sorted((r.min_ess or 0, r.psrf) for r in stat) == [(0, 1.01), (150.5, 1.002)]
    means = read.harmonic_means(spark, put(tmp_path / "r.lstat", "run\tarithmetic_mean\tharmonic_mean\n1\t-5\t-6\nall\t-5.5\t-6.5\n")).collect()
    assert [(r.arithmetic_mean, r.harmonic_mean) for r in means] == [(-5.5, -6.5)]


def test_lengths_and_index(spark, tmp_path):
    put(tmp_path / "l/a.nex", "#NEXUS\nDimensions ntax=2 NCHAR = 123;\n")
    put(tmp_path / "l/b.fa", ">a\nACG\nTT\n>b\nA\n")
    got = {r.source.split("/")[-1]: r.length for r in read.alignment_length(spark, str(tmp_path / "l")).collect()}
    assert got == {"a.nex": 123, "b.fa": 5}
    index = read.contig_index(spark, put(tmp_path / "r.fai", "c2\t50\t10\t60\t61\nc1\t70\t99\t60\t61\n"))
    assert [(r.contig, r.length, r.place) for r in index.orderBy("place").collect()] == [("c2", 50, 1), ("c1", 70, 2)]


def test_file_pairs_and_checksums(spark, tmp_path):
    for name in ("s1_1.fq", "s1_2.fq", "s1_R1.fq", "s1_R2.fq", "s2_1.fq", "s3_R1.fq", "s3_R2.fq"):
        put(tmp_path / "p" / name, name)
    got = {r["sample"]: (r.forward.split("/")[-1], r.reverse.split("/")[-1]) for r in read.paired_files(spark, str(tmp_path / "p"), [("_1.fq", "_2.fq"), ("_R1.fq", "_R2.fq")]).collect()}
    assert got == {"s1": ("s1_1.fq", "s1_2.fq"), "s3": ("s3_R1.fq", "s3_R2.fq")}
    sums = {r.name: r.md5 for r in read.checksums(spark, str(tmp_path / "p")).collect()}
    assert len(sums) == 7 and sums["s1_1.fq"] == hashlib.md5(b"s1_1.fq").hexdigest()


def test_lists(spark, tmp_path):
    assert [(r.name, r.place) for r in read.name_list(spark, put(tmp_path / "n.txt", "b\n\n a \n")).collect()] == [("b", 1), ("a", 2)]
    names = read.name_map(spark, put(tmp_path / "m.csv", "current_sample_name,standard_latin_name\ns1, Aus bus\n")).first()
    assert (names.current_sample_name, names.standard_latin_name) == ("s1", "Aus bus")
    text = "cal1 (a,b)\nmax 10.5\nmin 9\n\ncal2 c d;\nmax 3\nmin 2\n"
    got = {r.list_id: (r.taxa, r.max_age, r.min_age) for r in read.calibration_text(spark, put(tmp_path / "c.txt", text)).collect()}
    assert got == {"cal1": (["a", "b"], 10.5, 9.0), "cal2": (["c", "d"], 3.0, 2.0)}
    rows = read.sequence_lines(spark, put(tmp_path / "g.fa", ">a\nACG\n\nTT\n")).orderBy("ord").collect()
    assert [r.seq for r in rows] == ["ACG", "TT"]


def test_fasta_by_locus_comes_back(spark, tmp_path):
    rows = spark.createDataFrame([("L1", 1, "a", "ACGT" * 50), ("L1", 2, "b", "GG"), ("L2", 1, "a", "T")], "locus string, ord int, seq_id string, seq string")
    write.fasta(rows, str(tmp_path / "o"), by="locus")
    for locus, want in (("L1", {"a": "ACGT" * 50, "b": "GG"}), ("L2", {"a": "T"})):
        assert {r.seq_id: r.seq for r in read.fasta(spark, f"{tmp_path}/o/locus={locus}").collect()} == want
    assert max(map(len, lines(tmp_path / "o"))) == 80


def test_features_come_back(spark, tmp_path):
    rows = spark.createDataFrame([("c", "x", "CDS", 31, 40, None, "+", "0", "ID=m1"), ("c", "x", "mRNA", 1, 40, 5.5, "+", None, "ID=m0;Note=a")], "contig string, source string, type string, start long, end long, score double, strand string, phase string, attributes string")
    write.gff3(rows, str(tmp_path / "g"))
    assert lines(tmp_path / "g")[0] == "c\tx\tmRNA\t1\t40\t5.5\t+\t.\tID=m0;Note=a"
    back = {r.attrs["ID"]: (r.type, r.start, r.end) for r in read.gff(spark, str(tmp_path / "g")).collect()}
    assert back == {"m1": ("CDS", 31, 40), "m0": ("mRNA", 1, 40)}
    genes = rows.select("contig", "source", F.lit("exon").alias("type"), "start", "end", "strand", F.lit("g 1").alias("gene"), F.lit("t").alias("transcript"))
    write.gtf(genes, str(tmp_path / "t"))
    assert [r.attrs["gene_id"] for r in read.gtf(spark, str(tmp_path / "t")).collect()] == ["g 1", "g 1"]
    exons = genes.withColumn("off_lo", F.col("start")).withColumn("off_hi", F.col("end"))
    write.alignment_gff3(exons, str(tmp_path / "a"))
    assert [[tuple(s) for s in r.segments] for r in read.alignment_gff3(spark, str(tmp_path / "a")).collect()] == [[(1, 40), (31, 40)]]
    write.bed12(exons, str(tmp_path / "b"), track="models")
    assert lines(tmp_path / "b")[0] == "track name=models"


def test_other_texts(spark, tmp_path):
    seg = "ord int, type string, gene string, strand string, segments array<struct<start:long,end:long>>"
    text = write.interval_text(spark.createDataFrame([(1, "CDS", "g", "-", [(5, 9), (1, 3)]), (2, "gene", "h", "+", [(20, 30)])], seg)).collect()
    assert [r.value for r in text] == ["<\t1\t9\tg\n5\t9\texon\n1\t3\texon", ">\t20\t30\th\n20\t30\tutr"]
    parts = spark.createDataFrame([("L1", 1, 2), ("L2", 3, 3)], "locus string, first long, last long")
    assert [r.value for r in write.partition_lines(parts).collect()] == ["DNA, L1 = 1-2", "DNA, L2 = 3-3"]
    trees = spark.createDataFrame([("a", "(x,y);"), ("b", "(y,z);")], "tree_id string, newick string")
    blocks = [r.value for r in write.tree_block(trees, most=1).collect()]
    assert len(blocks) == 2 and all("Tree geneTree0 = (x,y);\nTree geneTree1 = (y,z);" in b for b in blocks) and any("(all) 1;" in b for b in blocks)
    cal = spark.createDataFrame([("t1", "c1", ["a", "b"], 1.0, 2.0)], "tree_id string, name string, taxa array<string>, min_age double, max_age double")
    assert write.dating_config(cal, {"smooth": "10"}).first().value == "mrca = c1 a b\nmin = c1 1.0\nmax = c1 2.0\nsmooth = 10"
    matrix = spark.createDataFrame([("b", "AC"), ("a", "A-")], "seq_id string, seq string")
    nexus = write.nexus(matrix, parts).first().value
    assert "ntax=2 nchar=2" in nexus and "matrix\na A-\nb AC\n;" in nexus and "charset L1 = 1-2;\ncharset L2 = 3-3;" in nexus


def test_reports_and_reads(spark, tmp_path):
    rows = spark.createDataFrame([("L", "m", 1.5), ("K", "n", None)], "locus string, metric string, value double")
    write.report(rows, str(tmp_path / "r"), by=["metric"])
    assert sorted(lines(tmp_path / "r")) == ["K\tNA", "L\t1.5", "locus\tvalue", "locus\tvalue"]
    reads = spark.createDataFrame([(f"r{i}", "ACG", "III") for i in range(20) for _ in (1, 2)], "read_id string, seq string, qual string")
    write.fastq_parts(reads, str(tmp_path / "q"), 3)
    assert len(lines(tmp_path / "q")) == 160 and len(glob.glob(f"{tmp_path}/q/part-*")) <= 3
    for f in glob.glob(f"{tmp_path}/q/part-*"):  # mates are in one file
        ids = [x for x in open(f).read().splitlines() if x.startswith("@")]
        assert all(ids.count(x) == 2 for x in ids)


def test_pieces_of_long_records(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")  # a record goes over many splits
    try:
        one, two = "ACGTTGCA" * 100, "GGT" * 70
        wrapped = lambda s, n: "\n".join(s[i : i + n] for i in range(0, len(s), n))
        path = put(tmp_path / "p/a.fa", f">one long\n{wrapped(one, 60)}\n>none\n>two\r\n{wrapped(two, 10)}\n\n>one again\n{one}\n")
        rows = read.fasta_pieces(spark, path, 100).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    records = {}
    for r in sorted(rows, key=lambda r: (tuple(r.record), r.start)):
        held = records.setdefault((tuple(r.record), r.seq_id), "")
        assert r.start == len(held)
        records[tuple(r.record), r.seq_id] = held + r.seq
    assert sorted((k[1], v) for k, v in records.items()) == sorted([("one", one), ("two", two), ("one", one)])
    assert len(rows) >= 12


def test_copies_of_a_call_do_not_go_by_the_order_of_rows(spark, tmp_path):
    from phylospark import plans

    lines = "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string, l_quantity double, l_tax double"
    rows = [(k, 1, 7, f, q, t) for k in range(40) for f, q, t in (("A", 5.0, 0.02), ("A", 9.0, 0.01), ("R", 3.0, 0.04))]
    got = []
    for name, some in (("a", rows), ("b", rows[::-1])):
        spark.createDataFrame(some, lines).coalesce(1).write.parquet(f"{tmp_path}/{name}/lineitem.parquet")
        spark.range(1).write.parquet(f"{tmp_path}/{name}/part.parquet")  # the view's text names its key
        got.append(sorted(plans.queries()["vcf_file"](spark, f"{tmp_path}/{name}").collect(), key=str))
    assert got[0] == got[1] and len(got[0]) == 80 and {r.gq for r in got[0]} == {5, None}


def test_a_large_folder_is_several_files_and_each_has_the_head(spark):
    from phylospark.plans import file_queries

    rows = spark.range(20_000).selectExpr("IF(id < 19000, 'A', 'B') AS flag", "id AS at", "concat_ws('\t', id, '.', 'x') AS value")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = file_queries._ranges(rows, "lines", "flag", "at", "#a\n#b")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    texts = {f: open(f).read().splitlines() for f in glob.glob(f"{path}/flag=*/*.txt")}
    assert sum("flag=A" in f for f in texts) > 3
    assert all(t[:2] == ["#a", "#b"] and not any(x.startswith("#") for x in t[2:]) for t in texts.values())
    assert sorted(int(x.split("\t")[0]) for t in texts.values() for x in t[2:]) == list(range(20_000))
    assert all([int(x.split("\t")[0]) for x in t[2:]] == sorted(int(x.split("\t")[0]) for x in t[2:]) for t in texts.values())
