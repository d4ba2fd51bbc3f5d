"""Queries that write a view in a format, read it back, and so show the format's writer and reader.

Every file is made in the same run, in the shared folder, of rows that Spark derives from the given tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import intervals, introgression, stats, trees
from ..operators.clusters import shared_path
from ..sources import read, write
from .registry import query
from .sequence_queries import _MODEL, kmer_model
from .tree_queries import _TRIPLETS, _triplets, tree_classes, tree_nodes
from .views import CODING, duck, tables, view

_C = duck(CODING)


def _lines(rows: DataFrame, name: str, by: str | None = None, order: list[str] | None = None) -> str:
    """``rows(value, ...)`` as text files in the shared folder: one for each value of ``by``, in order."""
    path = shared_path(rows.sparkSession, name)
    if by:
        rows.repartition(by).sortWithinPartitions(by, *(order or [])).select(by, "value").write.partitionBy(by).text(path)
    else:
        (rows.repartitionByRange(*order).sortWithinPartitions(*order) if order else rows).select("value").write.text(path)
    return path


def _ranges(rows: DataFrame, name: str, by: str, order: str, head: str | None = None) -> str:
    """``rows(value, ...)`` as text files in the shared folder: one folder for each value of ``by``, with a file for each
    range of ``order``, so that a large folder is written by many tasks.  Each file begins with ``head``.
    """
    path = shared_path(rows.sparkSession, name)
    dealt = rows.select(by, order, "value").repartitionByRange(by, order).sortWithinPartitions(by, order)
    if head:
        dealt = dealt.mapInArrow(lambda batches: _headed(batches, by, order, head), dealt.schema).sortWithinPartitions(by, order)
    dealt.select(by, "value").write.partitionBy(by).text(path)
    return path


def _headed(batches: Iterator[pa.RecordBatch], by: str, order: str, head: str) -> Iterator[pa.RecordBatch]:
    """A task's sorted rows and, for each value of ``by``, a first line ``head`` (at -1 in ``order``)."""
    seen: set = set()
    for batch in batches:
        new = [x for x in batch.column(by).unique().to_pylist() if x not in seen]
        seen.update(new)
        columns = {by: new, order: [-1] * len(new), "value": [head] * len(new)}
        yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in batch.schema], schema=batch.schema)
        yield batch


def _sql(spark, sf_dir, text, *names):
    tables(spark, sf_dir, *names)
    return spark.sql(text)


# sequences ---------------------------------------------------------------------------------------


@query(f"SELECT seq_id, seq_id || ' ' || locus AS header, CAST(length(seq) AS INTEGER) AS n, md5(seq) AS seq_md5 FROM {_C}")
def fasta_file(spark, sf_dir):
    """Wrapped FASTA and its scan."""
    rows, path = view(spark, sf_dir, CODING), shared_path(spark, "fasta")
    write.fasta(rows.select("ord", F.concat_ws(" ", "seq_id", "locus").alias("seq_id"), "seq"), path)
    return read.fasta(spark, path).select("seq_id", "header", F.length("seq").alias("n"), F.md5("seq").alias("seq_md5"))


@query(f"WITH l AS (SELECT seq_id, seq, unnest(range(0, length(seq), 80)) AS place FROM {_C}) SELECT seq_id, CAST(min(place) AS BIGINT) AS start, md5(substr(any_value(seq), min(place) + 1, max(place) - min(place) + 80)) AS seq_md5 FROM l GROUP BY seq_id, place // 500")
def fasta_pieces(spark, sf_dir):
    """Records in pieces of some lines, as long ones are read."""
    path = shared_path(spark, "fasta-pieces")
    write.fasta(view(spark, sf_dir, CODING), path)
    return read.fasta_pieces(spark, path, 500).select("seq_id", F.col("start").cast("long").alias("start"), F.md5("seq").alias("seq_md5"))


@query(f"SELECT seq_id, CAST(length(seq) AS INTEGER) AS n, md5(seq) AS seq_md5 FROM {_C}")
def fasta_folders(spark, sf_dir):
    """One folder of FASTA for each locus, scanned as a whole by suffix."""
    path = shared_path(spark, "fasta-loci")
    write.fasta(view(spark, sf_dir, CODING), path, by="locus")
    return read.fasta(spark, path, "*.txt").select("seq_id", F.length("seq").alias("n"), F.md5("seq").alias("seq_md5"))


@query(f"SELECT CAST(length(seq) AS BIGINT) AS length FROM (SELECT *, row_number() OVER (PARTITION BY locus ORDER BY ord) AS k FROM {_C}) WHERE k = 1")
def alignment_lengths(spark, sf_dir):
    """Length of each locus' file, by its first record."""
    path = shared_path(spark, "fasta-lengths")
    write.fasta(view(spark, sf_dir, CODING), path, by="locus")
    return read.alignment_length(spark, path).select("length")


_MATRIX = "(SELECT n_name AS seq_id, rpad(repeat('A', CAST(count(*) AS INTEGER)), CAST(any_value(most) AS INTEGER), '-') AS seq FROM customer JOIN nation ON c_nationkey = n_nationkey CROSS JOIN (SELECT max(n) AS most FROM (SELECT count(*) AS n FROM customer GROUP BY c_nationkey) x) y GROUP BY n_name)"
_CHARSETS = "(SELECT r_name AS locus, r_regionkey * 2 + 1 AS first, r_regionkey * 2 + 2 AS last FROM region)"


@query(f"SELECT concat(seq_id, ' ', seq) AS line, CAST(length(seq) AS BIGINT) AS length FROM {_MATRIX} UNION ALL SELECT concat('charset ', locus, ' = ', first, '-', last, ';'), (SELECT max(length(seq)) FROM {_MATRIX}) FROM {_CHARSETS}")
def nexus_file(spark, sf_dir):
    """NEXUS matrix and character sets of nations, its lines beside the length that it declares."""
    path = shared_path(spark, "nexus")
    write.nexus(view(spark, sf_dir, _MATRIX), view(spark, sf_dir, _CHARSETS), path)
    lines = spark.read.text(path).where(F.col("value").rlike("^(NATION|charset|[A-Z]+ [A-Z]* *A)")).select(F.col("value").alias("line"))
    return lines.crossJoin(F.broadcast(read.alignment_length(spark, path).select("length")))  # one row


@query(f"SELECT CAST(ord AS VARCHAR) AS read_id, CAST(length(seq) AS INTEGER) AS n FROM {_C} WHERE length(seq) > 0")
def fastq_split(spark, sf_dir):
    """Reads in about equal parts; each record has its four lines in one file."""
    path = shared_path(spark, "fastq")
    rows = view(spark, sf_dir, CODING).where("length(seq) > 0").select(F.col("ord").cast("string").alias("read_id"), "seq", F.repeat(F.lit("I"), F.length("seq")).alias("qual"))
    write.fastq_parts(rows, path, 7)
    records = spark.read.option("lineSep", "\n@").text(path).select(F.split(F.regexp_replace("value", r"^@|\n$", ""), "\n").alias("f"))
    whole = (F.size("f") == 4) & (F.get("f", F.lit(2)) == "+") & (F.length(F.get("f", F.lit(1))) == F.length(F.get("f", F.lit(3))))
    return records.where(whole).select(F.get("f", F.lit(0)).alias("read_id"), F.length(F.get("f", F.lit(1))).alias("n"))


# features ----------------------------------------------------------------------------------------

_FEATURES = "(SELECT concat('c', CAST(o_custkey AS VARCHAR(20))) AS contig, 'view' AS source, CASE WHEN o_orderkey % 3 = 0 THEN 'mRNA' ELSE 'CDS' END AS type, o_orderkey AS start, o_orderkey + 50 + o_orderkey % 7 AS stop, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, concat('ID=m', CAST(o_orderkey AS VARCHAR(20)), ';Parent=g', CAST(o_custkey AS VARCHAR(20)), ';Note=type:', CASE WHEN o_orderkey % 5 = 0 THEN 'complete' ELSE 'partial' END) AS attributes, CAST(o_custkey AS VARCHAR(20)) AS gene, CAST(o_orderkey AS VARCHAR(20)) AS transcript FROM orders)"


def _gff(spark, sf_dir):
    path = shared_path(spark, "gff3")
    rows = view(spark, sf_dir, _FEATURES).withColumnRenamed("stop", "end")
    write.gff3(rows.withColumn("score", F.lit(None).cast("string")).withColumn("phase", F.lit("0")), path)
    return path


@query(f"SELECT contig, start, stop AS \"end\", strand, concat('m', transcript) AS id, concat('g', gene) AS parent FROM {_FEATURES} WHERE type = 'mRNA'")
def gff_file(spark, sf_dir):
    """K3, S3: GFF3 lines and the scan of one type."""
    return read.gff(spark, _gff(spark, sf_dir), "mRNA").select("contig", "start", "end", "strand", F.col("attrs.ID").alias("id"), F.col("attrs.Parent").alias("parent"))


@query(f"SELECT concat('m', transcript) AS id FROM {_FEATURES} WHERE type = 'mRNA' AND attributes LIKE '%complete%'")
def complete_models(spark, sf_dir):
    """ids of complete reading frames in a GFF3 file."""
    return intervals.complete_ids(read.gff(spark, _gff(spark, sf_dir)))


@query(f"SELECT contig, start, stop AS \"end\", strand, gene, transcript FROM {_FEATURES} WHERE type = 'CDS'")
def gtf_file(spark, sf_dir):
    """GTF lines and the scan of one type."""
    path = shared_path(spark, "gtf")
    write.gtf(view(spark, sf_dir, _FEATURES).withColumnRenamed("stop", "end"), path)
    rows = read.gtf(spark, path, "CDS")
    return rows.select("contig", "start", "end", "strand", F.col("attrs.gene_id").alias("gene"), F.col("attrs.transcript_id").alias("transcript"))


_EXONS = "(SELECT CAST(l_orderkey AS VARCHAR(20)) AS transcript, concat('c', CAST(l_orderkey % 50 AS VARCHAR(20))) AS contig, CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, l_linenumber * 100 + l_orderkey % 9 AS start, l_linenumber * 100 + l_orderkey % 9 + CAST(max(l_quantity) AS BIGINT) AS stop FROM lineitem GROUP BY l_orderkey, l_linenumber)"
_SEGMENTS = f"(SELECT transcript, contig, strand, string_agg(concat(start, '-', stop), ',' ORDER BY start) AS segments, count(*) AS n FROM {_EXONS} GROUP BY ALL)"


@query(f"SELECT transcript, contig, strand, segments FROM {_SEGMENTS}")
def alignment_gff_file(spark, sf_dir):
    """Transcript alignments with their places, read as sorted segments."""
    path = shared_path(spark, "alignments")
    exons = intervals.exon_offsets(view(spark, sf_dir, _EXONS).withColumnRenamed("stop", "end"))
    write.alignment_gff3(exons, path)
    segments = F.array_join(F.transform("segments", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return read.alignment_gff3(spark, path).select("transcript", "contig", "strand", segments.alias("segments"))


@query(f"SELECT concat_ws(chr(9), contig, lo, hi, transcript, 0, strand, lo, hi, 0, n, sizes, starts) AS line FROM (SELECT transcript, contig, strand, min(start) - 1 AS lo, max(stop) AS hi, count(*) AS n, string_agg(CAST(stop - start + 1 AS VARCHAR), ',' ORDER BY start) AS sizes, string_agg(CAST(start - first AS VARCHAR), ',' ORDER BY start) AS starts FROM (SELECT *, min(start) OVER (PARTITION BY transcript) AS first FROM {_EXONS}) GROUP BY ALL) UNION ALL SELECT 'track name=models'")
def bed_file(spark, sf_dir):
    """K4: BED lines after a track line."""
    path = shared_path(spark, "bed")
    write.bed12(view(spark, sf_dir, _EXONS).withColumnRenamed("stop", "end"), path, track="models")
    return spark.read.text(path).withColumnRenamed("value", "line")


@query(f"SELECT concat_ws(chr(9), CASE WHEN strand = '-' THEN '<' ELSE '>' END, min(start), max(stop), concat('g', transcript)) AS line FROM {_EXONS} GROUP BY transcript, strand UNION ALL SELECT concat_ws(chr(9), start, stop, 'exon') FROM {_EXONS}")
def interval_file(spark, sf_dir):
    """K7: arrow, span and gene of each model, then its segments."""
    path = shared_path(spark, "intervals")
    models = view(spark, sf_dir, _EXONS).groupBy("transcript", "strand").agg(F.array_sort(F.collect_list(F.struct("start", F.col("stop").alias("end")))).alias("segments"))
    write.interval_text(models.select(F.col("transcript").alias("ord"), F.lit("CDS").alias("type"), F.concat(F.lit("g"), "transcript").alias("gene"), "strand", "segments"), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


_ENTRY = "concat('LOCUS       x', CAST(id AS VARCHAR(20)), chr(10), 'FEATURES             Location/Qualifiers', chr(10), '     gene            ', place, chr(10), '                     /gene=\"g', gene, '\"', chr(10), '     CDS             ', place, chr(10), '                     /gene=\"g', gene, '\"', chr(10), '                     /translation=\"M', protein, chr(10), '                     K\"', chr(10), 'ORIGIN', chr(10), '        1 acgt', chr(10), '//')"
_GENES = "(SELECT o_orderkey AS id, CAST(o_custkey % 200 AS VARCHAR(20)) AS gene, CASE WHEN o_orderkey % 3 = 0 THEN concat('complement(<', CAST(o_orderkey AS VARCHAR(20)), '..>', CAST(o_orderkey + 9 AS VARCHAR(20)), ')') ELSE concat('join(', CAST(o_orderkey AS VARCHAR(20)), '..', CAST(o_orderkey + 9 AS VARCHAR(20)), ',', CAST(o_orderkey + 20 AS VARCHAR(20)), '..', CAST(o_orderkey + 29 AS VARCHAR(20)), ')') END AS place, repeat('A', CAST(o_orderkey % 5 AS INTEGER)) AS protein FROM orders)"


def _genbank(spark, sf_dir):
    rows = view(spark, sf_dir, f"(SELECT id, {_ENTRY} AS value FROM {_GENES})")
    return _lines(rows, "genbank", order=["id"])


@query(f"SELECT type, concat('g', gene) AS gene, CASE WHEN id % 3 = 0 THEN '-' ELSE '+' END AS strand, CASE WHEN id % 3 = 0 THEN concat(id, '-', id + 9) ELSE concat(id, '-', id + 9, ',', id + 20, '-', id + 29) END AS segments FROM {_GENES} CROSS JOIN (SELECT unnest(['gene', 'CDS']) AS type)")
def genbank_features(spark, sf_dir):
    """Feature places of GenBank entries: complement, join, partial marks."""
    segments = F.array_join(F.transform("segments", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return read.genbank_features(spark, _genbank(spark, sf_dir)).select("type", "gene", "strand", segments.alias("segments"))


@query(f"SELECT concat('g', gene) AS gene, concat('M', arg_min(protein, id), 'K') AS seq FROM {_GENES} GROUP BY gene")
def genbank_proteins(spark, sf_dir):
    """Proteins of coding features; the first entry of a gene counts."""
    return read.genbank_proteins(spark, _genbank(spark, sf_dir))


@query(f"SELECT concat('g', gene) AS gene, count(*) AS cds, count(*) AS genes, count(*) FILTER (id % 3 = 0) AS reverse FROM {_GENES} GROUP BY gene")
def gene_content(spark, sf_dir):
    """How often each gene is annotated, by feature type and strand."""
    rows = read.genbank_features(spark, _genbank(spark, sf_dir))
    table = rows.groupBy("gene").pivot("type", ["CDS", "gene"]).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("strand") == "-").alias("minus"))
    return table.select("gene", F.col("CDS_n").alias("cds"), F.col("gene_n").alias("genes"), F.col("CDS_minus").alias("reverse"))


_CALLS = "(SELECT l_returnflag AS contig, l_orderkey * 10 + l_linenumber AS pos, CASE WHEN l_linenumber % 2 = 0 THEN 'A' ELSE 'CC' END AS ref, CASE WHEN l_linenumber % 3 = 0 THEN '.' ELSE 'G,T' END AS alt, l_linenumber % 3 AS a, CAST(l_quantity AS INTEGER) AS gq, CAST(round(l_tax * 100) AS INTEGER) AS dp, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_returnflag, l_quantity, l_tax) AS copy FROM lineitem)"


@query(f"SELECT contig, CAST(pos - 1 AS BIGINT) AS start, CAST(pos - 1 + length(ref) AS BIGINT) AS stop, ref, CASE WHEN alt = '.' THEN '' ELSE alt END AS alts, sample, CASE WHEN sample = 's1' THEN concat('0,', a) ELSE ',' END AS gt, CASE WHEN sample = 's1' THEN gq END AS gq, CASE WHEN sample = 's1' THEN dp END AS dp FROM {_CALLS} CROSS JOIN (SELECT unnest(['s1', 's2']) AS sample) WHERE copy = 1")
def vcf_file(spark, sf_dir):
    """Records of two samples, one folder for each contig, as genotypes."""
    calls = view(spark, sf_dir, _CALLS).where("copy = 1")
    record = F.concat_ws("\t", "contig", "pos", F.lit("."), "ref", "alt", F.lit("."), F.lit("."), F.lit("."), F.lit("GT:GQ:DP"), F.concat(F.lit("0/"), "a", F.lit(":"), "gq", F.lit(":"), "dp"), F.lit("./."))
    head = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2"
    rows = calls.select(F.col("contig").alias("flag"), F.col("pos").alias("at"), record.alias("value"))
    path = _ranges(rows, "vcf", "flag", "at", head)
    listed = lambda c: F.concat_ws(",", F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit(""))))
    return read.vcf(spark, path).select("contig", "start", "stop", "ref", listed("alts").alias("alts"), "sample", listed("gt").alias("gt"), "gq", "dp")


# tables ------------------------------------------------------------------------------------------

_HIT_ROWS = "(SELECT concat('q', CAST(l_orderkey AS VARCHAR(20))) AS query_id, concat('s', CAST(l_partkey AS VARCHAR(20))) AS subject_id, CAST(l_quantity AS DOUBLE) AS pident, l_linenumber AS length, l_linenumber AS mismatch, 0 AS gapopen, 1 AS qstart, 2 AS qend, 3 AS sstart, 4 AS send, CAST(l_tax AS DOUBLE) AS evalue, CAST(l_quantity AS DOUBLE) / 2 AS bitscore, l_returnflag AS flag FROM lineitem)"


def _hit_files(spark, sf_dir):
    rows = view(spark, sf_dir, _HIT_ROWS)
    return _ranges(rows.select("flag", "query_id", F.concat_ws("\t", *[c for c in rows.columns if c != "flag"]).alias("value")), "hits", "flag", "query_id")


@query(f"SELECT query_id, subject_id, pident, CAST(length AS INTEGER) AS length, evalue, bitscore FROM {_HIT_ROWS}")
def hit_files(spark, sf_dir):
    """Twelve-column hit tables of several files."""
    return read.hits(spark, _hit_files(spark, sf_dir)).select("query_id", "subject_id", "pident", "length", "evalue", "bitscore")


@query("SELECT concat('flag=', l_returnflag) AS folder, count(DISTINCT l_orderkey) AS queries FROM lineitem GROUP BY 1")
def listed_files(spark, sf_dir):
    """U4: the distinct files that several overlapping patterns find, and the distinct queries in each folder."""
    path = _hit_files(spark, sf_dir)
    last = lambda c: F.regexp_extract(c, "([^/]+/[^/]+)$", 1)
    files = read.file_list(spark, [f"{path}/flag=*", f"{path}/flag=A", f"{path}/*/*.txt"]).select(last("path").alias("file"))
    folder = F.split_part("file", F.lit("/"), F.lit(1)).alias("folder")
    # names of files, one for each range that was written
    found = read.hits(spark, path).select(last("source").alias("file"), "query_id").join(F.broadcast(files), "file").select(folder, "query_id")
    return found.distinct().groupBy("folder").agg(F.count("*").alias("queries"))


@query("SELECT concat('orf', l_orderkey) AS orf_id, concat('PF', l_partkey) AS domain, concat('acc', l_suppkey) AS accession, CAST(l_tax AS DOUBLE) AS evalue FROM lineitem")
def domain_table(spark, sf_dir):
    """Whitespace-separated domain hits between comment lines."""
    line = "concat_ws('   ', concat('PF', l_partkey), concat('acc', l_suppkey), 100, concat('orf', l_orderkey), '-', 200, 1, 50, 0, 1, 1, 1, l_tax, 40, 'words at the end')"
    rows = _sql(spark, sf_dir, f"SELECT l_orderkey, {line} AS value FROM lineitem UNION ALL SELECT -1, '# target name  accession' UNION ALL SELECT 0, ''", "lineitem")
    return read.domains(spark, _lines(rows, "domains", order=["l_orderkey"]))


@query(f"WITH {_MODEL} SELECT kmer, frame, n, round(loglik, 6) AS loglik FROM model")
def score_table(spark, sf_dir):
    """The framed k-mer score table, written with a header."""
    path = shared_path(spark, "scores")
    write.report(kmer_model(spark, sf_dir)[1].select("kmer", "frame", "n", F.round("loglik", 6).alias("loglik")), path)
    return read.score_table(spark, path, "kmer string, frame int, n long, loglik double")


_STATUS = "(SELECT concat('L', CAST(p_partkey AS VARCHAR(20))) AS locus, p_brand AS metric, p_size AS value, CASE WHEN p_size > 20 THEN 'PASS' WHEN p_size > 10 THEN 'FAIL' END AS status FROM part)"


@query(f"SELECT locus, metric, CAST(value AS INTEGER) AS value, status FROM {_STATUS}")
def report_files(spark, sf_dir):
    """Reports in folders by metric, with a mark for what is missing."""
    path = shared_path(spark, "reports")
    write.report(view(spark, sf_dir, _STATUS), path, by=["metric"])
    rows = spark.read.csv(path, sep="\t", header=True, nullValue="NA", schema="locus string, value int, status string, metric string")
    return rows.select("locus", "metric", "value", "status")


@query("SELECT n_regionkey AS place, n_name AS contig, CAST(count(*) AS BIGINT) AS length FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL".replace("n_regionkey AS place", "row_number() OVER (ORDER BY n_nationkey) AS place").replace("GROUP BY ALL", "GROUP BY n_name, n_nationkey"))
def contig_index(spark, sf_dir):
    """A reference index in the order of offsets."""
    rows = _sql(spark, sf_dir, "SELECT n_nationkey, concat_ws('\t', n_name, count(*), n_nationkey * 100, 60, 61) AS value FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name, n_nationkey", "nation", "customer")
    return read.contig_index(spark, _lines(rows, "index")).select(F.col("place").cast("long").alias("place"), "contig", "length")


_FILES = "(SELECT concat('/d/', name) AS path, name FROM (SELECT concat('s', CAST(o_custkey AS VARCHAR(20)), CASE o_orderkey % 5 WHEN 0 THEN '_1.fq' WHEN 1 THEN '_2.fq' WHEN 2 THEN '_R1.fq' WHEN 3 THEN '_R2.fq' ELSE '.txt' END) AS name FROM orders) x GROUP BY name)"


@query(f"WITH f AS {_FILES}, p AS (SELECT regexp_extract(name, '^(s[0-9]+)', 1) AS sample, max(path) FILTER (name LIKE '%\\_1.fq' ESCAPE '\\') AS a1, max(path) FILTER (name LIKE '%\\_2.fq' ESCAPE '\\') AS a2, max(path) FILTER (name LIKE '%\\_R1.fq' ESCAPE '\\') AS b1, max(path) FILTER (name LIKE '%\\_R2.fq' ESCAPE '\\') AS b2 FROM f GROUP BY 1) SELECT sample, CASE WHEN a1 IS NOT NULL AND a2 IS NOT NULL THEN a1 ELSE b1 END AS forward, CASE WHEN a1 IS NOT NULL AND a2 IS NOT NULL THEN a2 ELSE b2 END AS reverse FROM p WHERE (a1 IS NOT NULL AND a2 IS NOT NULL) OR (b1 IS NOT NULL AND b2 IS NOT NULL)")
def read_pairs(spark, sf_dir):
    """Read files of a sample by two pairs of suffixes; the first pair wins."""
    return read.pair_names(view(spark, sf_dir, _FILES), [("_1.fq", "_2.fq"), ("_R1.fq", "_R2.fq")])


@query("SELECT n_name AS name, row_number() OVER (ORDER BY n_name DESC) AS place FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)")
def name_list(spark, sf_dir):
    """A list of names in one file, with their places."""
    rows = _sql(spark, sf_dir, "SELECT concat(' ', n_name, ' \n') AS value FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer) ORDER BY n_name DESC", "nation", "customer")
    return read.name_list(spark, _lines(rows.coalesce(1), "names")).withColumn("place", F.col("place").cast("long"))


@query("SELECT concat('Clade_', dense_rank() OVER (ORDER BY n_regionkey)) AS clade, n_name AS sample FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)")
def clade_file(spark, sf_dir):
    """Groups of names between lines of ==."""
    rows = _sql(spark, sf_dir, "SELECT value FROM (SELECT n_regionkey, array_join(array_sort(collect_list(n_name)), '\n') || '\n====' AS value FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer) GROUP BY n_regionkey) ORDER BY n_regionkey", "nation", "customer")
    return read.clade_groups(spark, _lines(rows.coalesce(1), "clades"))


@query("SELECT concat('s', c_custkey) AS current_sample_name, concat('Genus ', c_mktsegment) AS standard_latin_name FROM customer")
def name_map(spark, sf_dir):
    """A renaming table with a header."""
    path = shared_path(spark, "renames")
    _sql(spark, sf_dir, "SELECT concat('s', c_custkey, ' ') AS current_sample_name, concat(' Genus ', c_mktsegment) AS standard_latin_name FROM customer", "customer").write.option("header", True).csv(path)
    return read.name_map(spark, path)


@query("SELECT concat('cal', n_nationkey) AS list_id, concat(n_name, ',', lower(n_name)) AS taxa, CAST(count(*) AS DOUBLE) AS max_age, CAST(count(*) / 2 AS DOUBLE) AS min_age FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name")
def calibration_file(spark, sf_dir):
    """Calibrations in groups of three lines."""
    rows = _sql(spark, sf_dir, "SELECT concat('cal', n_nationkey, ' (', n_name, ',', lower(n_name), ');\nmax ', count(*), ';\nmin ', count(*) / 2) AS value FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name", "nation", "customer")
    return read.calibration_text(spark, _lines(rows.coalesce(1), "calibrations")).select("list_id", F.array_join("taxa", ",").alias("taxa"), "max_age", "min_age")


# reports of single runs --------------------------------------------------------------------------

_RUNS = "(SELECT c_nationkey AS flag, CAST(c_custkey % 10 AS DOUBLE) AS smooth, CAST(sum(CAST(c_acctbal AS BIGINT)) AS DOUBLE) AS chisq, min(c_custkey) AS place FROM customer GROUP BY c_nationkey, c_custkey % 10)"


@query(f"SELECT arg_min(smooth, (chisq, place)) AS smooth FROM {_RUNS} GROUP BY flag".replace("CAST(c_acctbal AS BIGINT)", "CAST(floor(c_acctbal) AS BIGINT)"))
def smoothing_reports(spark, sf_dir):
    """The best smoothing of each run's cross-validation report."""
    rows = view(spark, sf_dir, _RUNS.replace("CAST(c_acctbal AS BIGINT)", "CAST(floor(c_acctbal) AS BIGINT)")).withColumn("value", F.concat(F.lit("some words\nchisq: ("), "smooth", F.lit(") "), "chisq"))
    return stats.best_smoothing(read.cv_report(spark, _lines(rows, "cv", "flag", ["place"]))).select("smooth")


@query("SELECT concat('(', n_name, ',x);') AS tree, -CAST(count(*) AS DOUBLE) AS log_probability FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name")
def network_reports(spark, sf_dir):
    """First tree and first log probability of each run."""
    rows = _sql(spark, sf_dir, "SELECT n_nationkey AS flag, concat('start\nVisualize in viewer : (', n_name, ',x);\nTotal log probability: -', count(*), '\nVisualize in viewer : (z);\nTotal log probability: -0.5') AS value FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name", "nation", "customer")
    return read.network_report(spark, _lines(rows, "networks", "flag")).select("tree", "log_probability")


@query("SELECT CAST(min(p_size) AS DOUBLE) AS min_ess, CAST(max(p_size) AS DOUBLE) AS max_psrf, CAST(max(p_partkey) AS DOUBLE) AS harmonic_mean FROM part GROUP BY p_brand")
def mcmc_reports(spark, sf_dir):
    """Convergence of each run's parameters, and the mean of all its chains."""
    tables(spark, sf_dir, "part")
    head = "SELECT p_brand AS flag, -2 AS at, '[ID: 1]\nParameter\tmean\tminESS\tPSRF' AS value FROM part GROUP BY p_brand"
    rows = spark.sql(f"{head} UNION ALL SELECT p_brand, p_partkey, concat_ws('\t', 'p', 1, p_size, p_size) FROM part")
    per_run = stats.convergence(read.mcmc_statistics(spark, _lines(rows, "pstat", "flag", ["at"])))
    # files of one brand have different names: runs are matched by their largest factor and number of rows
    means = spark.sql("SELECT p_brand AS flag, max(p_partkey) AS at, concat('run\tarithmetic\tharmonic\nall\t', min(p_size), '.', max(p_size), '\t', max(p_partkey)) AS value FROM part GROUP BY p_brand")
    found = read.harmonic_means(spark, _lines(means, "lstat", "flag", ["at"]))
    key = F.concat_ws(".", F.col("min_ess").cast("int"), F.col("max_psrf").cast("int")).cast("double")
    left = per_run.withColumn("key", key).withColumn("i", F.row_number().over(_by("key", "run")))
    right = found.withColumn("i", F.row_number().over(_by("arithmetic_mean", "harmonic_mean")))
    return left.join(right, (F.col("key") == F.col("arithmetic_mean")) & (left.i == right.i)).select("min_ess", "max_psrf", "harmonic_mean")


def _by(key: str, order: str):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(order)


# trees -------------------------------------------------------------------------------------------

_TREE_LINES = "(SELECT l_suppkey AS id, concat('(s', CAST(l_suppkey AS VARCHAR(20)), ',', CAST(count(*) AS VARCHAR(20)), ');') AS newick FROM lineitem GROUP BY l_suppkey)"


@query(f"SELECT newick FROM {_TREE_LINES}")
def tree_file(spark, sf_dir):
    """A corpus of trees, blank lines skipped."""
    rows = view(spark, sf_dir, _TREE_LINES).withColumn("value", F.concat("newick", F.when(F.col("id") % 3 == 0, F.lit("\n\n")).otherwise("")))
    return read.newick(spark, _lines(rows, "trees", order=["id"])).select("newick")


@query(f"WITH t AS (SELECT newick, row_number() OVER (ORDER BY CAST(id AS VARCHAR)) - 1 AS n FROM {_TREE_LINES}) SELECT k, concat('Tree geneTree', n, ' = ', newick) AS line FROM t CROSS JOIN (SELECT unnest(range(3)) AS k) UNION ALL SELECT k, concat('InferNetwork_MPL (all) ', k, ';') FROM (SELECT unnest(range(3)) AS k)")
def tree_blocks(spark, sf_dir):
    """K9: numbered trees with one command for each number of reticulations."""
    path = shared_path(spark, "blocks")
    write.tree_block(view(spark, sf_dir, _TREE_LINES).select(F.col("id").cast("string").alias("tree_id"), "newick"), most=2, path=path)
    return spark.read.text(path).where("value like 'Tree %' or value like 'Infer%'").select(F.col("k").cast("long").alias("k"), F.col("value").alias("line"))


@query("WITH c AS (SELECT c_nationkey AS tree_id, concat('n', c_custkey) AS name, c_custkey AS k FROM customer) SELECT tree_id, concat('mrca = ', name, ' a', k, ' b') AS line FROM c UNION ALL SELECT tree_id, concat('min = ', name, ' ', k, '.0') FROM c UNION ALL SELECT tree_id, concat('max = ', name, ' ', k + 1, '.0') FROM c UNION ALL SELECT DISTINCT tree_id, 'smooth = 10' FROM c")
def dating_files(spark, sf_dir):
    """Calibrations and settings of each tree."""
    path = shared_path(spark, "dating")
    rows = _sql(spark, sf_dir, "SELECT c_nationkey AS tree_id, concat('n', c_custkey) AS name, array(concat('a', c_custkey), 'b') AS taxa, CAST(c_custkey AS DOUBLE) AS min_age, CAST(c_custkey + 1 AS DOUBLE) AS max_age FROM customer", "customer")
    write.dating_config(rows, {"smooth": "10"}, path)
    return spark.read.text(path).select(F.col("tree_id").cast("long").alias("tree_id"), F.col("value").alias("line"))


_PARTS = "(SELECT p_brand AS locus, count(*) AS length FROM part GROUP BY p_brand)"


@query(f"SELECT concat('DNA, ', locus, ' = ', CAST(last - length + 1 AS BIGINT), '-', CAST(last AS BIGINT)) AS line FROM (SELECT *, sum(length) OVER (ORDER BY locus) AS last FROM {_PARTS})")
def partition_file(spark, sf_dir):
    """K8: partition lines with running offsets."""
    from ..operators import alignment

    path = shared_path(spark, "partitions")
    write.partition_lines(alignment.partitions(view(spark, sf_dir, _PARTS)), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query(f"SELECT tree_id, array_to_string(c, ',') AS clade, (k * 10 + 50) / 100 AS probability FROM (SELECT tree_id, k, list_sort(list(leaf)) AS c FROM {tree_classes()} GROUP BY ALL)")
def support_probabilities(spark, sf_dir):
    """Supports of inner nodes as probabilities."""
    rows = trees.support_probability(tree_nodes(spark, sf_dir)).where("probability is not null")
    return rows.select("tree_id", F.array_join("leaves", ",").alias("clade"), "probability")


@query(f"WITH {_TRIPLETS} SELECT tree_id, triplet, x AS first, y AS second, z AS third FROM (SELECT tree_id, concat_ws('_', x, y, z) AS triplet, x, y, z FROM t) JOIN br USING (tree_id, triplet)")
def triplet_names(spark, sf_dir):
    """The three taxa of triplet texts whose names contain the separator."""
    names = [f"NATION_{k}" for k in range(25)]
    rows = _triplets(spark, sf_dir).withColumn("p", introgression.taxa_of("triplet", names))
    return rows.select("tree_id", "triplet", F.col("p")[0].alias("first"), F.col("p")[1].alias("second"), F.col("p")[2].alias("third"))


@query("SELECT p_partkey AS id, concat('sp', p_partkey, CASE WHEN p_size % 2 = 0 THEN '.cds' ELSE '.pep' END) AS file, concat('sp', p_partkey, '.cds') AS partner FROM part")
def partner_names(spark, sf_dir):
    """Names of the partner files of proteins and coding sequences."""
    rows = _sql(spark, sf_dir, "SELECT p_partkey AS id, concat('sp', p_partkey, CASE WHEN p_size % 2 = 0 THEN '.cds' ELSE '.pep' END) AS file FROM part", "part")
    return rows.select("id", "file", fn.partner_file("file").alias("partner"))


@query("SELECT md5(concat(n_name, ' ', count(*), chr(10))) AS md5 FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name")
def file_checksums(spark, sf_dir):
    """Digests of listed files."""
    rows = _sql(spark, sf_dir, "SELECT n_nationkey AS flag, concat(n_name, ' ', count(*)) AS value FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name", "nation", "customer")
    return read.checksums(spark, f"{_lines(rows, 'files', 'flag')}/*/*.txt").select("md5")
