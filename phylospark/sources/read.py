"""Readers: every format becomes a DataFrame by Spark's own splittable text and csv scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.clusters import stored
from ..operators.places import carried, in_ranges

HITS = "query_id string, subject_id string, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue double, bitscore double"
FEATURES = "contig string, source string, type string, start bigint, end bigint, score string, strand string, phase string, attributes string"


def _file() -> Column:
    """The file's whole path: names alone may be the same in several folders."""
    return F.col("_metadata.file_path")


def _ord() -> Column:
    """Order of rows within a file, over all its splits."""
    return F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def fasta(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``source``, ``ord``, ``seq_id`` (first token), ``header``, ``seq``; the last of equal ids wins.

    One row for each record comes from a splittable scan by the record separator.
    """
    reader = spark.read.option("lineSep", "\n>")
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    raw = reader.text(path).select(_file().alias("source"), _ord().alias("ord"), F.regexp_replace(F.regexp_replace("value", "\r", ""), "^>", "").alias("v"))
    rows = raw.where(F.trim("v") != "").select("source", "ord", F.regexp_extract("v", r"^([^\n]*)", 1).alias("header"), F.regexp_replace(F.regexp_extract("v", r"(?s)^[^\n]*\n(.*)$", 1), r"\s", "").alias("seq"))
    rows = rows.withColumn("seq_id", F.regexp_extract("header", r"^(\S*)", 1))
    last = F.row_number().over(W.partitionBy("source", "seq_id").orderBy(F.col("ord").desc()))
    return rows.withColumn("__n", last).where("__n = 1").select("source", "ord", "seq_id", "header", "seq")


def fasta_pieces(spark: SparkSession, path: str, size: int = 1 << 20) -> DataFrame:
    """``source``, ``seq_id``, ``record``, ``start`` (from 0) and ``seq`` of the pieces of each record, about ``size`` characters long.

    Files are read line by line, so that a record of any length, a whole chromosome, is many rows of many
    tasks.  A line belongs to the last header before it; headers and places are carried over ranges of
    lines.  Pieces begin at lines; ``record`` tells apart records of one name; a record without sequence has no piece.
    """
    lines = spark.read.text(path).select(_file().alias("source"), _ord().alias("ord"), F.regexp_replace("value", r"\s+$", "").alias("v"))
    lines = lines.select("source", "ord.block", "ord.row", "v", F.col("v").startswith(">").alias("head")).where("v <> ''")
    order = ["block", "row"]
    owner = F.when(F.col("head"), F.struct("block", "row", F.regexp_extract("v", r"^>\s*(\S*)", 1).alias("seq_id")))
    length = F.when(F.col("head"), 0).otherwise(F.length("v"))
    scanned = stored(carried(in_ranges(lines, ["source", *order]), ["source"], order, {"upto": length}, {"owner": owner}), "fasta-lines")
    heads = scanned.where("head").select("source", "owner", F.col("upto").alias("before"))
    placed = scanned.where("not head").join(heads, ["source", "owner"]).withColumn("at", F.col("upto") - F.length("v") - F.col("before"))
    pieces = placed.groupBy("source", "owner", F.expr(f"at div {size}").alias("piece")).agg(F.min("at").alias("start"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]), "").alias("seq"))
    return pieces.select("source", F.col("owner.seq_id").alias("seq_id"), F.struct("owner.block", "owner.row").alias("record"), "start", "seq")


def sequence_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line that is no header is a sequence of its own (gathered gene files)."""
    rows = spark.read.text(path).select(_file().alias("source"), _ord().alias("ord"), F.trim("value").alias("seq"))
    return rows.where((F.col("seq") != "") & ~F.col("seq").startswith(">"))


def gff(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """S3: nine-column features; comment lines and short lines are skipped; ``attrs`` is a map of key=value."""
    rows = spark.read.csv(path, sep="\t", comment="#", schema=FEATURES, mode="DROPMALFORMED", quote="")
    rows = rows.where("attributes is not null")
    rows = rows if kind is None else rows.where(F.col("type") == kind)
    pairs = F.filter(F.split("attributes", r";\s*"), lambda x: x.contains("="))
    entry = F.transform(pairs, lambda x: F.struct(F.trim(F.split_part(x, F.lit("="), F.lit(1))).alias("k"), F.regexp_replace(x, "^[^=]*=", "").alias("v")))
    return rows.withColumn("attrs", F.map_from_entries(_unique(entry)))


def gtf(spark: SparkSession, path: str, kind: str | None = "exon") -> DataFrame:
    """Features with attributes ``key "value";`` as a map; a key that occurs twice is an error."""
    rows = spark.read.csv(path, sep="\t", comment="#", schema=FEATURES, mode="DROPMALFORMED", quote="").where("attributes is not null")
    rows = rows if kind is None else rows.where(F.col("type") == kind)
    plain = F.regexp_replace(F.regexp_replace(F.trim("attributes"), ";$", ""), '"', "")
    return rows.withColumn("attrs", F.str_to_map(plain, F.lit(r";\s*"), F.lit(" ")))


def _unique(entries: Column) -> Column:
    """Key and value structs with the first of equal keys."""
    keys = F.transform(entries, lambda e: e["k"])
    return F.filter(entries, lambda e, i: F.array_position(keys, e["k"]) == i + 1)


def alignment_gff3(spark: SparkSession, path: str) -> DataFrame:
    """Transcript alignments: ``transcript``, ``gene``, ``contig``, ``strand`` and sorted ``segments``."""
    rows = gff(spark, path).withColumn("target", F.split_part(F.regexp_extract("attributes", "Target=([^;]+)", 1), F.lit(" "), F.lit(1))).where("target <> ''")
    both = F.col("target").rlike(r"^GENE\^.+,TRANS\^.+$")
    gene = F.when(both, F.regexp_extract("target", r"^GENE\^([^,]+)", 1))
    trans = F.when(both, F.regexp_extract("target", r"TRANS\^(.+)$", 1)).otherwise(F.col("target"))
    return rows.groupBy(trans.alias("transcript"), gene.alias("gene"), "contig", "strand").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("segments"))


def ortholog_table(spark: SparkSession, path: str) -> DataFrame:
    """The wide table as written, with ``row`` for its order."""
    return spark.read.csv(path, sep="\t", header=True).withColumn("row", F.monotonically_increasing_id())


def hits(spark: SparkSession, path: str) -> DataFrame:
    """Twelve-column similarity hits with ``source``; an empty file has no rows."""
    return spark.read.csv(path, sep="\t", schema=HITS, comment="#").withColumn("source", _file())


def domains(spark: SparkSession, path: str) -> DataFrame:
    """Protein-domain table: ``orf_id``, ``domain``, ``accession``, ``evalue``."""
    f = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    return rows.select(f[3].alias("orf_id"), f[0].alias("domain"), f[1].alias("accession"), F.get(f, F.lit(12)).try_cast("double").alias("evalue"))


def vcf(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record and sample; start is 0-based.  Sample names are the header line's of each file."""
    text = spark.read.text(path).select(_file().alias("source"), _ord().alias("ord"), F.split("value", "\t").alias("f"), "value")
    heads = text.where(F.col("value").startswith("#CHROM")).select("source", F.slice("f", 10, 1 << 20).alias("samples"))
    rows = text.where(~F.col("value").startswith("#") & (F.size("f") >= 10)).join(heads, "source")
    keys = F.split(F.col("f")[8], ":")
    one = rows.select("source", "ord", F.col("f")[0].alias("contig"), (F.col("f")[1].cast("bigint") - 1).alias("start"), F.col("f")[3].alias("ref"), F.filter(F.split(F.col("f")[4], ","), lambda a: a != ".").alias("alts"), keys.alias("keys"), F.posexplode(F.slice("f", 10, 1 << 20)).alias("i", "cell"), "samples")
    cell = F.split("cell", ":")
    get = lambda k: F.get(cell, F.array_position("keys", F.lit(k)).cast("int") - 1)
    gt = F.transform(F.split(F.coalesce(F.when(F.array_contains("keys", "GT"), get("GT")), F.lit(".")), r"[/|]"), lambda a: a.try_cast("int"))
    number = lambda k: F.when(F.array_contains("keys", k), get(k).try_cast("int"))
    return one.select("source", "ord", "contig", "start", (F.col("start") + F.length("ref")).alias("stop"), "ref", "alts", F.get("samples", F.col("i")).alias("sample"), gt.alias("gt"), number("GQ").alias("gq"), number("DP").alias("dp"))


def _genbank(spark: SparkSession, path: str) -> DataFrame:
    """One row for each GenBank entry."""
    return spark.read.option("lineSep", "//\n").text(path).select(_file().alias("source"), _ord().alias("ord"), F.regexp_replace("value", "\r", "").alias("entry")).where(F.trim("entry") != "")


def genbank_features(spark: SparkSession, path: str) -> DataFrame:
    """Features of entries: ``type``, ``gene``, ``strand``, ``segments`` (start, end; partial marks dropped)."""
    table = F.regexp_extract("entry", r"(?s)\nFEATURES[^\n]*\n(.*?)(?:\nORIGIN|\nBASE COUNT|\nCONTIG|\Z)", 1)
    blocks = F.split(F.concat(F.lit("\n"), table), r"\n {5}(?=\S)")
    rows = _genbank(spark, path).select("source", "ord", F.posexplode(blocks).alias("i", "block")).where("trim(block) <> ''")
    place = F.regexp_replace(F.regexp_extract("block", r"(?s)^\S+\s+(.*?)(?:\n\s+/|\Z)", 1), r"\s", "")
    found = F.transform(F.regexp_extract_all("place", F.lit(r"(<?\d+(?:\.\.>?\d+)?)"), F.lit(1)), lambda s: F.struct(F.regexp_extract(s, r"(\d+)", 1).cast("bigint").alias("start"), F.regexp_extract(s, r"(\d+)$", 1).cast("bigint").alias("end")))
    return rows.withColumn("place", place).select("source", "ord", "i", F.regexp_extract("block", r"^(\S+)", 1).alias("type"), F.nullif(F.regexp_extract("block", r'/gene="([^"]*)"', 1), F.lit("")).alias("gene"), F.when(F.col("place").contains("complement"), "-").otherwise("+").alias("strand"), F.array_sort(found).alias("segments"), F.regexp_replace(F.regexp_extract("block", r'(?s)/translation="([^"]*)"', 1), r"\s", "").alias("translation"))


def genbank_proteins(spark: SparkSession, path: str) -> DataFrame:
    """Gene and protein of coding features; of one gene name the first in file order wins."""
    rows = genbank_features(spark, path).where("type = 'CDS' and gene is not null and translation <> ''")
    first = F.row_number().over(W.partitionBy("gene").orderBy("source", "ord", "i"))
    return rows.withColumn("n", first).where("n = 1").select("gene", F.col("translation").alias("seq"))


def newick(spark: SparkSession, path: str) -> DataFrame:
    """``tree_id`` (file and place) and ``newick`` of a corpus, ;-separated or one per line; blanks skipped."""
    rows = spark.read.option("lineSep", ";").text(path).select(_file().alias("source"), _ord().alias("ord"), F.trim(F.regexp_replace("value", r"[\r\n]+", " ")).alias("t"))
    number = F.row_number().over(W.partitionBy("source").orderBy("ord"))
    return rows.where("t <> ''").select("source", F.concat_ws(":", "source", number).alias("tree_id"), F.concat("t", F.lit(";")).alias("newick"))


def cv_report(spark: SparkSession, path: str) -> DataFrame:
    """``run``, ``ord``, ``smooth``, ``chisq`` from lines ``chisq: (smooth) value``."""
    form = r"chisq:\s*\(([^)]+)\)\s*(\S+)"
    rows = spark.read.text(path).select(_file().alias("run"), _ord().alias("ord"), "value").where(F.col("value").rlike(form))
    return rows.select("run", "ord", F.regexp_extract("value", form, 1).cast("double").alias("smooth"), F.regexp_extract("value", form, 2).cast("double").alias("chisq"))


def network_report(spark: SparkSession, path: str) -> DataFrame:
    """First tree line and first total log probability of each report."""
    rows = spark.read.text(path, wholetext=True).select(_file().alias("run"), "value")
    return rows.select("run", F.trim(F.regexp_extract("value", r"Visualize[^:\n]*:\s*([^\n]+)", 1)).alias("tree"), F.nullif(F.regexp_extract("value", r"Total log probability:\s*(\S+)", 1), F.lit("")).cast("double").alias("log_probability"))


def mcmc_statistics(spark: SparkSession, path: str) -> DataFrame:
    """``run``, ``min_ess``, ``psrf`` from parameter-statistic files with a header of names."""
    rows = spark.read.text(path).select(_file().alias("run"), _ord().alias("ord"), F.split(F.trim("value"), r"\t+").alias("f"))
    head = rows.where(F.array_contains("f", "minESS")).groupBy("run").agg(F.min_by("f", "ord").alias("h"))
    get = lambda k: F.get("f", F.array_position("h", F.lit(k)).cast("int") - 1).try_cast("double")
    return rows.join(head, "run").select("run", get("minESS").alias("min_ess"), get("PSRF").alias("psrf")).where("min_ess is not null or psrf is not null")


def harmonic_means(spark: SparkSession, path: str) -> DataFrame:
    """The row of all runs in likelihood-statistic files."""
    f = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).select(_file().alias("run"), "value").where(F.lower(f[0]) == "all")
    return rows.select("run", f[1].try_cast("double").alias("arithmetic_mean"), f[2].try_cast("double").alias("harmonic_mean"))


def alignment_length(spark: SparkSession, path: str) -> DataFrame:
    """Sites of each file: ``nchar=`` of NEXUS, else the first FASTA record's length."""
    texts = spark.read.text(path, wholetext=True).select(_file().alias("source"), "value")
    nexus = F.nullif(F.regexp_extract(F.lower("value"), r"nchar\s*=\s*(\d+)", 1), F.lit("")).cast("bigint")
    first = F.regexp_replace(F.regexp_extract("value", r"(?s)^\s*>[^\n]*\n(.*?)(?=\n>|\Z)", 1), r"\s", "")
    return texts.select("source", F.coalesce(nexus, F.length(first).cast("bigint")).alias("length"))


def contig_index(spark: SparkSession, path: str) -> DataFrame:
    """Contigs of a reference index in order, with lengths."""
    rows = spark.read.csv(path, sep="\t", schema="contig string, length bigint, offset bigint, bases int, width int")
    return rows.withColumn("place", F.row_number().over(W.orderBy("offset", "contig")))


def file_list(spark: SparkSession, globs: list[str]) -> DataFrame:
    """U4: ``path`` and ``name`` of the distinct files that any of the patterns finds.  Only names are read."""
    files = spark.read.format("binaryFile").load(globs).select("path").distinct()
    return files.select("path", F.regexp_extract("path", "([^/]+)$", 1).alias("name"))


def pair_names(files: DataFrame, suffixes: list[tuple[str, str]]) -> DataFrame:
    """``sample``, ``forward``, ``reverse`` of ``files(path, name)``; unpaired ones are left out, the first suffix pair wins."""
    out = None
    for i, (a, b) in enumerate(suffixes):
        side = lambda s, as_: files.where(F.col("name").endswith(s)).select(F.expr(f"substr(name, 1, length(name) - {len(s)})").alias("sample"), F.col("path").alias(as_))
        pairs = side(a, "forward").join(side(b, "reverse"), "sample").withColumn("rank", F.lit(i))
        out = pairs if out is None else out.unionByName(pairs)
    return out.groupBy("sample").agg(F.min_by(F.struct("forward", "reverse"), "rank").alias("p")).select("sample", "p.*")


def paired_files(spark: SparkSession, path: str, suffixes: list[tuple[str, str]]) -> DataFrame:
    """Pairs among the files of a folder (:func:`pair_names`)."""
    return pair_names(file_list(spark, [path]), suffixes)


def name_list(spark: SparkSession, path: str) -> DataFrame:
    """One name on each line."""
    rows = spark.read.text(path).select(_ord().alias("ord"), F.trim("value").alias("name")).where("name <> ''")
    return rows.select("name", F.row_number().over(W.orderBy("ord")).alias("place"))


def clade_groups(spark: SparkSession, path: str) -> DataFrame:
    """Groups separated by lines of ==, named Clade_1, ..."""
    rows = spark.read.text(path).select(_ord().alias("ord"), F.trim("value").alias("v")).where("v <> ''")
    number = F.sum(F.when(F.col("v").startswith("=="), 1).otherwise(0)).over(W.orderBy("ord")) + 1
    return rows.withColumn("n", number).where(~F.col("v").startswith("==")).select(F.concat(F.lit("Clade_"), F.col("n").cast("string")).alias("clade"), F.col("v").alias("sample"))


def name_map(spark: SparkSession, path: str) -> DataFrame:
    """Renaming table with header current_sample_name, standard_latin_name."""
    return spark.read.csv(path, header=True).select(F.trim("current_sample_name").alias("current_sample_name"), F.trim("standard_latin_name").alias("standard_latin_name"))


def calibration_text(spark: SparkSession, path: str) -> DataFrame:
    """Calibrations in groups of three lines: name and subtree, largest age, smallest age."""
    rows = spark.read.text(path).select(_ord().alias("ord"), F.trim("value").alias("v")).where("v <> ''").withColumn("i", F.row_number().over(W.orderBy("ord")) - 1)
    line = lambda k: F.max(F.when(F.col("i") % 3 == k, F.col("v")))
    number = lambda k: F.regexp_extract(line(k), r"([-+.\deE]+)\s*;?$", 1).try_cast("double")
    rows = rows.groupBy(F.floor(F.col("i") / 3).alias("n")).agg(line(0).alias("head"), number(1).alias("max_age"), number(2).alias("min_age"))
    return rows.select(F.regexp_extract("head", r"^(\S+)", 1).alias("list_id"), F.regexp_extract_all(F.regexp_replace("head", r"^\S+\s*", ""), F.lit(r"([^\s(),;:]+)"), F.lit(1)).alias("taxa"), "max_age", "min_age")


def score_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """K-mer, ROC and AUC tables with a header line."""
    return spark.read.csv(path, sep="\t", header=True, schema=schema)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """MD5 of listed files."""
    return spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), F.md5("content").alias("md5"))
