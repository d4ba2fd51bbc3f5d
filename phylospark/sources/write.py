"""Writers: each makes one text column and lets Spark write it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import wrap


def _text(rows: DataFrame, line: Column, path: str | None, by: list[str] | None = None, order: list | None = None) -> DataFrame:
    """The text rows; written where a path is given."""
    if order:
        rows = rows.repartition(*by).sortWithinPartitions(*by, *order) if by else rows.repartitionByRange(*order).sortWithinPartitions(*order)
    out = rows.select(*(by or []), line.alias("value"))
    if path:
        writer = out.write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).text(path)
    return out


def fasta(sequences: DataFrame, path: str | None = None, by: str | None = None, order: str = "ord", width: int | None = 80) -> DataFrame:
    """K1, K2: FASTA wrapped at ``width``; one folder for each value of ``by`` (a locus or gene)."""
    seq = wrap("seq", width) if width else F.col("seq")
    return _text(sequences, F.concat(F.lit(">"), "seq_id", F.lit("\n"), seq), path, [by] if by else None, [order] if order in sequences.columns else ["seq_id"])


def gff3(features: DataFrame, path: str | None = None) -> DataFrame:
    """K3: nine-column lines in order of contig and start."""
    dot = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    return _text(features, F.concat_ws("\t", *map(dot, ("contig", "source", "type", "start", "end", "score", "strand", "phase", "attributes"))), path, order=["contig", "start", "end"])


def bed12(exons: DataFrame, path: str | None = None, track: str | None = None) -> DataFrame:
    """K4: ``exons(transcript, contig, strand, start, end)`` as BED12 lines, after a track line if named."""
    per = exons.groupBy("transcript", "contig", "strand").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s"), (F.min("start") - 1).alias("lo"), F.max("end").alias("hi"))
    sizes = F.array_join(F.transform("s", lambda x: (x["end"] - x["start"] + 1).cast("string")), ",")
    starts = F.array_join(F.transform("s", lambda x: (x["start"] - 1 - F.col("lo")).cast("string")), ",")
    line = F.concat_ws("\t", "contig", "lo", "hi", "transcript", F.lit("0"), "strand", "lo", "hi", F.lit("0"), F.size("s"), sizes, starts)
    rows = per.select("contig", F.col("lo").alias("at"), line.alias("l"))
    if track:
        head = rows.sparkSession.createDataFrame([("", -1, f"track name={track}")], "contig string, at long, l string")
        rows = head.unionByName(rows)
    return _text(rows, F.col("l"), path, order=["contig", "at"])


def gtf(features: DataFrame, path: str | None = None) -> DataFrame:
    """K5: features(contig, source, type, start, end, strand, gene, transcript) as GTF."""
    attrs = F.concat(F.lit('gene_id "'), "gene", F.lit('"; transcript_id "'), "transcript", F.lit('";'))
    return _text(features, F.concat_ws("\t", "contig", "source", "type", "start", "end", F.lit("."), "strand", F.lit("."), attrs), path, order=["contig", "start"])


def alignment_gff3(exons: DataFrame, path: str | None = None) -> DataFrame:
    """K6: exons as cDNA matches with their places in the transcript (columns off_lo, off_hi)."""
    attrs = F.concat(F.lit("ID="), "transcript", F.lit(";Target="), "transcript", F.lit(" "), "off_lo", F.lit(" "), "off_hi", F.lit(" +"))
    return _text(exons, F.concat_ws("\t", "contig", F.lit("phylospark"), F.lit("cDNA_match"), "start", "end", F.lit("."), "strand", F.lit("."), attrs), path, order=["contig", "transcript", "start"])


def interval_text(features: DataFrame, path: str | None = None) -> DataFrame:
    """K7: strand arrow, span and gene, then a line for each segment (exon or utr)."""
    span = F.struct(F.array_min(F.transform("segments", lambda s: s["start"])).alias("a"), F.array_max(F.transform("segments", lambda s: s["end"])).alias("b"))
    head = F.concat_ws("\t", F.when(F.col("strand") == "-", "<").otherwise(">"), span["a"], span["b"], "gene")
    kind = F.when(F.col("type") == "CDS", "exon").otherwise("utr")
    body = F.transform("segments", lambda s: F.concat_ws("\t", s["start"], s["end"], kind))
    return _text(features, F.array_join(F.concat(F.array(head), body), "\n"), path, order=["ord", "i"] if "i" in features.columns else ["ord"])


def partition_lines(partitions: DataFrame, path: str | None = None) -> DataFrame:
    """K8: ``DNA, name = a-b``."""
    return _text(partitions, F.concat(F.lit("DNA, "), "locus", F.lit(" = "), "first", F.lit("-"), "last"), path, order=["first"])


def tree_block(trees: DataFrame, command: str = "InferNetwork_MPL", most: int = 5, path: str | None = None) -> DataFrame:
    """K9: numbered trees and one command for each reticulation count 0 to ``most``: one block row each."""
    from pyspark.sql import Window as W

    numbered = trees.withColumn("n", F.row_number().over(W.orderBy("tree_id")) - 1)
    block = numbered.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "newick"))), lambda t: F.concat(F.lit("Tree geneTree"), t["n"].cast("string"), F.lit(" = "), t["newick"])), "\n").alias("b"), F.max("n").alias("last"))
    each = block.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(most))))
    line = F.concat(F.lit("#NEXUS\nBEGIN TREES;\n"), "b", F.lit(f"\nEND;\nBEGIN PHYLONET;\n{command} (all) "), F.col("k").cast("string"), F.lit(";\nEND;"))
    return _text(each, line, path, ["k"], ["last"])


def report(rows: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Tab-separated report with header, in folders by some columns."""
    writer = rows.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "NA")
    (writer.partitionBy(*by) if by else writer).csv(path)


def dating_config(calibrations: DataFrame, settings: dict[str, str], path: str | None = None) -> DataFrame:
    """Per tree, calibration lines (mrca, min, max of ``name`` and ``taxa``) and settings."""
    one = F.concat(F.lit("mrca = "), "name", F.lit(" "), F.array_join("taxa", " "), F.lit("\nmin = "), "name", F.lit(" "), F.col("min_age").cast("string"), F.lit("\nmax = "), "name", F.lit(" "), F.col("max_age").cast("string"))
    per = calibrations.withColumn("l", one).groupBy("tree_id").agg(F.array_join(F.array_sort(F.collect_list("l")), "\n").alias("l"))
    tail = "\n".join(f"{k} = {v}" for k, v in settings.items())
    return _text(per, F.concat("l", F.lit("\n" + tail)), path, ["tree_id"], ["l"])


def nexus(alignment: DataFrame, partitions: DataFrame | None = None, path: str | None = None) -> DataFrame:
    """matrix(seq_id, seq) with character sets as one NEXUS text (one data set)."""
    matrix = alignment.agg(F.count("*").alias("n"), F.max(F.length("seq")).alias("len"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq_id", "seq"))), lambda r: F.concat_ws(" ", r["seq_id"], r["seq"])), "\n").alias("m"))
    text = F.concat(F.lit("#NEXUS\nbegin data;\ndimensions ntax="), F.col("n").cast("string"), F.lit(" nchar="), F.col("len").cast("string"), F.lit(";\nformat datatype=dna missing=? gap=-;\nmatrix\n"), "m", F.lit("\n;\nend;"))
    if partitions is not None:
        lines = F.transform(F.array_sort(F.collect_list(F.struct("first", "locus", "last"))), lambda p: F.concat(F.lit("charset "), p["locus"], F.lit(" = "), p["first"].cast("string"), F.lit("-"), p["last"].cast("string"), F.lit(";")))
        sets = partitions.agg(F.array_join(lines, "\n").alias("sets"))  # one row beside one row
        matrix = matrix.crossJoin(sets)
        text = F.concat(text, F.lit("\nbegin sets;\n"), "sets", F.lit("\nend;"))
    return _text(matrix, text, path)


def fastq_parts(reads: DataFrame, path: str, parts: int) -> None:
    """reads(read_id, seq, qual) split into about equal files, mates together."""
    line = F.concat(F.lit("@"), "read_id", F.lit("\n"), "seq", F.lit("\n+\n"), "qual")
    reads.repartition(parts, "read_id").select(line.alias("value")).write.mode("overwrite").text(path)
