"""Sequencing reads: ``reads(read_id, mate, seq, qual)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .counts import distinct_windows, kept_bases


def trim(reads: DataFrame, **options) -> DataFrame:
    """Trimmed reads (see ``functions.trim_quality``); of a pair both mates have to survive."""
    cut = reads.where("read_id is not null").select("read_id", "mate", "seq", "qual", kept_bases("qual", **options).alias("k"))
    part = lambda c: F.when(F.col("k").isNotNull(), F.substr(c, F.col("k.at"), F.col("k.n"))).alias(c)
    rows = cut.select("read_id", "mate", F.col("k").isNotNull().alias("__left"), part("seq"), part("qual"))
    own = W.partitionBy("read_id")  # the mates of one read
    mates = lambda x: F.size(F.collect_set(x).over(own))
    counted = rows.withColumn("__mates", mates(F.col("mate"))).withColumn("__kept", mates(F.when(F.col("__left"), F.col("mate"))))
    return counted.where("__left and __mates = __kept").select("read_id", "mate", "seq", "qual")


def longest_records(sequences: DataFrame, n: int, longest: int | None = None) -> DataFrame:
    """The n longest entries, those over ``longest`` left out before counting; ties by input order."""
    rows = sequences if longest is None else sequences.where(F.length("seq") <= longest)
    return rows.orderBy(F.length("seq").desc(), "ord").limit(n)


def low_complexity(proteins: DataFrame, least: float = 0.3) -> DataFrame:
    """proteins whose distinct 5-mers are under ``least`` of length / 5 windows."""
    n = F.length("seq")
    return proteins.withColumn("kinds", distinct_windows("seq", 5)).withColumn("low", F.col("kinds") < least * n / 5)


def longest_isoform(sequences: DataFrame, gene: str = "gene") -> DataFrame:
    """The longest record of each source and gene (first of equals)."""
    best = F.max_by(F.struct("seq_id", "seq", "ord"), F.struct(F.length("seq"), -F.col("ord")))
    return sequences.groupBy("source", gene).agg(best.alias("b")).select("source", gene, "b.*")
