"""Similarity hits: ``hits(query_id, subject_id, ..., bitscore)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ratio


def contamination_ratio(records: DataFrame, hits: DataFrame, threshold: float = 0.1) -> DataFrame:
    """A5: per sample, distinct hit queries over records; flagged from the threshold on; 0 without records.

    ``records(sample, seq_id)``, ``hits(sample, query_id)``.
    """
    n = records.groupBy("sample").agg(F.count("*").alias("records"))
    hit = hits.groupBy("sample").agg(F.count_distinct("query_id").alias("hit_queries"))
    out = n.join(hit, "sample", "full").na.fill(0, ["records", "hit_queries"])
    share = F.coalesce(ratio("hit_queries", "records"), F.lit(0.0))
    return out.withColumn("ratio", F.round(share, 6)).withColumn("flagged", share >= threshold)


def split_contaminated(samples: DataFrame, ratios: DataFrame) -> DataFrame:
    """Every data set of a flagged sample is removed, whole."""
    flags = ratios.select("sample", "flagged")
    return samples.join(flags, "sample", "left").withColumn("status", F.when(F.col("flagged"), "removed").otherwise("kept")).drop("flagged")


def best_subject(hits: DataFrame, key: str = "query_id") -> DataFrame:
    """Subject with the largest sum of bit scores; ties to the smallest subject."""
    sums = hits.groupBy(key, "subject_id").agg(F.round(F.sum("bitscore"), 4).alias("total"))
    return sums.groupBy(key).agg(F.min_by(F.struct("subject_id", "total"), F.struct(-F.col("total"), "subject_id")).alias("b")).select(key, "b.subject_id", "b.total")


def homology_evidence(orfs: DataFrame, hits: DataFrame, domains: DataFrame) -> DataFrame:
    """Number of evidence types (0 to 2) of every ORF."""
    a = hits.select(F.col("query_id").alias("orf_id")).distinct().withColumn("h", F.lit(1))
    b = domains.select("orf_id").distinct().withColumn("d", F.lit(1))
    return orfs.join(a, "orf_id", "left").join(b, "orf_id", "left").withColumn("homology_count", F.coalesce("h", F.lit(0)) + F.coalesce("d", F.lit(0))).drop("h", "d")


def with_scores(rows: DataFrame, scores: DataFrame, key: str = "feature", missing: str = "__MISSING_INFO__") -> DataFrame:
    """Score text of each listed feature, or the mark for none."""
    return rows.join(scores.select(key, F.col("score").cast("string").alias("score")), key, "left").na.fill(missing, ["score"])
