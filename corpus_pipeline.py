"""A training-data pipeline over ``documents``; each stage works on what the one before kept.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the columns of
``docs``.  Rows with a null ``doc_id`` stay where a stage only rejects by content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phylospark.llm import decontaminate, pieces, quality, secrets, simhash
from phylospark.llm.common import materialise, table
from phylospark.llm.queries import tokenizer_file


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores under 0.5 go; a third of the labels is never learned from."""
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    model = quality.train(docs, table(spark, sf_dir, "labels").where(~held_out))
    return quality.score(docs, model, score_name="__score").where("__score >= 0.5").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays: the one with the smallest doc_id, null being the largest.

    A row's key is its doc_id and a hash of all its columns, so rows that share a doc_id (or have
    none) are compared like any others; among them the smallest hash decides.  Of rows alike in
    every column one stays.
    """
    content = F.xxhash64(*docs.columns)
    key = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", content.alias("content"))
    fps = materialise(simhash.fingerprints(docs.withColumn("__row", key), keys=("__row",)), "pipeline-fps")
    best = simhash.near_components(fps, key="__row").where("__row = component_id").groupBy("__row").count()
    best = materialise(best.select(F.col("__row.doc_id").alias("__id"), F.col("__row.content").alias("__content"), "count"), "pipeline-kept")

    def rows(some: DataFrame) -> DataFrame:
        return docs.join(some, docs.doc_id.eqNullSafe(some["__id"]) & (content == some["__content"]), "left_semi")

    kept = rows(best.where("count = 1"))
    again = best.where("count > 1")
    return kept.union(rows(again).distinct()) if again.limit(1).count() else kept


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least a twentieth of their words in benchmark passages go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows the text."""
    clean = secrets.redact(docs, secrets.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text (summarised), with the check that they decode to it."""
    return pieces.summary(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("pieces", encoded),
]
#: No SQL expresses the classifier, the piece search and the Markov model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
