"""The given tables as the library's inputs.  Each view is one SQL text for Spark and DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_FROM = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ "
_TO = "ACGTACGTACGTACGTACGT-?NACG" * 2 + "-"

#: documents as aligned rows: letters stand for bases, gaps and unknowns; other characters stay
ALIGNMENTS = f"(SELECT concat(lang, '_', CAST(doc_id % 10 AS VARCHAR(9))) AS locus, doc_id AS ord, CAST(doc_id AS VARCHAR(20)) AS seq_id, translate(text, concat('{_FROM}', chr(10)), '{_TO}-') AS seq FROM documents)"
#: the same rows reduced to plain bases
CODING = f"(SELECT locus, ord, seq_id AS orf_id, seq_id, regexp_replace_all(seq, '[^ACGT]', '') AS seq FROM {ALIGNMENTS})"
#: orders as intervals on customers; lengths vary with the price
INTERVALS = "(SELECT o_custkey AS contig, o_orderkey AS ord, o_orderkey AS id, CAST(floor(o_totalprice) AS BIGINT) % 1000 * 10 + o_orderkey % 97 AS start, CAST(floor(o_totalprice) AS BIGINT) % 1000 * 10 + o_orderkey % 97 + CAST(floor(o_totalprice) AS BIGINT) % 400 AS stop FROM orders)"
#: parts as groups, nations of the suppliers as species, order lines as genes
ORTHO = "(SELECT l_partkey AS group_id, l_partkey % 20 / 20.0 AS alg_conn, concat('s', CAST(s_nationkey AS VARCHAR(9))) AS species, concat(CAST(l_orderkey AS VARCHAR(20)), '_', CAST(l_linenumber AS VARCHAR(9)), '_', CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR(20))) AS gene_id, CAST(floor(l_extendedprice) AS BIGINT) AS length, l_orderkey * 10 + l_linenumber AS ord FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"
#: order lines as similarity hits
HITS = "(SELECT l_orderkey AS query_id, l_partkey AS subject_id, l_extendedprice AS bitscore, l_discount AS evalue FROM lineitem)"
#: event values as ages
AGES = "(SELECT CAST(user_id AS VARCHAR(20)) AS sample, value AS age FROM events WHERE value IS NOT NULL)"
#: order lines as genotype calls
GENOTYPES = "(SELECT l_returnflag AS contig, l_partkey AS start, CASE WHEN l_linestatus = 'O' THEN 'A' ELSE 'C' END AS ref, CASE WHEN l_linenumber % 2 = 0 THEN 'G' ELSE 'T' END AS alt, concat('s', CAST(l_suppkey % 5 AS VARCHAR(9))) AS sample, l_linenumber % 3 AS kind, CAST(l_quantity AS INTEGER) AS gq, CAST(round(l_tax * 100) AS INTEGER) AS dp, l_orderkey * 10 + l_linenumber AS ord FROM lineitem)"


def tables(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A view's rows (its tables are registered first)."""
    known = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "pages", "conversations")
    tables(spark, sf_dir, *[n for n in known if n in text])
    return spark.sql("SELECT * FROM " + text.replace("regexp_replace_all", "regexp_replace"))


def duck(text: str) -> str:
    """The view's text in DuckDB's words."""
    import re

    return re.sub(r"regexp_replace_all\((\w+), ('[^']*'), ''\)", r"regexp_replace(\1, \2, '', 'g')", text)
