"""The registered ``opN_*`` queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audio, codes, decontaminate, html, licenses, merkle, minhash, pieces, quality, secrets, simhash, sql, substrings, tokenids
from .common import materialise, table


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each whole text keeps without the bytes of repeated 400-byte strings, and ``text``, the kept
    bytes as a string (of a character that is cut, the rest is a replacement sign)."""
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("spans", "kept")


def op2_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's bytes as a recording, one row for each class of equal queries that matches it;
    the queries are the doc_ids divisible by 100 (``own_class`` tells which class each belongs to)."""
    media = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("media"))
    return audio.by_class(audio.align(audio.fingerprints(media), F.col("doc_id") % 100 == 0))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page; no page, or one without text, has an empty one."""
    pages = html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, number and checksum of each document's ids, read back from their files; null texts have the end id only."""
    return tokenids.write_and_read(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document in benchmark windows; items without an id hit words and are not listed."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.drop("text")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of each document and the smallest id that is reachable over near ones; repeated rows have the same."""
    fps = materialise(simhash.fingerprints(table(spark, sf_dir, "documents")), "simhash")
    return simhash.near_components(fps).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and a checksum of each whole text's piece ids, and whether they decode to the text."""
    return pieces.summary(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices that each document holds, a row for each; documents without any, or without text, have none."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of each document, null and empty texts too, by a model of the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    labels = table(spark, sf_dir, "labels").where(~held_out)
    model = quality.train(docs, labels)
    scored = quality.score(docs, model).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and places of each document's secrets; texts without any, or null, have empty lists."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(docs))
    base = F.filter("__spans", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("__spans", lambda s: s["kind"] == k)).cast("long")
    return found.withColumn("__b", base).select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(secrets.listed("__b"), 256).alias("base_sha256"), secrets.listed("__spans").alias("spans"), count(3).alias("n_markov"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of each document; where 7 divides the id's CRC32, one more character is claimed."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    found = merkle.manifest(docs, claimed={"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    folded = found.withColumn("folded_root", merkle.fold("claimed"))
    return folded.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of each vector, the error of its label, and a digest of the final codebooks."""
    found, books = codes.compress(table(spark, sf_dir, "embeddings"))
    found = materialise(found, "codes")
    by_label = found.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = found.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of each document over links of a similarity of 0.8 or more."""
    return minhash.near_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op")}


_LOW = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_LOW} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_LOW} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT item, w, least(13, len(w)) AS n, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item FROM dw JOIN bw USING (n, s)),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY 1),
it AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw ON hw.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that it can express; the others are tested otherwise (tests/llm)."""
    return {"op5_decontaminate": _DECONTAMINATE, "op11_manifest": sql.MANIFEST, "op12_codes": sql.CODES, "op13_minhash": sql.MINHASH}
