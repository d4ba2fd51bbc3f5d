"""Queries over ortholog, hit, interval, statistics and genotype views of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alignment, coding, genotypes, hits, intervals, ortho, stats
from .registry import query
from .views import AGES, GENOTYPES, HITS, INTERVALS, ORTHO, tables, view

#: order lines as a small matrix: loci are return flags, taxa suppliers, the text is the count
_TAXA = "(SELECT l_returnflag AS locus, l_suppkey AS ord, CAST(l_suppkey AS VARCHAR(20)) AS seq_id, CAST(count(*) AS VARCHAR(20)) AS seq FROM lineitem WHERE l_linestatus = 'O' OR l_suppkey % 3 <> 0 GROUP BY l_returnflag, l_suppkey)"


@query(f"WITH a AS {_TAXA}, l AS (SELECT locus, arg_min(length(seq), ord) AS n FROM a GROUP BY 1), t AS (SELECT DISTINCT seq_id FROM a) SELECT t.seq_id, string_agg(coalesce(a.seq, repeat('?', n)), '' ORDER BY l.locus) AS seq FROM t CROSS JOIN l LEFT JOIN a ON a.locus = l.locus AND a.seq_id = t.seq_id GROUP BY 1")
def supermatrix_concat(spark, sf_dir):
    return alignment.supermatrix(view(spark, sf_dir, _TAXA)).select("seq_id", "seq")


@query(f"WITH a AS {_TAXA}, c AS (SELECT seq_id FROM a GROUP BY 1 HAVING count(DISTINCT locus) = (SELECT count(DISTINCT locus) FROM a)) SELECT seq_id, string_agg(seq, '' ORDER BY locus) AS seq FROM a WHERE seq_id IN (SELECT seq_id FROM c) GROUP BY 1")
def intersection_concat(spark, sf_dir):
    return alignment.intersection_matrix(view(spark, sf_dir, _TAXA))


@query("WITH l AS (SELECT p_brand AS locus, CAST(sum(p_size) AS BIGINT) AS length FROM part GROUP BY 1) SELECT locus, length, CAST(sum(length) OVER (ORDER BY locus) - length + 1 AS BIGINT) AS first, CAST(sum(length) OVER (ORDER BY locus) AS BIGINT) AS last FROM l")
def partition_offsets(spark, sf_dir):
    tables(spark, sf_dir, "part")
    lengths = spark.sql("SELECT p_brand AS locus, CAST(sum(p_size) AS BIGINT) AS length FROM part GROUP BY 1")
    return alignment.partitions(lengths)


_PER = f"o AS {ORTHO}, per AS (SELECT group_id, species, count(*) AS n, max(alg_conn) AS conn FROM o GROUP BY ALL), ns AS (SELECT count(DISTINCT species) AS k FROM o)"


@query(f"WITH {_PER} SELECT group_id, count(*) AS present, max(n) AS most FROM per GROUP BY 1 HAVING ((SELECT k FROM ns) - count(*)) / (SELECT k FROM ns)::DOUBLE <= 0.35 AND max(conn) >= 0.1 AND max(n) <= 4")
def ortholog_filter(spark, sf_dir):
    rows = view(spark, sf_dir, ORTHO)
    return ortho.keep_groups(rows, rows.agg(F.count_distinct("species")), 0.35, 0.1, 4)


@query(f"WITH o AS {ORTHO} SELECT group_id, species, arg_max(gene_id, (length, -ord)) AS gene_id, max(length) AS length FROM o GROUP BY ALL")
def longest_copy(spark, sf_dir):
    rows = view(spark, sf_dir, ORTHO)
    return ortho.longest_copy(rows.drop("length"), rows.select("species", "gene_id", "length"))


@query(f"WITH o AS {ORTHO}, b AS (SELECT DISTINCT species, group_id % 7 AS g FROM o) SELECT species, " + ", ".join(f"CAST(max(CASE WHEN g = {k} THEN 1 ELSE 0 END) AS INTEGER) AS g{k}" for k in range(7)) + " FROM b GROUP BY 1")
def presence_absence(spark, sf_dir):
    rows = view(spark, sf_dir, ORTHO).withColumn("group_id", F.concat(F.lit("g"), (F.col("group_id") % 7).cast("string")))
    return ortho.presence_absence(rows, [f"g{k}" for k in range(7)])


@query(f"WITH o AS {ORTHO} SELECT species, count(*) AS genes, count(DISTINCT group_id) AS groups FROM o GROUP BY 1")
def genes_per_species(spark, sf_dir):
    return ortho.genes_per_species(view(spark, sf_dir, ORTHO))


@query(f"WITH {_PER} SELECT group_id, count(*) AS species, CAST(sum(n) AS BIGINT) AS genes, CASE WHEN count(*) = 1 THEN 'specific' WHEN max(n) = 1 THEN 'single_copy' ELSE 'multi_copy' END AS kind FROM per GROUP BY 1")
def group_types(spark, sf_dir):
    return ortho.group_types(view(spark, sf_dir, ORTHO)).select("group_id", "species", "genes", "kind")


@query("WITH a AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_name) AS i FROM supplier), b AS (SELECT c_custkey, row_number() OVER (ORDER BY c_name) AS i FROM customer) SELECT s_suppkey, c_custkey, i FROM a JOIN b USING (i)")
def positional_pairing(spark, sf_dir):
    tables(spark, sf_dir, "supplier", "customer")
    return ortho.positional_pairs(spark.table("supplier").select("s_suppkey", "s_name"), spark.table("customer").select("c_custkey", "c_name"), "s_name", "c_name").select("s_suppkey", "c_custkey", F.col("i").cast("long").alias("i"))


@query("SELECT c_custkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey < 3")
def rename_tips(spark, sf_dir):
    tables(spark, sf_dir, "customer", "nation")
    names = spark.sql("SELECT CAST(n_nationkey AS STRING) AS current_sample_name, n_name AS standard_latin_name FROM nation WHERE n_regionkey < 3")
    return ortho.rename(spark.sql("SELECT c_custkey, CAST(c_nationkey AS STRING) AS name FROM customer"), names, "name")


@query("WITH g AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS n FROM part) SELECT p_partkey, concat('ortho', CAST(n AS VARCHAR)) AS name FROM g")
def running_names(spark, sf_dir):
    tables(spark, sf_dir, "part")
    return ortho.numbered(spark.sql("SELECT p_partkey FROM part"), "p_partkey")


@query("WITH g AS (SELECT l_partkey AS family, count(DISTINCT l_suppkey) AS species, count(*) AS genes FROM lineitem GROUP BY 1) SELECT * FROM g WHERE species >= 4 AND species <> genes")
def family_filter(spark, sf_dir):
    tables(spark, sf_dir, "lineitem")
    return ortho.family_filter(spark.sql("SELECT l_partkey AS family, count(DISTINCT l_suppkey) AS species, count(*) AS genes FROM lineitem GROUP BY 1"), "species", "genes", 4, True)


_BEST = "h AS (SELECT l_partkey AS q, l_suppkey AS s, l_partkey % 3 AS qs, l_suppkey % 3 AS ss, l_extendedprice AS b FROM lineitem)"


@query(f"WITH {_BEST}, both_ AS (SELECT q * 2 AS q, s * 2 + 1 AS s, 0 AS qs, 1 AS ss, b FROM h UNION ALL SELECT s * 2 + 1, q * 2, 1, 0, b FROM h), best AS (SELECT q, ss, arg_min(s, (-b, s)) AS s FROM both_ GROUP BY ALL) SELECT a.q AS src, a.s AS dst FROM best a JOIN best c ON c.q = a.s AND c.s = a.q WHERE a.q < a.s")
def reciprocal_best_hits(spark, sf_dir):
    tables(spark, sf_dir, "lineitem")
    h = spark.sql("SELECT l_partkey * 2 AS query_id, l_suppkey * 2 + 1 AS subject_id, 0 AS query_species, 1 AS subject_species, l_extendedprice AS bitscore FROM lineitem")
    back = h.select(F.col("subject_id").alias("query_id"), F.col("query_id").alias("subject_id"), F.lit(1).alias("query_species"), F.lit(0).alias("subject_species"), "bitscore")
    return ortho.reciprocal_best(h.union(back))


# hits -------------------------------------------------------------------------------------------


@query(f"WITH h AS {HITS}, s AS (SELECT query_id, subject_id, round(sum(bitscore), 4) AS total FROM h GROUP BY ALL) SELECT query_id, arg_min(subject_id, (-total, subject_id)) AS subject_id, max(total) AS total FROM s GROUP BY 1")
def best_gene(spark, sf_dir):
    return hits.best_subject(view(spark, sf_dir, HITS))


_RATIO = "r AS (SELECT o_custkey AS sample, count(*) AS records FROM orders GROUP BY 1), q AS (SELECT o_custkey AS sample, count(DISTINCT o_orderkey) AS hit_queries FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_discount = 0.1 GROUP BY 1), c AS (SELECT sample, records, coalesce(hit_queries, 0) AS hit_queries, round(coalesce(hit_queries, 0) / records::DOUBLE, 6) AS ratio, coalesce(hit_queries, 0) / records::DOUBLE >= 0.5 AS flagged FROM r LEFT JOIN q USING (sample))"


def _ratios(spark, sf_dir):
    tables(spark, sf_dir, "orders", "lineitem")
    records = spark.sql("SELECT o_custkey AS sample, o_orderkey AS seq_id FROM orders")
    hit = spark.sql("SELECT o_custkey AS sample, o_orderkey AS query_id FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_discount = 0.1")
    return hits.contamination_ratio(records, hit, 0.5)


@query(f"WITH {_RATIO} SELECT * FROM c")
def contamination_ratio(spark, sf_dir):
    return _ratios(spark, sf_dir)


@query(f"WITH {_RATIO} SELECT c_custkey AS sample, CASE WHEN flagged THEN 'removed' ELSE 'kept' END AS status FROM customer LEFT JOIN c ON sample = c_custkey")
def contaminated_samples(spark, sf_dir):
    ratios = _ratios(spark, sf_dir)
    tables(spark, sf_dir, "customer")
    return hits.split_contaminated(spark.sql("SELECT c_custkey AS sample FROM customer"), ratios)


@query("SELECT o_orderkey AS orf_id, CAST((o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount = 0)) AS INTEGER) + CAST((o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_tax = 0)) AS INTEGER) AS homology_count FROM orders")
def homology_evidence(spark, sf_dir):
    tables(spark, sf_dir, "orders", "lineitem")
    a = spark.sql("SELECT l_orderkey AS query_id FROM lineitem WHERE l_discount = 0")
    b = spark.sql("SELECT l_orderkey AS orf_id FROM lineitem WHERE l_tax = 0")
    return hits.homology_evidence(spark.sql("SELECT o_orderkey AS orf_id FROM orders"), a, b)


# intervals --------------------------------------------------------------------------------------


def _intervals(spark, sf_dir):
    return view(spark, sf_dir, INTERVALS).withColumnRenamed("stop", "end")


@query(f"WITH f AS {INTERVALS}, w AS (SELECT *, max(stop) OVER (PARTITION BY contig ORDER BY start, stop, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM f) SELECT contig, id, start, stop AS \"end\" FROM w WHERE seen IS NULL OR start > seen")
def nonoverlapping_intervals(spark, sf_dir):
    return intervals.nonoverlapping(_intervals(spark, sf_dir)).select("contig", "id", "start", "end")


@query(f"WITH f AS {INTERVALS} SELECT contig, id, start, stop AS \"end\" FROM f a WHERE NOT EXISTS (SELECT 1 FROM f b WHERE b.contig = a.contig AND b.start < a.start AND b.stop > a.stop)")
def contained_intervals(spark, sf_dir):
    return intervals.not_eclipsed(_intervals(spark, sf_dir)).select("contig", "id", "start", "end")


def _greedy(order: str, limit: str) -> str:
    """SQL that takes each contig's intervals one after the other and keeps those that no kept one overlaps by more than a limit."""
    own = "{'s': start, 'e': stop, 'id': id}"
    both, short = "least(x.e, r.stop) - greatest(x.s, r.start) + 1", "least(x.e - x.s + 1, r.stop - r.start + 1)"
    return f"""WITH RECURSIVE f AS {INTERVALS}, r AS (SELECT *, row_number() OVER (PARTITION BY contig ORDER BY {order}) AS k FROM f),
step AS (SELECT contig, k, [{own}] AS kept FROM r WHERE k = 1
UNION ALL SELECT r.contig, r.k, CASE WHEN len(list_filter(kept, lambda x: {both} > 0 AND {both} > {limit.format(short)})) > 0 THEN kept ELSE list_append(kept, {own}) END FROM step JOIN r ON r.contig = step.contig AND r.k = step.k + 1),
whole AS (SELECT contig, unnest(arg_max(kept, k)) AS x FROM step GROUP BY contig) SELECT contig, x.id AS id, x.s AS start, x.e AS "end" FROM whole"""


@query(_greedy("start - stop, id", "0.1 * {}"))
def greedy_intervals(spark, sf_dir):
    """Longest first; one that overlaps a taken one by over a tenth of either goes."""
    rows = _intervals(spark, sf_dir)
    return intervals.greedy(rows, "contig", [-(F.col("end") - F.col("start")), F.col("id")])


@query(_greedy("ord % 7 DESC, id", "0 * {}"))
def scored_intervals(spark, sf_dir):
    """Best score first; any overlap with a taken one rejects."""
    rows = _intervals(spark, sf_dir)
    return intervals.greedy(rows, "contig", [-(F.col("ord") % 7), F.col("id")], None)


@query(f"WITH f AS {INTERVALS} SELECT contig, arg_min(id, (start - stop, id)) AS id FROM f GROUP BY 1")
def single_best_interval(spark, sf_dir):
    rows = _intervals(spark, sf_dir)
    return intervals.single_best(rows, "contig", [-(F.col("end") - F.col("start")), F.col("id")]).select("contig", "id")


@query(f"WITH f AS {INTERVALS} SELECT a.contig, a.id AS id_a, b.id AS id_b FROM f a JOIN f b ON a.contig = b.contig AND a.start <= b.stop AND b.start <= a.stop WHERE a.id < b.id")
def overlapping_pairs(spark, sf_dir):
    rows = _intervals(spark, sf_dir)
    return intervals.overlaps(rows, rows, 2000).where("id_a < id_b")


_EXONS = "(SELECT l_orderkey AS transcript, 'c' AS contig, CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, CAST(l_linenumber * 1000 AS BIGINT) AS start, CAST(l_linenumber * 1000 + max(l_quantity) - 1 AS BIGINT) AS stop FROM lineitem GROUP BY l_orderkey, l_linenumber)"


@query(f"WITH e AS {_EXONS}, o AS (SELECT *, sum(stop - start + 1) OVER (PARTITION BY transcript ORDER BY CASE WHEN strand = '-' THEN -start ELSE start END) AS hi FROM e), x AS (SELECT *, hi - (stop - start) AS lo FROM o), p AS (SELECT o_orderkey AS transcript, CAST(o_custkey % 120 + 1 AS BIGINT) AS pt FROM orders) SELECT transcript, pt, strand, CAST(CASE WHEN strand = '-' THEN stop - (pt - lo) ELSE start + pt - lo END AS BIGINT) AS genome_pos FROM p JOIN x USING (transcript) WHERE pt BETWEEN lo AND hi")
def coordinate_lift(spark, sf_dir):
    tables(spark, sf_dir, "orders")
    points = spark.sql("SELECT o_orderkey AS transcript, CAST(o_custkey % 120 + 1 AS BIGINT) AS pt FROM orders")
    return intervals.lift(points, view(spark, sf_dir, _EXONS).withColumnRenamed("stop", "end")).select("transcript", "pt", "strand", "genome_pos")


@query("SELECT l_orderkey AS id, l_linenumber AS place, l_partkey AS contig FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def id_list_filter(spark, sf_dir):
    tables(spark, sf_dir, "orders", "lineitem")
    ids = spark.sql("SELECT o_orderkey AS id, 0 AS place FROM orders WHERE o_orderpriority = '1-URGENT'")
    rows = spark.sql("SELECT l_orderkey AS id, l_linenumber AS n, l_partkey AS contig FROM lineitem")
    return intervals.by_ids(rows, ids).select("id", F.col("n").alias("place"), "contig")


@query(f"WITH f AS {INTERVALS}, t AS (SELECT *, CASE WHEN ord % 3 = 0 THEN 'mRNA' ELSE 'exon' END AS type FROM f) SELECT contig, id FROM t WHERE type = 'mRNA' AND stop - start + 1 <= 200")
def typed_features(spark, sf_dir):
    rows = _intervals(spark, sf_dir).withColumn("type", F.when(F.col("ord") % 3 == 0, "mRNA").otherwise("exon"))
    return intervals.by_type(rows, "mRNA", 200).select("contig", "id")


# statistics -------------------------------------------------------------------------------------

_HIST = f"a AS (SELECT * FROM {AGES} WHERE age BETWEEN 5 AND 80), h AS (SELECT sample, CAST(least(floor((age - 5) / 1.5625) + 1, 48) AS BIGINT) AS bin, count(*) AS n FROM a GROUP BY ALL), hist AS (SELECT sample, bin, n, n / sum(n) OVER (PARTITION BY sample)::DOUBLE AS share FROM h)"
_DENSE = _HIST + ", g AS (SELECT sample, bin FROM (SELECT DISTINCT sample FROM hist) CROSS JOIN (SELECT unnest(generate_series(1, 48)) AS bin)), d AS (SELECT g.sample, g.bin, coalesce(share, 0) AS share FROM g LEFT JOIN hist USING (sample, bin)), sm AS (SELECT sample, bin, (coalesce(lag(share, 2) OVER w, 0) + 2 * coalesce(lag(share) OVER w, 0) + 3 * share + 2 * coalesce(lead(share) OVER w, 0) + coalesce(lead(share, 2) OVER w, 0)) / 9 AS smooth FROM d WINDOW w AS (PARTITION BY sample ORDER BY bin))"


@query(f"WITH {_HIST} SELECT sample, bin, n, round(share, 6) AS share, round(share / 1.5625, 6) AS density FROM hist")
def age_histogram(spark, sf_dir):
    return stats.histogram(view(spark, sf_dir, AGES)).select("sample", "bin", "n", F.round("share", 6).alias("share"), F.round("density", 6).alias("density"))


@query(f"WITH {_HIST} SELECT sample, CAST(sum(n) AS BIGINT) AS count, round(CAST(5 + (arg_max(bin, (n, -bin)) - 0.5) * 1.5625 AS DOUBLE), 4) AS peak FROM hist GROUP BY 1")
def age_peaks(spark, sf_dir):
    return stats.peaks(stats.histogram(view(spark, sf_dir, AGES)))


@query(f"WITH a AS (SELECT * FROM {AGES} WHERE age BETWEEN 5 AND 80) SELECT sample, count(*) AS n FROM a GROUP BY 1 HAVING count(*) >= 5")
def age_samples(spark, sf_dir):
    return stats.in_range(view(spark, sf_dir, AGES)).groupBy("sample").agg(F.count("*").alias("n"))


@query(f"WITH {_DENSE} SELECT sample, CAST(bin AS BIGINT) AS bin, round(smooth, 6) AS smooth FROM sm")
def smooth_histogram(spark, sf_dir):
    return stats.smoothed(stats.dense(stats.histogram(view(spark, sf_dir, AGES)))).select("sample", "bin", F.round("smooth", 6).alias("smooth"))


@query(f"WITH {_DENSE}, q AS (SELECT sample, quantile_cont(smooth, 0.35) AS lo, quantile_cont(smooth, 0.95) AS hi FROM sm GROUP BY 1), c AS (SELECT sample, bin, CASE WHEN hi > lo THEN least(greatest((smooth - lo) / (hi - lo), 0), 1) ELSE 0 END AS x FROM sm JOIN q USING (sample)) SELECT sample, CAST(bin AS BIGINT) AS bin, round(pow(least(greatest((x - 0.1) / 0.9, 0), 1), 1.8), 4) AS contrast FROM c")
def row_contrast(spark, sf_dir):
    rows = stats.smoothed(stats.dense(stats.histogram(view(spark, sf_dir, AGES))))
    return stats.contrast(rows).select("sample", "bin", F.round("contrast", 4).alias("contrast"))


@query("SELECT event_type, count(value) AS n, round(min(value), 6) AS least, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3, round(max(value), 6) AS most FROM events GROUP BY 1")
def value_distribution(spark, sf_dir):
    tables(spark, sf_dir, "events")
    d = stats.distribution(spark.table("events"), "event_type", "value")
    return d.select("event_type", "n", *[F.round(c, 6).alias(c) for c in ("least", "q1", "median", "q3", "most")])


@query()
def mixture_bic(spark, sf_dir):
    ages = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("label").cast("string").alias("sample"), F.col("embedding")[0].cast("double").alias("age"))
    return stats.mixtures(ages).select("sample", "n", "k", "bic")


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def status_counts(spark, sf_dir):
    tables(spark, sf_dir, "orders")
    return stats.status_counts(spark.table("orders"), "o_orderstatus").withColumnRenamed("o_orderstatus", "status")


@query("SELECT o_custkey AS run, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS smooth FROM orders GROUP BY 1")
def best_smoothing(spark, sf_dir):
    tables(spark, sf_dir, "orders")
    return stats.best_smoothing(spark.sql("SELECT o_custkey AS run, o_orderkey AS ord, o_orderkey AS smooth, o_totalprice AS chisq FROM orders"))


@query("SELECT l_orderkey AS run, min(l_quantity) AS min_ess, max(l_tax) AS max_psrf FROM lineitem GROUP BY 1")
def convergence(spark, sf_dir):
    tables(spark, sf_dir, "lineitem")
    return stats.convergence(spark.sql("SELECT l_orderkey AS run, l_quantity AS min_ess, l_tax AS psrf FROM lineitem"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS sample, coalesce(n_name, 'Other') AS clade FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 1")
def sample_clades(spark, sf_dir):
    tables(spark, sf_dir, "customer", "nation")
    groups = spark.sql("SELECT CAST(c_custkey AS STRING) AS sample, n_name AS clade FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey <> 1")
    return stats.with_clades(spark.sql("SELECT CAST(c_custkey AS STRING) AS sample FROM customer"), groups)


_ROC = "s AS (SELECT lang AS category, CASE WHEN quality = 1 THEN 'pos' ELSE 'neg' END AS truth, CAST(n_chars AS DOUBLE) AS score FROM labels JOIN documents USING (doc_id)), lim AS (SELECT min(score) AS lo, max(score) AS hi FROM s), thr AS (SELECT k, lo + k * ((hi - lo) / 10) AS threshold FROM lim CROSS JOIN (SELECT unnest(range(10)) AS k)), roc AS (SELECT category, CAST(k AS INTEGER) AS step, threshold, count(*) FILTER (truth = 'pos' AND score >= threshold) AS tp, count(*) FILTER (truth = 'neg' AND score < threshold) AS tn, count(*) FILTER (truth = 'neg' AND score >= threshold) AS fp, count(*) FILTER (truth = 'pos' AND score < threshold) AS fn FROM s CROSS JOIN thr GROUP BY ALL), pts AS (SELECT *, CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE END AS tpr, CASE WHEN fp + tn > 0 THEN fp / (fp + tn)::DOUBLE END AS fpr, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn)::DOUBLE END AS f1 FROM roc), pe AS (SELECT category, fpr, tpr FROM pts WHERE fpr IS NOT NULL AND tpr IS NOT NULL UNION ALL SELECT category, e, e FROM (SELECT DISTINCT category FROM pts) CROSS JOIN (SELECT unnest([0.0::DOUBLE, 1.0]) AS e)), areas AS (SELECT category, sum(a) AS auc FROM (SELECT category, (fpr - lag(fpr) OVER w) * (tpr + lag(tpr) OVER w) / 2 AS a FROM pe WINDOW w AS (PARTITION BY category ORDER BY fpr, tpr)) GROUP BY 1)"


def _roc(spark, sf_dir):
    tables(spark, sf_dir, "labels", "documents")
    return coding.roc(spark.sql("SELECT lang AS category, CASE WHEN quality = 1 THEN 'pos' ELSE 'neg' END AS truth, CAST(n_chars AS DOUBLE) AS score FROM labels JOIN documents USING (doc_id)"))


@query(f"WITH {_ROC} SELECT category, step, round(threshold, 4) AS threshold, tp, tn, fp, fn, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr, round(f1, 6) AS f1 FROM pts")
def roc(spark, sf_dir):
    return _roc(spark, sf_dir).select("category", "step", F.round("threshold", 4).alias("threshold"), "tp", "tn", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("tpr", "fpr", "f1")])


@query(f"WITH {_ROC} SELECT category, round(auc, 6) AS auc FROM areas")
def auc(spark, sf_dir):
    return coding.auc(_roc(spark, sf_dir)).select("category", F.round("auc", 6).alias("auc"))


@query(f"WITH {_ROC}, b AS (SELECT arg_min(category, (-auc, category)) AS category FROM areas WHERE auc > 0) SELECT category, round(arg_min(threshold, (-f1, step)), 4) AS threshold, round(max(f1), 6) AS f1 FROM pts WHERE category = (SELECT category FROM b) GROUP BY 1")
def best_threshold(spark, sf_dir):
    points = _roc(spark, sf_dir)
    return coding.best_threshold(points, coding.auc(points)).select("category", F.round("threshold", 4).alias("threshold"), F.round("f1", 6).alias("f1"))


# genotypes --------------------------------------------------------------------------------------


def _genotypes(spark, sf_dir):
    g = view(spark, sf_dir, GENOTYPES)
    gt = F.when(F.col("kind") == 0, F.array(F.lit(0), F.lit(0))).when(F.col("kind") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1), F.lit(1)))
    return g.select("contig", "start", (F.col("start") + 1).alias("stop"), "ref", F.array("alt").alias("alts"), "sample", gt.alias("gt"), "gq", "dp", "ord")


_CALLS = f"g AS {GENOTYPES}, c AS (SELECT *, CASE kind WHEN 0 THEN ref WHEN 2 THEN alt ELSE CASE ref || alt WHEN 'AG' THEN 'R' WHEN 'AT' THEN 'W' WHEN 'CG' THEN 'S' ELSE 'Y' END END AS base FROM g WHERE gq >= 20 AND dp >= 3), b AS (SELECT sample, contig, start AS pos, arg_max(base, ord) AS base FROM c GROUP BY ALL)"


@query(f"WITH {_CALLS} SELECT sample, contig, pos, base FROM b")
def genotype_calls(spark, sf_dir):
    return genotypes.called_bases(_genotypes(spark, sf_dir))


@query(f"WITH {_CALLS}, len_ AS (SELECT contig, max(start) + 1 AS n FROM g GROUP BY 1), grid AS (SELECT s.sample, l.contig, unnest(range(n)) AS pos FROM len_ l CROSS JOIN (SELECT DISTINCT sample FROM g) s) SELECT sample, contig, CAST(count(*) AS BIGINT) AS n, md5(string_agg(coalesce(base, 'N'), '' ORDER BY pos)) AS seq_md5 FROM grid LEFT JOIN b USING (sample, contig, pos) GROUP BY ALL")
def genotype_consensus(spark, sf_dir):
    g = _genotypes(spark, sf_dir)
    reference = g.groupBy("contig").agg((F.max("start") + 1).alias("length"))
    whole = genotypes.contig_sequences(genotypes.consensus(g, reference))
    return whole.select("sample", "contig", F.length("seq").cast("long").alias("n"), F.md5("seq").alias("seq_md5"))
