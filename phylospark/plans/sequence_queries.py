"""Queries over pseudo-alignments and coding sequences made of ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import alignment, clusters, coding, counts, reads, stats, trees
from .registry import query
from .tree_queries import tree_classes, tree_corpus
from .views import ALIGNMENTS, CODING, duck, tables, view

_A, _C = duck(ALIGNMENTS), duck(CODING)
_CELLS = f"a AS {_A}, rows_ AS (SELECT * FROM a WHERE NOT regexp_matches(seq, '^[?Nn-]*$')), cells AS (SELECT locus, seq_id, unnest(string_split(seq, '')) AS base, unnest(generate_series(1, length(seq))) AS pos FROM rows_)"
_ALL_CELLS = f"a AS {_A}, cells AS (SELECT locus, seq_id, upper(unnest(string_split(seq, ''))) AS base, unnest(generate_series(1, length(seq))) AS pos FROM a)"
_PATTERNS = _ALL_CELLS + ", bases AS (SELECT locus, pos, base, count(*) AS n FROM cells WHERE base IN ('A','C','G','T') GROUP BY ALL), sites AS (SELECT locus, pos, count(*) AS kinds, count(*) FILTER (n >= 2) AS repeated FROM bases GROUP BY ALL)"
_METRICS = _PATTERNS + ", loci AS (SELECT locus, count(DISTINCT seq_id) AS taxon_count, CAST(min(length(seq)) AS BIGINT) AS seq_length FROM a GROUP BY 1), inf AS (SELECT s.locus, count(*) FILTER (repeated >= 2) AS informative FROM sites s JOIN loci USING (locus) WHERE pos <= seq_length GROUP BY 1), m AS (SELECT locus, taxon_count, seq_length, coalesce(informative, 0) AS informative_sites, 1 - taxon_count / (SELECT max(taxon_count) FROM loci)::DOUBLE AS missing_ratio FROM loci LEFT JOIN inf USING (locus))"
_OCC = _CELLS + ", nrows AS (SELECT locus, count(*) AS n FROM rows_ GROUP BY 1), occ AS (SELECT locus, pos, count(*) FILTER (regexp_matches(base, '^[ACGTacgt]$')) AS present, any_value(n) AS n FROM cells JOIN nrows USING (locus) GROUP BY ALL)"


@query(f"WITH {_METRICS} SELECT locus, taxon_count, seq_length, informative_sites, round(missing_ratio, 6) AS missing_ratio FROM m")
def locus_metrics(spark, sf_dir):
    m = alignment.locus_metrics(view(spark, sf_dir, ALIGNMENTS))
    return m.select("locus", "taxon_count", "seq_length", "informative_sites", F.round("missing_ratio", 6).alias("missing_ratio"))


@query(f"WITH {_METRICS}, t AS (SELECT * FROM (VALUES ('missing_ratio', 0.1::DOUBLE), ('missing_ratio', 0.2), ('avg_support', 60.0), ('avg_support', 70.0), ('seq_length', 1000.0), ('seq_length', 1500.0), ('informative_sites', 500.0), ('informative_sites', 1000.0)) v(metric, limit_)) SELECT locus, metric, replace(CAST(limit_ AS VARCHAR), '.', 'p') AS threshold, CASE WHEN metric = 'missing_ratio' THEN CASE WHEN missing_ratio <= limit_ THEN 'PASS' ELSE 'FAIL' END WHEN metric = 'seq_length' AND seq_length >= limit_ THEN 'PASS' WHEN metric = 'informative_sites' AND informative_sites >= limit_ THEN 'PASS' ELSE 'FAIL' END AS status FROM m CROSS JOIN t")
def threshold_report(spark, sf_dir):
    return alignment.threshold_report(alignment.locus_metrics(view(spark, sf_dir, ALIGNMENTS))).select("locus", "metric", "threshold", "status")


_SUPPORTED = "sup AS (SELECT concat('en_', tree_id) AS locus, avg(k * 10 + 50) AS avg_support FROM (SELECT DISTINCT tree_id, k FROM {}) GROUP BY 1)".format(tree_classes())


@query(f"WITH {_METRICS}, {_SUPPORTED}, t AS (SELECT * FROM (VALUES (60.0::DOUBLE), (70.0)) v(limit_)) SELECT locus, taxon_count, informative_sites, round(avg_support, 6) AS avg_support, replace(CAST(limit_ AS VARCHAR), '.', 'p') AS threshold, CASE WHEN coalesce(avg_support, -1) >= limit_ THEN 'PASS' ELSE 'FAIL' END AS status FROM m LEFT JOIN sup USING (locus) CROSS JOIN t")
def supported_loci(spark, sf_dir):
    """Loci with the mean support of their trees, by base name; loci without a tree have none and fail."""
    corpus = tree_corpus(spark, sf_dir)
    supports = trees.mean_support(trees.nodes(corpus)).select(F.concat(F.lit("en_"), "tree_id").alias("locus"), "avg_support")
    metrics = alignment.locus_metrics(view(spark, sf_dir, ALIGNMENTS), supports)
    report = alignment.threshold_report(metrics, [("avg_support", 60.0, "min"), ("avg_support", 70.0, "min")]).select("locus", "threshold", "status")
    return metrics.select("locus", "taxon_count", "informative_sites", F.round("avg_support", 6).alias("avg_support")).join(report, "locus")


@query(f"WITH {_OCC} SELECT locus, count(*) AS sites, count(*) FILTER (n - present < 0.2 * n) AS kept_20, count(*) FILTER (n - present < 0.5 * n) AS kept_50, CAST(sum(present) AS BIGINT) AS present FROM occ GROUP BY 1")
def site_occupancy(spark, sf_dir):
    """Sites of each locus, and how many two thresholds keep."""
    sites = alignment.site_occupancy(view(spark, sf_dir, ALIGNMENTS))
    missing = F.col("n") - F.col("present")
    return sites.groupBy("locus").agg(F.count("*").alias("sites"), F.count_if(missing < 0.2 * F.col("n")).alias("kept_20"), F.count_if(missing < 0.5 * F.col("n")).alias("kept_50"), F.sum("present").alias("present"))


@query(f"WITH {_OCC}, kept AS (SELECT locus, pos FROM occ WHERE n - present < 0.5 * n), nk AS (SELECT locus, count(*) AS k FROM kept GROUP BY 1), out_ AS (SELECT c.locus, seq_id, rpad(string_agg(base, '' ORDER BY c.pos), CAST(any_value(k) AS INTEGER), '-') AS seq FROM cells c JOIN kept USING (locus, pos) JOIN nk USING (locus) GROUP BY ALL) SELECT locus, seq_id, CAST(length(seq) AS BIGINT) AS sites, md5(seq) AS seq_md5 FROM out_ WHERE NOT regexp_matches(seq, '^(-*|[?]*)$')")
def filtered_alignment(spark, sf_dir):
    rows = alignment.filter_sites(view(spark, sf_dir, ALIGNMENTS), 0.5)
    return rows.select("locus", "seq_id", F.length("seq").cast("long").alias("sites"), F.md5("seq").alias("seq_md5"))


@query(f"WITH a AS {_A}, b AS (SELECT locus, seq_id, seq, unnest(range(0, greatest(1, CAST(ceil(length(seq) / 1500) AS BIGINT)))) AS block FROM a) SELECT locus, block, count(*) AS n, CAST(sum(length(substr(seq, block * 1500 + 1, 1500))) AS BIGINT) AS sites FROM b GROUP BY ALL")
def site_blocks(spark, sf_dir):
    """Rows and characters of each block of sites."""
    rows = alignment.site_blocks(view(spark, sf_dir, ALIGNMENTS), 1500)
    return rows.groupBy("locus", F.col("block").cast("long").alias("block")).agg(F.count("*").alias("n"), F.sum(F.length("seq")).alias("sites"))


@query(f"SELECT locus, seq_id, md5(seq) AS seq_md5 FROM {_A}")
def merged_blocks(spark, sf_dir):
    """Rows that were cut into blocks of sites and joined again are what they were."""
    blocks = alignment.site_blocks(view(spark, sf_dir, ALIGNMENTS), 97)
    return alignment.merged_blocks(blocks).select("locus", "seq_id", F.md5("seq").alias("seq_md5"))


@query(f"WITH {_PATTERNS} SELECT locus, count(*) FILTER (kinds = 1) AS constant, count(*) FILTER (kinds > 1) AS variable, count(*) FILTER (kinds > 1 AND repeated < 2) AS singleton, count(*) FILTER (repeated >= 2) AS informative FROM sites GROUP BY 1")
def site_statistics(spark, sf_dir):
    return alignment.site_statistics(view(spark, sf_dir, ALIGNMENTS))


@query(f"WITH a AS {_A}, q AS (SELECT locus, CASE WHEN length(seq) = 0 THEN NULL ELSE (length(seq) - length(replace(seq, '?', ''))) / length(seq)::DOUBLE END AS share FROM a) SELECT locus, count(*) AS n_rows, count(*) FILTER (share <= 0.01) AS n_kept, CASE WHEN count(*) FILTER (share <= 0.01) >= 4 THEN 'kept' ELSE 'removed' END AS status FROM q GROUP BY 1")
def ambiguous_rows(spark, sf_dir):
    return alignment.filter_ambiguous_rows(view(spark, sf_dir, ALIGNMENTS), 0.01)


@query(f"WITH a AS {_A} SELECT locus, seq_id, CAST(length(seq) AS BIGINT) AS length, CAST(len(regexp_extract_all(seq, '-')) AS BIGINT) AS gaps, CAST(len(regexp_extract_all(seq, '[?Nn]')) AS BIGINT) AS unknown, CAST(len(regexp_extract_all(seq, '-+')) AS BIGINT) AS gap_runs, round(CASE WHEN length(seq) > 0 THEN len(regexp_extract_all(seq, '-')) / length(seq)::DOUBLE END, 6) AS gap_share FROM a")
def gap_statistics(spark, sf_dir):
    return alignment.gap_statistics(view(spark, sf_dir, ALIGNMENTS))


@query(f"WITH {_ALL_CELLS}, b AS (SELECT locus, pos, base, count(*) AS k FROM cells WHERE base IN ('A','C','G','T') GROUP BY ALL), s AS (SELECT locus, pos, sum(k) AS n, sum(k * k) AS sq FROM b GROUP BY ALL), p AS (SELECT locus, pos, CASE WHEN n > 1 THEN (n * n - sq) / (n * (n - 1))::DOUBLE ELSE 0 END AS pi FROM s), w AS (SELECT locus, pi, unnest(generate_series(greatest(0, CAST(ceil((pos - 600) / 200.0) AS BIGINT)), (pos - 1) // 200)) AS w FROM p) SELECT locus, CAST(w * 200 + 1 AS BIGINT) AS start, round(sum(pi) / 600, 5) AS pi FROM w GROUP BY ALL")
def nucleotide_diversity(spark, sf_dir):
    return alignment.nucleotide_diversity(view(spark, sf_dir, ALIGNMENTS)).select("locus", F.col("start").cast("long").alias("start"), F.round("pi", 5).alias("pi"))


@query(f"WITH c AS {_C} SELECT seq_id, md5(reverse(translate(seq, 'ACGT', 'TGCA'))) AS rc_md5 FROM c")
def reverse_complement(spark, sf_dir):
    return view(spark, sf_dir, CODING).select("seq_id", F.md5(fn.reverse_complement("seq")).alias("rc_md5"))


@query(f"WITH c AS {_C}, n AS (SELECT sum(length(seq) - length(replace(seq, 'A', ''))) AS a, sum(length(seq) - length(replace(seq, 'C', ''))) AS c, sum(length(seq) - length(replace(seq, 'G', ''))) AS g, sum(length(seq) - length(replace(seq, 'T', ''))) AS t FROM c) SELECT base, CAST(k AS BIGINT) AS n, round(k / (2 * (a + c + g + t))::DOUBLE, 3) AS ratio FROM (SELECT unnest(['A', 'C', 'G', 'T']) AS base, unnest([a + t, c + g, c + g, a + t]) AS k, a, c, g, t FROM n)")
def base_composition(spark, sf_dir):
    return coding.base_composition(view(spark, sf_dir, CODING))


@query(f"WITH a AS {_A} SELECT locus, CAST(sum(length(seq)) AS BIGINT) AS bases, CAST(sum(len(regexp_extract_all(seq, '[^ACGTacgt]'))) AS BIGINT) AS other FROM a GROUP BY ROLLUP(locus)")
def composition_rollup(spark, sf_dir):
    return coding.other_bases(view(spark, sf_dir, ALIGNMENTS), "locus")


_CDS = f"c AS (SELECT orf_id, regexp_replace(seq, '(TAA|TAG|TGA)$', '') AS s FROM {_C})"


def _ending(key: str, text: str, rows: str) -> str:
    """SQL rows (key, i, six): the six characters, or as many as there are, that end at each place of a text."""
    before = ", ".join(f"lag(b, {k}) OVER w" for k in (5, 4, 3, 2, 1))
    return f"SELECT {key}, i, concat({before}, b) AS six FROM (SELECT {key}, unnest(string_split({text}, '')) AS b, unnest(range(length({text}))) AS i FROM {rows} WHERE length({text}) > 0) WINDOW w AS (PARTITION BY {key} ORDER BY i)"


_KMERS = _CDS + f", e AS ({_ending('orf_id', 's', 'c')}), sixes AS (SELECT six, i % 3 AS f, count(*) AS n FROM e GROUP BY ALL), k AS (SELECT *, unnest([1, 2, 3, 4, 5, 6]) AS k FROM sixes), kmers AS (SELECT right(six, k) AS kmer, CAST(f AS INTEGER) AS frame, CAST(sum(n) AS BIGINT) AS n FROM k WHERE k <= length(six) GROUP BY ALL)"
_BACK = f"n AS (SELECT sum(length(seq) - length(replace(seq, 'A', ''))) AS a, sum(length(seq) - length(replace(seq, 'C', ''))) AS c, sum(length(seq) - length(replace(seq, 'G', ''))) AS g, sum(length(seq) - length(replace(seq, 'T', ''))) AS t FROM {_C}), bg AS (SELECT base, round(k / (2 * (a + c + g + t))::DOUBLE, 3) AS ratio FROM (SELECT unnest(['A', 'C', 'G', 'T']) AS base, unnest([a + t, c + g, c + g, a + t]) AS k, a, c, g, t FROM n))"
_MODEL = f"{_KMERS}, {_BACK}, tot AS (SELECT '' AS kmer, frame, CAST(sum(n) AS BIGINT) AS n FROM kmers WHERE length(kmer) = 1 GROUP BY frame), pre AS (SELECT kmer, frame, n FROM kmers UNION ALL SELECT * FROM tot), model AS (SELECT k.kmer, k.frame, k.n, coalesce(p.n, 0) AS prefix_n, ln((k.n + 1) / (coalesce(p.n, 0) + 4)::DOUBLE / ratio) AS loglik FROM kmers k LEFT JOIN pre p ON p.kmer = substr(k.kmer, 1, length(k.kmer) - 1) AND p.frame = (k.frame + 2) % 3 JOIN bg ON base = right(k.kmer, 1))"


@query(f"WITH {_KMERS} SELECT kmer, frame, n FROM kmers")
def framed_kmer_counts(spark, sf_dir):
    return coding.framed_kmers(view(spark, sf_dir, CODING), 6).select("kmer", F.col("frame").cast("int").alias("frame"), "n")


def kmer_model(spark, sf_dir):
    cds = clusters.stored(view(spark, sf_dir, CODING), "coding")  # read three times
    return cds, coding.kmer_model(coding.framed_kmers(cds, 6), coding.base_composition(cds))


@query(f"WITH {_MODEL} SELECT kmer, frame, n, prefix_n, round(loglik, 6) AS loglik FROM model")
def kmer_loglik(spark, sf_dir):
    return kmer_model(spark, sf_dir)[1].select("kmer", F.col("frame").cast("int").alias("frame"), "n", "prefix_n", F.round("loglik", 6).alias("loglik"))


@query(f"WITH {_MODEL}, r AS (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY loglik) - 1 AS i, count(*) OVER (PARTITION BY frame) AS c FROM model), q AS (SELECT frame, max(loglik) FILTER (i = floor((c - 1) * 0.25)) AS q1, max(loglik) FILTER (i = floor((c - 1) * 0.75)) AS q3 FROM r GROUP BY 1) SELECT kmer, m.frame, round(least(greatest(loglik, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)), 6) AS loglik FROM model m JOIN q USING (frame)")
def clipped_loglik(spark, sf_dir):
    return coding.clip_outliers(kmer_model(spark, sf_dir)[1]).select("kmer", F.col("frame").cast("int").alias("frame"), F.round("loglik", 6).alias("loglik"))


@query(f"WITH {_MODEL}, st AS (SELECT orf_id, 0 AS st, s FROM c UNION ALL SELECT orf_id, 1, reverse(translate(s, 'ACGT', 'TGCA')) FROM c), fr AS (SELECT orf_id, st, f, substr(s, f + 1) AS t FROM st CROSS JOIN (SELECT unnest([0, 1, 2]) AS f)), fk AS (SELECT orf_id, st * 3 + f + 1 AS k, t FROM fr), g AS (SELECT orf_id, k, six AS kmer, i % 3 AS frame FROM (" + _ending("orf_id, k", "t", "fk") + ")), cnt AS (SELECT orf_id, k, kmer, frame, count(*) AS c FROM g GROUP BY ALL), sc AS (SELECT orf_id, k, sum(c * loglik) AS x FROM cnt JOIN model USING (kmer, frame) GROUP BY ALL) SELECT d.orf_id, CAST(length(d.seq) AS BIGINT) AS seq_length, " + ", ".join(f"round(round(CASE WHEN length(d.seq) < 6 THEN 0.0 ELSE coalesce(max(x) FILTER (k = {k}), 0.0) END, 2), 1) AS score_{k}" for k in range(1, 7)) + f" FROM {_C} d LEFT JOIN sc USING (orf_id) GROUP BY d.orf_id, d.seq")
def coding_scores(spark, sf_dir):
    cds, model = kmer_model(spark, sf_dir)
    return coding.coding_scores(cds, model, 5).select("orf_id", "seq_length", *[F.round(f"score_{k}", 1).alias(f"score_{k}") for k in range(1, 7)])


@query(f"WITH c AS {_C}, p AS (SELECT seq_id, [array_to_string(list_filter(string_split(seq, ''), lambda x, i: (i - 1) % 3 = k), '') FOR k IN [0, 1, 2]] AS p FROM c) SELECT seq_id, md5(p[1]) AS first, md5(p[2]) AS second, md5(p[3]) AS third, CAST(length(p[1]) AS BIGINT) AS n FROM p WHERE p[1] <> ''")
def codon_partitions(spark, sf_dir):
    rows = view(spark, sf_dir, CODING).where("seq <> ''").withColumn("p", fn.codon_positions("seq"))
    part = lambda k: F.md5(F.col("p")[k])
    return rows.select("seq_id", part(0).alias("first"), part(1).alias("second"), part(2).alias("third"), F.length(F.col("p")[0]).cast("long").alias("n"))


_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
_AA = f"c AS {_C}, cod AS (SELECT seq_id, unnest(generate_series(1, length(seq) - 2, 3)) AS i, seq FROM c WHERE length(seq) >= 3), aa AS (SELECT seq_id, i, substr(seq, i, 3) AS codon, substr('{_ACIDS}', CAST((instr('TCAG', substr(seq, i, 1)) - 1) * 16 + (instr('TCAG', substr(seq, i + 1, 1)) - 1) * 4 + instr('TCAG', substr(seq, i + 2, 1)) AS BIGINT), 1) AS a FROM cod)"


@query(f"WITH {_AA}, p AS (SELECT seq_id, string_agg(a, '' ORDER BY i) AS p FROM aa GROUP BY 1) SELECT seq_id, CAST(length(p) AS BIGINT) AS n, md5(p) AS protein_md5 FROM p")
def translated(spark, sf_dir):
    p = view(spark, sf_dir, CODING).where("length(seq) >= 3").select("seq_id", counts.translated("seq").alias("p"))
    return p.select("seq_id", F.length("p").cast("long").alias("n"), F.md5("p").alias("protein_md5"))


@query(f"WITH {_AA}, u AS (SELECT codon, a AS amino_acid, count(*) AS n FROM aa GROUP BY ALL) SELECT codon, amino_acid, n, round(n * count(*) OVER (PARTITION BY amino_acid) / sum(n) OVER (PARTITION BY amino_acid)::DOUBLE, 6) AS rscu FROM u")
def codon_usage(spark, sf_dir):
    return coding.codon_usage(view(spark, sf_dir, CODING))


@query(f"WITH {_AA}, p AS (SELECT seq_id, string_agg(a, '' ORDER BY i) AS p FROM aa GROUP BY 1), q AS (SELECT seq_id, len(regexp_extract_all(regexp_replace(p, '[*]$', ''), '[*]')) AS k, p FROM p) SELECT seq_id, CAST(k AS BIGINT) AS internal_stops, NOT suffix(p, '*') AS no_final_stop, NOT prefix(p, 'M') AS no_start FROM q WHERE k > 0")
def protein_check(spark, sf_dir):
    from ..operators import intervals

    return intervals.protein_check(view(spark, sf_dir, CODING).where("length(seq) >= 3").select("seq_id", counts.translated("seq").alias("seq")))


_STRANDS = f"st AS (SELECT seq_id, '+' AS strand, seq AS s FROM {_C} UNION ALL SELECT seq_id, '-', reverse(translate(seq, 'ACGT', 'TGCA')) FROM {_C}), fr AS (SELECT seq_id, strand, f AS frame, substr(s, f + 1) AS t FROM st CROSS JOIN (SELECT unnest([0, 1, 2]) AS f)), cod AS (SELECT seq_id, strand, frame, i, substr(t, 3 * i + 1, 3) AS c FROM (SELECT *, unnest(range(length(t) // 3)) AS i FROM fr))"
_ORFS = _STRANDS + f", aa AS (SELECT seq_id, strand, frame, string_agg(substr('{_ACIDS}', CAST((instr('TCAG', c[1]) - 1) * 16 + (instr('TCAG', c[2]) - 1) * 4 + instr('TCAG', c[3]) AS BIGINT), 1), '' ORDER BY i) AS p FROM cod GROUP BY ALL), part AS (SELECT seq_id, strand, frame, unnest(string_split(p, '*')) AS part, unnest(range(len(string_split(p, '*')))) AS k, len(string_split(p, '*')) - 1 AS last FROM aa), at_ AS (SELECT *, coalesce(sum(length(part) + 1) OVER (PARTITION BY seq_id, strand, frame ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place, CASE WHEN k = 0 THEN 1 ELSE instr(part, 'M') END AS cut FROM part)"


@query(f"WITH {_ORFS} SELECT seq_id, strand, CAST(frame AS INTEGER) AS frame, CAST(place + cut - 1 AS INTEGER) AS aa_start, CAST(length(part) - cut + 1 AS INTEGER) AS n, CASE WHEN substr(part, cut, 1) = 'M' THEN CASE WHEN k < last THEN 'complete' ELSE '3prime_partial' END WHEN k < last THEN '5prime_partial' ELSE 'internal' END AS kind FROM at_ WHERE cut > 0 AND length(part) - cut + 1 >= 30")
def open_reading_frames(spark, sf_dir):
    return coding.orfs(view(spark, sf_dir, CODING), 30).select("seq_id", "strand", "frame", "aa_start", F.length("protein").alias("n"), "kind")


@query(f"WITH a AS {_A}, l AS (SELECT locus, length(seq) AS len, count(*) AS c FROM a GROUP BY ALL), r AS (SELECT locus, len, c, sum(len * c) OVER (PARTITION BY locus ORDER BY len DESC) AS run, sum(len * c) OVER (PARTITION BY locus) AS all_ FROM l) SELECT locus, CAST(sum(c) AS BIGINT) AS records, CAST(any_value(all_) AS BIGINT) AS bases, CAST(max(len) AS BIGINT) AS longest, CAST(max(len) FILTER (2 * run >= all_) AS BIGINT) AS n50 FROM r GROUP BY 1")
def sequence_n50(spark, sf_dir):
    return stats.n50(view(spark, sf_dir, ALIGNMENTS), "locus")


#: stretches with a period of k; the next one begins where a repeat before it ends, if they overlap
_STRETCHES = f"""WITH RECURSIVE cell AS (SELECT seq_id, unnest(string_split(seq, '')) AS b, unnest(range(1, length(seq) + 1)) AS i FROM {_C} WHERE length(seq) > 0),
least_ AS (SELECT unnest([1, 2, 3, 4, 5, 6]) AS k, unnest([6, 4, 3, 3, 3, 3]) AS n),
same AS (SELECT seq_id, k, n, i FROM (SELECT *, {", ".join(f"b = lead(b, {k}) OVER w AS s{k}" for k in range(1, 7))} FROM cell WINDOW w AS (PARTITION BY seq_id ORDER BY i)) CROSS JOIN least_ WHERE CASE k {" ".join(f"WHEN {k} THEN s{k}" for k in range(1, 7))} END),
run AS (SELECT seq_id, k, n, min(i) AS a, max(i) + k + 1 AS e FROM (SELECT *, i - row_number() OVER (PARTITION BY seq_id, k ORDER BY i) AS g FROM same) GROUP BY seq_id, k, n, g HAVING count(*) + k >= n * k),
r AS (SELECT *, row_number() OVER (PARTITION BY seq_id, k ORDER BY a) AS j FROM run),
step AS (SELECT seq_id, k, j, a AS start, (e - a) // k AS copies, a + (e - a) // k * k AS past FROM r WHERE j = 1
UNION ALL SELECT r.seq_id, r.k, r.j, greatest(r.a, past), CASE WHEN (r.e - greatest(r.a, past)) // r.k >= n THEN (r.e - greatest(r.a, past)) // r.k ELSE 0 END, CASE WHEN (r.e - greatest(r.a, past)) // r.k >= n THEN greatest(r.a, past) + (r.e - greatest(r.a, past)) // r.k * r.k ELSE past END FROM step JOIN r ON r.seq_id = step.seq_id AND r.k = step.k AND r.j = step.j + 1)
SELECT seq_id, CAST(k AS INTEGER) AS unit_length, substr(seq, start, k) AS unit, CAST(copies AS INTEGER) AS copies FROM step JOIN {_C} USING (seq_id) WHERE copies > 0 AND (k = 1 OR replace(substr(seq, start, k), seq[start], '') <> '')"""


@query(_STRETCHES)
def simple_repeats(spark, sf_dir):
    return coding.repeats(view(spark, sf_dir, CODING), {1: 6, 2: 4, 3: 3, 4: 3, 5: 3, 6: 3})


@query("WITH k AS (SELECT CAST(doc_id AS VARCHAR) AS seq_id, text, unnest(range(1, greatest(length(text) - 3, 1))) AS i FROM documents), d AS (SELECT seq_id, count(DISTINCT substr(text, i, 5)) AS kinds FROM k GROUP BY 1) SELECT CAST(doc_id AS VARCHAR) AS seq_id, coalesce(kinds, 0) AS kinds, coalesce(kinds, 0) < 0.3 * length(text) / 5 AS low FROM documents LEFT JOIN d ON seq_id = CAST(doc_id AS VARCHAR)")
def low_complexity(spark, sf_dir):
    tables(spark, sf_dir, "documents")
    docs = spark.sql("SELECT CAST(doc_id AS STRING) AS seq_id, text AS seq FROM documents")
    return reads.low_complexity(docs).select("seq_id", F.col("kinds").cast("long").alias("kinds"), "low")


@query("SELECT source, lang AS gene, arg_max(doc_id, (length(text), -doc_id)) AS ord, CAST(max(length(text)) AS BIGINT) AS n FROM documents GROUP BY ALL")
def longest_isoform(spark, sf_dir):
    tables(spark, sf_dir, "documents")
    docs = spark.sql("SELECT source, lang AS gene, doc_id AS ord, CAST(doc_id AS STRING) AS seq_id, text AS seq FROM documents")
    return reads.longest_isoform(docs).select("source", "gene", "ord", F.length("seq").cast("long").alias("n"))


@query("SELECT doc_id AS ord, CAST(length(text) AS BIGINT) AS n FROM documents WHERE length(text) <= 5000 ORDER BY length(text) DESC, doc_id LIMIT 50")
def longest_records(spark, sf_dir):
    tables(spark, sf_dir, "documents")
    docs = spark.sql("SELECT doc_id AS ord, text AS seq FROM documents")
    return reads.longest_records(docs, 50, 5000).select("ord", F.length("seq").cast("long").alias("n"))


_READS = "r AS (SELECT doc_id // 2 AS read_id, doc_id % 2 AS mate, regexp_replace(text, '[^!-~]', '', 'g') AS s FROM documents), q AS (SELECT read_id, mate, unnest([ascii(x) - 33 for x in string_split(s, '')]) AS q, unnest(range(1, length(s) + 1)) AS i FROM r WHERE length(s) > 0), b AS (SELECT read_id, mate, min(i) FILTER (q >= 30) AS first, max(i) FILTER (q >= 30) AS last FROM q GROUP BY ALL), p AS (SELECT read_id, mate, first, last, i, sum(q) OVER (PARTITION BY read_id, mate ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS four FROM q JOIN b USING (read_id, mate) WHERE i BETWEEN first AND last), w AS (SELECT read_id, mate, first, coalesce(min(i) FILTER (four < 240 AND i + 3 <= last), last + 1) - first - 8 AS n FROM p GROUP BY read_id, mate, first, last), t AS (SELECT read_id, mate, substr(s, first + 8, n) AS seq FROM w JOIN r USING (read_id, mate) WHERE n >= 36)"


@query(f"WITH {_READS} SELECT read_id, mate, CAST(length(seq) AS INTEGER) AS n, md5(seq) AS seq_md5 FROM t WHERE read_id IN (SELECT read_id FROM r JOIN t USING (read_id) GROUP BY 1 HAVING count(DISTINCT r.mate) = count(DISTINCT t.mate))")
def read_trimming(spark, sf_dir):
    tables(spark, sf_dir, "documents")
    docs = spark.sql("SELECT doc_id div 2 AS read_id, doc_id % 2 AS mate, regexp_replace(text, '[^!-~]', '') AS seq, regexp_replace(text, '[^!-~]', '') AS qual FROM documents")
    return reads.trim(docs, mean=60, leading=30, trailing=30).select("read_id", "mate", F.length("seq").alias("n"), F.md5("seq").alias("seq_md5"))


_TEXTS = "SELECT CAST(doc_id AS STRING) AS seq_id, text AS seq FROM documents"


@query()
def near_duplicate_sequences(spark, sf_dir):
    tables(spark, sf_dir, "documents")
    return clusters.near_identical(spark.sql(_TEXTS), 5, 0.95)


@query()
def greedy_redundancy(spark, sf_dir):
    tables(spark, sf_dir, "documents")
    return clusters.greedy_representatives(spark.sql(_TEXTS))


#: turns of conversations, and near copies of every other one
_TURNS = "(SELECT concat(CAST(conv_id AS VARCHAR(20)), '_', CAST(turn AS VARCHAR(20))) AS seq_id, text AS seq FROM conversations UNION ALL SELECT concat(CAST(conv_id AS VARCHAR(20)), '_', CAST(turn AS VARCHAR(20)), CASE WHEN conv_id % 4 = 1 THEN 'y' ELSE 'x' END), CASE WHEN conv_id % 4 = 0 THEN concat(text, ' And so on.') WHEN conv_id % 4 = 1 THEN text ELSE replace(text, CASE WHEN conv_id % 4 = 2 THEN 'eau' ELSE 'tion' END, 'oe') END FROM conversations WHERE turn % 2 = 0)"
_GRAMS = f"v AS {_TURNS}, s AS (SELECT seq, min(seq_id) AS one FROM v WHERE seq IS NOT NULL GROUP BY 1), at_ AS (SELECT one, i, array_to_string(l[i:i + 4], '') AS g FROM (SELECT one, string_split(seq, '') AS l, unnest(range(1, length(seq) - 3)) AS i FROM s WHERE length(seq) >= 5)), k AS MATERIALIZED (SELECT DISTINCT one, g FROM at_)"


@query(f"WITH RECURSIVE {_GRAMS}, n AS (SELECT one, count(*) AS n FROM k GROUP BY 1), met AS (SELECT a.one AS x, b.one AS y, count(*) AS c FROM k a JOIN k b ON a.g = b.g AND a.one < b.one GROUP BY 1, 2), link AS MATERIALIZED (SELECT x, y FROM met JOIN n p ON p.one = x JOIN n q ON q.one = y WHERE c / least(p.n, q.n)::DOUBLE >= {0.95**5}), edge AS MATERIALIZED (SELECT x, y FROM link UNION ALL SELECT y, x FROM link), reach AS (SELECT one AS x, one AS y FROM s UNION SELECT reach.x, edge.y FROM reach JOIN edge ON edge.x = reach.y), root AS (SELECT x, min(y) AS cluster FROM reach GROUP BY 1) SELECT seq_id, cluster FROM v JOIN s USING (seq) JOIN root ON x = one")
def near_identical_turns(spark, sf_dir):
    """J21 over turns of conversations and their near copies."""
    return clusters.near_identical(view(spark, sf_dir, _TURNS), 5, 0.95)


@query(f"WITH RECURSIVE {_GRAMS}, q AS MATERIALIZED (SELECT DISTINCT one, g FROM at_ WHERE i % 5 = 1), n AS (SELECT one, count(*) AS n FROM q GROUP BY 1), r AS (SELECT one, row_number() OVER (ORDER BY length(seq) DESC, one) AS k FROM s WHERE length(seq) >= 5), met AS (SELECT q.one AS later, k.one AS earlier, count(*) AS c FROM q JOIN k USING (g) JOIN r a ON a.one = q.one JOIN r b ON b.one = k.one AND b.k < a.k GROUP BY 1, 2), against AS MATERIALIZED (SELECT later, list(earlier) AS es FROM met JOIN n ON n.one = later WHERE c / n::DOUBLE > 0.8 GROUP BY 1), item AS MATERIALIZED (SELECT one, k, coalesce(es, []) AS es FROM r LEFT JOIN against ON later = one), step AS (SELECT k, [one] AS kept FROM item WHERE k = 1 UNION ALL SELECT item.k, CASE WHEN list_has_any(kept, es) THEN kept ELSE list_append(kept, one) END FROM step JOIN item ON item.k = step.k + 1) SELECT unnest(arg_max(kept, k)) AS seq_id FROM step UNION ALL SELECT seq_id FROM v WHERE coalesce(length(seq) < 5, true)")
def greedy_turns(spark, sf_dir):
    """W11 over turns of conversations and their near copies: those that stay, longest first."""
    return clusters.greedy_representatives(view(spark, sf_dir, _TURNS))


_DRAWN = "l AS (SELECT locus, CAST(max(length(seq)) AS BIGINT) AS n, CAST(concat('0x', substr(md5(locus), 1, 7)) AS BIGINT) AS h FROM a GROUP BY 1), d AS (SELECT locus, n, list_transform(list_transform(list_transform(list_transform(range(1, n + 1), lambda k: (k * 2654435761 + 1597334677 + 1812433253 + h) % 4294967296), lambda x: (xor(x, x >> 15) * 2146121005) % 4294967296), lambda x: (xor(x, x >> 13) * 1540483477) % 4294967296), lambda x: xor(x, x >> 16) % n + 1) AS s FROM l)"


@query(f"WITH a AS {_A}, {_DRAWN} SELECT locus, seq_id, n AS sites, md5(array_to_string(list_select(string_split(rpad(seq, CAST(n AS INTEGER), '-'), ''), s), '')) AS seq_md5 FROM a JOIN d USING (locus)")
def column_bootstrap(spark, sf_dir):
    rows = alignment.bootstrap(view(spark, sf_dir, ALIGNMENTS), 1)
    return rows.select("locus", "seq_id", F.length("seq").cast("long").alias("sites"), F.md5("seq").alias("seq_md5"))


@query(f"WITH a AS {_A} SELECT locus, seq_id, CAST((n + 9) // 10 AS BIGINT) AS sites, md5(array_to_string(list_select(string_split(rpad(seq, CAST(n AS INTEGER), '-'), ''), range(1, n + 1, 10)), '')) AS seq_md5 FROM a JOIN (SELECT locus, max(length(seq)) AS n FROM a GROUP BY 1) USING (locus)")
def selected_sites(spark, sf_dir):
    """Every tenth site of each locus, by a list of sites."""
    rows = view(spark, sf_dir, ALIGNMENTS)
    sites = rows.groupBy("locus").agg(F.max(F.length("seq")).alias("n")).select("locus", F.explode(F.sequence(F.lit(1), F.col("n"), F.lit(10))).alias("pos"))
    out = alignment.select_sites(rows, sites)
    return out.select("locus", "seq_id", F.length("seq").cast("long").alias("sites"), F.md5("seq").alias("seq_md5"))


@query(f"WITH a AS {_A} SELECT locus, seq_id, CAST(length(seq) AS BIGINT) AS n FROM a WHERE ord IN (SELECT doc_id FROM labels WHERE quality = 1)")
def selected_records(spark, sf_dir):
    """Rows of the documents that are labelled good."""
    names = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select(F.col("doc_id").cast("string").alias("seq_id"))
    return alignment.select_records(view(spark, sf_dir, ALIGNMENTS), names).select("locus", "seq_id", F.length("seq").cast("long").alias("n"))


@query(f"WITH a AS {_A} SELECT locus, seq_id, CAST(length(seq) AS BIGINT) AS n FROM a WHERE ord NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def removed_taxa(spark, sf_dir):
    rows = view(spark, sf_dir, ALIGNMENTS)
    return alignment.remove_taxa(rows, _toxic(spark, sf_dir, rows)).select("locus", "seq_id", F.length("seq").cast("long").alias("n"))


def _toxic(spark, sf_dir, rows):
    ids = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").select(F.col("doc_id").cast("string").alias("seq_id"))
    return rows.join(ids, "seq_id", "left_semi").select("locus", "seq_id")


@query(f"WITH a AS {_A}, good AS (SELECT locus FROM a GROUP BY 1 HAVING max(length(seq)) > 9000), r AS (SELECT * FROM a WHERE locus IN (SELECT locus FROM good) AND ord NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)), cells AS (SELECT locus, seq_id, unnest(string_split(seq, '')) AS base, unnest(generate_series(1, length(seq))) AS pos FROM r), kept AS (SELECT locus, pos FROM cells WHERE base <> '-' GROUP BY ALL), nk AS (SELECT locus, count(*) AS k FROM kept GROUP BY 1) SELECT r.locus, r.seq_id, CAST(k AS BIGINT) AS sites, md5(rpad(coalesce(s, ''), CAST(k AS INTEGER), '-')) AS seq_md5 FROM r JOIN nk USING (locus) LEFT JOIN (SELECT locus, seq_id, string_agg(base, '' ORDER BY pos) AS s FROM cells JOIN kept USING (locus, pos) GROUP BY ALL) USING (locus, seq_id)")
def outlier_pruning(spark, sf_dir):
    """Toxic documents are the outliers; trees have all rows of long loci, and lack one of short ones."""
    rows = view(spark, sf_dir, ALIGNMENTS)
    long = rows.groupBy("locus").agg((F.max(F.length("seq")) > 9000).alias("whole"))
    leaves = rows.join(long, "locus").select("locus", F.when(F.col("whole"), F.col("seq_id")).otherwise(F.concat("seq_id", F.lit("x"))).alias("leaf"))
    out = alignment.prune_outliers(rows, leaves, _toxic(spark, sf_dir, rows))
    return out.select("locus", "seq_id", F.length("seq").cast("long").alias("sites"), F.md5("seq").alias("seq_md5"))


# start codons ------------------------------------------------------------------------------------

_MOTIF = f"c AS {_C}, h AS (SELECT seq_id, seq, i AS pos FROM (SELECT seq_id, seq, unnest(generate_series(1, length(seq) - 2)) AS i FROM c WHERE length(seq) >= 3) WHERE substr(seq, i, 3) = 'ATG'), st AS (SELECT seq_id, min(pos) AS pos FROM h WHERE pos > 20 GROUP BY 1), w AS (SELECT h.seq_id, h.pos, CASE WHEN st.pos IS NULL THEN 'neg' ELSE 'pos' END AS label, substr(h.seq, h.pos - 20, 33) AS win FROM h LEFT JOIN st ON st.seq_id = h.seq_id AND st.pos = h.pos WHERE h.pos > 20 AND h.pos + 12 <= length(h.seq)), cell AS (SELECT seq_id, pos, label, unnest(range(33)) AS p_, unnest(string_split(win, '')) AS base FROM w), cnt AS (SELECT label, p_, base, count(*) AS n FROM cell GROUP BY ALL), grid AS (SELECT label, p_, base FROM (SELECT DISTINCT label, p_ FROM cnt) CROSS JOIN (SELECT unnest(['A', 'C', 'G', 'T']) AS base)), pwm AS (SELECT label, p_, base, coalesce(n, 0) AS n, (coalesce(n, 0) + 1) / (sum(coalesce(n, 0)) OVER (PARTITION BY label, p_) + 4)::DOUBLE AS prob FROM grid LEFT JOIN cnt USING (label, p_, base)), odds AS (SELECT p_, base, ln(max(prob) FILTER (label = 'pos')) - ln(max(prob) FILTER (label = 'neg')) AS o FROM pwm GROUP BY ALL), score AS (SELECT seq_id, pos, label, sum(coalesce(o, 0)) / count(*) AS score FROM cell LEFT JOIN odds USING (p_, base) WHERE p_ NOT BETWEEN 20 AND 22 GROUP BY ALL)"


def _windows(spark, sf_dir):
    return coding.motif_windows(view(spark, sf_dir, CODING))


def _motifs(spark, sf_dir):
    return clusters.stored(_windows(spark, sf_dir), "motifs")


@query(f"WITH {_MOTIF} SELECT label, CAST(p_ AS INTEGER) AS pos, base, n, round(prob, 6) AS prob FROM pwm")
def motif_matrix(spark, sf_dir):
    """Base frequencies around the first ATG beyond base 20 of each sequence, and around all other ones."""
    return coding.weight_matrix(_motifs(spark, sf_dir)).select("label", F.col("pos").cast("int").alias("pos"), "base", "n", F.round("prob", 6).alias("prob"))


@query(f"WITH {_MOTIF} SELECT seq_id, CAST(pos AS BIGINT) AS pos, label, round(score, 6) AS score FROM score")
def motif_scores(spark, sf_dir):
    windows = _motifs(spark, sf_dir)
    rows = coding.motif_scores(windows, coding.weight_matrix(windows))
    return rows.select("seq_id", F.col("pos").cast("long").alias("pos"), "label", F.round("score", 6).alias("score"))


_REFINED = "o AS (SELECT seq_id, 21 AS start, length(seq) AS stop, CASE WHEN length(seq) % 2 = 0 THEN 'internal' ELSE '5prime_partial' END AS kind FROM c WHERE length(seq) > 60), best AS (SELECT o.seq_id, arg_min(s.pos, (-round(s.score, 9), s.pos)) AS pos FROM o JOIN score s ON s.seq_id = o.seq_id AND s.pos >= start AND s.pos <= start + greatest(30, floor((stop - start + 1) * 0.15)) AND (s.pos - start) % 3 = 0 AND round(s.score, 9) >= 0.01 GROUP BY 1)"


@query(f"WITH {_MOTIF}, {_REFINED} SELECT o.seq_id, CAST(coalesce(b.pos, start) AS BIGINT) AS start, CAST(stop AS BIGINT) AS \"end\", CASE WHEN b.pos IS NULL THEN kind WHEN kind = 'internal' THEN '3prime_partial' ELSE 'complete' END AS kind FROM o LEFT JOIN best b USING (seq_id)")
def refined_starts(spark, sf_dir):
    windows = _motifs(spark, sf_dir)
    scores = coding.motif_scores(windows, coding.weight_matrix(windows)).select("seq_id", "pos", F.round("score", 9).alias("score"))
    kind = F.when(F.length("seq") % 2 == 0, "internal").otherwise("5prime_partial")
    orfs = view(spark, sf_dir, CODING).where("length(seq) > 60").select("seq_id", F.lit(21).alias("start"), F.length("seq").alias("end"), kind.alias("kind"))
    rows = coding.refine_starts(orfs, scores, 0.01)
    return rows.select("seq_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "kind")


@query(f"WITH {_MODEL}, g AS (SELECT orf_id, i, six AS kmer, i % 3 AS frame FROM ({_ending('orf_id', 'seq', _C + ' p_')})), r AS (SELECT orf_id, i, coalesce(loglik, 0) AS lik FROM g LEFT JOIN model USING (kmer, frame)), w AS (SELECT orf_id, lik, sum(lik) OVER (PARTITION BY orf_id ORDER BY i) AS running FROM r) SELECT orf_id AS seq_id, count(*) AS n, round(max(lik), 6) AS most, round(max(running), 3) AS highest, round(min(running), 3) AS lowest FROM w GROUP BY 1")
def likelihood_profile(spark, sf_dir):
    """Extremes of each sequence's profile of k-mer log-likelihoods and of its running sum."""
    cds, model = kmer_model(spark, sf_dir)
    rows = coding.likelihood_profile(cds, model, 5).where(F.size("lik") > 0)
    return rows.select("seq_id", F.size("lik").cast("long").alias("n"), F.round(F.array_max("lik"), 6).alias("most"), F.round(F.array_max("running"), 3).alias("highest"), F.round(F.array_min("running"), 3).alias("lowest"))


_DRAWN_FROM = "CAST(concat('0x', substr(md5({}), 1, 7)) AS BIGINT) % 10000"


def _matrices(name: str, cells: str, by: str = "") -> str:
    """SQL tables of counts, probabilities and log-odds of the cells (label, p_, base), for each value of a column."""
    return f"cnt{name} AS (SELECT {by}label, p_, base, count(*) AS n FROM {cells} GROUP BY ALL), full{name} AS (SELECT g.*, coalesce(n, 0) AS n FROM (SELECT DISTINCT {by}label, p_, unnest(['A', 'C', 'G', 'T']) AS base FROM cnt{name}) g LEFT JOIN cnt{name} USING ({by}label, p_, base)), prob{name} AS (SELECT *, (n + 1) / (sum(n) OVER (PARTITION BY {by}label, p_) + 4)::DOUBLE AS prob FROM full{name}), odds{name} AS (SELECT {by}p_, base, ln(max(prob) FILTER (label = 'pos')) - ln(max(prob) FILTER (label = 'neg')) AS o FROM prob{name} GROUP BY ALL)"


_SPANS = [(a, b) for a in (0, 5, 10, 15) for b in (27, 32)]
_ROUNDS = f"rw AS (SELECT *, {_DRAWN_FROM.format("concat_ws(':', seq_id, pos, round)")} AS u FROM w CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS round)), train AS (SELECT round, label, unnest(range(33)) AS p_, unnest(string_split(win, '')) AS base FROM rw WHERE u < 7500), {_matrices('_r', 'train', 'round, ')}, test AS (SELECT round, label, seq_id, pos, unnest(range(33)) AS p_, unnest(string_split(win, '')) AS base FROM rw WHERE u >= 7500), hit AS (SELECT test.*, coalesce(o, 0) AS o FROM test LEFT JOIN odds_r USING (round, p_, base) WHERE p_ NOT BETWEEN 20 AND 22)"


@query(f"WITH {_MOTIF}, {_ROUNDS}, each AS (" + " UNION ALL ".join(f"SELECT round, {a} AS first, {b} AS last, label, seq_id, pos, sum(o) / count(*) AS score FROM hit WHERE p_ BETWEEN {a} AND {b} GROUP BY ALL" for a, b in _SPANS) + ") SELECT round, first, last, label, count(*) AS n, round(avg(score), 5) AS score FROM each GROUP BY ALL")
def cross_scored_starts(spark, sf_dir):
    """Mean score of all test windows by round, range of positions and label."""
    rows = coding.cross_scored(_windows(spark, sf_dir), rounds=5)
    return rows.groupBy("round", "first", "last", "label").agg(F.count("*").alias("n"), F.round(F.avg("score"), 5).alias("score"))


def _purified(rounds: int) -> str:
    out = [f"kept0 AS (SELECT seq_id, pos FROM w WHERE label = 'pos' AND {_DRAWN_FROM.format("concat_ws(':', seq_id, pos)")} < 3000)"]
    for k in range(rounds):
        last = f", score FROM (SELECT *, rank() OVER (ORDER BY score DESC) AS r, count(*) OVER () AS c FROM score{k}) WHERE r - 1 <= 0.3 * (c - 1) AND score > 0)"
        out += [
            f"cell{k} AS (SELECT label, p_, base FROM cell WHERE label = 'neg' OR (seq_id, pos) IN (SELECT (seq_id, pos) FROM kept{k}))", _matrices(f"_{k}", f"cell{k}"),
            f"score{k} AS (SELECT seq_id, pos, round(sum(coalesce(o, 0)) / count(*), 9) AS score FROM cell LEFT JOIN odds_{k} USING (p_, base) WHERE label = 'pos' AND p_ NOT BETWEEN 20 AND 22 GROUP BY ALL)", f"kept{k + 1} AS (SELECT seq_id, pos{last}",
        ]
    return ", ".join(out)


@query(f"WITH {_MOTIF}, {_purified(3)} SELECT seq_id, CAST(pos AS BIGINT) AS pos, round(score, 6) AS score FROM kept3")
def purified_starts(spark, sf_dir):
    """True start windows that three rounds keep, with their last score."""
    rows = coding.purified(_motifs(spark, sf_dir), 3).where("label = 'pos'")
    return rows.select("seq_id", F.col("pos").cast("long").alias("pos"), F.round("score", 6).alias("score"))
