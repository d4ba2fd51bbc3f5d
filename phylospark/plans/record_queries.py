"""Queries over identifiers, records, feature sequences and joins of named files."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import coding, genotypes, hits, intervals, ortho, stats
from .registry import query
from .views import CODING, INTERVALS, ORTHO, duck, tables, view

_C = duck(CODING)

# names ------------------------------------------------------------------------------------------

_NAMES = "(SELECT o_orderkey AS id, concat(o_orderpriority, '/', CAST(o_custkey AS VARCHAR(20)), ' extra words') AS header, concat('g', CAST(o_custkey AS VARCHAR(20)), '_', CASE WHEN o_orderkey % 3 = 0 THEN 'i' ELSE 'x' END, CAST(o_orderkey % 7 AS VARCHAR(9))) AS isoform, concat(CASE WHEN o_orderkey % 2 = 0 THEN 'ortho' ELSE 'file_' END, CAST(o_custkey AS VARCHAR(20)), '.fa') AS file, concat('sp', CAST(o_custkey % 9 AS VARCHAR(9)), '++gene.', CAST(o_orderkey AS VARCHAR(20))) AS label FROM orders)"


@query(f"SELECT id, translate(split_part(header, ' ', 1), '/\\', '__') AS clean, CASE WHEN regexp_matches(header, '^[0-9]') THEN 'T' ELSE '' END || regexp_replace(header, '[^A-Za-z0-9_]', '_', 'g') AS taxon, CASE WHEN regexp_matches(isoform, '_i[0-9]+$') THEN regexp_extract(isoform, '^(.*)_i[0-9]+$', 1) ELSE regexp_extract(isoform, '^(.*)_[^_]*$', 1) END AS gene, CAST(regexp_extract(file, '([0-9]+)', 1) AS DOUBLE) AS number, split_part(label, '++', 1) AS species, split_part(label, '.', 1) AS gene_name, replace(header, '_R_', '') AS undirected FROM {_NAMES}")
def identifier_forms(spark, sf_dir):
    """Cleaned ids, taxon names, genes of isoforms, file numbers and species of names made of orders."""
    rows = view(spark, sf_dir, _NAMES)
    return rows.select(
        "id", fn.clean_id("header").alias("clean"), fn.taxon_name("header").alias("taxon"), fn.gene_of_isoform("isoform").alias("gene"), fn.file_number("file").alias("number"),
        fn.species_of("label").alias("species"), fn.before_dot("label").alias("gene_name"), fn.drop_direction("header").alias("undirected"),
    )


_TREE_TEXT = "(SELECT l_orderkey AS id, concat('(', string_agg_, ');') AS newick FROM (SELECT l_orderkey, {agg} AS string_agg_ FROM lineitem GROUP BY l_orderkey))"
_SPARK_TREES = _TREE_TEXT.format(agg="array_join(transform(array_sort(collect_list(struct(l_linenumber, l_suppkey))), x -> concat('s', x.l_suppkey, '++g', x.l_linenumber)), ',')")
_DUCK_TREES = _TREE_TEXT.format(agg="string_agg(concat('s', l_suppkey, '++g', l_linenumber), ',' ORDER BY l_linenumber, l_suppkey)")


@query(f"SELECT id, regexp_replace(newick, '\\+\\+[^,:;()]+', '', 'g') AS stripped FROM {_DUCK_TREES}")
def stripped_labels(spark, sf_dir):
    return view(spark, sf_dir, _SPARK_TREES).select("id", fn.strip_gene_labels("newick").alias("stripped"))


@query("WITH l AS (SELECT l_orderkey AS id, list(concat('s', l_suppkey) ORDER BY l_linenumber, l_suppkey) AS s FROM lineitem GROUP BY 1) SELECT id, array_to_string(list_filter(s, lambda x, i: list_position(s, x) = i), ',') AS species FROM l")
def species_in_order(spark, sf_dir):
    """Distinct species of each order's labels, in the order of first appearance."""
    tables(spark, sf_dir, "lineitem")
    labels = spark.sql("SELECT l_orderkey AS id, transform(array_sort(collect_list(struct(l_linenumber, l_suppkey))), x -> concat('s', x.l_suppkey, '++g', x.l_linenumber)) AS labels FROM lineitem GROUP BY l_orderkey")
    return labels.select("id", F.array_join(fn.species_list("labels"), ",").alias("species"))


@query(f"WITH c AS {_C}, p AS (SELECT seq_id, seq, concat('M', repeat('-', CAST(length(seq) % 5 AS INTEGER)), 'KL*') AS prot FROM c WHERE length(seq) >= 12 AND length(seq) % 3 = 0) SELECT seq_id, substr(seq, 1, 3) || repeat('---', CAST(length(seq) % 5 AS INTEGER)) || substr(seq, 4, 6) || '---' AS aligned FROM p")
def back_translated(spark, sf_dir):
    """Codon alignment of a gapped protein of four residues for each sequence of whole codons."""
    rows = view(spark, sf_dir, CODING).where("length(seq) >= 12 and length(seq) % 3 = 0")
    protein = F.concat(F.lit("M"), F.repeat(F.lit("-"), F.length("seq") % 5), F.lit("KL*"))
    return rows.withColumn("p", protein).select("seq_id", fn.back_translate("p", "seq").alias("aligned"))


@query("SELECT page_id, url AS plain FROM pages")
def unescaped_urls(spark, sf_dir):
    """Percent-escaped addresses decode to themselves."""
    tables(spark, sf_dir, "pages")
    escaped = spark.sql("SELECT page_id, replace(url_encode(url), '+', '%20') AS e FROM pages")
    return escaped.select("page_id", fn.unescape("e").alias("plain"))


@query(f"WITH a AS (SELECT CAST(doc_id AS VARCHAR) AS seq_id, text AS s FROM documents) SELECT seq_id, md5(translate(s, '-*', '')) AS stripped, CAST(length(s) - length(replace(s, '-', '')) AS BIGINT) AS gaps, md5(CASE WHEN length(s) % 80 = 0 THEN regexp_replace(regexp_replace(replace(s, chr(10), ' '), '(.{{80}})', '\\1' || chr(10), 'g'), chr(10) || '$', '') ELSE regexp_replace(replace(s, chr(10), ' '), '(.{{80}})', '\\1' || chr(10), 'g') END) AS wrapped FROM a")
def residue_forms(spark, sf_dir):
    """Texts without gaps and stops, their gaps, and their lines of 80."""
    tables(spark, sf_dir, "documents")
    rows = spark.sql("SELECT CAST(doc_id AS STRING) AS seq_id, text AS s, replace(text, chr(10), ' ') AS flat FROM documents")
    return rows.select("seq_id", F.md5(fn.strip_residues("s", "-*")).alias("stripped"), fn.gap_counts("s").alias("gaps"), F.md5(fn.wrap("flat")).alias("wrapped"))


# joins ------------------------------------------------------------------------------------------

_SEQS = f"(SELECT species, gene_id, md5(gene_id) AS seq FROM {ORTHO} WHERE length % 3 <> 0 GROUP BY species, gene_id)"


@query(f"WITH o AS {ORTHO}, s AS {_SEQS} SELECT group_id, species, gene_id, seq FROM o JOIN s USING (species, gene_id)")
def attached_sequences(spark, sf_dir):
    """Genes with their sequences; genes without one are dropped."""
    return ortho.attach_sequences(view(spark, sf_dir, ORTHO).select("group_id", "species", "gene_id"), view(spark, sf_dir, _SEQS)).select("group_id", "species", "gene_id", "seq")


@query(f"SELECT group_id, species, gene_id, md5(gene_id) AS seq FROM {ORTHO}")
def strictly_attached_sequences(spark, sf_dir):
    """The same where a gene without a sequence is an error."""
    genes = view(spark, sf_dir, ORTHO).select("group_id", "species", "gene_id")
    seqs = genes.select("species", "gene_id").distinct().withColumn("seq", F.md5("gene_id"))
    return ortho.attach_sequences(genes, seqs, strict=True).select("group_id", "species", "gene_id", "seq")


@query("SELECT concat('fam', p_partkey) AS family, concat('fam', p_partkey, '.pep') AS pep, CASE WHEN p_size > 10 THEN concat('fam', p_partkey, '.cds') END AS cds, CASE WHEN p_size <= 10 THEN concat('no coding file for fam', p_partkey, '.pep') END AS message FROM part")
def paired_files(spark, sf_dir):
    """Protein and coding files by family; small parts lack the coding file."""
    tables(spark, sf_dir, "part")
    pep, cds = spark.sql("SELECT concat('fam', p_partkey, '.pep') AS file FROM part"), spark.sql("SELECT concat('fam', p_partkey, '.cds') AS file FROM part WHERE p_size > 10")
    return ortho.pair_partners(pep, cds, strict=False)


_CONTIGS = "(SELECT CAST(o_custkey AS VARCHAR(20)) AS sample, o_orderpriority AS contig, concat(repeat('N', CAST(count(*) AS INTEGER)), CAST(max(o_orderkey) AS VARCHAR(20))) AS seq FROM orders GROUP BY o_custkey, o_orderpriority)"
_PLACES = "(SELECT o_orderpriority AS contig, row_number() OVER (ORDER BY o_orderpriority DESC) AS place FROM (SELECT DISTINCT o_orderpriority FROM orders))"


@query(f"SELECT sample, string_agg(seq, '' ORDER BY place) AS seq FROM {_CONTIGS} JOIN {_PLACES} USING (contig) GROUP BY 1")
def concatenated_samples(spark, sf_dir):
    """Contigs of each customer in reference order; absent ones are skipped."""
    return genotypes.sample_concat(view(spark, sf_dir, _CONTIGS), view(spark, sf_dir, _PLACES))


@query(f"SELECT o_custkey AS sample, o_orderpriority AS contig, o_orderkey AS start, CAST(place AS INTEGER) AS place FROM orders JOIN {_PLACES} ON contig = o_orderpriority")
def united_shards(spark, sf_dir):
    """Shards of one contig each as one table in reference order."""
    tables(spark, sf_dir, "orders")
    order = view(spark, sf_dir, _PLACES)
    shard = lambda p: spark.sql("SELECT o_custkey AS sample, o_orderpriority AS contig, o_orderkey AS start FROM orders").where(F.col("contig") == p)
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return genotypes.union_shards([shard(p) for p in names], order).select("sample", "contig", "start", F.col("place").cast("int").alias("place"))


@query(f"WITH r AS (SELECT o_orderpriority AS gene, CAST(o_custkey AS VARCHAR) AS sample, max(o_orderkey) AS k FROM orders GROUP BY ALL) SELECT gene AS locus, row_number() OVER (PARTITION BY gene ORDER BY sample) - 1 AS ord, sample AS seq_id, CAST(k AS VARCHAR) AS seq FROM r")
def gathered_genes(spark, sf_dir):
    tables(spark, sf_dir, "orders")
    return genotypes.gather_by_gene(spark.sql("SELECT o_orderpriority AS gene, CAST(o_custkey AS STRING) AS sample, CAST(max(o_orderkey) AS STRING) AS seq FROM orders GROUP BY o_orderpriority, o_custkey"))


@query("SELECT o_orderkey AS feature, o_orderpriority AS kind, coalesce(CAST(s AS VARCHAR), '__MISSING_INFO__') AS score FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS s FROM lineitem WHERE l_quantity > 30 GROUP BY 1) ON l_orderkey = o_orderkey")
def listed_scores(spark, sf_dir):
    """Score of each order, or the mark for none."""
    tables(spark, sf_dir, "orders", "lineitem")
    scores = spark.sql("SELECT l_orderkey AS feature, count(*) AS score FROM lineitem WHERE l_quantity > 30 GROUP BY l_orderkey")
    return hits.with_scores(spark.sql("SELECT o_orderkey AS feature, o_orderpriority AS kind FROM orders"), scores)


@query("SELECT n_name AS sample, n_nationkey AS place, count(*) AS n FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL")
def checked_leaves(spark, sf_dir):
    """Leaves in tree order with their number of ages; a leaf without any is an error."""
    tables(spark, sf_dir, "nation", "customer")
    leaves = spark.sql("SELECT DISTINCT n_name AS sample, n_nationkey AS place FROM nation JOIN customer ON c_nationkey = n_nationkey")
    return stats.check_leaves(leaves, spark.sql("SELECT n_name AS sample, c_acctbal AS age FROM customer JOIN nation ON c_nationkey = n_nationkey"))


@query("SELECT l_orderkey AS orf_id, CAST(l_quantity AS DOUBLE) - 20 AS score_1, l_discount * 100 AS score_2, l_tax * 100 AS score_3, CAST(l_extendedprice AS BIGINT) % 1500 AS seq_length, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS homology_count FROM lineitem WHERE (l_quantity - 20 > 0 AND l_quantity - 20 > greatest(l_discount * 100, l_tax * 100)) OR l_returnflag = 'R' OR CAST(floor(l_extendedprice) AS BIGINT) % 1500 >= 1000".replace("CAST(l_extendedprice AS BIGINT)", "CAST(floor(l_extendedprice) AS BIGINT)"))
def accepted_orfs(spark, sf_dir):
    tables(spark, sf_dir, "lineitem")
    return coding.accepted(spark.sql("SELECT l_orderkey AS orf_id, CAST(l_quantity AS DOUBLE) - 20 AS score_1, l_discount * 100 AS score_2, l_tax * 100 AS score_3, CAST(floor(l_extendedprice) AS BIGINT) % 1500 AS seq_length, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS homology_count FROM lineitem"))


# features ---------------------------------------------------------------------------------------


@query(f"WITH f AS {INTERVALS}, m AS (SELECT id % 500 AS token, contig, min(ord) AS ord FROM f GROUP BY ALL) SELECT contig, ord FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY contig, ord) AS n FROM (SELECT contig, ord, concat(contig % 3, ':', token % 11, '-', token % 7 + 20) AS token FROM m)) WHERE n = 1")
def first_coordinates(spark, sf_dir):
    """Models whose contig and segments were not seen before."""
    rows = view(spark, sf_dir, INTERVALS).groupBy((F.col("id") % 500).alias("t"), "contig").agg(F.min("ord").alias("ord"))
    segment = F.struct((F.col("t") % 11).alias("start"), (F.col("t") % 7 + 20).alias("end"))
    models = rows.select(F.col("contig").alias("own"), "ord", (F.col("contig") % 3).alias("contig"), F.array(segment).alias("segments"), F.struct("contig", "ord").alias("place"))
    return intervals.first_of_same_segments(models, "place").select(F.col("own").alias("contig"), "ord")


_MODELS = "(SELECT l_orderkey AS model_id, CAST(l_orderkey % 97 AS VARCHAR(20)) AS contig, CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, 'CDS' AS type, l_linenumber * 60 + 1 AS start, l_linenumber * 60 + CAST(max(l_quantity) AS INTEGER) AS stop FROM lineitem GROUP BY l_orderkey, l_linenumber)"


@query(f"WITH c AS {_C}, p AS (SELECT model_id, strand, start, substr(seq, start, stop - start + 1) AS part FROM {_MODELS} JOIN c ON contig = seq_id), j AS (SELECT model_id, any_value(strand) AS strand, string_agg(part, '' ORDER BY start) AS s FROM p GROUP BY 1) SELECT model_id, CASE WHEN strand = '-' THEN reverse(translate(s, 'ACGT', 'TGCA')) ELSE s END AS seq FROM j")
def spliced_models(spark, sf_dir):
    """Coding sequences of models (order lines) out of contigs (documents)."""
    contigs = view(spark, sf_dir, CODING).select(F.col("seq_id").alias("contig"), "seq")
    return intervals.spliced(view(spark, sf_dir, _MODELS).withColumnRenamed("stop", "end"), contigs)


_PLACES_OF = "(SELECT p_brand AS ord, CAST(count(*) AS INTEGER) AS start, CAST(count(*) + 40 AS INTEGER) AS stop FROM part GROUP BY p_brand)"


@query(f"WITH c AS {_C}, f AS (SELECT *, concat('gene_', row_number() OVER (ORDER BY ord)) AS gene FROM {_PLACES_OF}) SELECT seq_id AS sample, gene, substr(seq, start, stop - start + 1) AS seq FROM c CROSS JOIN f")
def consensus_regions(spark, sf_dir):
    """Every region (a brand) out of every sequence."""
    samples = view(spark, sf_dir, CODING).select(F.col("seq_id").alias("sample"), "seq")
    return intervals.regions(samples, view(spark, sf_dir, _PLACES_OF).withColumnRenamed("stop", "end"))


@query("SELECT l_partkey AS contig, arg_max(l_orderkey * 10 + l_linenumber, (l_quantity, -(l_orderkey * 10 + l_linenumber))) AS orf, CAST(max(l_quantity) AS BIGINT) AS length FROM lineitem GROUP BY 1")
def longest_orf(spark, sf_dir):
    """Longest ORF of each contig by the length in its header."""
    tables(spark, sf_dir, "lineitem")
    heads = spark.sql("SELECT l_orderkey * 10 + l_linenumber AS orf, concat('g1 type:complete len:', CAST(l_quantity AS INT), ' (+) ', l_partkey, ':1-', CAST(l_quantity AS INT), '(+)') AS header FROM lineitem")
    rows = heads.select("orf", fn.orf_header("header").alias("h")).select("orf", F.col("h.contig").cast("long").alias("contig"), F.col("h.length").alias("length"))
    return intervals.single_best(rows, "contig", [-F.col("length"), F.col("orf")]).select("contig", "orf", "length")
