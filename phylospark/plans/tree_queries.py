"""Queries over tree corpora made of order lines: one tree for each supplier, nations as leaves."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clusters, introgression, trees
from .registry import query
from .views import tables


_NATION, _REGION, _STATUS = "replace(n_name, ' ', '_')", "concat('R', CAST(n_regionkey AS VARCHAR(9)))", "o_orderstatus"


def tree_classes(where: str = "", groups: int = 4, leaf: str = _NATION) -> str:
    """Leaves of each supplier's tree: customers' nations (or another column), grouped by their number of lines (mod ``groups``)."""
    return f"(SELECT CAST(l_suppkey AS VARCHAR(20)) AS tree_id, {leaf} AS leaf, count(*) % {groups} AS k, CAST(CAST(sum(l_quantity) AS BIGINT) % 97 + 1 AS DOUBLE) AS len FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey {where} GROUP BY l_suppkey, {leaf})"


#: lines of large quantities only: trees lack some nations
_RARE = "WHERE l_quantity > 46"
#: order states as leaves, in up to two groups: some trees are binary
_FEW = ("", 2, _STATUS)


def tree_corpus(spark, sf_dir, where="", groups=4, leaf=_NATION):
    tables(spark, sf_dir, "nation", "customer", "orders", "lineitem")
    return spark.sql(f"""
        WITH g AS (SELECT tree_id, k, concat('(', array_join(transform(array_sort(collect_list(struct(leaf AS l, len))), x -> concat(x.l, ':', CAST(x.len AS STRING))), ','), ')', CAST(k * 10 + 50 AS STRING), ':', CAST(1 + k AS STRING)) AS t FROM {tree_classes(where, groups, leaf)} GROUP BY tree_id, k)
        SELECT tree_id, concat('(', array_join(transform(array_sort(collect_list(struct(k, t))), x -> x.t), ','), ');') AS newick FROM g GROUP BY tree_id""")


def tree_nodes(spark, sf_dir, *kind):
    return trees.nodes(tree_corpus(spark, sf_dir, *kind))


def _species(spark, sf_dir):
    tables(spark, sf_dir, "nation")
    return spark.sql("""
        WITH g AS (SELECT n_regionkey AS k, concat('(', array_join(array_sort(collect_list(concat(replace(n_name, ' ', '_'), ':1'))), ','), '):1') AS t FROM nation GROUP BY n_regionkey)
        SELECT 'species' AS tree_id, concat('(', array_join(transform(array_sort(collect_list(struct(k, t))), x -> x.t), ','), ');') AS newick FROM g""")


def _clades(*kind) -> str:
    return f"leaves AS (SELECT * FROM {tree_classes(*kind)}), inner_ AS (SELECT tree_id, k, list_sort(list(leaf)) AS c FROM leaves GROUP BY ALL), roots AS (SELECT tree_id, list_sort(list(leaf)) AS c FROM leaves GROUP BY 1), gene AS (SELECT tree_id, c FROM inner_ UNION SELECT tree_id, c FROM roots), sp AS (SELECT list_sort(list(replace(n_name, ' ', '_'))) AS c FROM nation GROUP BY n_regionkey UNION SELECT list_sort(list(replace(n_name, ' ', '_'))) FROM nation)"


_joined = lambda c: F.array_join(c, ",")


@query(f"WITH {_clades()} SELECT array_to_string(sp.c, ',') AS clade, CAST(len(sp.c) AS INTEGER) AS size, count(DISTINCT tree_id) AS n, round(100 * count(DISTINCT tree_id) / (SELECT count(DISTINCT tree_id) FROM gene)::DOUBLE, 2) AS percent FROM sp LEFT JOIN gene ON gene.c = sp.c GROUP BY sp.c")
def clade_support(spark, sf_dir):
    rows = trees.clade_support(trees.nodes(_species(spark, sf_dir)), tree_nodes(spark, sf_dir))
    return rows.select(_joined("clade").alias("clade"), "size", "n", "percent")


@query(f"WITH {_clades()}, x AS (SELECT sp.c AS s, g.c AS g, tree_id FROM sp JOIN gene g ON len(list_intersect(sp.c, g.c)) > 0 WHERE len(sp.c) > 1) SELECT array_to_string(s, ',') AS clade, count(DISTINCT tree_id) FILTER (s = g) AS concordant, count(DISTINCT tree_id) FILTER (len(list_intersect(s, g)) < len(s) AND len(list_intersect(s, g)) < len(g)) AS conflicting FROM x GROUP BY s")
def clade_conflict(spark, sf_dir):
    rows = trees.clade_conflict(trees.nodes(_species(spark, sf_dir)), tree_nodes(spark, sf_dir))
    return rows.select(_joined("clade").alias("clade"), "concordant", "conflicting")


@query(f"WITH {_clades(_RARE)} SELECT tree_id, array_to_string(list_sort(list_filter((SELECT list(replace(n_name, ' ', '_')) FROM nation), lambda x: NOT list_contains(c, x))), ',') AS missing FROM roots WHERE len(c) < (SELECT count(*) FROM nation)")
def tip_differences(spark, sf_dir):
    rows = trees.tip_differences(trees.nodes(_species(spark, sf_dir)), tree_nodes(spark, sf_dir, _RARE))
    return rows.select("tree_id", _joined(F.array_sort("missing")).alias("missing"))


@query(f"WITH {_clades(_RARE)} SELECT tree_id FROM roots WHERE list_contains(c, 'NATION_1') AND list_contains(c, 'NATION_2')")
def trees_with_taxa(spark, sf_dir):
    return trees.with_taxa(tree_nodes(spark, sf_dir, _RARE), ["NATION_1", "NATION_2"])


@query(f"WITH {_clades()}, h AS (SELECT tree_id, k, max(1 + k + len) AS far FROM leaves GROUP BY ALL) SELECT tree_id, array_to_string(list_sort(list(leaf)), ',') AS clade, round(max(len), 6) AS age FROM leaves GROUP BY tree_id, k UNION SELECT tree_id, (SELECT array_to_string(c, ',') FROM roots r WHERE r.tree_id = h.tree_id), round(max(far), 6) FROM h GROUP BY tree_id")
def node_ages(spark, sf_dir):
    rows = trees.node_ages(tree_nodes(spark, sf_dir)).where("not is_leaf")
    return rows.select("tree_id", _joined("leaves").alias("clade"), F.round("age", 6).alias("age")).distinct()


@query(f"SELECT tree_id, round(avg(k * 10 + 50), 6) AS avg_support FROM (SELECT DISTINCT tree_id, k FROM {tree_classes()}) GROUP BY 1")
def mean_support(spark, sf_dir):
    return trees.mean_support(tree_nodes(spark, sf_dir)).select("tree_id", F.round("avg_support", 6).alias("avg_support"))


@query(f"WITH l AS (SELECT * FROM {tree_classes()}) SELECT a.tree_id, least(a.leaf, b.leaf) AS a, greatest(a.leaf, b.leaf) AS b, CAST(CASE WHEN a.k = b.k THEN 1 + a.k ELSE 0 END AS DOUBLE) AS depth FROM l a JOIN l b ON a.tree_id = b.tree_id AND a.leaf < b.leaf")
def pair_depths(spark, sf_dir):
    return trees.pair_depths(tree_nodes(spark, sf_dir))


_TRIPLETS = f"l AS (SELECT * FROM {tree_classes(_RARE)}), t AS (SELECT x.tree_id, x.leaf AS x, y.leaf AS y, z.leaf AS z, CASE WHEN x.k = y.k THEN 1 + x.k ELSE 0 END AS xy, CASE WHEN x.k = z.k THEN 1 + x.k ELSE 0 END AS xz, CASE WHEN y.k = z.k THEN 1 + y.k ELSE 0 END AS yz FROM l x JOIN l y ON x.tree_id = y.tree_id AND x.leaf < y.leaf JOIN l z ON x.tree_id = z.tree_id AND y.leaf < z.leaf), br AS (SELECT tree_id, concat_ws('_', x, y, z) AS triplet, CASE WHEN xy > greatest(xz, yz) THEN z WHEN xz > greatest(xy, yz) THEN y ELSE x END AS outgroup, CAST(greatest(xy, xz, yz) - (xy + xz + yz - greatest(xy, xz, yz) - least(xy, xz, yz)) AS DOUBLE) AS branch FROM t WHERE NOT (xy = xz AND xz = yz) AND greatest(xy, xz, yz) > (xy + xz + yz - greatest(xy, xz, yz) - least(xy, xz, yz)))"


def _triplets(spark, sf_dir):
    return _branches(spark, sf_dir, _RARE)


def _branches(spark, sf_dir, *kind):
    return introgression.triplet_branches(trees.pair_depths(tree_nodes(spark, sf_dir, *kind)))


@query(f"WITH {_TRIPLETS} SELECT tree_id, triplet, outgroup, branch FROM br")
def triplet_topology(spark, sf_dir):
    return _branches(spark, sf_dir, _RARE)


@query()
def introgression_models(spark, sf_dir):
    return introgression.fit_mixtures(_branches(spark, sf_dir, "", 4, _REGION)).select("triplet", "outgroup", "count", "BIC1Dist", "BIC2Dist")


_FITS = "(SELECT CAST(l_suppkey AS VARCHAR(20)) AS triplet, CAST(l_linenumber AS VARCHAR(9)) AS outgroup, count(*) AS count, CAST(max(l_discount) AS DOUBLE) AS mixprop2, CAST(CAST(sum(l_quantity) AS BIGINT) % 50 AS DOUBLE) AS BIC2Dist, CAST(CAST(sum(l_quantity) AS BIGINT) % 70 AS DOUBLE) AS BIC1Dist FROM lineitem GROUP BY l_suppkey, l_linenumber)"


@query(f"WITH m AS {_FITS}, w AS (SELECT *, round(BIC2Dist - BIC1Dist, 4) AS delta_bic, CAST(sum(count) OVER (PARTITION BY triplet) AS BIGINT) AS total, count = max(count) OVER (PARTITION BY triplet) AS major FROM m WHERE triplet NOT LIKE '%7%'), d AS (SELECT *, delta_bic < -10 AS significant, CAST(sum(CASE WHEN major THEN 0 ELSE count END) OVER (PARTITION BY triplet) AS BIGINT) AS discordant FROM w) SELECT triplet, outgroup, count, delta_bic, total, major, significant, discordant, round(CASE WHEN discordant > 0 THEN CASE WHEN significant AND NOT major THEN mixprop2 * count ELSE 0 END / discordant END, 6) AS share_of_discordant, round(CASE WHEN significant AND NOT major THEN mixprop2 * count ELSE 0 END / total, 6) AS share_of_all FROM d")
def summarised_models(spark, sf_dir):
    """Summary of models made of order lines, without the triplets of one outgroup."""
    tables(spark, sf_dir, "lineitem")
    rows = introgression.summarise(spark.sql(f"SELECT * FROM {_FITS}"), -10.0, without="7")
    return rows.select("triplet", "outgroup", "count", "delta_bic", "total", "major", "significant", "discordant", "share_of_discordant", "share_of_all")


@query()
def introgression_summary(spark, sf_dir):
    rows = introgression.summarise(introgression.fit_mixtures(_branches(spark, sf_dir, "", 4, _REGION)))
    return rows.select("triplet", "outgroup", "count", "delta_bic", "significant", "major", "discordant", "total")


_MODELS = "(SELECT l_suppkey AS triplet, CAST(l_linenumber AS VARCHAR(9)) AS outgroup, CAST(0.0 AS DOUBLE) AS C1, 1 + max(l_tax) * 10 AS C2, CAST(1 AS DOUBLE) - max(l_discount) AS mixprop1, max(l_discount) AS mixprop2, CAST(1 + max(l_quantity) AS DOUBLE) AS lambda2Dist, min(l_quantity) AS BIC1Dist, max(l_tax) * 400 AS BIC2Dist, concat('T', CAST(l_suppkey % 4 AS VARCHAR(9))) AS a, concat('T', CAST(l_linenumber % 4 AS VARCHAR(9))) AS b, l_linenumber = 1 AS major FROM lineitem WHERE l_returnflag = 'N' GROUP BY l_suppkey, l_linenumber)"


@query(f"WITH m AS {_MODELS}, x AS (SELECT l_orderkey AS tree_id, l_suppkey AS triplet, CAST(l_linenumber AS VARCHAR) AS outgroup, l_quantity AS x FROM lineitem), j AS (SELECT tree_id, triplet, outgroup, mixprop1 * 0.5 / lambda2Dist * exp(-x / lambda2Dist) * 2 AS f1, mixprop2 * CASE WHEN x >= C2 * lambda2Dist THEN 0.5 / lambda2Dist * exp(-x / lambda2Dist) * (1 + exp(C2)) ELSE (exp(x / lambda2Dist) - exp(-x / lambda2Dist)) / 2 / (lambda2Dist * (exp(C2) - 1)) END AS f2 FROM x JOIN m USING (triplet, outgroup)) SELECT tree_id, triplet, outgroup, round(f2 / (f1 + f2), 6) AS probability FROM j")
def tree_probabilities(spark, sf_dir):
    """Probabilities of the second component under models and branches made of order lines."""
    tables(spark, sf_dir, "lineitem")
    branches = spark.sql("SELECT l_orderkey AS tree_id, l_suppkey AS triplet, CAST(l_linenumber AS STRING) AS outgroup, l_quantity AS branch FROM lineitem")
    return introgression.tree_probabilities(branches, spark.sql(f"SELECT * FROM {_MODELS}")).withColumn("probability", F.round("probability", 6))


@query(f"WITH m AS {_MODELS}, p AS (SELECT least(a, b) AS a, greatest(a, b) AS b, avg(CASE WHEN BIC1Dist - BIC2Dist > 20 THEN mixprop2 ELSE 0 END) AS v FROM m WHERE NOT major AND a <> b GROUP BY ALL), w AS (SELECT a, b, v FROM p UNION ALL SELECT b, a, v FROM p) SELECT a, " + ", ".join(f"coalesce(round(max(v) FILTER (b = 'T{k}'), 6), 0) AS T{k}" for k in range(4)) + " FROM w GROUP BY 1")
def introgression_matrix(spark, sf_dir):
    tables(spark, sf_dir, "lineitem")
    return introgression.pair_matrix(spark.sql(f"SELECT * FROM {_MODELS} WHERE a <> b"), 20.0, ["T0", "T1", "T2", "T3"])


@query(f"WITH {_clades(*_FEW)} SELECT tree_id, bool_and(n <= 2) AS binary FROM (SELECT tree_id, k, count(*) AS n FROM leaves GROUP BY ALL UNION ALL SELECT tree_id, -1, count(DISTINCT k) FROM leaves GROUP BY tree_id) GROUP BY 1 HAVING bool_and(n <= 2)")
def binary_trees(spark, sf_dir):
    return trees.binary_trees(tree_nodes(spark, sf_dir, *_FEW)).withColumn("binary", F.lit(True))


@query(f"WITH {_clades()}, want AS (SELECT n_regionkey AS r, list_sort(list(replace(n_name, ' ', '_'))) AS c FROM nation GROUP BY 1), held AS (SELECT tree_id, r, len(g.c) AS size, g.c = want.c AS same FROM want JOIN gene g ON len(list_intersect(g.c, want.c)) = len(want.c)) SELECT tree_id, r AS list_id, CAST(min(size) AS INTEGER) AS size, bool_or(same) AS monophyletic FROM held GROUP BY ALL")
def mrca(spark, sf_dir):
    lists = spark.read.parquet(f"{sf_dir}/nation.parquet").groupBy(F.col("n_regionkey").alias("list_id")).agg(F.collect_list(F.translate("n_name", " ", "_")).alias("taxa"))
    return trees.mrca(tree_nodes(spark, sf_dir), lists).select("tree_id", "list_id", "size", "monophyletic")


@query(f"WITH {_clades(*_FEW)}, two AS (SELECT tree_id FROM gene WHERE c = ['F', 'O'] GROUP BY 1) SELECT tree_id, 'pair' AS list_id, CAST(2 AS DOUBLE) AS min_age, CAST(9 AS DOUBLE) AS max_age FROM two UNION ALL SELECT tree_id, 'root', 50, 50 FROM roots WHERE tree_id NOT IN (SELECT tree_id FROM two)")
def listed_calibrations(spark, sf_dir):
    """The pair of states F and O is dated where it is a clade; other trees get a fixed root."""
    listed = spark.createDataFrame([("pair", ["F", "O"], 9.0, 2.0)], "list_id string, taxa array<string>, max_age double, min_age double")
    return trees.listed_calibrations(tree_nodes(spark, sf_dir, *_FEW), listed, 50.0).select("tree_id", "list_id", "min_age", "max_age")


@query(f"WITH {_clades(*_FEW)}, one AS (SELECT c, max(len) AS age FROM leaves JOIN inner_ USING (tree_id, k) WHERE tree_id = '1' GROUP BY tree_id, k, c UNION SELECT (SELECT c FROM roots WHERE tree_id = '1'), max(1 + k + len) FROM leaves WHERE tree_id = '1') SELECT g.tree_id, array_to_string(g.c, ',') AS clade, round(CASE WHEN g.c = r.c THEN age ELSE age * 0.95 END, 6) AS min_age, round(CASE WHEN g.c = r.c THEN age ELSE age * 1.05 END, 6) AS max_age FROM (SELECT DISTINCT tree_id, c FROM gene) g JOIN roots r USING (tree_id) JOIN (SELECT c, max(age) AS age FROM one GROUP BY 1) o ON o.c = g.c")
def dated_calibrations(spark, sf_dir):
    """Clades of the first supplier's tree date those of all trees."""
    gene = tree_nodes(spark, sf_dir, *_FEW)
    met = trees.dated_calibrations(gene, gene.where("tree_id = '1'"))
    clades = gene.select("tree_id", "node_id", _joined("leaves").alias("clade"))
    rows = met.join(clades, ["tree_id", "node_id"])
    # a node with one child has its child's leaves: the higher one counts
    return rows.groupBy("tree_id", "clade").agg(*[F.round(F.min_by(c, F.struct("node_id", -F.col("max_age"))), 6).alias(c) for c in ("min_age", "max_age")])


@query(f"WITH {_clades()}, h AS (SELECT tree_id, max(1 + k + len) AS h FROM leaves GROUP BY 1) SELECT tree_id, leaf AS name, round(len / h, 6) AS scaled_len FROM leaves JOIN h USING (tree_id)")
def scaled_trees(spark, sf_dir):
    rows = trees.scaled(tree_nodes(spark, sf_dir)).where("is_leaf")
    return rows.select("tree_id", "name", F.round("scaled_len", 6).alias("scaled_len"))


_EDGES = f"leaves AS (SELECT * FROM {tree_classes()}), all_ AS (SELECT tree_id, list_sort(list(leaf)) AS a FROM leaves GROUP BY 1), edges AS (SELECT tree_id, [leaf] AS m, len FROM leaves UNION ALL SELECT tree_id, list_sort(list(leaf)), CAST(1 + k AS DOUBLE) FROM leaves GROUP BY tree_id, k), sides AS (SELECT tree_id, a, list_filter(a, lambda x: x <> 'NATION_3') AS rest FROM all_ WHERE list_contains(a, 'NATION_3')), e AS (SELECT tree_id, m, len, rest, m = ['NATION_3'] OR m = rest AS root_edge, CASE WHEN list_contains(m, 'NATION_3') THEN list_filter(a, lambda x: NOT list_contains(m, x)) ELSE m END AS c FROM edges JOIN sides USING (tree_id)), half AS (SELECT tree_id, any_value(rest) AS rest, sum(len) / 2 AS h FROM e WHERE root_edge GROUP BY 1)"


@query(f"WITH {_EDGES} SELECT tree_id, array_to_string(c, ',') AS clade, round(sum(len), 6) AS branch_len FROM e WHERE NOT root_edge AND len(c) > 0 GROUP BY ALL UNION ALL SELECT tree_id, 'NATION_3', round(h, 6) FROM half UNION ALL SELECT tree_id, array_to_string(rest, ','), round(h, 6) FROM half")
def rerooted_trees(spark, sf_dir):
    rows = trees.rerooted_nodes(tree_nodes(spark, sf_dir), ["NATION_3"])
    return rows.select("tree_id", _joined("leaves").alias("clade"), F.round("branch_len", 6).alias("branch_len"))


_TWELVE = [f"NATION_{k}" for k in range(12)]


@query(f"WITH l AS (SELECT * FROM {tree_classes(_RARE)} WHERE leaf IN ({', '.join(repr(x) for x in _TWELVE)})), g AS (SELECT tree_id, k, list_sort(list(leaf)) AS c, count(*) AS n FROM l GROUP BY ALL), t AS (SELECT tree_id, list_sort(list(leaf)) AS c, count(DISTINCT k) AS groups FROM l GROUP BY 1), rows_ AS (SELECT tree_id, leaf AS clade, CASE WHEN groups = 1 AND n = 1 THEN NULL WHEN n = 1 THEN len + 1 + k ELSE len END AS branch_len FROM l JOIN g USING (tree_id, k) JOIN t USING (tree_id) UNION ALL SELECT tree_id, array_to_string(g.c, ','), 1 + k FROM g JOIN t USING (tree_id) WHERE n > 1 AND groups > 1 UNION ALL SELECT tree_id, array_to_string(c, ','), NULL FROM t WHERE len(c) > 1) SELECT tree_id, clade, CAST(branch_len AS DOUBLE) AS branch_len FROM rows_")
def pruned_trees(spark, sf_dir):
    rows = trees.pruned_nodes(tree_nodes(spark, sf_dir, _RARE), _TWELVE)
    return rows.select("tree_id", _joined("leaves").alias("clade"), "branch_len")


def _long_branches(rounds: int = 5) -> str:
    """SQL rows (tree_id, leaf, signature) of the leaves that go, round by round."""
    out = [
        f"l AS MATERIALIZED (SELECT * FROM {tree_classes()})", "n AS (SELECT tree_id, CAST(least(count(*) // 5, floor(2 * sqrt(count(*)))) AS BIGINT) AS steps FROM l GROUP BY 1)",
        "p0 AS (SELECT a.tree_id, a.leaf AS x, b.leaf AS y, a.len + b.len + CASE WHEN a.k = b.k THEN 0 ELSE 2 + a.k + b.k END AS d FROM l a JOIN l b ON a.tree_id = b.tree_id AND a.leaf < b.leaf)",
    ]
    for k in range(1, rounds + 1):
        out += [
            f"top{k} AS (SELECT tree_id, arg_min({{'x': x, 'y': y, 'd': d}}, (-d, x, y)) AS t FROM p{k - 1} JOIN n USING (tree_id) WHERE steps >= {k} GROUP BY 1)",
            f"gone{k} AS MATERIALIZED (SELECT tree_id, CASE WHEN (ax, t.x) <= (ay, t.y) THEN t.x ELSE t.y END AS leaf, CASE WHEN least(ax, ay) > 0 THEN t.d / least(ax, ay) ELSE 1 END AS signature FROM (SELECT tree_id, t, max(d) FILTER (x <> t.x AND y <> t.x) AS ax, max(d) FILTER (x <> t.y AND y <> t.y) AS ay FROM p{k - 1} JOIN top{k} USING (tree_id) GROUP BY ALL))",
            f"p{k} AS (SELECT p.* FROM p{k - 1} p JOIN gone{k} USING (tree_id) WHERE x <> leaf AND y <> leaf)",
        ]
    return ", ".join(out) + ", sig AS (" + " UNION ALL ".join(f"SELECT * FROM gone{k}" for k in range(1, rounds + 1)) + ")"


@query(f"WITH {_long_branches()} SELECT tree_id, leaf, round(signature, 6) AS signature FROM sig")
def long_branches(spark, sf_dir):
    """Leaves on long branches of each tree, with the ratio of diameters."""
    return trees.long_branches(tree_nodes(spark, sf_dir)).withColumn("signature", F.round("signature", 6))


@query(f"WITH {_long_branches()}, occ AS (SELECT leaf, count(*) AS n FROM l GROUP BY 1), few AS (SELECT min(n) < 20 AS whole FROM occ), s AS (SELECT leaf, n, coalesce(sum(ln(signature)), 0) AS s, coalesce(sum(ln(signature) * ln(signature)), 0) AS q FROM occ LEFT JOIN sig USING (leaf) GROUP BY ALL), g AS (SELECT leaf, CASE WHEN whole THEN sum(s) OVER () ELSE s END AS s, CASE WHEN whole THEN sum(q) OVER () ELSE q END AS q, CASE WHEN whole THEN sum(n) OVER () ELSE n END AS n, whole FROM s CROSS JOIN few), t AS (SELECT leaf, exp(s / n + 1.6448536269514722 * sqrt(greatest(q / n - s / n * (s / n), 0))) AS limit_, whole FROM g) SELECT tree_id, leaf AS species, leaf, round(ln(signature), 6) AS ln_signature, round(CASE WHEN whole THEN limit_ ELSE greatest(limit_, 1.05) END, 6) AS threshold FROM sig JOIN t USING (leaf) WHERE signature > CASE WHEN whole THEN limit_ ELSE greatest(limit_, 1.05) END")
def branch_outliers(spark, sf_dir):
    """Leaves whose signature is over the threshold of all leaves, or of their species."""
    nodes = tree_nodes(spark, sf_dir)
    # read twice: the trees are read for it once
    occupancy = clusters.stored(nodes.where("is_leaf").groupBy(F.col("name").alias("species")).agg(F.count("*").alias("n_trees")), "occupancy")
    return trees.removal_thresholds(trees.long_branches(nodes), occupancy).withColumn("threshold", F.round("threshold", 6))


def _copies(spark, sf_dir):
    """Leaves as genes of two species, by the last digit of the nation's number."""
    even = F.regexp_replace("newick", r"(NATION_\d*[02468]):", "even++$1:")
    return tree_corpus(spark, sf_dir, _RARE, 8).select("tree_id", F.regexp_replace(even, r"(?<!\+)(NATION_\d*[13579]):", "odd++$1:").alias("newick"))


@query(f"WITH l AS (SELECT *, CASE WHEN CAST(right(leaf, 1) AS INTEGER) % 2 = 0 THEN 'even' ELSE 'odd' END AS s FROM {tree_classes(_RARE, 8)}), g AS (SELECT tree_id, k, count(*) AS n, max(len) AS age, min(s) AS lo, max(s) AS hi FROM l GROUP BY ALL), r AS (SELECT tree_id, max(1 + k + len) AS age FROM l GROUP BY 1 HAVING count(DISTINCT k) = 2) SELECT tree_id, lo AS species, round(age, 6) AS age FROM g WHERE n = 2 AND lo = hi UNION ALL SELECT tree_id, s, round(age, 6) FROM r JOIN (SELECT tree_id, s FROM l GROUP BY ALL HAVING count(DISTINCT k) = 2) USING (tree_id)")
def duplication_ages(spark, sf_dir):
    rows = trees.duplication_ages(trees.nodes(_copies(spark, sf_dir)))
    return rows.select("tree_id", "species", F.round("age", 6).alias("age"))


@query(f"WITH l AS (SELECT tree_id, k, len, leaf, leaf = 'P' AS outer_ FROM {tree_classes(*_FEW)}), g AS (SELECT tree_id, k, count(*) FILTER (NOT outer_) AS inner_, count(*) FILTER (outer_) AS outer_ FROM l GROUP BY ALL), t AS (SELECT tree_id, CAST(sum(inner_) AS BIGINT) AS all_, count(*) AS k, bool_or(inner_ = 0 AND outer_ > 0) AS o, max(CASE WHEN outer_ = 0 THEN inner_ ELSE 0 END) AS i FROM g GROUP BY 1), up AS (SELECT tree_id, 0 AS node FROM t WHERE k = 2 AND o AND i > 2 * all_ / 3::DOUBLE), low AS (SELECT tree_id, k, count(*) AS n, bool_or(outer_) AS o, max(CASE WHEN outer_ THEN 0 ELSE 1 END) AS i FROM l GROUP BY ALL HAVING count(*) = 2), deep AS (SELECT tree_id, 1 AS node FROM low JOIN t USING (tree_id) WHERE low.o AND low.i > 2 * all_ / 3::DOUBLE) SELECT tree_id, count(*) AS n, CAST(20 AS DOUBLE) AS min_age, round(20.01, 2)::DOUBLE AS max_age FROM (SELECT * FROM up UNION ALL SELECT * FROM deep) GROUP BY 1")
def split_calibrations(spark, sf_dir):
    """Nodes that part the outgroup (state P) from most of a tree's other leaves, by tree."""
    rows = trees.split_calibrations(tree_nodes(spark, sf_dir, *_FEW), ["P"], 20.0)
    return rows.groupBy("tree_id").agg(F.count("*").alias("n"), F.max("min_age").alias("min_age"), F.round(F.max("max_age"), 2).alias("max_age"))


#: order priorities as genes, the first three of an outgroup species
_GENES = ("WHERE l_quantity > 40", 3, "concat(CASE WHEN substr(o_orderpriority, 1, 1) < '4' THEN 'o' ELSE 'x' END, '++g', substr(o_orderpriority, 1, 1))")
_OUTGROUP = f"l AS (SELECT * FROM {tree_classes(*_GENES)}), t AS (SELECT tree_id, list_sort(list(leaf) FILTER (leaf LIKE 'x%')) AS inner_, coalesce(list_sort(list(leaf) FILTER (leaf LIKE 'o%')), []) AS outer_, count(DISTINCT k) AS groups FROM l GROUP BY 1), g AS (SELECT tree_id, k, list_sort(list(leaf)) AS c FROM l GROUP BY ALL), n AS (SELECT tree_id, c FROM g UNION ALL SELECT tree_id, [leaf] FROM l), s AS (SELECT tree_id, inner_, outer_, groups, bool_or(c = inner_ OR c = outer_) AS apart, max(len(list_intersect(c, outer_))) FILTER (len(c) > 1 AND list_has_all(c, inner_)) AS intruders, max(list_intersect(c, outer_)[1]) FILTER (len(c) > 1 AND list_has_all(c, inner_)) AS gone FROM t JOIN n USING (tree_id) GROUP BY ALL), st AS (SELECT *, CASE WHEN inner_ IS NULL THEN 'no_non_outgroup_gene' WHEN len(outer_) = 0 THEN 'all_non_outgroup_no_outgroup' WHEN apart THEN 'success' WHEN len(outer_) >= 3 AND intruders = 1 THEN 'success_after_drop_one_outgroup' ELSE 'non_outgroup_not_monophyletic' END AS status FROM s)"


@query(f"WITH {_OUTGROUP} SELECT tree_id, status, CASE WHEN status LIKE '%drop%' THEN gone END AS dropped FROM st")
def outgroup_statuses(spark, sf_dir):
    """How each tree can be rooted by the outgroup species."""
    corpus = tree_corpus(spark, sf_dir, *_GENES)
    return trees.outgroup_statuses(trees.nodes(corpus), ["o"], corpus).select("tree_id", "status", "dropped")


@query(f"WITH {_OUTGROUP}, e AS (SELECT tree_id, leaf AS gene, len FROM l UNION ALL SELECT tree_id, NULL, 1 + k FROM g JOIN t USING (tree_id) WHERE groups > 1) SELECT tree_id, status, round(sum(len), 6) AS total FROM e JOIN st USING (tree_id) WHERE status LIKE 'success%' AND NOT (status LIKE '%drop%' AND coalesce(gene = gone, false)) GROUP BY ALL")
def rerooted_by_outgroup(spark, sf_dir):
    """Trees rooted by the outgroup species, with the length of all their branches."""
    nodes = tree_nodes(spark, sf_dir, *_GENES)
    statuses = trees.outgroup_statuses(nodes, ["o"])
    rows = trees.rooted_nodes_by_outgroup(nodes, statuses).groupBy("tree_id").agg(F.round(F.sum("branch_len"), 6).alias("total"))
    return statuses.select("tree_id", "status").join(rows, "tree_id")


#: order priorities as species, order states as their genes
_STEPS = ("WHERE l_quantity > 47", 3, "concat('p', substr(o_orderpriority, 1, 1), '++', o_orderstatus)")
_ORDERED = f"l AS (SELECT * FROM {tree_classes(*_STEPS)}), t AS (SELECT tree_id, list(leaf) AS a, list(leaf) FILTER (substr(leaf, 2, 1) >= '3') AS inner_, coalesce(list_sort(list(leaf) FILTER (leaf LIKE 'p1%')), list_sort(list(leaf) FILTER (leaf LIKE 'p2%')), []) AS genes FROM l GROUP BY 1), n AS (SELECT tree_id, list_sort(list(leaf)) AS c FROM l GROUP BY tree_id, k UNION ALL SELECT tree_id, [leaf] FROM l), sides AS (SELECT *, c AS s FROM n JOIN t USING (tree_id) UNION ALL SELECT *, list_filter(a, lambda x: NOT list_contains(c, x)) FROM n JOIN t USING (tree_id)), apart AS (SELECT tree_id, bool_or(list_sort(s) = genes) AS apart FROM sides GROUP BY 1), size_ AS (SELECT tree_id, gene, min(len(s)) AS size FROM (SELECT tree_id, s, unnest(list_filter(genes, lambda x: NOT list_contains(s, x))) AS gene FROM sides WHERE inner_ IS NOT NULL AND list_has_all(s, inner_)) GROUP BY ALL), best AS (SELECT size_.tree_id, arg_min(gene, (size, k, gene)) AS best FROM size_ JOIN l ON l.tree_id = size_.tree_id AND l.leaf = gene GROUP BY 1), st AS (SELECT tree_id, CASE WHEN inner_ IS NULL THEN 'no_ingroup_gene' WHEN len(genes) = 0 THEN 'no_valid_root_found' ELSE 'success' END AS status, CASE WHEN len(genes) = 1 OR apart THEN array_to_string(genes, ',') ELSE best END AS out FROM t JOIN apart USING (tree_id) LEFT JOIN best USING (tree_id))"


@query(f"WITH {_ORDERED} SELECT tree_id, status, CASE WHEN status = 'success' THEN out END AS rooted_on FROM st")
def order_statuses(spark, sf_dir):
    """How each tree can be rooted by two nested outgroup species."""
    corpus = tree_corpus(spark, sf_dir, *_STEPS)
    rows = trees.order_statuses(trees.nodes(corpus), [["p1"], ["p2"], ["p3", "p4", "p5"]], corpus)
    return rows.select("tree_id", "status", F.array_join("out", ",").alias("rooted_on"))
