"""Operators over aligned loci: ``alignments(locus, ord, seq_id, seq)``.

Sites are counted as vectors within tasks (``counts``), so that what is shuffled is a few numbers for
each site and task, never a raw cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_all_missing, ratio, threshold_label
from .counts import base_counts, keep_marked, marked_sites, occupied_sites, resampled, take_sites
from .places import running_sum


def drop_missing_rows(alignments: DataFrame) -> DataFrame:
    """Rows of nothing but missing-base symbols go (F1)."""
    return alignments.where(~is_all_missing("seq"))


def pad(alignments: DataFrame, fill: str = "-") -> DataFrame:
    """Ragged rows filled up to the locus' longest."""
    longest = alignments.groupBy("locus").agg(F.max(F.length("seq")).alias("__n"))
    return alignments.join(longest, "locus").withColumn("seq", F.rpad("seq", F.col("__n"), fill)).drop("__n")


def site_occupancy(alignments: DataFrame) -> DataFrame:
    """``locus``, ``pos``, ``present``, ``missing_ratio`` of every site; absent tails count as missing (F2).

    The ratio is over the rows that F1 keeps; any base but ACGT (either case) is missing.
    """
    rows = drop_missing_rows(alignments)
    counts = rows.groupBy("locus").agg(F.count("*").alias("n"))
    sites = base_counts(rows).select("locus", "pos", (F.col("A") + F.col("C") + F.col("G") + F.col("T")).alias("present"))
    return sites.join(counts, "locus").select("locus", "pos", "present", (1 - ratio("present", "n")).alias("missing_ratio"), "n")


def filter_sites(alignments: DataFrame, threshold: float = 0.2, empty: str = "^(-*|\\?*)$") -> DataFrame:
    """Rows reduced to the kept sites; rows that match ``empty`` then go.

    A locus without kept site gives no rows.  Kept sites travel as bitmaps (an eighth of a byte for each
    site), made of counts by block; rows are rebuilt where they are.
    """
    if threshold <= 0:
        raise ValueError("threshold must be above 0")
    rows = drop_missing_rows(alignments)
    return keep_marked(rows, occupied_sites(rows, threshold)).where(~F.col("seq").rlike(empty))


def site_patterns(alignments: DataFrame) -> DataFrame:
    """Per site: number of bases, of different bases, and of bases that occur twice or more."""
    some = lambda least: sum((F.col(b) >= least).cast("long") for b in "ACGT")
    bases = F.col("A") + F.col("C") + F.col("G") + F.col("T")
    return base_counts(alignments).select("locus", "pos", bases.alias("bases"), some(1).alias("kinds"), some(2).alias("repeated")).where("bases > 0")


def site_statistics(alignments: DataFrame) -> DataFrame:
    """Per locus: constant, variable, singleton and parsimony-informative sites."""
    informative = F.col("repeated") >= 2
    return site_patterns(alignments).groupBy("locus").agg(
        F.count_if(F.col("kinds") == 1).alias("constant"),
        F.count_if(F.col("kinds") > 1).alias("variable"),
        F.count_if((F.col("kinds") > 1) & ~informative).alias("singleton"),
        F.count_if(informative).alias("informative"),
    )


def locus_metrics(alignments: DataFrame, supports: DataFrame | None = None) -> DataFrame:
    """``locus``, ``taxon_count``, ``seq_length`` (shortest row), ``informative_sites``,
    ``missing_ratio`` (1 - taxa / most taxa of any locus) and ``avg_support`` (A1-A4, J3).

    Sites beyond the shortest row do not count.  ``supports`` has ``locus`` and ``avg_support``.
    """
    rows = alignments.groupBy("locus").agg(F.count_distinct("seq_id").alias("taxon_count"), F.min(F.length("seq")).cast("long").alias("seq_length"))
    sites = site_patterns(alignments).join(rows.select("locus", "seq_length"), "locus").where("pos <= seq_length")
    informative = sites.groupBy("locus").agg(F.count_if(F.col("repeated") >= 2).alias("informative_sites"))
    most = rows.agg(F.max("taxon_count").alias("most"))  # one row
    out = rows.join(informative, "locus", "left").crossJoin(F.broadcast(most))
    out = out.withColumn("informative_sites", F.coalesce("informative_sites", F.lit(0))).withColumn("missing_ratio", 1 - ratio("taxon_count", "most")).drop("most")
    if supports is None:
        return out.withColumn("avg_support", F.lit(None).cast("double"))
    return out.join(supports, "locus", "left")


#: metric, threshold, "at most" or "at least"
THRESHOLDS = [("missing_ratio", 0.1, "max"), ("missing_ratio", 0.2, "max"), ("avg_support", 60.0, "min"), ("avg_support", 70.0, "min"), ("seq_length", 1000.0, "min"), ("seq_length", 1500.0, "min"), ("informative_sites", 500.0, "min"), ("informative_sites", 1000.0, "min")]


def threshold_report(metrics: DataFrame, thresholds: list[tuple[str, float, str]] = THRESHOLDS) -> DataFrame:
    """One row for each locus, metric and threshold with PASS or FAIL.

    An unknown support, and a support of 0, fail.
    """
    def status(metric: str, limit: float, kind: str) -> Column:
        value = F.col(metric).cast("double")
        passed = value <= limit if kind == "max" else F.when(value == 0, F.lit(-1.0)).otherwise(F.coalesce(value, F.lit(-1.0))) >= limit if metric == "avg_support" else value >= limit
        return F.struct(F.lit(metric).alias("metric"), threshold_label(F.lit(limit)).alias("threshold"), value.alias("value"), F.when(passed, "PASS").otherwise("FAIL").alias("status"))

    return metrics.select("locus", F.explode(F.array(*[status(*t) for t in thresholds])).alias("r")).select("locus", "r.*")


def filter_ambiguous_rows(alignments: DataFrame, threshold: float = 0.8, least: int = 4) -> DataFrame:
    """Rows with a share of ``?`` up to the threshold stay; loci need ``least`` of them.

    All loci come back, as ``status`` kept or removed with their count of survivors.
    """
    good = ratio(F.length("seq") - F.length(F.replace("seq", F.lit("?"), F.lit(""))), F.length("seq")) <= threshold
    counts = alignments.groupBy("locus").agg(F.count("*").alias("n_rows"), F.count_if(good).alias("n_kept"))
    return counts.withColumn("status", F.when(F.col("n_kept") >= least, "kept").otherwise("removed"))


def gap_statistics(alignments: DataFrame) -> DataFrame:
    """Per row: length, gaps, unknowns, gap share and the number of gap runs."""
    return alignments.select(
        "locus", "seq_id", F.length("seq").cast("long").alias("length"),
        F.regexp_count("seq", F.lit("-")).cast("long").alias("gaps"), F.regexp_count("seq", F.lit("[?Nn]")).cast("long").alias("unknown"),
        F.regexp_count("seq", F.lit("-+")).cast("long").alias("gap_runs"), F.round(ratio(F.regexp_count("seq", F.lit("-")), F.length("seq")), 6).alias("gap_share"),
    )


def select_sites(alignments: DataFrame, sites: DataFrame) -> DataFrame:
    """Rows reduced to the listed ``sites(locus, pos)``; loci without any give no rows."""
    return take_sites(alignments, sites.select("locus", "pos").distinct())


def select_records(alignments: DataFrame, names: DataFrame) -> DataFrame:
    """Rows whose ``seq_id`` is listed in ``names(seq_id)``."""
    return alignments.join(names.select("seq_id").distinct(), "seq_id", "left_semi")


def remove_taxa(alignments: DataFrame, removed: DataFrame) -> DataFrame:
    """Rows listed in ``removed(locus, seq_id)`` go."""
    return alignments.join(removed.select("locus", "seq_id").distinct(), ["locus", "seq_id"], "left_anti")


def site_blocks(alignments: DataFrame, size: int = 50_000) -> DataFrame:
    """Rows cut into blocks of ``size`` sites: ``locus``, ``block`` (from 0), ``first`` (site, from 1), ``ord``, ``seq_id``, ``seq``.

    A row has the blocks that it reaches, one at least.
    """
    n = F.greatest(F.lit(1), F.ceil(F.length("seq") / size)).cast("int")
    each = alignments.select("locus", "ord", "seq_id", "seq", F.explode(F.sequence(F.lit(0), n - 1)).alias("block"))
    first = F.col("block") * size + 1
    return each.select("locus", "block", first.alias("first"), "ord", "seq_id", F.substr("seq", first, F.lit(size)).alias("seq"))


def merged_blocks(blocks: DataFrame) -> DataFrame:
    """Rows made of their blocks again, in the order of numbers (not of names)."""
    parts = F.array_sort(F.collect_list(F.struct("block", "seq")))
    return blocks.groupBy("locus", "ord", "seq_id").agg(F.array_join(F.transform(parts, lambda p: p["seq"]), "").alias("seq"))


def filled_sites(rows: DataFrame, gap: str = "-") -> DataFrame:
    """Rows without the sites at which their locus has nothing but gaps; shorter rows are filled up with gaps.

    Each task marks its rows' sites in bitmaps; what is shuffled is one bitmap for each locus and task.
    """
    return keep_marked(rows, marked_sites(rows, gap), gap)


def prune_outliers(alignments: DataFrame, leaves: DataFrame, removed: DataFrame) -> DataFrame:
    """loci whose names equal their tree's leaves lose the listed rows and then all-gap sites."""
    names = alignments.groupBy("locus").agg(F.array_sort(F.collect_set("seq_id")).alias("a"))
    tips = leaves.groupBy("locus").agg(F.array_sort(F.collect_set("leaf")).alias("b"))
    same = names.join(tips, "locus").where("a = b").select("locus")
    rows = remove_taxa(alignments.join(same, "locus", "left_semi"), removed)
    return filled_sites(rows)


def supermatrix(alignments: DataFrame, fill: str = "?") -> DataFrame:
    """``seq_id``, ``seq``: loci joined in name order, absent loci filled to the first row's length.

    ``ord`` is the order of rows; ``first_seen`` numbers taxa by first locus, then row.
    """
    first = alignments.groupBy("locus").agg(F.min_by(F.length("seq"), "ord").alias("len"))
    taxa = alignments.groupBy("seq_id").agg(F.min(F.struct("locus", "ord")).alias("seen"))
    grid = taxa.crossJoin(first)  # every taxon needs every locus: the result's own size
    full = grid.join(alignments.select("locus", "seq_id", "seq"), ["locus", "seq_id"], "left")
    said = F.coalesce("seq", F.repeat(F.lit(fill), F.col("len")))
    rows = full.groupBy("seq_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("locus", said.alias("s")))), lambda x: x["s"]), "").alias("seq"), F.first("seen").alias("seen"))
    return rows.select("seq_id", "seq", F.col("seen.locus").alias("first_locus"), F.col("seen.ord").alias("first_ord"))


def intersection_matrix(alignments: DataFrame) -> DataFrame:
    """The same for taxa that every locus has, without fill."""
    n = alignments.agg(F.count_distinct("locus").alias("n"))  # one row
    common = alignments.groupBy("seq_id").agg(F.count_distinct("locus").alias("k")).crossJoin(F.broadcast(n)).where("k = n").select("seq_id")
    rows = alignments.join(common, "seq_id", "left_semi")
    return rows.groupBy("seq_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("locus", "seq"))), lambda x: x["seq"]), "").alias("seq"))


def partitions(lengths: DataFrame, order: str = "locus", length: str = "length") -> DataFrame:
    """Cumulative 1-based ``first`` and ``last`` of each locus (W13), in ``order`` (no ties)."""
    return running_sum(lengths, order, F.col(length), "last").select(*lengths.columns, (F.col("last") - F.col(length) + 1).alias("first"), "last")


def bootstrap(alignments: DataFrame, replicates: int = 1, seed: int = 1) -> DataFrame:
    """Column resamples with replacement (N7): all rows of a locus get the same sites of replicate r.

    Site k of a locus of n sites is drawn by integer arithmetic from k, r, the seed and the locus' md5
    (``counts.drawn_sites``); a row's end is filled with ``-``.
    """
    lengths = alignments.groupBy("locus").agg(F.max(F.length("seq")).alias("__n"))
    rows = alignments.join(lengths, "locus").withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    return resampled(rows, seed).select("locus", "replicate", "ord", "seq_id", "seq")


def nucleotide_diversity(alignments: DataFrame, window: int = 600, step: int = 200) -> DataFrame:
    """Mean pairwise difference in sliding windows of sites (N11): ``locus``, ``start``, ``pi``."""
    total = lambda f: sum(f(F.col(b)) for b in "ACGT")
    site = base_counts(alignments).select("locus", "pos", total(lambda x: x).alias("n"), total(lambda x: x * x).alias("sq")).where("n > 0")
    pi = site.withColumn("pi", ratio(F.col("n") * F.col("n") - F.col("sq"), F.col("n") * (F.col("n") - 1)))
    first = F.greatest(F.lit(0), F.ceil((F.col("pos") - window) / step))
    bins = pi.withColumn("w", F.explode(F.sequence(first.cast("int"), F.floor((F.col("pos") - 1) / step).cast("int"))))
    return bins.groupBy("locus", (F.col("w") * step + 1).alias("start")).agg((F.sum(F.coalesce("pi", F.lit(0.0))) / window).alias("pi"))
