"""Ortholog groups: ``ortho(group_id, alg_conn, species, gene_id)``; absent species have no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ratio
from .places import with_place


def unpivot_groups(wide: DataFrame, fixed: list[str], group_order: str | None = None) -> DataFrame:
    """Wide table (three leading columns, then one per species) as rows (S6): ``*`` is absent, ``,`` separates copies.

    ``group_order`` names a column that numbers the groups; without it they are numbered by content.
    """
    species = [c for c in wide.columns if c not in fixed and c != group_order]
    key = F.col(group_order) if group_order else F.xxhash64(*[F.col(f"`{c}`") for c in wide.columns])
    long = wide.withColumn("group_id", key).unpivot(["group_id", *[f"`{c}`" for c in fixed]], [f"`{c}`" for c in species], "species", "__genes")
    return long.where("__genes <> '*'").withColumn("gene_id", F.explode(F.split("__genes", ","))).drop("__genes")


def keep_groups(ortho: DataFrame, n_species: int | DataFrame, absent: float = 0.3, connectivity: float = 0.1, copies: int = 2) -> DataFrame:
    """ids of groups that lack at most ``absent`` of the species, are connected enough, and have no
    species with over ``copies`` copies.  Decided on counts, before any sequence is joined."""
    per = ortho.groupBy("group_id", "species").agg(F.count("*").alias("n"), F.first("alg_conn").alias("conn"))
    if isinstance(n_species, DataFrame):
        per = per.crossJoin(F.broadcast(n_species.toDF("n_species")))  # one row
    else:
        per = per.withColumn("n_species", F.lit(n_species))
    groups = per.groupBy("group_id").agg(F.count("*").alias("present"), F.max("n").alias("most"), F.max("conn").alias("conn"), F.max("n_species").alias("n_species"))
    gone = ratio(F.col("n_species") - F.col("present"), "n_species")
    return groups.where((gone <= absent) & (F.col("conn") >= connectivity) & (F.col("most") <= copies)).select("group_id", "present", "most")


def family_filter(groups: DataFrame, species: str, genes: str, least: int = 4, skip_single: bool = False) -> DataFrame:
    """families with ``least`` or more in ``species``; optionally those with one gene each go."""
    kept = groups.where(F.col(species) >= least)
    return kept.where(F.col(species) != F.col(genes)) if skip_single else kept


def longest_copy(ortho: DataFrame, lengths: DataFrame) -> DataFrame:
    """One gene for each group and species, the longest coding one (absent: 0), the first of equals.

    ``ortho`` has ``ord`` for the order of copies; ``lengths`` has species, gene_id, length.
    """
    sized = ortho.join(lengths, ["species", "gene_id"], "left").withColumn("length", F.coalesce("length", F.lit(0)))
    pick = sized.groupBy("group_id", "species").agg(F.max_by(F.struct("gene_id", "length"), F.struct("length", -F.col("ord"))).alias("g"))
    return pick.select("group_id", "species", "g.gene_id", "g.length")


def presence_absence(ortho: DataFrame, groups: list | None = None) -> DataFrame:
    """Species by group, 1 or 0.  Naming the groups spares the pass that finds them."""
    pivot = ortho.groupBy("species").pivot("group_id", groups) if groups else ortho.groupBy("species").pivot("group_id")
    return pivot.agg(F.max(F.lit(1))).na.fill(0)


def listed_first(rows: DataFrame, listed: DataFrame, key: str = "species") -> DataFrame:
    """Order of a matrix: listed species by their place, then the others by name.  Spark chooses the join by size."""
    joined = rows.join(listed.withColumnRenamed("place", "__place"), key, "left")
    return joined.orderBy(F.col("__place").asc_nulls_last(), key).drop("__place")


def genes_per_species(ortho: DataFrame) -> DataFrame:
    """N2."""
    return ortho.groupBy("species").agg(F.count("*").alias("genes"), F.count_distinct("group_id").alias("groups"))


def group_types(ortho: DataFrame) -> DataFrame:
    """Single-copy, multi-copy or species-specific groups."""
    per = ortho.groupBy("group_id", "species").agg(F.count("*").alias("n")).groupBy("group_id").agg(F.count("*").alias("species"), F.max("n").alias("most"), F.sum("n").alias("genes"))
    kind = F.when(F.col("species") == 1, "specific").when(F.col("most") == 1, "single_copy").otherwise("multi_copy")
    return per.select("group_id", "species", "genes", kind.alias("kind"))


def attach_sequences(genes: DataFrame, sequences: DataFrame, strict: bool = False) -> DataFrame:
    """(species, gene) to sequence; a miss drops the row, or raises when ``strict``."""
    keyed = sequences.select("species", "gene_id", "seq")
    if not strict:
        return genes.join(keyed, ["species", "gene_id"])
    joined = genes.join(keyed, ["species", "gene_id"], "left")
    checked = F.when(F.col("seq").isNotNull(), F.col("seq")).otherwise(F.raise_error(F.concat(F.lit("no sequence for "), F.col("gene_id"))).cast("string"))
    return joined.withColumn("seq", checked)


def pair_partners(proteins: DataFrame, codings: DataFrame, strict: bool = True) -> DataFrame:
    """Protein and coding files of one family, by the name before ``.pep`` or ``.cds`` (``file`` each).

    A protein file without partner raises when ``strict`` (gene families), else has a ``message``
    (annotation) and no ``cds``.
    """
    stem = F.regexp_replace("file", r"\.(pep|cds)$", "")
    pep, cds = proteins.select(stem.alias("family"), F.col("file").alias("pep")), codings.select(stem.alias("family"), F.col("file").alias("cds"))
    joined, missing = pep.join(cds, "family", "left"), F.concat(F.lit("no coding file for "), F.col("pep"))
    if strict:
        return joined.withColumn("cds", F.when(F.col("cds").isNotNull(), F.col("cds")).otherwise(F.raise_error(missing).cast("string")))
    return joined.withColumn("message", F.when(F.col("cds").isNull(), missing))


def numbered(groups: DataFrame, order: str, prefix: str = "ortho", start: int = 0) -> DataFrame:
    """Running names by a given order (``order`` has no ties)."""
    return with_place(groups, order).withColumn("name", F.concat(F.lit(prefix), (F.col("__place") - 1 + start).cast("string"))).drop("__place")


def positional_pairs(files: DataFrame, lines: DataFrame, file_order: str, line_order: str) -> DataFrame:
    """I-th file with i-th line."""
    a = with_place(files, file_order).withColumnRenamed("__place", "i")
    b = with_place(lines, line_order).withColumnRenamed("__place", "i")
    return a.join(b, "i")


def rename(rows: DataFrame, names: DataFrame, key: str, old: str = "current_sample_name", new: str = "standard_latin_name") -> DataFrame:
    """Mapped names; unmatched ones stay.  The map is small by nature; Spark chooses to broadcast it by its size."""
    pairs = names.select(F.col(old).alias("__old"), F.col(new).alias("__new"))
    return rows.join(pairs, rows[key] == pairs["__old"], "left").withColumn(key, F.coalesce("__new", key)).drop("__old", "__new")


def reciprocal_best(hits: DataFrame) -> DataFrame:
    """Pairs of genes that are each other's best hit between two species.

    ``hits`` has query_id, subject_id, query_species, subject_species, bitscore; ties go to the
    smaller subject.  Edges ``src``, ``dst`` for the grouping into components.
    """
    best = hits.where("query_species <> subject_species").groupBy("query_id", "subject_species").agg(F.min_by("subject_id", F.struct(-F.col("bitscore"), "subject_id")).alias("best"))
    back = best.select(F.col("query_id").alias("best"), F.col("best").alias("query_id"))
    return best.select("query_id", "best").intersect(back.select("query_id", "best")).where("query_id < best").select(F.col("query_id").alias("src"), F.col("best").alias("dst"))
