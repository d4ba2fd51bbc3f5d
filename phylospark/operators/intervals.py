"""Interval tables: ``features(contig, start, end, ...)``, 1-based and closed.

Every join carries the contig or transcript as equi key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import reverse_complement
from .clusters import greedy_kept, stored
from .counts import translated
from .places import carried, in_ranges, with_place


def nonoverlapping(features: DataFrame, contig: str = "contig", start: str = "start", end: str = "end", order: str = "ord") -> DataFrame:
    """Features that start beyond every end seen before on the contig (dropped ones count as seen).

    ``order`` tells apart features of one place.  A contig is scanned range by range.
    """
    keys = [start, end, order]
    seen = carried(in_ranges(features, [contig, *keys]), [contig], keys, maxima={"__seen": F.col(end)}, own=False)
    return seen.where(F.col("__seen").isNull() | (F.col(start) > F.col("__seen"))).drop("__seen")


def not_eclipsed(features: DataFrame, contig: str = "contig", start: str = "start", end: str = "end") -> DataFrame:
    """Features that are not strictly inside another one of the contig.

    One pass in order of starts, range by range: a feature is inside if an end over its own was seen at a smaller start.
    """
    # at equal starts nothing is strictly inside: look at the largest end of strictly smaller starts
    firsts = features.groupBy(contig, start).agg(F.max(end).alias("__m"))
    seen = carried(in_ranges(firsts, [contig, start]), [contig], [start], maxima={"__before": F.col("__m")}, own=False).drop("__m")
    here = features[contig].eqNullSafe(seen[contig]) & features[start].eqNullSafe(seen[start])
    return features.join(seen, here).where(F.col("__before").isNull() | (F.col("__before") <= features[end])).select(*[features[c] for c in features.columns])


def greedy(features: DataFrame, key: str, better: list[Column], overlap: float | None = 0.1, start: str = "start", end: str = "end", id_: str = "id", bin_size: int = 10_000) -> DataFrame:
    """Per key, take features best first; reject one that overlaps a taken one too much.

    ``overlap`` is the largest share of either feature's length (None: any overlap rejects).
    ``better`` lists ascending sort columns without ties; ``id_`` names a feature within all keys.
    Overlapping pairs are joined by key and bin and decided in rounds, so that no key is gathered.
    """
    rank = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(better)])
    items = stored(features.select(key, F.col(id_).alias("id"), F.col(start).alias("s"), F.col(end).alias("e"), rank.alias("rank")), "features")

    def side(x: str) -> DataFrame:
        bins = F.sequence(F.floor(F.col("s") / bin_size), F.floor(F.col("e") / bin_size))
        return items.select(key, *[F.col(c).alias(f"{c}_{x}") for c in ("id", "s", "e", "rank")], F.explode(bins).alias("bin"))

    both = F.least("e_a", "e_b") - F.greatest("s_a", "s_b") + 1
    limit = F.lit(0) if overlap is None else overlap * F.least(F.col("e_a") - F.col("s_a") + 1, F.col("e_b") - F.col("s_b") + 1)
    met = side("a").join(side("b"), [key, "bin"]).where("rank_a < rank_b").where((both > 0) & (both > limit))
    against = met.select(F.struct(key, F.col("id_b").alias("id")).alias("later"), F.struct(key, F.col("id_a").alias("id")).alias("earlier"))
    kept = greedy_kept(items.select(F.struct(key, "id").alias("item")), against, "item").select("item.*")
    return items.join(kept, [key, "id"]).select(key, F.col("id").alias(id_), F.col("s").alias(start), F.col("e").alias(end))


def single_best(features: DataFrame, key: str, better: list[Column]) -> DataFrame:
    """The best row of each key."""
    return features.withColumn("__n", F.row_number().over(W.partitionBy(key).orderBy(*better))).where("__n = 1").drop("__n")


def first_of_same_segments(models: DataFrame, order: str = "ord") -> DataFrame:
    """models(model_id, contig, segments) with coordinates seen before go."""
    token = F.concat_ws(":", "contig", F.array_join(F.transform(F.array_sort("segments"), lambda s: F.concat_ws("-", s["start"], s["end"])), ","))
    return models.withColumn("token", token).withColumn("__n", F.row_number().over(W.partitionBy("token").orderBy(order))).where("__n = 1").drop("__n")


def exon_offsets(exons: DataFrame) -> DataFrame:
    """Transcript offsets of each exon block: ``exons(transcript, contig, strand, start, end)``."""
    forward = F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start"))
    upto = F.sum(F.col("end") - F.col("start") + 1).over(W.partitionBy("transcript").orderBy(forward).rowsBetween(W.unboundedPreceding, W.currentRow))
    return exons.withColumn("off_hi", upto).withColumn("off_lo", F.col("off_hi") - (F.col("end") - F.col("start")))


def lift(points: DataFrame, exons: DataFrame) -> DataFrame:
    """Transcript positions (1-based) to genome positions, both strands.

    ``points(transcript, pt, ...)``; positions beyond the blocks have no row.  The join is an equi
    join on the transcript with the range as residual.
    """
    blocks = exon_offsets(exons).select("transcript", "contig", "strand", "start", "end", "off_lo", "off_hi")
    inside = points.join(blocks, "transcript").where("pt between off_lo and off_hi")
    genome = F.when(F.col("strand") == "-", F.col("end") - (F.col("pt") - F.col("off_lo"))).otherwise(F.col("start") + F.col("pt") - F.col("off_lo"))
    return inside.withColumn("genome_pos", genome).drop("start", "end", "off_lo", "off_hi")


def overlaps(a: DataFrame, b: DataFrame, bin_size: int = 10_000) -> DataFrame:
    """Overlapping pairs of two feature tables (id_a, id_b, contig): equi join on contig and bin."""
    def binned(x: DataFrame, side: str) -> DataFrame:
        bins = F.sequence(F.floor(F.col("start") / bin_size), F.floor(F.col("end") / bin_size))
        return x.select("contig", F.col("id").alias(f"id_{side}"), F.col("start").alias(f"s_{side}"), F.col("end").alias(f"e_{side}"), F.explode(bins).alias("bin"))

    met = binned(a, "a").join(binned(b, "b"), ["contig", "bin"]).where("s_a <= e_b and s_b <= e_a")
    # a pair is reported in the bin where its overlap begins
    return met.where(F.floor(F.greatest("s_a", "s_b") / bin_size) == F.col("bin")).select("contig", "id_a", "id_b")


def by_type(features: DataFrame, kind: str, longest: int | None = 10_000) -> DataFrame:
    """F8: features of a type, up to a length."""
    out = features.where(F.col("type") == kind)
    return out if longest is None else out.where(F.col("end") - F.col("start") + 1 <= longest)


def by_ids(features: DataFrame, ids: DataFrame) -> DataFrame:
    """features of listed ids, with the list's ``place``."""
    return features.join(ids.groupBy("id").agg(F.min("place").alias("place")), "id")


def complete_ids(features: DataFrame) -> DataFrame:
    """ids of mRNA rows whose attributes say "complete"."""
    return features.where((F.col("type") == "mRNA") & F.col("attributes").contains("complete")).select(F.regexp_extract("attributes", "ID=([^;]+)", 1).alias("id"))


def spliced(features: DataFrame, contigs: DataFrame, kind: str = "CDS", protein: bool = False, code: int = 1) -> DataFrame:
    """Sequences of models(model_id, contig, strand, type, start, end), segments joined in order."""
    cut = features.where(F.col("type") == kind).join(contigs.select("contig", "seq"), "contig").select("model_id", "strand", "start", F.substr("seq", F.col("start"), F.col("end") - F.col("start") + 1).alias("part"))
    joined = cut.groupBy("model_id").agg(F.first("strand").alias("strand"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "part"))), lambda x: x["part"]), "").alias("seq"))
    seq = F.when(F.col("strand") == "-", reverse_complement("seq")).otherwise(F.col("seq"))
    return joined.select("model_id", (translated(seq, code) if protein else seq).alias("seq"))


def regions(samples: DataFrame, features: DataFrame, order: str = "ord") -> DataFrame:
    """Every region out of every one-record consensus, named gene_1.. by feature order.

    Positions times samples is the result's own size; the contig's name is not looked at.
    """
    named = with_place(features, order).select("start", "end", F.concat(F.lit("gene_"), F.col("__place").cast("string")).alias("gene"))
    return samples.crossJoin(named).select("sample", "gene", F.substr("seq", F.col("start"), F.col("end") - F.col("start") + 1).alias("seq"))


def protein_check(proteins: DataFrame) -> DataFrame:
    """proteins with internal stops: how many, and whether they lack a final stop or a start."""
    inner = F.regexp_count(F.regexp_replace("seq", r"\*$", ""), F.lit(r"\*"))
    return proteins.select("seq_id", inner.cast("long").alias("internal_stops"), (~F.col("seq").endswith("*")).alias("no_final_stop"), (~F.col("seq").startswith("M")).alias("no_start")).where("internal_stops > 0")
