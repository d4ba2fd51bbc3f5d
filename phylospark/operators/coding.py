"""Coding potential: framed k-mers, log-likelihoods, scores, ROC tables and start-codon motifs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import chars, ratio, translate_codons
from ..functions.sequence import GENETIC_CODES
from .clusters import stored
from .counts import base_totals, ending_kmer_counts, frame_scores, profiles, reading_frames, span_scores, window_counts, word_windows
from .places import carried, in_ranges

_STOP = "(TAA|TAG|TGA)$"


def base_composition(sequences: DataFrame, both_strands: bool = True) -> DataFrame:
    """Base, count, ratio (3 decimals); the second strand's counts are the complements'."""
    # all four of them, of no sequences too
    none = sequences.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, "ACGT"))).alias("base"), F.lit(0).cast("long").alias("n"))
    own = base_totals(sequences).union(none).groupBy("base").agg(F.sum("n").alias("n"))
    if both_strands:
        other = own.select(F.translate("base", "ACGT", "TGCA").alias("base"), "n")
        own = own.union(other).groupBy("base").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(W.partitionBy())  # four rows
    return own.select("base", "n", F.round(ratio("n", total), 3).alias("ratio"))


def other_bases(sequences: DataFrame, source: str = "source") -> DataFrame:
    """Bases, and those beyond ACGT, of each source, with a grand total (source NULL)."""
    other = F.regexp_count("seq", F.lit("[^ACGTacgt]"))
    return sequences.rollup(source).agg(F.sum(F.length("seq")).cast("long").alias("bases"), F.sum(other).cast("long").alias("other"))


def _without_stop(seq: Column) -> Column:
    return F.regexp_replace(F.upper(seq), _STOP, "")


def framed_kmers(cds: DataFrame, longest: int = 6) -> DataFrame:
    """``kmer``, ``frame`` (index of its last base mod 3), ``n``, for k = 1 .. ``longest``."""
    return ending_kmer_counts(cds.select(_without_stop(F.col("seq")).alias("seq")), longest)


def kmer_model(kmers: DataFrame, background: DataFrame) -> DataFrame:
    """A10: ln(((n + 1) / (prefix_n + 4)) / background of the last base).

    The prefix is counted in the frame before; of a single base it is that frame's total.
    ``background(base, ratio)`` has no zero.  K-mers with other letters are left out.
    """
    plain = kmers.where(F.col("kmer").rlike("^[ACGT]+$"))
    totals = plain.where(F.length("kmer") == 1).groupBy("frame").agg(F.sum("n").alias("n")).select(F.lit("").alias("kmer"), "frame", "n")
    prefixes = plain.select("kmer", "frame", "n").union(totals).select(F.col("kmer").alias("prefix"), F.col("frame").alias("prefix_frame"), F.col("n").alias("prefix_n"))
    keyed = plain.withColumn("prefix", F.substr("kmer", F.lit(1), F.length("kmer") - 1)).withColumn("prefix_frame", (F.col("frame") + 2) % 3)
    joined = keyed.join(prefixes, ["prefix", "prefix_frame"], "left").withColumn("base", F.right("kmer", F.lit(1))).join(F.broadcast(background.select("base", "ratio")), "base")  # four rows
    n = F.coalesce("prefix_n", F.lit(0))
    return joined.select("kmer", "frame", "n", n.alias("prefix_n"), F.ln((F.col("n") + 1) / (n + 4) / F.col("ratio")).alias("loglik"))


def coding_scores(cds: DataFrame, model: DataFrame, order: int = 5, id_: str = "orf_id") -> DataFrame:
    """Six frame scores of each ORF, sums of k-mer log-likelihoods (2 decimals).

    Base i is scored by the k-mer of up to ``order`` + 1 bases that ends there; unknown k-mers give 0.
    """
    rows = cds.select(id_, F.length("seq").cast("long").alias("seq_length"), _without_stop(F.col("seq")).alias("seq"))
    row = F.struct(id_, "seq_length").alias("__row")  # rows may share an id
    scored = frame_scores(rows.select(row, "seq"), model, order, "__row").select("__row.*", *[f"score_{k}" for k in range(1, 7)])
    zero = F.col("seq_length") < 6
    return scored.select(id_, F.lit(order).alias("markov_order"), "seq_length", *[F.when(zero, 0.0).otherwise(F.round(f"score_{k}", 2)).alias(f"score_{k}") for k in range(1, 7)])


def clip_outliers(model: DataFrame, value: str = "loglik", group: str = "frame") -> DataFrame:
    """Values clipped at the quartiles (order statistics at int((n - 1) * q)) -+ 1.5 IQR."""
    w = W.partitionBy(group)
    ranked = model.withColumn("__i", F.row_number().over(w.orderBy(value)) - 1).withColumn("__n", F.count("*").over(w))
    pick = lambda q: F.max(F.when(F.col("__i") == F.floor((F.col("__n") - 1) * q), F.col(value)))
    limits = ranked.groupBy(group).agg(pick(0.25).alias("q1"), pick(0.75).alias("q3"))
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    return model.join(F.broadcast(limits), group).withColumn(value, F.least(F.greatest(F.col(value), F.col("q1") - spread), F.col("q3") + spread)).drop("q1", "q3")


def accepted(scores: DataFrame, auto: int = 1000) -> DataFrame:
    """score_1 positive and over scores 2 and 3; or homology; or long enough."""
    good = (F.col("score_1") > 0) & (F.col("score_1") > F.greatest("score_2", "score_3"))
    return scores.where(good | (F.col("homology_count") > 0) | (F.col("seq_length") >= auto))


def orfs(transcripts: DataFrame, least: int = 100, code: int = 1) -> DataFrame:
    """P25: open reading frames of at least ``least`` amino acids on six frames.

    ``seq_id``, ``strand``, ``frame``, ``aa_start`` (0-based in the frame's translation), ``protein``
    and ``kind``: complete, 5prime_partial, 3prime_partial or internal.  Stretches between stops
    begin at their first M unless they open the frame.
    """
    return reading_frames(transcripts, least, GENETIC_CODES[code])


def likelihood_profile(seqs: DataFrame, model: DataFrame, order: int = 5, cap: int | None = None, id_: str = "seq_id") -> DataFrame:
    """``lik`` and ``running``: each sequence's log-likelihoods by position and their running sum, as arrays; at most
    ``cap`` uses of one k-mer and frame count."""
    return profiles(seqs.select(id_, F.upper("seq").alias("seq")), model, order, id_, cap)


def roc(scores: DataFrame, steps: int = 10) -> DataFrame:
    """Per category and threshold: tp, tn, fp, fn, tpr, fpr, f1 (``truth`` pos or neg; NULL scores ignored).

    Thresholds go from the least to the largest score of all, exclusive, in ``steps``.  Scores are
    counted by step first; thresholds are then running sums over at most ``steps`` rows a category.
    """
    known = scores.where("score is not null")
    limits = known.agg(F.min("score").alias("lo"), F.max("score").alias("hi"))  # one row
    wide = known.crossJoin(F.broadcast(limits))
    step = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("score") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / steps)), F.lit(steps))).otherwise(0)
    # a score at step s passes the thresholds 0 .. s; equality with a threshold is settled by comparing
    edge = lambda s: F.col("lo") + s * ((F.col("hi") - F.col("lo")) / steps)
    s = F.when(F.col("score") < edge(step), step - 1).when(F.col("score") >= edge(step + 1), step + 1).otherwise(step)
    counts = wide.withColumn("s", F.least(s, F.lit(steps - 1)).cast("int")).groupBy("category", "s").agg(F.count_if(F.col("truth") == "pos").alias("p"), F.count_if(F.col("truth") == "neg").alias("n"))
    grid = counts.select("category").distinct().withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
    full = grid.join(counts, ["category", "s"], "left").na.fill(0, ["p", "n"])
    above, all_ = W.partitionBy("category").orderBy(F.col("s").desc()), W.partitionBy("category")
    rows = full.withColumn("tp", F.sum("p").over(above)).withColumn("fp", F.sum("n").over(above)).withColumn("fn", F.sum("p").over(all_) - F.col("tp")).withColumn("tn", F.sum("n").over(all_) - F.col("fp"))
    out = rows.crossJoin(F.broadcast(limits)).withColumn("threshold", edge(F.col("s")))
    return out.select("category", F.col("s").alias("step"), "threshold", "tp", "tn", "fp", "fn", ratio("tp", F.col("tp") + F.col("fn")).alias("tpr"), ratio("fp", F.col("fp") + F.col("tn")).alias("fpr"), ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def auc(points: DataFrame) -> DataFrame:
    """Trapezoid area over (fpr, tpr) in order, with (0, 0) and (1, 1) added."""
    ends = points.select("category").distinct().withColumn("e", F.explode(F.array(F.lit(0.0), F.lit(1.0)))).select("category", F.col("e").alias("fpr"), F.col("e").alias("tpr"))
    w = W.partitionBy("category").orderBy("fpr", "tpr")
    rows = points.where("fpr is not null and tpr is not null").select("category", "fpr", "tpr").union(ends)
    area = (F.col("fpr") - F.lag("fpr").over(w)) * (F.col("tpr") + F.lag("tpr").over(w)) / 2
    return rows.withColumn("a", area).groupBy("category").agg(F.sum("a").alias("auc"))


def best_threshold(points: DataFrame, areas: DataFrame) -> DataFrame:
    """The category with the largest area (> 0), and there the threshold with the largest F1; first wins."""
    best = areas.where("auc > 0").agg(F.min_by("category", F.struct(-F.col("auc"), "category")).alias("category"))
    return points.join(F.broadcast(best), "category").groupBy("category").agg(F.min_by(F.struct("threshold", "f1"), F.struct(-F.col("f1"), "step")).alias("b")).select("category", "b.threshold", "b.f1")


def motif_windows(transcripts: DataFrame, starts: DataFrame | None = None, up: int = 20, down: int = 10) -> DataFrame:
    """Windows around true and decoy ATGs: ``starts(seq_id, pos)`` (1-based) are true, other ATGs decoys.

    Without ``starts``, the first ATG of each ``seq_id`` that has ``up`` bases before it is true, be it too near to the end
    for a window; the sequences are then read once.
    """
    seqs = transcripts.select("seq_id", F.upper("seq").alias("seq"))
    if starts is None:
        first = F.min("pos").over(W.partitionBy("seq_id"))  # one sequence's windows
        found = word_windows(seqs, "ATG", up, down, short=True).withColumn("t", F.col("seq_id").isNotNull() & (F.col("pos") == first)).where(F.length("window") == up + 3 + down)
    else:
        true = starts.select("seq_id", "pos").distinct().withColumn("t", F.lit(True))
        found = word_windows(seqs, "ATG", up, down).join(true, ["seq_id", "pos"], "left")
    return found.select("seq_id", "pos", F.when(F.col("t"), "pos").otherwise("neg").alias("label"), "window")


def weight_matrix(windows: DataFrame, pseudo: float = 1.0, by: list[str] | None = None) -> DataFrame:
    """``label``, ``pos`` (from 0), ``base``, ``n``, ``prob`` (for each value of the columns ``by``)."""
    keys = [*(by or []), "label"]
    each = F.explode(F.array(*[F.struct(F.lit(b).alias("base"), F.col(b).alias("n")) for b in "ACGT"]))
    total = F.col("A") + F.col("C") + F.col("G") + F.col("T")
    full = window_counts(windows, keys).select(*keys, "pos", total.alias("__total"), each.alias("b")).select(*keys, "pos", "b.base", "b.n", "__total")
    return full.withColumn("prob", (F.col("n") + pseudo) / (F.col("__total") + 4 * pseudo)).drop("__total")


def _log_odds(matrix: DataFrame, by: list[str]) -> DataFrame:
    prob = lambda label: F.ln(F.max(F.when(F.col("label") == label, F.col("prob"))))
    return matrix.groupBy(*by, F.col("pos").alias("at"), "base").agg((prob("pos") - prob("neg")).alias("odds"))


def motif_scores(windows: DataFrame, matrix: DataFrame, first: int = 0, last: int = 10_000, skip: tuple[int, int] = (20, 22)) -> DataFrame:
    """Log-odds of the windows over positions ``first`` .. ``last`` (without the ATG), per scored position."""
    cells = windows.select("seq_id", "pos", "label", F.posexplode(chars("window")).alias("at", "base")).where(F.col("at").between(first, last) & ~F.col("at").between(*skip))
    # four bases for each position of a window
    return cells.join(F.broadcast(_log_odds(matrix, [])), ["at", "base"], "left").groupBy("seq_id", "pos", "label").agg((F.sum(F.coalesce("odds", F.lit(0.0))) / F.count("*")).alias("score"))


def _drawn(*key: Column | str) -> Column:
    """A number from 0 to 9999 by the MD5 of some columns, which SQL can draw as well."""
    return F.conv(F.substr(F.md5(F.concat_ws(":", *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in key])), F.lit(1), F.lit(7)), 16, 10).cast("long") % 10_000


def cross_scored(windows: DataFrame, rounds: int = 5, share: float = 0.75, most: int | None = None, firsts: tuple[int, ...] = (0, 5, 10, 15), lasts: tuple[int, ...] = (27, 32), skip: tuple[int, int] = (20, 22)) -> DataFrame:
    """For each round, matrices of a hashed training share score all other windows (with ``most``, so many a label, the
    first by hash), over all ranges of positions around the start (``round``, ``first``, ``last``).

    All rounds are one job; windows are read once and stored with their numbers.  Windows that share ``seq_id``, ``pos`` and
    label have one score over all their places; only those are grouped.
    """
    numbers = F.array(*[_drawn("seq_id", "pos", F.lit(k)).cast("int") for k in range(1, rounds + 1)])
    alike = F.count("*").over(W.partitionBy("seq_id", "pos", "label"))
    dealt = stored(windows.select("seq_id", "pos", "label", "window", numbers.alias("__u"), alike.alias("__alike")), "dealt")
    dealt = dealt.select("seq_id", "pos", "label", "window", "__alike", F.posexplode("__u").alias("__k", "u")).withColumn("round", F.col("__k") + 1).drop("__k")
    found = _log_odds(weight_matrix(dealt.where(F.col("u") < share * 10_000), by=["round"]), ["round"]).where((F.col("at") <= max(lasts)) & F.col("odds").isNotNull())
    odds = np.zeros((rounds, max(lasts) + 1, 5))
    for r in found.collect():  # rounds x positions x four bases
        odds[r["round"] - 1, r["at"], "ACGT".index(r["base"])] = r["odds"]
    held = dealt.where(F.col("u") >= share * 10_000)
    if most is not None:
        held = _first_drawn(held, most)
    spans, keys = [(a, b) for a in firsts for b in lasts], ["round", "seq_id", "pos", "label"]
    ends = [F.array(*[F.lit(span[i]) for span in spans]).alias(x) for i, x in enumerate(("first", "last"))]

    def scores(some: DataFrame) -> DataFrame:
        rows = span_scores(some.select(*keys, "window"), odds, spans, skip)
        return rows.select(*keys, F.explode(F.arrays_zip(*ends, "score", "n")).alias("s")).select("round", "s.first", "s.last", "seq_id", "pos", "label", "s.score", "s.n")

    whole = F.try_divide(F.sum(F.col("score") * F.col("n")), F.sum("n")).alias("score")
    several = scores(held.where("__alike > 1")).groupBy("round", "first", "last", "seq_id", "pos", "label").agg(whole)
    return scores(held.where("__alike = 1")).drop("n").union(several)


def _first_drawn(held: DataFrame, most: int) -> DataFrame:
    """At most ``most`` windows a round and label, the first by number: they are counted by number, and only those of one
    number (a ten-thousandth of the windows) are ever ordered."""
    before = F.sum("__c").over(W.partitionBy("round", "label").orderBy("u").rowsBetween(W.unboundedPreceding, -1))  # at most 10,000 rows
    counts = held.groupBy("round", "label", "u").agg(F.count("*").alias("__c")).withColumn("__before", F.coalesce(before, F.lit(0)))
    first = counts.where(F.col("__before") < most).select(F.col("round").alias("__round"), F.col("label").alias("__label"), F.col("u").alias("__u"), "__before")
    # at most 10,000 rows for each round and label
    near = held.join(F.broadcast(first), (F.col("round") == F.col("__round")) & F.col("label").eqNullSafe(F.col("__label")) & (F.col("u") == F.col("__u")))
    own = F.row_number().over(W.partitionBy("round", "label", "u").orderBy("seq_id", "pos", "window"))
    return near.withColumn("__n", F.col("__before") + own).where(F.col("__n") <= most)


def best_share(rows: DataFrame, score: str, share: float) -> DataFrame:
    """Rows whose rank by ``score`` (largest first, equal ones share the first's) is within ``share`` of all rows' ranks.

    The score at that rank comes from running counts over different scores, range by range, so that no
    row is ever ordered with all others.
    """
    kinds = rows.where(F.col(score).isNotNull()).groupBy((-F.col(score)).alias("__s")).agg(F.count("*").alias("__c")).withColumn("__g", F.lit(0))
    ranked = carried(in_ranges(kinds, ["__g", "__s"]), ["__g"], ["__s"], sums={"__before": F.col("__c")}, own=False)
    total = kinds.agg(F.sum("__c").alias("__n"))  # one row
    limit = ranked.crossJoin(F.broadcast(total)).where(F.col("__before") <= share * (F.col("__n") - 1)).agg(F.max("__s").alias("__s"))  # one row
    return rows.crossJoin(F.broadcast(limit)).where(-F.col(score) <= F.col("__s")).drop("__s")


def purified(windows: DataFrame, rounds: int = 3, share: float = 0.3) -> DataFrame:
    """From a hashed ``share`` of the true windows, rounds of "score all, keep the best share, rebuild"; those of
    score <= 0 go.

    True windows that stay, with the ``score`` (9 decimals) that kept them, and all others (score NULL).
    """
    true, other = windows.where("label = 'pos'"), windows.where("label <> 'pos'")
    kept = true.where(_drawn("seq_id", "pos") < share * 10_000)
    for _ in range(rounds):
        matrix = weight_matrix(kept.select(*windows.columns).unionByName(other))
        scored = stored(motif_scores(true, matrix).select("seq_id", "pos", F.round("score", 9).alias("score")), "starts")
        good = best_share(scored, "score", share).where("score > 0")
        kept = stored(true.join(good, ["seq_id", "pos"]).select(*windows.columns, "score"), "starts")
    return kept.unionByName(other.withColumn("score", F.lit(None).cast("double")))


def refine_starts(orfs: DataFrame, scores: DataFrame, threshold: float, most: int = 30, share: float = 0.15) -> DataFrame:
    """In-frame ATG within max(30 nt, 15 % of the ORF) with the best score over the threshold.

    ``orfs(seq_id, start, end, kind)``, ``scores(seq_id, pos, score)``; a new start makes internal
    ORFs 3prime_partial and 5prime_partial ones complete.
    """
    reach = F.greatest(F.lit(most), F.floor((F.col("end") - F.col("start") + 1) * share))
    met = orfs.where(F.col("kind").isin("internal", "5prime_partial")).join(scores, "seq_id").where((F.col("pos") >= F.col("start")) & (F.col("pos") <= F.col("start") + reach) & ((F.col("pos") - F.col("start")) % 3 == 0) & (F.col("score") >= threshold))
    best = met.groupBy("seq_id", "start", "end").agg(F.max_by("pos", F.struct("score", -F.col("pos"))).alias("new_start"))
    kind = F.when(F.col("new_start").isNull(), F.col("kind")).when(F.col("kind") == "internal", "3prime_partial").otherwise("complete")
    return orfs.join(best, ["seq_id", "start", "end"], "left").select("seq_id", F.coalesce("new_start", "start").alias("start"), "end", kind.alias("kind"))


def codon_usage(cds: DataFrame, code: int = 1) -> DataFrame:
    """``codon``, ``amino_acid``, ``n`` and relative synonymous usage."""
    ending = ending_kmer_counts(cds.select(F.upper("seq").alias("seq")), 3)
    codons = ending.where(F.col("kmer").rlike("^[ACGT]{3}$") & (F.col("frame") == 2)).select(F.col("kmer").alias("codon"), "n")
    own = codons.withColumn("amino_acid", translate_codons("codon", code))
    w = W.partitionBy("amino_acid")
    return own.select("codon", "amino_acid", "n", F.round(F.col("n") * F.count("*").over(w) / F.sum("n").over(w), 6).alias("rscu"))


def repeats(sequences: DataFrame, least: dict[int, int] | None = None) -> DataFrame:
    """Simple sequence repeats: unit and copies, by unit length 1 to 6."""
    least = least or {1: 10, 2: 6, 3: 5, 4: 5, 5: 5, 6: 5}
    def of(k: int, n: int) -> Column:
        found = F.regexp_extract_all(F.upper("seq"), F.lit(f"(([ACGT]{{{k}}})\\2{{{n - 1},}})"), F.lit(1))
        return F.transform(found, lambda m: F.struct(F.lit(k).alias("unit_length"), F.substring(m, 1, k).alias("unit"), (F.length(m) / k).cast("int").alias("copies")))

    found = [of(k, n) for k, n in least.items()]
    one = sequences.select("seq_id", F.explode(F.concat(*found)).alias("r")).select("seq_id", "r.*")
    # "AA" as a unit of two is the unit of one
    return one.where((F.col("unit_length") == 1) | ~F.col("unit").rlike(r"^(.)\1+$"))
