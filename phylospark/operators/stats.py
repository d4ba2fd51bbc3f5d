"""Age distributions, histograms, mixtures and convergence reports: ``ages(sample, age)``."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .clusters import stored
from .places import carried, in_ranges

LOW, HIGH, BINS = 5.0, 80.0, 48


def in_range(ages: DataFrame, low: float = LOW, high: float = HIGH, least: int = 5) -> DataFrame:
    """ages within [low, high] of samples with ``least`` or more of them."""
    inside = ages.where(F.col("age").between(low, high))
    counts = inside.groupBy("sample").agg(F.count("*").alias("__n")).where(F.col("__n") >= least)
    return inside.join(counts.select("sample"), "sample", "left_semi")


def bin_of(age: Column | str, low: float = LOW, high: float = HIGH, bins: int = BINS) -> Column:
    """Number (from 1) of an equal bin; the last bin is closed."""
    age = F.col(age) if isinstance(age, str) else age
    return F.least(F.width_bucket(age, F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins).cast("long"))


def histogram(ages: DataFrame, key: str = "sample", low: float = LOW, high: float = HIGH, bins: int = BINS) -> DataFrame:
    """``bin``, ``n``, ``share`` and ``density`` (share over width) of each key's occupied bins."""
    counts = ages.where(F.col("age").between(low, high)).groupBy(key, bin_of("age", low, high, bins).alias("bin")).agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(W.partitionBy(key))
    return counts.withColumn("share", share).withColumn("density", share / ((high - low) / bins))


def peaks(hist: DataFrame, key: str = "sample", low: float = LOW, high: float = HIGH, bins: int = BINS) -> DataFrame:
    """Count and centre of the first fullest bin."""
    width = (high - low) / bins
    best = hist.groupBy(key).agg(F.sum("n").alias("count"), F.max_by("bin", F.struct("n", -F.col("bin"))).alias("bin"))
    return best.select(key, "count", F.round(low + (F.col("bin") - 0.5) * width, 4).alias("peak"))


def dense(hist: DataFrame, key: str = "sample", value: str = "share", bins: int = BINS) -> DataFrame:
    """Every bin of every key, empty ones 0."""
    grid = hist.select(key).distinct().withColumn("bin", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(bins).cast("long"))))
    return grid.join(hist.select(key, "bin", value), [key, "bin"], "left").na.fill(0, [value])


def smoothed(rows: DataFrame, key: str = "sample", value: str = "share") -> DataFrame:
    """Kernel 1, 2, 3, 2, 1 over 9, zeros beyond the ends."""
    w = W.partitionBy(key).orderBy("bin")
    part = lambda k: F.coalesce(F.lag(value, k).over(w), F.lit(0.0))
    return rows.withColumn("smooth", (part(2) + 2 * part(1) + 3 * F.col(value) + 2 * F.coalesce(F.lead(value, 1).over(w), F.lit(0.0)) + F.coalesce(F.lead(value, 2).over(w), F.lit(0.0))) / 9)


def contrast(rows: DataFrame, key: str = "sample", value: str = "smooth", low: float = 0.35, high: float = 0.95, floor: float = 0.1, power: float = 1.8) -> DataFrame:
    """Row contrast between two percentiles, a floor, and a power."""
    limits = rows.groupBy(key).agg(F.percentile(value, low).alias("__lo"), F.percentile(value, high).alias("__hi"))
    clip = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    scaled = clip(F.coalesce(F.try_divide(F.col(value) - F.col("__lo"), F.col("__hi") - F.col("__lo")), F.lit(0.0)))
    return rows.join(limits, key).withColumn("contrast", F.pow(clip((scaled - floor) / (1 - floor)), F.lit(power))).drop("__lo", "__hi")


def with_clades(rows: DataFrame, groups: DataFrame, default: str = "Other") -> DataFrame:
    """Clade of each sample."""
    return rows.join(groups.select("sample", "clade"), "sample", "left").na.fill(default, ["clade"])


def check_leaves(leaves: DataFrame, ages: DataFrame) -> DataFrame:
    """leaves(sample, place) in tree order; leaves without ages are an error."""
    counts = ages.groupBy("sample").agg(F.count("*").alias("n"))
    joined = leaves.join(counts, "sample", "left")
    checked = F.when(F.col("n").isNotNull(), F.col("n")).otherwise(F.raise_error(F.concat(F.lit("no ages for "), F.col("sample"))).cast("long"))
    return joined.withColumn("n", checked).orderBy("place")


#: share of the log-likelihood under which a gain ends the rounds of EM
_GAIN = 1e-9


def _starts(k: int) -> list[float]:
    """Shares of a sample's order at which k components begin."""
    return [(j + 0.5) / k for j in range(k)]


def _fit(x: np.ndarray, w: np.ndarray, k: int, rounds: int) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood, weights, means, variances of a 1-D mixture by EM; ``x`` ascends, ``w`` are counts."""
    n, upto = w.sum(), np.cumsum(w)
    centre = (w * x).sum() / n
    d = x - centre
    spread = (w * d * d).sum() / n
    floor = 1e-6 + 1e-6 * spread
    mean = d[[int(np.searchsorted(upto, math.floor((n - 1) * p), "right")) for p in _starts(k)]]
    var, weight, before = np.full(k, spread + floor), np.full(k, 1 / k), -math.inf
    for _ in range(rounds):
        p = np.log(weight) - 0.5 * (np.log(2 * np.pi * var) + (d[:, None] - mean) ** 2 / var)
        top = p.max(1, keepdims=True)
        each = top[:, 0] + np.log(np.exp(p - top).sum(1))
        total = float((w * each).sum())
        if total - before < _GAIN * abs(total) + 1e-12:
            break
        before, r = total, w[:, None] * np.exp(p - each[:, None])
        own = r.sum(0) + 1e-12
        weight, mean = own / own.sum(), (r * d[:, None]).sum(0) / own
        var = np.maximum((r * d[:, None] ** 2).sum(0) / own - mean**2, 0.0) + floor
    return total, weight, mean + centre, var


def _log_parts(parts: str) -> Column:
    """Log densities of the components ``parts`` (structs weight, mean, var) at ``d``."""
    return F.transform(parts, lambda c: F.log(c["weight"]) - 0.5 * (F.log(2 * math.pi * c["var"]) + (F.col("d") - c["mean"]) * (F.col("d") - c["mean"]) / c["var"]))


def _fit_by_sums(values: DataFrame, key: str, most: int, rounds: int) -> DataFrame:
    """The same fits for samples of any size: the state is one row for each sample and number of components, and a round is
    one grouped sum of each component's responsibilities, by partial aggregates."""
    totals = values.groupBy(key).agg(F.sum("w").alias("n"), (F.sum(F.col("w") * F.col("age")) / F.sum("w")).alias("centre"), F.count("*").alias("kinds"))
    totals = stored(totals, "mixtures")
    rows = in_ranges(values.join(totals, key).withColumn("d", F.col("age") - F.col("centre")), [key, "age"])
    spreads = rows.groupBy(key).agg((F.sum(F.col("w") * F.col("d") * F.col("d")) / F.first("n")).alias("spread"))
    placed = carried(rows, [key], ["age"], sums={"upto": F.col("w")})
    fits = F.explode(F.sequence(F.lit(1), F.least(F.lit(most).cast("long"), F.col("kinds")).cast("int"))).alias("k")
    wanted = placed.select(key, "n", "w", "upto", "d", fits).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rank = F.floor((F.col("n") - 1) * ((F.col("j") + 0.5) / F.col("k")))
    first = wanted.where((rank < F.col("upto")) & (rank >= F.col("upto") - F.col("w"))).join(spreads, key)
    floor = 1e-6 + 1e-6 * F.col("spread")
    part = F.struct("j", (1.0 / F.col("k")).alias("weight"), F.col("d").alias("mean"), (F.col("spread") + floor).alias("var"))
    lost = F.lit(float("-inf"))
    state = stored(first.groupBy(key, "k").agg(F.array_sort(F.collect_list(part)).alias("parts"), F.first(floor).alias("floor"), lost.alias("ll"), F.lit(False).alias("done")), "mixtures")
    slim = rows.select(key, "d", "w")
    for _ in range(rounds):
        open_ = state.where("not done").select(key, "k", "parts")
        p = slim.join(open_, key).withColumn("p", _log_parts("parts")).withColumn("top", F.array_max("p"))
        p = p.withColumn("each", F.col("top") + F.log(F.aggregate("p", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))))
        r = [F.col("w") * F.exp(F.get("p", F.lit(j)) - F.col("each")) for j in range(most)]
        sums = [F.struct(F.sum(x).alias("s0"), F.sum(x * F.col("d")).alias("s1"), F.sum(x * F.col("d") * F.col("d")).alias("s2")) for x in r]
        found = stored(p.groupBy(key, "k").agg(F.sum(F.col("w") * F.col("each")).alias("now"), F.array(*sums).alias("sums")), "mixtures")
        ended = F.col("now") - F.col("ll") < _GAIN * F.abs("now") + 1e-12
        own = lambda s: s["s0"] + 1e-12
        kept = F.slice("sums", F.lit(1), F.col("k"))
        whole = F.aggregate(kept, F.lit(0.0), lambda a, s: a + own(s))
        moved = F.transform(kept, lambda s, j: F.struct(j.alias("j"), (own(s) / whole).alias("weight"), (s["s1"] / own(s)).alias("mean"), (F.greatest(s["s2"] / own(s) - (s["s1"] / own(s)) * (s["s1"] / own(s)), F.lit(0.0)) + F.col("floor")).alias("var")))
        both = state.join(found, [key, "k"], "left")
        state = stored(both.select(key, "k", F.when(F.col("done") | ended, F.col("parts")).otherwise(moved).alias("parts"), "floor", F.when(F.col("done"), F.col("ll")).otherwise(F.col("now")).alias("ll"), (F.col("done") | ended).alias("done")), "mixtures")
        if not state.where("not done").limit(1).count():
            break
    bic = -2 * F.col("ll") + (3 * F.col("k") - 1) * F.log("n")
    best = state.join(totals, key).withColumn("bic", bic).groupBy(key).agg(F.min_by(F.struct("n", "k", "bic", "centre", "parts"), F.struct(F.round("bic", 6), "k")).alias("b")).select(key, "b.*")
    parts = F.array_sort(F.transform("parts", lambda c: F.struct((c["mean"] + F.col("centre")).alias("mean"), c["weight"].alias("weight"), c["var"].alias("var"))))
    return best.withColumn("parts", parts).select(key, "n", "k", F.round("bic", 4).alias("bic"), F.col("parts.weight").alias("weights"), F.col("parts.mean").alias("means"), F.transform("parts", lambda c: F.sqrt(c["var"])).alias("sds"))


def mixtures(ages: DataFrame, key: str = "sample", most: int = 3, in_task: int = 1 << 16, rounds: int = 200) -> DataFrame:
    """Per sample, the 1-D Gaussian mixture of 1 to ``most`` components with the lowest BIC.

    BIC = -2 LL + (3k - 1) ln n.  EM starts at order statistics of the sample and ends when the log-likelihood
    hardly grows, or after ``rounds``.  Equal ages are one value with a weight.  Samples of up to ``in_task`` different ages are fitted in
    one task, larger ones by rounds of grouped sums over all tasks (:func:`_fit_by_sums`), with the same steps.
    """
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("age")
        x, w = rows["age"].to_numpy(float), rows["w"].to_numpy(float)
        n, fits = w.sum(), []
        for k in range(1, min(most, len(x)) + 1):
            ll, weight, mean, var = _fit(x, w, k, rounds)
            fits.append((-2 * ll + (3 * k - 1) * math.log(n), k, weight, mean, var))
        bic, k, weight, mean, var = min(fits, key=lambda f: (round(f[0], 6), f[1]))
        order = np.argsort(mean, kind="stable")
        return pd.DataFrame({key: [rows[key].iloc[0]], "n": [int(n)], "k": [k], "bic": [round(bic, 4)], "weights": [weight[order].tolist()], "means": [mean[order].tolist()], "sds": [np.sqrt(var[order]).tolist()]})

    kind = dict(ages.dtypes)[key]
    values = ages.where(F.col("age").isNotNull() & F.col(key).isNotNull()).groupBy(key, F.col("age").cast("double").alias("age")).agg(F.count("*").alias("w"))
    sizes = stored(values.groupBy(key).agg(F.count("*").alias("__d")), "mixture-sizes")
    small = values.join(sizes.where(F.col("__d") <= in_task).select(key), key)
    fits = small.groupBy(key).applyInPandas(fit, f"`{key}` {kind}, n long, k int, bic double, weights array<double>, means array<double>, sds array<double>")
    large = sizes.where(F.col("__d") > in_task).select(key)
    return fits.unionByName(_fit_by_sums(values.join(large, key), key, most, rounds)) if large.limit(1).count() else fits


def distribution(values: DataFrame, key: str, value: str) -> DataFrame:
    """The five numbers of a violin or box for each key."""
    q = [F.percentile(value, p).alias(name) for p, name in ((0.0, "least"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1.0, "most"))]
    return values.groupBy(key).agg(F.count(value).alias("n"), *q)


def n50(sequences: DataFrame, key: str = "source") -> DataFrame:
    """Records, bases, longest and N50 of each source.

    Records are counted by length first, so that the running sum sees one row for each length.
    """
    lengths = sequences.groupBy(key, F.length("seq").cast("long").alias("len")).agg(F.count("*").alias("c"))
    w = W.partitionBy(key)
    rows = lengths.withColumn("__run", F.sum(F.col("len") * F.col("c")).over(w.orderBy(F.col("len").desc()))).withColumn("__all", F.sum(F.col("len") * F.col("c")).over(w))
    return rows.groupBy(key).agg(F.sum("c").alias("records"), F.first("__all").alias("bases"), F.max("len").alias("longest"), F.max(F.when(2 * F.col("__run") >= F.col("__all"), F.col("len"))).alias("n50"))


def status_counts(rows: DataFrame, status: str = "status") -> DataFrame:
    """A29."""
    return rows.groupBy(status).agg(F.count("*").alias("n"))


def best_smoothing(reports: DataFrame) -> DataFrame:
    """``reports(run, ord, smooth, chisq)``: smoothing of the least chi-square, first of equals."""
    return reports.groupBy("run").agg(F.min_by("smooth", F.struct("chisq", "ord")).alias("smooth"))


def convergence(ess: DataFrame) -> DataFrame:
    """``ess(run, min_ess, psrf)``: least effective size and largest scale-reduction factor."""
    return ess.groupBy("run").agg(F.min("min_ess").alias("min_ess"), F.max("psrf").alias("max_psrf"))
