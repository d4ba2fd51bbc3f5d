"""Triplet tables of tree corpora: topologies, branch lengths, mixture fits and summaries."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import coalescent_density
from .clusters import stored
from .places import carried, in_ranges


def triplet_branches(pairs: DataFrame, taxa: list[str] | None = None) -> DataFrame:
    """For each tree and triplet of taxa: the taxon that is out and the inner branch's length.

    ``pairs(tree_id, a, b, depth)`` (a < b) has the root distance of each pair's last common
    ancestor.  The pair with the deepest one is the cherry.  Triplets without one deepest pair have
    no row.  ``taxa`` restricts to some taxa (the outgroup is left out of it).
    """
    p = pairs if taxa is None else pairs.where(F.col("a").isin(taxa) & F.col("b").isin(taxa))
    whole = p.where("a is not null and b is not null and depth is not null").groupBy("tree_id").agg(F.collect_list("a").alias("a"), F.collect_list("b").alias("b"), F.collect_list("depth").alias("depth"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*rows)], names=["tree_id", "triplet", "outgroup", "branch"])

        for batch in batches:
            for tree_id, *columns in zip(*[batch.column(c) for c in ("tree_id", "a", "b", "depth")]):
                for x, y, z, out, branch in _cherries(*[c.values for c in columns]):
                    rows.append((pa.repeat(tree_id, len(out)), pc.binary_join_element_wise(x, y, z, "_"), out, branch))
                    size += len(out)
                    if size >= _TRIPLETS:
                        yield done()
                        rows, size = [], 0
        if rows:
            yield done()

    kind = p.schema["tree_id"].dataType.simpleString()
    return whole.mapInArrow(run, f"tree_id {kind}, triplet string, outgroup string, branch double")


#: triplets that are looked at at once
_TRIPLETS = 1 << 17


def _cherries(a: pa.Array, b: pa.Array, depth: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
    """The taxa x < y < z of one tree's triplets with one deepest pair, the one that is out, and the inner branch."""
    names = pa.array(sorted({*a.to_pylist(), *b.to_pylist()}), pa.string())
    n = len(names)
    # of pairs that are not there the depth is NaN, which is larger than nothing
    d = np.full((n, n), np.nan)
    d[pc.index_in(a, names).to_numpy(), pc.index_in(b, names).to_numpy()] = depth.to_numpy(zero_copy_only=False)
    for x, y, z in _threes(n):
        three = np.stack([d[x, y], d[x, z], d[y, z]])
        top, most = three.argmax(axis=0), three.max(axis=0)
        second = np.sort(three, axis=0)[1]
        good = np.flatnonzero(most - second > 0)
        if len(good):
            x, y, z, top = x[good], y[good], z[good], top[good]
            yield *[names.take(pa.array(i)) for i in (x, y, z, np.choose(top, [z, y, x]))], pa.array((most - second)[good])


def _threes(n: int) -> Iterator[tuple[np.ndarray, ...]]:
    """All x < y < z < n, in blocks."""
    if n * (n - 1) * (n - 2) // 6 <= _TRIPLETS:
        yield _all_threes(n)
        return
    for x in range(n - 2):
        height = max(1, _TRIPLETS // (n - x))
        for first in range(x + 1, n - 1, height):
            y, z = np.nonzero(np.arange(n)[None, :] > np.arange(first, min(n - 1, first + height))[:, None])
            yield np.full(len(y), x), y + first, z


@lru_cache(8)
def _all_threes(n: int) -> tuple[np.ndarray, ...]:
    return tuple(np.array(list(combinations(range(n), 3)), np.int64).reshape(-1, 3).T)


def taxa_of(triplet: Column | str, names: list[str]) -> Column:
    """``functions.triplet_parts`` for a fixed list of names: each different text of a batch is cut once."""
    known = set(names)

    def parts(text: str | None) -> list[str] | None:
        cuts = [k for k, c in enumerate(text or "") if c == "_"]
        ways = ((text[:i], text[i + 1 : j], text[j + 1 :]) for i, j in combinations(cuts, 2))
        return next((list(w) for w in ways if known.issuperset(w)), None)  # the shortest first name, then the shortest second one

    def run(texts: pa.Array) -> pa.Array:
        coded = texts.dictionary_encode()
        return pa.array([parts(t) for t in coded.dictionary.to_pylist()], pa.list_(pa.string())).take(coded.indices)

    return F.arrow_udf(run, "array<string>").asNondeterministic()(triplet)


def _log_second(u: np.ndarray, c: np.ndarray | float, far: np.ndarray) -> np.ndarray:
    """Log density of the second component, times the scale, at u = length / scale; ``far`` where u >= c."""
    with np.errstate(divide="ignore"):
        beyond = np.log1p(np.exp(-np.asarray(c, float))) + c - u - np.log(2)
        below = u - np.log(2) + np.log1p(-np.exp(-2 * u)) - c - np.log(-np.expm1(-np.asarray(c, float)))
    return np.where(far, beyond, below)


def _fit_group(x: np.ndarray, w: np.ndarray, rounds: int, floor: float) -> tuple[float, float, float, float]:
    """Log-likelihood, mixing share, scale and threshold of one group; ``x`` ascends, ``w`` are counts."""
    n = w.sum()
    mean = max(float((w * x).sum() / n), floor)
    pi, scale, c = 0.5, mean, 1.0
    best, last = (-np.inf, pi, scale, c), None
    for _ in range(rounds):
        u = x / scale
        odds = np.log(pi) + _log_second(u, c, u >= c) - np.log1p(-pi) + u
        resp = 1 / (1 + np.exp(-odds))
        pi = float(np.clip((w * resp).sum() / n, *_SHARE))
        weight = (w * (1 - resp)).sum()
        scale = max(floor, float((w * (1 - resp) * x).sum() / weight) if weight > 0.5 else scale)
        u, r = x / scale, w * resp
        # expected log density under each threshold: shorter lengths have one branch, the others another one
        with np.errstate(divide="ignore"):
            below = np.cumsum(r * (u - np.log(2) + np.log1p(-np.exp(-2 * u))))
        upto, first = np.cumsum(r), np.concatenate(([0.0], np.cumsum(r * u)))
        before = np.concatenate(([0.0], upto[:-1]))
        gain = np.concatenate(([0.0], below[:-1])) - before * (u + np.log(-np.expm1(-u))) - (first[-1] - first[:-1]) + (upto[-1] - before) * (np.log1p(np.exp(-u)) + u - np.log(2))
        gain[(u <= _THRESHOLDS[0]) | (u >= _THRESHOLDS[1])] = -np.inf
        if len(gain) and gain.max() > -np.inf:
            c = float(u[int(gain.argmax())])
        ll = float((w * (np.logaddexp(np.log1p(-pi) - u, np.log(pi) + _log_second(u, c, u >= c)) - np.log(scale))).sum())
        best = max(best, (ll, pi, scale, c))
        if (pi, scale, c) == last:
            break  # nothing moves any more
        last = (pi, scale, c)
    return best


#: bounds of the mixing share, and of thresholds in units of the scale
_SHARE, _THRESHOLDS = (1e-6, 1 - 1e-6), (1e-6, 700.0)
_KEY = ["triplet", "outgroup"]


def _second(u: Column, c: Column, far: Column) -> Column:
    """:func:`_log_second` as a column expression."""
    return F.when(far, F.log1p(F.exp(-c)) + c - u - math.log(2)).otherwise(u - math.log(2) + F.log1p(-F.exp(-2 * u)) - c - F.log(-F.expm1(-c)))


def _fit_by_ranges(lengths: DataFrame, rounds: int, floor: float) -> DataFrame:
    """The same fit for groups of any size: a round is two grouped sums, and one scan of the lengths by ranges."""
    rows = in_ranges(lengths, [*_KEY, "branch"])
    clip = lambda x: F.least(F.greatest(x, F.lit(_SHARE[0])), F.lit(_SHARE[1]))
    start = rows.groupBy(*_KEY).agg(F.sum("w").alias("n"), F.greatest(F.sum(F.col("w") * F.col("branch")) / F.sum("w"), F.lit(floor)).alias("scale"))
    state = stored(start.select(*_KEY, "n", F.col("scale").alias("mean"), F.lit(0.5).alias("pi"), "scale", F.lit(1.0).alias("c"), F.lit(float("-inf")).alias("ll"), F.struct(F.lit(float("-inf")).alias("ll"), F.lit(0.5).alias("pi"), F.col("scale"), F.lit(1.0).alias("c")).alias("best"), F.lit(True).alias("moves")), "mixtures")
    for _ in range(rounds):
        own = rows.join(state.where("moves").select(*_KEY, "n", "pi", "scale", "c"), _KEY)
        u = F.col("branch") / F.col("scale")
        odds = F.log("pi") + _second(u, F.col("c"), u >= F.col("c")) - F.log1p(-F.col("pi")) + u
        resp = own.withColumn("r", 1 / (1 + F.exp(-odds)))
        rest = F.col("w") * (1 - F.col("r"))
        weight = F.sum(rest)
        scale = F.when(weight > 0.5, F.greatest(F.sum(rest * F.col("branch")) / weight, F.lit(floor))).otherwise(F.greatest(F.first("scale"), F.lit(floor)))
        moved = stored(resp.groupBy(*_KEY).agg(clip(F.sum(F.col("w") * F.col("r")) / F.first("n")).alias("new_pi"), scale.alias("new_scale")), "mixtures")
        step = resp.join(moved, _KEY).withColumn("u", F.col("branch") / F.col("new_scale")).withColumn("wr", F.col("w") * F.col("r"))
        near = F.col("wr") * (F.col("u") - math.log(2) + F.log1p(-F.exp(-2 * F.col("u"))))
        scanned = carried(step.select("__part", *_KEY, "branch", "u", "wr"), _KEY, ["branch"], sums={"near": F.when(F.col("wr") > 0, near), "before": F.col("wr"), "first": F.col("wr") * F.col("u")}, own=False)
        whole = step.groupBy(*_KEY).agg(F.sum("wr").alias("all"), F.sum(F.col("wr") * F.col("u")).alias("far"))
        gain = F.col("near") - F.col("before") * (F.col("u") + F.log(-F.expm1(-F.col("u")))) - (F.col("far") - F.col("first")) + (F.col("all") - F.col("before")) * (F.log1p(F.exp(-F.col("u"))) + F.col("u") - math.log(2))
        some = scanned.join(whole, _KEY).where((F.col("u") > _THRESHOLDS[0]) & (F.col("u") < _THRESHOLDS[1]))
        chosen = some.groupBy(*_KEY).agg(F.max_by("u", F.struct(gain, -F.col("u"))).alias("new_c"))
        now = stored(state.join(moved, _KEY, "left").join(chosen, _KEY, "left").select(*_KEY, "n", "mean", F.coalesce("new_pi", "pi").alias("pi"), F.coalesce("new_scale", "scale").alias("scale"), F.coalesce("new_c", "c").alias("c"), "best", (F.col("moves") & ~((F.col("new_pi") == F.col("pi")) & (F.col("new_scale") == F.col("scale")) & (F.coalesce("new_c", "c") == F.col("c")))).alias("moves")), "mixtures")
        u = F.col("branch") / F.col("scale")
        a, b = F.log1p(-F.col("pi")) - u, F.log("pi") + _second(u, F.col("c"), u >= F.col("c"))
        mix = F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b))) - F.log("scale")
        fits = rows.join(now.select(*_KEY, "pi", "scale", "c"), _KEY).groupBy(*_KEY).agg(F.sum(F.col("w") * mix).alias("ll"))
        found = F.struct("ll", "pi", "scale", "c")
        state = stored(now.join(fits, _KEY).select(*_KEY, "n", "mean", "pi", "scale", "c", "ll", F.greatest("best", found).alias("best"), "moves"), "mixtures")
        if not state.where("moves").limit(1).count():
            break
    return state.select(*_KEY, "n", "mean", "best.*")


def fit_mixtures(branches: DataFrame, rounds: int = 50, floor: float = 0.0005, in_task: int = 1 << 16) -> DataFrame:
    """Per (triplet, outgroup) with two branches or more: a mixture of lineage-sorting and
    introgression branch lengths against one exponential, by BIC.

    The null has lambda = mean.  The mixture is fitted by EM, ``rounds`` times: responsibilities, the mixing share, the
    shared scale (of the first component, floored), and the threshold C with the highest expected log density, whose candidates
    are all of the rescaled data: with the lengths sorted, each candidate's value is made of sums up to it and from
    it on.  Equal lengths are one value with a weight.  Groups of up to ``in_task`` different lengths are fitted in one task,
    larger ones by ranges of lengths (:func:`_fit_by_ranges`), with the same steps.  Lengths are positive; others are left out.
    """
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("branch")
        x, w = rows["branch"].to_numpy(float), rows["w"].to_numpy(float)
        ll, pi, scale, c = _fit_group(x, w, rounds, floor)
        return pd.DataFrame({"triplet": [rows["triplet"].iloc[0]], "outgroup": [rows["outgroup"].iloc[0]], "n": [int(w.sum())], "mean": [max(float((w * x).sum() / w.sum()), floor)], "ll": [ll], "pi": [pi], "scale": [scale], "c": [c]})

    # equal lengths are counted before a group is gathered
    lengths = branches.where("branch > 0").groupBy(*_KEY, "branch").agg(F.count("*").alias("w"))
    sizes = stored(lengths.groupBy(*_KEY).agg(F.sum("w").alias("__n"), F.count("*").alias("__d")).where("__n >= 2"), "mixture-sizes")
    small = lengths.join(sizes.where(F.col("__d") <= in_task).select(*_KEY), _KEY)
    fits = small.groupBy(*_KEY).applyInPandas(fit, "triplet string, outgroup string, n long, mean double, ll double, pi double, scale double, c double")
    large = sizes.where(F.col("__d") > in_task).select(*_KEY)
    if large.limit(1).count():
        fits = fits.unionByName(_fit_by_ranges(lengths.join(large, _KEY), rounds, floor))
    null = -F.col("n") * (F.log("mean") + F.col("total") / F.col("n") / F.col("mean"))
    totals = branches.where("branch > 0").groupBy(*_KEY).agg(F.sum("branch").alias("total"))
    k = 2
    return fits.join(totals, _KEY).select(
        *_KEY, F.lit(0.0).alias("C1"), F.round("c", 6).alias("C2"), F.round(1 - F.col("pi"), 6).alias("mixprop1"), F.round("pi", 6).alias("mixprop2"),
        F.round("scale", 6).alias("lambda2Dist"), F.round("mean", 6).alias("lambda1Dist"), F.round(F.log("n") * (2 * k - 1) - 2 * F.col("ll"), 4).alias("BIC2Dist"), F.round(F.log("n") - 2 * null, 4).alias("BIC1Dist"), F.col("n").alias("count"),
    )


def tree_probabilities(branches: DataFrame, models: DataFrame) -> DataFrame:
    """Per tree, the probability that its branch comes from the second component."""
    joined = branches.join(models, ["triplet", "outgroup"])
    first = F.col("mixprop1") * coalescent_density("branch", "lambda2Dist", "C1")
    second = F.col("mixprop2") * coalescent_density("branch", "lambda2Dist", "C2")
    return joined.select("tree_id", "triplet", "outgroup", F.try_divide(second, first + second).alias("probability"))


def summarise(models: DataFrame, limit: float = -10.0, without: str | None = None) -> DataFrame:
    """Difference of BIC, significance, major topology (ties all), and shares over trees."""
    rows = models if without is None else models.where(~F.col("triplet").contains(without))
    w = W.partitionBy("triplet")
    rows = rows.withColumn("delta_bic", F.round(F.col("BIC2Dist") - F.col("BIC1Dist"), 4)).withColumn("total", F.sum("count").over(w)).withColumn("major", F.col("count") == F.max("count").over(w))
    significant = F.col("delta_bic") < limit
    discordant = F.sum(F.when(~F.col("major"), F.col("count")).otherwise(0)).over(w)
    share = F.when(significant & ~F.col("major"), F.col("mixprop2") * F.col("count")).otherwise(0.0)
    return rows.withColumn("significant", significant).withColumn("discordant", discordant).withColumn("share_of_discordant", F.round(F.try_divide(share, F.col("discordant").cast("double")), 6)).withColumn("share_of_all", F.round(F.try_divide(share, F.col("total").cast("double")), 6))


def pair_matrix(models: DataFrame, limit: float = 20.0, names: list[str] | None = None) -> DataFrame:
    """Mean introgression of each unordered pair over discordant rows, as a filled matrix.

    ``models`` has ``a``, ``b`` (the taxa that the discordant topology joins) and ``major``.
    """
    value = F.when(F.col("BIC1Dist") - F.col("BIC2Dist") > limit, F.col("mixprop2")).otherwise(0.0)
    mean = models.where("not major").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.avg(value).alias("v"))
    both = mean.union(mean.select("b", "a", "v"))
    pivot = both.groupBy("a").pivot("b", names) if names else both.groupBy("a").pivot("b")
    return pivot.agg(F.round(F.first("v"), 6)).na.fill(0.0)
