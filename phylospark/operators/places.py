"""Running numbers, sums and maxima over a whole table or its groups, range by range instead of in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .clusters import stored


def running_sum(rows: DataFrame, order: str, value: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over all rows up to this one in ``order`` (no ties).

    Rows are dealt to a fixed number of ranges of ``order``; each range is summed on its own and the
    sums before it, one row for each range, are added.
    """
    cuts = _cuts(rows, order)
    dealt = rows.withColumn("__range", F.size(F.filter(cuts, lambda c: c < F.col(order)))) if cuts is not None else rows.withColumn("__range", F.lit(0))
    own = F.sum(value).over(W.partitionBy("__range").orderBy(order))
    totals = dealt.groupBy("__range").agg(F.sum(value).alias("__total"))
    before = F.coalesce(F.sum("__total").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # at most RANGES rows
    offsets = totals.select("__range", before.alias("__before"))
    return dealt.withColumn(name, own).join(F.broadcast(offsets), "__range").withColumn(name, F.col(name) + F.col("__before")).drop("__range", "__before")


#: Ranges that a table is dealt to.
RANGES = 256


def _cuts(rows: DataFrame, order: str) -> Column | None:
    """Values of ``order`` that part the rows into about equal ranges, from a sample of a bounded size."""
    n = rows.count()
    if not n:
        return None
    sample = rows.select(order).sample(fraction=min(1.0, 64 * RANGES / n), seed=7).orderBy(order).limit(200 * RANGES).toArrow().column(0).drop_null()
    some = sorted({sample[i * len(sample) // RANGES].as_py() for i in range(1, RANGES)}) if len(sample) else []
    return F.array(*map(F.lit, some)) if some else None


def with_place(rows: DataFrame, order: str) -> DataFrame:
    """``rows`` with ``__place``: 1, 2, ... in ``order`` (no ties)."""
    return running_sum(rows, order, F.lit(1), "__place")


def in_ranges(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` stored in ranges of ``keys`` with ``__part``, the range's number; a group of any size is several ranges."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(rows.repartitionByRange(ranges, *keys).withColumn("__part", F.spark_partition_id()), "ranges")


def _alike(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in columns])


def carried(dealt: DataFrame, group: list[str], order: list[str], sums: dict[str, Column] | None = None, maxima: dict[str, Column] | None = None, own: bool = True) -> DataFrame:
    """``dealt`` (see :func:`in_ranges`, by ``group`` and ``order``) with sums and maxima of the group's rows up to each row.

    With ``own`` false the row itself does not count.  Each range is scanned on its own; what comes before it is
    one row for each group and range.  ``order`` has no ties within a group; NULL values do not count.
    """
    sums, maxima = sums or {}, maxima or {}
    keys = ["__part", *group]
    frame = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow if own else -1)
    before = W.partitionBy(*group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    totals = dealt.groupBy(*keys).agg(*[F.sum(v).alias(f"__{n}") for n, v in sums.items()], *[F.max(v).alias(f"__{n}") for n, v in maxima.items()])
    carry = totals.select(*keys, *[F.sum(f"__{n}").over(before).alias(f"__{n}") for n in sums], *[F.max(f"__{n}").over(before).alias(f"__{n}") for n in maxima])
    scanned = dealt.select("*", *[F.sum(v).over(frame).alias(n) for n, v in sums.items()], *[F.max(v).over(frame).alias(n) for n, v in maxima.items()])
    joined = scanned.join(carry, _alike(scanned, carry, keys))
    out = [scanned[c] for c in dealt.columns if c != "__part"]
    out += [(F.coalesce(scanned[n], F.lit(0)) + F.coalesce(carry[f"__{n}"], F.lit(0))).alias(n) for n in sums]
    out += [F.greatest(scanned[n], carry[f"__{n}"]).alias(n) for n in maxima]
    return joined.select(*out)
