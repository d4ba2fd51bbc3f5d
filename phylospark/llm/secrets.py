"""Secret scans with DataFrame functions only: fixed patterns, then character Markov models.

Two first-order character models, of random strings and of ordinary identifiers, are counted from
labelled samples of the corpus itself (what the patterns matched against plain identifiers of texts
without a match).  A long token is reported when the log-likelihood ratio of the two models says
that it looks random.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns of the base rule, in the order in which kinds are listed.
PATTERNS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]{12,}",  # the longest match of AKIA[A-Z0-9]+ has 16 characters or more
    "hex": "[0-9a-f]{32,}",  # a maximal run of 32 or more
    "markov": "[A-Za-z0-9+/_=-]{20,}",
}
KINDS = list(PATTERNS)
#: Words without one of which the first pattern cannot match.
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_N = len(ALPHABET) + 1  # place 0: any other character, and the start

_SPAN = "struct<start:int,end:int,kind:int,said:string>"


def _spans(text: Column, pattern: str, kind: int, long_enough: Column | None = None) -> Column:
    """Matches of ``pattern`` as spans in code points; starts are sums of the gaps and matches before.

    ``long_enough`` is an array of booleans, one for each match.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    keep = long_enough if long_enough is not None else F.transform(found, lambda m: F.lit(True))
    zero = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<{_SPAN}>)").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["said"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["said"].alias("said"))
        return F.struct(end.alias("at"), F.when(x["keep"], F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    rows = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("said"), keep.alias("keep"))
    return F.aggregate(rows, zero, step, lambda acc: acc["out"])


def _none() -> Column:
    return F.expr(f"cast(array() as array<{_SPAN}>)")


def _with_base_spans(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with __text and __base, the spans of the fixed patterns by start, then kind."""
    out = docs.withColumn("__text", F.coalesce(text, F.lit("")))
    low = F.lower("__text")
    may = low.contains(_ASSIGN_WORDS[0])
    for word in _ASSIGN_WORDS[1:]:
        may = may | low.contains(word)
    second = F.regexp_extract_all("__text", F.lit(PATTERNS["assign"]), F.lit(2))
    assign = _spans(F.col("__text"), PATTERNS["assign"], 0, F.transform(second, lambda v: F.length(v) >= 8))
    out = out.withColumn("__assign", F.when(may, assign).otherwise(_none()))
    out = out.withColumn("__access", F.when(F.col("__text").contains("AKIA"), _spans(F.col("__text"), PATTERNS["access"], 1)).otherwise(_none()))
    out = out.withColumn("__hex", F.when(F.col("__text").rlike(PATTERNS["hex"]), _spans(F.col("__text"), PATTERNS["hex"], 2)).otherwise(_none()))
    return out.withColumn("__base", F.array_sort(F.concat("__assign", "__access", "__hex"))).drop("__assign", "__access", "__hex")


def train(docs: DataFrame, text: str = "text", key: str = "doc_id", sample: int = 20_000, smoothing: float = 2.0) -> list[float]:
    """Log-likelihood ratios (random against ordinary) of a character after another, row by row.

    About ``sample`` documents, dealt by a hash of ``key``, are used for the counts: a bounded
    training sample.  Without any labelled string both models are uniform and every ratio is 0.
    """
    every = max(1, docs.count() // sample)
    part = docs.where(F.pmod(F.xxhash64(key), F.lit(every)) == 0)
    spans = _with_base_spans(part.select(text), text)
    value = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
    random = spans.select(F.explode("__base").alias("s")).select(F.lit(1).alias("label"), F.regexp_replace("s.said", value, "").alias("token"))
    plain = spans.where(F.size("__base") == 0).select(F.lit(0).alias("label"), F.explode(F.regexp_extract_all("__text", F.lit("[A-Za-z][A-Za-z0-9_]{7,}"), F.lit(0))).alias("token"))
    chars = random.union(plain).select("label", F.split("token", "").alias("c"))
    pairs = chars.select("label", F.explode(F.arrays_zip(F.concat(F.array(F.lit("")), F.slice("c", 1, F.size("c") - 1)).alias("a"), F.col("c").alias("b"))).alias("p"))
    at = lambda c: F.when(c == "", F.lit(0)).otherwise(F.call_function("instr", F.lit(ALPHABET), c))
    counts = pairs.select("label", at(F.col("p.a")).alias("a"), at(F.col("p.b")).alias("b")).groupBy("label", "a", "b").count().collect()
    table = [[[0.0] * _N for _ in range(_N)] for _ in range(2)]
    for r in counts:  # at most 2 * 68 * 68 rows
        table[r["label"]][r["a"]][r["b"]] += r["count"]
    out = []
    for a in range(_N):
        sums = [sum(table[k][a]) + smoothing * _N for k in range(2)]
        out += [math.log((table[1][a][b] + smoothing) / sums[1]) - math.log((table[0][a][b] + smoothing) / sums[0]) for b in range(_N)]
    return [round(x, 6) for x in out]


def scan(docs: DataFrame, model: list[float], text: str = "text", mean: float = 0.3, total: float = 12.0) -> DataFrame:
    """``docs`` with __spans: array of (start, end, kind, said), by start, then kind as in KINDS.

    A token of 20 or more characters that touches no base span is of kind "markov" when its
    log-likelihood ratio is at least ``total``, and ``mean`` for each character.  Offsets are code
    points, ends exclusive.  Null texts are empty, rows may repeat, texts are read whole; of clashing
    columns only ``__spans`` is replaced.
    """
    found = _scan_rows(docs, model, text, mean, total)
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "__spans"], "__spans")


def _scan_rows(docs: DataFrame, model: list[float], text: str, mean: float = 0.3, total: float = 12.0) -> DataFrame:
    """``row`` (all columns of ``docs``) and __spans."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = _with_base_spans(rows.withColumn("__said", F.col("row")[text]), "__said").drop("__said")
    weights = F.from_json(F.lit(json.dumps(model)), "array<double>")
    at = lambda c: F.call_function("instr", F.lit(ALPHABET), c)

    def ratio(said: Column) -> Column:
        zero = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))
        fold = lambda acc, c: F.struct(at(c).alias("last"), (acc["sum"] + F.element_at(weights, acc["last"] * _N + at(c) + 1)).alias("sum"))
        return F.aggregate(F.split(said, ""), zero, fold, lambda acc: acc["sum"])

    tokens = F.when(F.col("__text").rlike(PATTERNS["markov"]), _spans(F.col("__text"), PATTERNS["markov"], 3)).otherwise(_none())
    apart = lambda t: ~F.exists("__base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    out = out.withColumn("__tokens", tokens)

    def secret(t: Column) -> Column:
        return F.exists(F.array(ratio(t["said"])), lambda r: (r >= total) & (r >= F.length(t["said"]) * mean)) & apart(t)

    return out.withColumn("__spans", F.array_sort(F.concat("__base", F.filter("__tokens", secret)))).drop("__tokens", "__text")


def listed(spans: str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def redact(docs: DataFrame, model: list[float], text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``mark`` (overlapping ones by one)."""
    found = _scan_rows(docs, model, text)
    said = F.col("row")[text]
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(said, acc["at"] + 1, s["start"] - acc["at"])
        fresh = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("__spans", zero, step, lambda acc: F.concat(acc["out"], F.substring(said, acc["at"] + 1, F.length(said))))
    clean = F.when(F.size("__spans") > 0, done).otherwise(said)
    return found.select(*[(clean if c == text else F.col("row")[c]).alias(c) for c in docs.columns])
