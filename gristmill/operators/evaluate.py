"""Evaluation, statistics and drift, as aggregates."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def precision_recall(df: DataFrame, predicted: str, truth: str) -> DataFrame:
    """tp, fp, fn, precision and recall (0 where nothing was predicted or true)."""
    p, t = F.col(predicted), F.col(truth)
    c = df.agg(F.count_if(p & t).alias("tp"), F.count_if(p & ~t).alias("fp"), F.count_if(~p & t).alias("fn"))
    return c.select("tp", "fp", "fn", F.round(F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(0.0)), 4).alias("precision"), F.round(F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(0.0)), 4).alias("recall"))


def kappa(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cohen's kappa of two yes/no judgements; null where chance explains all."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    m = df.agg(F.count("*").alias("n"), F.avg((x == y).cast("double")).alias("po"), F.avg(x).alias("px"), F.avg(y).alias("py"))
    pe = F.col("px") * F.col("py") + (1 - F.col("px")) * (1 - F.col("py"))
    return m.select("n", F.round(F.try_divide(F.col("po") - pe, 1 - pe), 6).alias("kappa"))


def bucket(score: Column, edges: tuple[float, float]) -> Column:
    """low, mid or high: [.., e0), [e0, e1), [e1, ..]; null is low."""
    return F.when(score.isNull() | (score < edges[0]), "low").when(score < edges[1], "mid").otherwise("high")


def hash_fraction(key: Column) -> Column:
    """0..1 in steps of 1/10000, from the key's SHA-256."""
    return (F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long") % 10000) / 10000


def fingerprint(df: DataFrame) -> DataFrame:
    """(fingerprint, n): the same for the same rows in any order: two sums of 60-bit parts of the rows' digests, so that nothing is gathered."""
    h = F.md5(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns)))
    lane = lambda at: F.coalesce(F.sum(F.conv(F.substring("h", at, 15), 16, 10).cast("decimal(38,0)")), F.lit(0)).cast("string")
    return df.select(h.alias("h")).agg(F.concat_ws(":", lane(1), lane(16)).alias("fingerprint"), F.count("*").alias("n"))


def at_ranks(df: DataFrame, value: str, ranks: list[int], ranges: int = 1000) -> list:
    """The values at the given 1-based ranks of the sorted column, without sorting it in one task.

    Approximate quantiles cut the values into ranges, exact counts of these tell in which range a rank
    lies, and only those few ranges are ordered.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).count()
    edges = sorted(set(counts.approxQuantile(value, [i / ranges for i in range(1, ranges)], 0.5 / ranges)))
    placed = counts.withColumn("range", F.array_size(F.filter(F.array(*(F.lit(e) for e in edges)), lambda e: e <= F.col(value)))) if edges else counts.withColumn("range", F.lit(0))
    sizes = dict(placed.groupBy("range").agg(F.sum("count")).collect())  # ``ranges`` rows
    below, before = {}, 0
    for r in sorted(sizes):
        below[r], before = before, before + sizes[r]
    wanted = {k: max(r for r in below if below[r] < k) for k in ranks if k <= before}
    if not wanted:
        return []
    hi = F.sum("count").over(Window.partitionBy("range").orderBy(value))
    cum = placed.where(F.col("range").isin(*set(wanted.values()))).withColumn("hi", hi)
    hit = [(F.col("range") == r) & (F.col("hi") >= k - below[r]) & (F.col("hi") - F.col("count") < k - below[r]) for k, r in wanted.items()]
    return sorted({r[0] for r in cum.where(functools.reduce(lambda a, b: a | b, hit)).select(value).collect()})


def mad(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, n, centre, scale): median and 1.4826 times the median absolute deviation, in two passes."""
    centre = df.groupBy(*keys).agg(F.median(value).alias("centre"), F.count(value).alias("n"))
    return df.join(centre, keys).groupBy(*keys, "centre", "n").agg((1.4826 * F.median(F.abs(F.col(value) - F.col("centre")))).alias("scale"))


def psi(base: DataFrame, now: DataFrame, value: str, bins: int = 10, eps: float = 1e-6) -> DataFrame:
    """Population stability index over the base's nearest-rank quantile bins."""
    n = base.where(F.col(value).isNotNull()).count()
    ranks = sorted({min(int(n * i / bins), n - 1) + 1 for i in range(1, bins)}) if n else []
    cuts = at_ranks(base, value, ranks)

    def bin_of(c: Column) -> Column:
        return sum(((c >= F.lit(x)).cast("int") for x in cuts), F.lit(0))

    def shares(df: DataFrame, name: str) -> DataFrame:
        v = df.where(F.col(value).isNotNull()).groupBy(bin_of(F.col(value)).alias("bin")).agg(F.count("*").alias("c"))
        return v.select("bin", (F.col("c") / F.lit(float(max(1, df.where(F.col(value).isNotNull()).count())))).alias(name))

    both = shares(base, "p").join(shares(now, "q"), "bin", "full_outer")
    p, q = F.greatest(F.coalesce("p", F.lit(0.0)), F.lit(eps)), F.greatest(F.coalesce("q", F.lit(0.0)), F.lit(eps))
    s = both.agg(F.sum((q - p) * F.log(q / p)).alias("psi"), F.count("*").alias("n_bins"))
    return s.select(F.round("psi", 6).alias("psi"), "n_bins", F.when(F.col("psi") > 0.25, "significant").when(F.col("psi") > 0.10, "moderate").otherwise("stable").alias("level"))


def retrieval(ranks: DataFrame, rank: str = "rank", keys: list[str] | None = None) -> DataFrame:
    """recall@1/5/10 and MRR of target ranks (null: not found)."""
    r = F.col(rank)
    return ranks.groupBy(*(keys or [])).agg(F.count("*").alias("n"), *(F.round(F.avg(F.coalesce(r <= k, F.lit(False)).cast("double")), 6).alias(f"recall_at_{k}") for k in (1, 5, 10)), F.round(F.avg(F.coalesce(1 / r, F.lit(0.0))), 6).alias("mrr"))


def sign_test(df: DataFrame, a: str, b: str) -> dict:
    """Two-sided paired sign test: wins, losses, ties and p."""
    from math import comb

    row = df.agg(F.count_if(F.col(a) > F.col(b)).alias("w"), F.count_if(F.col(a) < F.col(b)).alias("l"), F.count_if(F.col(a) == F.col(b)).alias("t")).first()
    n, k = row["w"] + row["l"], min(row["w"], row["l"])
    p = min(1.0, 2 * sum(comb(n, i) for i in range(k + 1)) / 2**n) if n else 1.0
    return {"wins": row["w"], "losses": row["l"], "ties": row["t"], "p": p}
