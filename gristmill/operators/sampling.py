"""Sampling: by hash, so that it is fixed by key and seed and needs no order of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(key: Column, seed: int) -> Column:
    return F.xxhash64(key.cast("string"), F.lit(seed))


def random_sample(df: DataFrame, budget: int, seed: int = 0, id_col: str = "id") -> DataFrame:
    """``budget`` rows: a top-k by hash, which every partition cuts before the shuffle."""
    return df.orderBy(draw(F.col(id_col), seed), id_col).limit(budget)


def quotas(counts: list[tuple[str, int]], budget: int, weights: dict[str, float]) -> dict[str, int]:
    """Floors of the weighted shares, capped by what there is, then one more each in order of the largest remainder."""
    total = sum(n * weights.get(s, 1.0) for s, n in counts) or 1.0
    share = {s: budget * n * weights.get(s, 1.0) / total for s, n in counts}
    out = {s: min(n, int(share[s])) for s, n in counts}
    left = budget - sum(out.values())
    have = dict(counts)
    for s in sorted(share, key=lambda s: (-(share[s] - int(share[s])), s)):
        if left <= 0:
            break
        if out[s] < have[s]:
            out[s] += 1
            left -= 1
    return out


def stratified_sample(df: DataFrame, stratum: str, budget: int, weights: dict[str, float] | None = None, seed: int = 0, id_col: str = "id") -> DataFrame:
    """Rows by quota per stratum, topped up at random to ``budget``. The strata's counts are all that reaches the driver."""
    counts = [(r[0], r[1]) for r in df.groupBy(stratum).count().orderBy(stratum).collect()]
    q = quotas([(str(s), n) for s, n in counts], budget, weights or {})
    quota = F.create_map(*(x for s, n in q.items() for x in (F.lit(s), F.lit(n)))) if q else F.create_map()
    w = Window.partitionBy(stratum).orderBy(draw(F.col(id_col), seed), id_col)
    ranked = df.withColumn("_r", F.row_number().over(w))
    taken = ranked.where(F.col("_r") <= F.element_at(quota, F.col(stratum).cast("string")))
    missing = budget - sum(q.values())
    if missing <= 0:
        return taken.drop("_r")
    rest = random_sample(ranked.where(F.col("_r") > F.element_at(quota, F.col(stratum).cast("string"))), missing, seed, id_col)
    return taken.unionByName(rest).drop("_r")
