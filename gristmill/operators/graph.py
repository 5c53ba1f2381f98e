"""Connected components over an edge table, without collecting edges anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.plans.store import discard, materialize


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Label every vertex of ``edges`` with the smallest vertex it can reach.

    Alternating large-star and small-star steps. The minimum of a vertex's neighbours is an
    aggregate (combined before the shuffle) that is joined back, so a hub with very many
    neighbours is never gathered in one group; adaptive execution may split the join. Every
    round is written to the shared folder. Null ends are ignored; an empty table gives an
    empty result. Returns ``(node, component)`` with one row per vertex that has an edge.
    """
    plain = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    kind = plain.schema["a"].dataType
    now = materialize(plain.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    alone = materialize(plain.where("a = b").select("a").distinct(), "cc-self")
    state = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: every vertex's smaller neighbours, and itself, point to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            .select("e.*")
            .where("a <> b")
            .distinct()
        )
        new = materialize(small, "cc")
        row = new.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        discard(now)
        now = new
        if (row["n"], row["h"]) == state:
            break
        state = (row["n"], row["h"])
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct()
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
    lonely = alone.select(F.col("a").alias("node")).join(labels.select("node"), "node", "left_anti")
    out = labels.unionByName(lonely.select("node", F.col("node").alias("component")))
    return out.select(F.col("node").cast(kind), F.col("component").cast(kind))
