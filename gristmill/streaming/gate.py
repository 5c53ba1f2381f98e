"""Streaming forms: the quality gate, exact dedup within a watermark, windowed aggregates, idempotent sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.operators.funnel import Stage, keeps
from gristmill.operators.registry import get


def gate(df: DataFrame, stages: list[Stage], text: str = "text") -> DataFrame:
    """``df`` with scores (struct), flags (operators that failed) and passed; row operators only, so it streams."""
    if any(get(s.op).batch for s in stages):
        raise ValueError("the gate takes row operators")
    scores = F.struct(*(get(s.op).score(F.col(text), **s.params).alias(s.op) for s in stages))
    out = df.withColumn("scores", scores)
    flags = F.array_compact(F.array(*(F.when(~keeps(F.col(f"scores.{s.op}"), s.min, s.max), F.lit(s.op)) for s in stages)))
    return out.withColumn("flags", flags).withColumn("passed", F.size("flags") == 0)


def exact_dedup(stream: DataFrame, time: str, text: str = "text", delay: str = "1 day") -> DataFrame:
    """The first of equal texts within the watermark."""
    return stream.withWatermark(time, delay).withColumn("_md5", F.md5(F.coalesce(F.col(text), F.lit("")))).dropDuplicatesWithinWatermark(["_md5"]).drop("_md5")


def windowed(stream: DataFrame, time: str, keys: list[str | Column], size: str, slide: str | None = None, delay: str = "1 hour", **aggs: Column) -> DataFrame:
    """Event-time windows; rows later than ``delay`` are left out by the engine."""
    w = F.window(time, size, slide) if slide else F.window(time, size)
    return stream.withWatermark(time, delay).groupBy(w.alias("window"), *keys).agg(*(c.alias(n) for n, c in aggs.items()))


def partition_sink(path: str, by: list[str]):
    """For foreachBatch: rewrites the partitions a batch touches, so a replayed batch leaves the same table."""

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)

    return write
