"""The funnel: operators in order, each with bounds; what falls out is marked, never removed.

Consecutive row operators are one projection: every score is an expression, and the first
operator whose bound fails names the drop. Batch operators see survivors only and add a join.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text as T
from gristmill.operators.registry import Tier, get, operator
from gristmill.plans.store import materialize

TEXT = ("text_article", "image_caption")
operator("text_length", ("image_caption", "text_article"))(T.text_length)
operator("doc_length", ("text_article",))(T.doc_length)
operator("chinese_ratio", TEXT)(T.script_ratio)
operator("char_repetition", TEXT)(T.char_repetition)
operator("line_repetition", TEXT)(T.line_repetition)
operator("boilerplate", TEXT)(T.boilerplate)
operator("pii_detect", TEXT)(T.pii_detect)


@operator("exact_text", TEXT, batch=True, needs={"_md5": lambda text: F.md5(F.coalesce(text, F.lit("")))})
def exact_text(df: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, score, keep): the smallest id of equal texts stays. ``df`` has id and ``_md5``; the minimum is combined before the shuffle."""
    first = df.groupBy("_md5").agg(F.min(id_col).alias("_first"))
    return df.select(id_col, "_md5").join(first, "_md5").select(id_col, F.lit(None).cast("double").alias("score"), (F.col(id_col) == F.col("_first")).alias("keep"))


@dataclass(frozen=True)
class Stage:
    op: str
    min: float | None = None
    max: float | None = None
    params: dict = field(default_factory=dict)


def keeps(score: Column, low: float | None, high: float | None) -> Column:
    """Bounds are inclusive; a score that could not be computed keeps its row."""
    ok = F.lit(True)
    if low is not None:
        ok = ok & (score >= low)
    if high is not None:
        ok = ok & (score <= high)
    return score.isNull() | ok


def check(stages: list[Stage], modality: str | None) -> None:
    for s in stages:
        if modality is not None and modality not in get(s.op).modalities:
            raise ValueError(f"operator {s.op} does not apply to {modality}")


def run(df: DataFrame, stages: list[Stage], id_col: str = "id", text: str = "text", modality: str | None = "text_article", carry: list[str] | None = None) -> DataFrame:
    """The id, the columns to ``carry`` (all by default), ``score_<op>`` (null once dropped), ``dropped_seq`` and ``dropped_by``.

    Texts are read once: all row scores, and what batch operators need, are one projection that is
    written, and the decisions are made on the written columns. Otherwise the optimizer would work a
    score out again wherever it is read.
    """
    check(stages, modality)
    carry = [c for c in (df.columns if carry is None else carry) if c != id_col]
    batch = [s for s in stages if get(s.op).batch]
    made = [get(s.op).score(F.col(text), **s.params).cast("double").alias(f"score_{s.op}") for s in stages if s not in batch]
    made += [f(F.col(text)).alias(c) for c, f in {c: f for s in batch for c, f in get(s.op).needs.items()}.items()]
    out = materialize(df.select(id_col, *carry, *made), "funnel").withColumn("dropped_seq", F.lit(None).cast("int"))
    for i, s in enumerate(stages):
        c = f"score_{s.op}"
        if s in batch:
            judged = get(s.op).score(out.where("dropped_seq is null"), id_col, **s.params).select(id_col, F.col("score").alias(c), F.col("keep").alias("_keep"))
            out = out.join(judged, id_col, "left")
            gone = F.col("dropped_seq").isNull() & ~F.coalesce("_keep", F.lit(True))
            out = out.withColumn("dropped_seq", F.when(gone, F.lit(i)).otherwise(F.col("dropped_seq"))).drop("_keep")
        else:  # an operator never sees what fell before it
            out = out.withColumn(c, F.when(F.col("dropped_seq").isNull(), F.col(c)))
            out = out.withColumn("dropped_seq", F.coalesce("dropped_seq", F.when(~keeps(F.col(c), s.min, s.max), F.lit(i))))
    ops = F.array(*(F.lit(s.op) for s in stages))
    by = F.when(F.col("dropped_seq").isNotNull(), F.element_at(ops, F.col("dropped_seq") + 1))
    return out.select(id_col, *carry, *(f"score_{s.op}" for s in stages), "dropped_seq", by.alias("dropped_by"))


def stats(run_: DataFrame, stages: list[Stage]) -> DataFrame:
    """One row per stage: rows in, out and dropped, and least, median and greatest score, from one pass."""
    wanted = []
    for i, s in enumerate(stages):
        here = F.col("dropped_seq").isNull() | (F.col("dropped_seq") >= i)
        c = F.when(here, F.col(f"score_{s.op}"))
        wanted += [F.count_if(here).alias(f"in{i}"), F.count_if(F.col("dropped_seq") == i).alias(f"gone{i}"), F.min(c).alias(f"lo{i}"), F.median(c).alias(f"mid{i}"), F.max(c).alias(f"hi{i}")]
    row = run_.agg(*wanted)
    one = [F.struct(F.lit(i).alias("seq"), F.lit(s.op).alias("op"), F.col(f"in{i}").alias("n_in"), (F.col(f"in{i}") - F.col(f"gone{i}")).alias("n_out"), F.col(f"gone{i}").alias("n_dropped"), F.col(f"lo{i}").alias("score_min"), F.col(f"mid{i}").alias("score_p50"), F.col(f"hi{i}").alias("score_max")) for i, s in enumerate(stages)]
    return row.select(F.explode(F.array(*one)).alias("s")).select("s.*")


def rule(score: Column, low: float | None, high: float | None, dropped: Column) -> Column:
    """The verdict's rule: by the bounds alone."""
    out = F.when(score.isNull(), F.when(dropped, F.lit("batch_drop_no_score")).otherwise(F.lit("no_score_kept")))
    if low is not None:
        out = out.when(score < low, F.lit("score_below_min"))
    if high is not None:
        out = out.when(score > high, F.lit("score_above_max"))
    return out.otherwise(F.when(dropped, F.lit("batch_drop_score_in_range")).otherwise(F.lit("within_threshold")))


def verdicts(run_: DataFrame, stages: list[Stage], id_col: str = "id") -> DataFrame:
    """The ledger: a row for each operator that a row met."""
    rows = []
    for i, s in enumerate(stages):
        met = F.col("dropped_seq").isNull() | (F.col("dropped_seq") >= i)
        gone = F.coalesce(F.col("dropped_seq") == i, F.lit(False))
        c = F.col(f"score_{s.op}")
        rows.append(F.when(met, F.struct(F.lit(i).alias("seq"), F.lit(s.op).alias("op"), F.when(gone, F.lit("drop")).otherwise(F.lit("keep")).alias("decision"), c.alias("score"), rule(c, s.min, s.max, gone).alias("rule"))))
    return run_.select(id_col, F.explode(F.array_compact(F.array(*rows))).alias("v")).select(id_col, "v.*")


TEXT_FUNNEL = [Stage("doc_length", min=30, max=50000), Stage("line_repetition", min=0.8), Stage("char_repetition", min=0.8), Stage("boilerplate", min=0.8), Stage("pii_detect", min=0.9), Stage("exact_text")]

__all__ = ["TEXT_FUNNEL", "Stage", "Tier", "check", "keeps", "rule", "run", "stats", "verdicts"]
