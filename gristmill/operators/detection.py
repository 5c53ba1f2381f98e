"""Judging a funnel against known truth: recall by form, false kills, service levels, baselines, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.operators import funnel
from gristmill.operators.evaluate import hash_fraction
from gristmill.operators.registry import get
from gristmill.plans.store import materialize

DEDUP = ("exact_text", "text_minhash", "minhash_lsh", "md5_exact", "phash_near", "semantic_dedup")
UNEVALUATED = 5e-4  # ceilings are stated to four digits


def form_recall(run: DataFrame, form: str, clean: str = "clean") -> DataFrame:
    """(form, n, caught, dedup_only, kept, rate): what a deduplicating operator drops is no recall; for the clean form ``rate`` is the false kill."""
    by_dedup = F.coalesce(F.col("dropped_by").isin(*DEDUP), F.lit(False))
    gone = F.col("dropped_by").isNotNull()
    g = run.groupBy(F.col(form).alias("form")).agg(F.count("*").alias("n"), F.count_if(gone & ~by_dedup).alias("caught"), F.count_if(by_dedup).alias("dedup_only"), F.count_if(~gone).alias("kept"))
    caught = F.when(F.col("form") == clean, F.col("caught") + F.col("dedup_only")).otherwise(F.col("caught"))
    return g.withColumn("rate", F.round(caught / F.col("n"), 6))


def ceilings(df: DataFrame, form: str, text: str = "text") -> DataFrame:
    """(form, ceiling): copies fall to deduplication, so no more than the share of distinct texts can be caught otherwise."""
    return df.groupBy(F.col(form).alias("form")).agg(F.round(F.count_distinct(F.md5(F.coalesce(F.col(text), F.lit("")))) / F.count("*"), 4).alias("ceiling"))


def judge_levels(recall: DataFrame, levels: dict[str, tuple[float | None, float | None]], ceiling: DataFrame) -> DataFrame:
    """``recall`` with target, budget, ceiling and verdict: a form without both is NO_SLO; a breach is 1 - rate over the budget, unless the rate is at its ceiling."""
    known = {k: v for k, v in levels.items() if None not in v}
    column = lambda i: F.element_at(F.create_map(*(x for k, v in known.items() for x in (F.lit(k), F.lit(float(v[i]))))), F.col("form")) if known else F.lit(None).cast("double")
    d = recall.join(ceiling, "form", "left").withColumn("target", column(0)).withColumn("budget", column(1))
    full = F.coalesce(F.col("rate") >= F.col("ceiling") - UNEVALUATED, F.lit(False))
    verdict = F.when(F.col("budget").isNull() | F.col("rate").isNull(), "NO_SLO").when(1 - F.col("rate") <= F.col("budget"), "PASS").when(full, "CEILING").otherwise("BREACH")
    return d.withColumn("verdict", verdict)


def alone(df: DataFrame, stages: list[funnel.Stage], truth: list[str], text: str = "text") -> DataFrame:
    """Each row operator judged by itself: (op, n_flagged, precision and per truth column its recall), from one pass over the texts."""
    row = [s for s in stages if not get(s.op).batch]
    scored = materialize(df.select(*truth, *(get(s.op).score(F.col(text), **s.params).cast("double").alias(s.op) for s in row)), "scored")
    flags = [(s.op, ~funnel.keeps(F.col(s.op), s.min, s.max)) for s in row]
    anyhow = F.greatest(*(F.col(t).cast("int") for t in truth)) == 1 if len(truth) > 1 else F.col(truth[0])
    wanted = [F.count_if(f).alias(f"n_{o}") for o, f in flags] + [F.count_if(f & anyhow).alias(f"hit_{o}") for o, f in flags]
    wanted += [F.count_if(f & F.col(t)).alias(f"{t}_{o}") for o, f in flags for t in truth] + [F.count_if(F.col(t)).alias(f"all_{t}") for t in truth]
    one = scored.agg(*wanted)
    share = lambda a, b: F.round(F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)), 4)
    rows = [F.struct(F.lit(o).alias("op"), F.col(f"n_{o}").alias("n_flagged"), share(f"hit_{o}", f"n_{o}").alias("precision"), *(share(f"{t}_{o}", f"all_{t}").alias(f"recall_{t}") for t in truth)) for o, _ in flags]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def grid(df: DataFrame, flag, first: list, second: list, truth: Column) -> DataFrame:
    """(a, b, n_flagged, caught): every pair of parameters in one pass; ``flag(a, b)`` gives the condition."""
    pairs = [(a, b) for a in first for b in second]
    one = df.agg(*(F.count_if(flag(a, b)).alias(f"n{i}") for i, (a, b) in enumerate(pairs)), *(F.count_if(flag(a, b) & truth).alias(f"c{i}") for i, (a, b) in enumerate(pairs)))
    return one.select(F.explode(F.array(*(F.struct(F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b"), F.col(f"n{i}").alias("n_flagged"), F.col(f"c{i}").alias("caught")) for i, (a, b) in enumerate(pairs)))).alias("r")).select("r.*")


def curve(df: DataFrame, value: str, steps: list[float], low_is_bad: bool = True) -> DataFrame:
    """(threshold, rate): the share of scored rows beyond each threshold, null where nothing is scored."""
    beyond = lambda t: (F.col(value) < t) if low_is_bad else (F.col(value) > t)
    one = df.agg(F.count(value).alias("n"), *(F.count_if(beyond(t)).alias(f"k{i}") for i, t in enumerate(steps)))
    return one.select(F.explode(F.array(*(F.struct(F.lit(float(t)).alias("threshold"), F.round(F.try_divide(f"k{i}", "n"), 6).alias("rate")) for i, t in enumerate(steps)))).alias("r")).select("r.*")


def gate(now: DataFrame, frozen: DataFrame, tolerance: float) -> DataFrame:
    """(threshold, rate, frozen_rate, ok): fails beyond the tolerance, where a point is missing, and where a rate turned null or ceased to be."""
    d = now.withColumn("_n", F.lit(True)).join(frozen.withColumnRenamed("rate", "frozen_rate").withColumn("_f", F.lit(True)), "threshold", "full_outer")
    both = F.col("rate").isNull() & F.col("frozen_rate").isNull() & F.coalesce(F.col("_f") & F.col("_n"), F.lit(False))
    return d.select("threshold", "rate", "frozen_rate", F.coalesce(F.abs(F.col("rate") - F.col("frozen_rate")) <= tolerance, both).alias("ok"))


def random_drops(df: DataFrame, key: str, dirty: Column, rate: float, seeds: range) -> DataFrame:
    """(seed, n_dropped, n_dirty): dropping the same share by hash, one pass for all seeds."""
    u = lambda s: hash_fraction(F.concat(F.lit(f"{s}:"), F.col(key).cast("string"))) < rate
    one = df.agg(*(F.count_if(u(s)).alias(f"n{s}") for s in seeds), *(F.count_if(u(s) & dirty).alias(f"d{s}") for s in seeds))
    return one.select(F.explode(F.array(*(F.struct(F.lit(s).alias("seed"), F.col(f"n{s}").alias("n_dropped"), F.col(f"d{s}").alias("n_dirty")) for s in seeds))).alias("r")).select("r.*")


def drop_summary(drops: DataFrame) -> DataFrame:
    """(n, mean, std, low, high, least, most) of precision over seeds: sample deviation and a normal 95 % interval."""
    p = drops.select(F.try_divide("n_dirty", "n_dropped").alias("p"))
    half = 1.96 * F.coalesce(F.stddev_samp("p"), F.lit(0.0)) / F.sqrt(F.count("p"))
    return p.agg(F.count("p").alias("n"), F.round(F.avg("p"), 6).alias("mean"), F.round(F.stddev_samp("p"), 6).alias("std"), F.round(F.avg("p") - half, 6).alias("low"), F.round(F.avg("p") + half, 6).alias("high"), F.round(F.min("p"), 6).alias("least"), F.round(F.max("p"), 6).alias("most"))


def noise_floor(metrics: DataFrame, arm: str, value: str) -> DataFrame:
    """(floor, difference, verdict): the range of a metric over seeds of one arm, the largest of arms, is what a difference of arm means has to exceed."""
    g = metrics.groupBy(arm).agg((F.max(value) - F.min(value)).alias("spread"), F.avg(value).alias("m"))
    d = g.agg(F.max("spread").alias("floor"), (F.max("m") - F.min("m")).alias("difference"))
    return d.select(F.round("floor", 6).alias("floor"), F.round("difference", 6).alias("difference"), F.when(F.col("difference") > F.col("floor"), "differs").otherwise("within_noise").alias("verdict"))


def parity(rates: DataFrame, least: int = 30, points: float = 0.01, times: float = 5.0) -> DataFrame:
    """(clean, synth, dirty, verdict) from (arm, n, n_flagged): synthesised rows are flagged at most ``points`` more often than clean ones, dirty ones ``times`` as often at least."""
    rate = lambda a: F.max(F.when(F.col("arm") == a, F.try_divide("n_flagged", "n")))
    d = rates.agg(F.min("n").alias("n"), *(rate(a).alias(a) for a in ("clean", "synth", "dirty")))
    verdict = F.when(F.col("n") < least, "TOO_FEW").when(F.col("synth") > F.col("clean") + points, "SYNTH_FLAGGED").when(F.col("dirty") < times * F.col("clean"), "DIRTY_MISSED").otherwise("PASS")
    return d.select(*(F.round(a, 6).alias(a) for a in ("clean", "synth", "dirty")), verdict.alias("verdict"))


def unscored(scores: DataFrame, channel: list[str], score: str = "score") -> DataFrame:
    """(n_windows, n_unscored, unscored_rate, n_channels, n_channels_unscored): windows without a score, and channels wholly without."""
    g = scores.groupBy(*channel).agg(F.count("*").alias("n"), F.count_if(F.col(score).isNull()).alias("u"))
    return g.agg(F.sum("n").alias("n_windows"), F.sum("u").alias("n_unscored"), F.round(F.try_divide(F.sum("u"), F.sum("n")), 6).alias("unscored_rate"), F.count("*").alias("n_channels"), F.count_if(F.col("n") == F.col("u")).alias("n_channels_unscored"))


def reachability(windows: DataFrame, keys: list[str], needs: dict[str, int]) -> DataFrame:
    """(check, needs, n_groups, n_short): groups with fewer windows than a check must have to say anything."""
    g = windows.groupBy(*keys).agg(F.count("*").alias("n"))
    one = g.agg(F.count("*").alias("n_groups"), *(F.count_if(F.col("n") < k).alias(c) for c, k in needs.items()))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("check"), F.lit(k).cast("long").alias("needs"), F.col("n_groups"), F.col(c).alias("n_short")) for c, k in needs.items()))).alias("r")).select("r.*")


def routing_effect(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """(n, n_preserved, calls_before, calls_after, saved): ``calls`` of two runs, and rows whose value differs by no more than 1e-9."""
    d = before.alias("a").join(after.alias("b"), key)
    same = F.coalesce(F.abs(F.col(f"a.{value}") - F.col(f"b.{value}")) <= 1e-9, F.col(f"a.{value}").isNull() & F.col(f"b.{value}").isNull())
    return d.agg(F.count("*").alias("n"), F.count_if(same).alias("n_preserved"), F.sum("a.calls").alias("calls_before"), F.sum("b.calls").alias("calls_after")).withColumn("saved", F.round(1 - F.try_divide("calls_after", "calls_before"), 6))
