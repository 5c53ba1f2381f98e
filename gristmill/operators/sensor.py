"""Grouped time-series operators over sensor windows.

A window is (device, channel, window_start, readings array<double>); all of it is window functions
and aggregates over higher-order expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SENTINEL = -999.0


def mean(r: Column) -> Column:
    return F.aggregate(r, F.lit(0.0), lambda a, x: a + x) / F.size(r)


def std(r: Column) -> Column:
    """Population standard deviation."""
    m = mean(r)
    return F.sqrt(F.aggregate(r, F.lit(0.0), lambda a, x: a + (x - m) * (x - m)) / F.size(r))


def autocorrelation(r: Column) -> Column:
    """At lag 1, clamped to 0..0.99; 0 for constant or very short windows."""
    m = mean(r)
    n = F.size(r)
    cross = F.aggregate(F.zip_with(F.slice(r, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(r, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: (a - m) * (b - m)), F.lit(0.0), lambda a, x: a + x)
    var = F.aggregate(r, F.lit(0.0), lambda a, x: a + (x - m) * (x - m))
    return F.when((n < 3) | (var <= 0), F.lit(0.0)).otherwise(F.least(F.greatest(cross / var, F.lit(0.0)), F.lit(0.99)))


def constant(r: Column) -> Column:
    return F.array_max(r) == F.array_min(r)


def sentinel(r: Column, value: float = SENTINEL) -> Column:
    return F.forall(r, lambda x: x == value)


def span_ratio(start: Column, end: Column, n: Column, hz: Column) -> Column:
    """Elapsed time against what the readings should take; null for fewer than 2 readings or no rate."""
    took = (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6
    return F.when((hz > 0) & (n >= 2), took / ((n - 1) / hz))


def in_range(r: Column, low: Column, high: Column) -> Column:
    """1 minus the share of readings outside the bounds; null without bounds."""
    return F.when(low.isNotNull() & high.isNotNull() & (F.size(r) > 0), 1 - F.size(F.filter(r, lambda x: (x < low) | (x > high))) / F.size(r))


def device_stops(w: DataFrame) -> DataFrame:
    """(device, window_start) where two channels or more are constant together and none is all sentinel."""
    g = w.groupBy("device", "window_start").agg(F.count("*").alias("n"), F.bool_and(constant(F.col("readings"))).alias("flat"), F.bool_or(sentinel(F.col("readings"))).alias("off"))
    return g.where("n >= 2 and flat and not off").select("device", "window_start")


def stuck(w: DataFrame, alpha: float = 0.2, min_run: int = 10) -> DataFrame:
    """(device, channel, window_start, score): 0 for a constant window, and from the ``min_run``-th window in a row whose deviation is under alpha times the channel's reference on.

    The reference is the nearest-rank upper quartile of the deviations of windows that vary; null without one.
    """
    s = w.select("device", "channel", "window_start", std(F.col("readings")).alias("sd"), constant(F.col("readings")).alias("flat"))
    healthy = s.where(~F.col("flat")).groupBy("device", "channel", "sd").agg(F.count("*").alias("c"))
    upto = Window.partitionBy("device", "channel").orderBy("sd")
    placed = healthy.withColumn("hi", F.sum("c").over(upto)).withColumn("n", F.sum("c").over(Window.partitionBy("device", "channel")))
    ref = placed.where("hi > floor(0.75 * (n - 1))").groupBy("device", "channel").agg(F.min("sd").alias("ref"))
    low = ~F.col("flat") & (F.col("sd") < alpha * F.col("ref"))
    order = Window.partitionBy("device", "channel").orderBy("window_start")
    d = s.join(ref, ["device", "channel"], "left").withColumn("low", F.coalesce(low, F.lit(False)))
    d = d.withColumn("island", F.sum((~F.col("low")).cast("int")).over(order))
    run = F.sum(F.col("low").cast("int")).over(Window.partitionBy("device", "channel", "island").orderBy("window_start"))
    d = d.withColumn("run", run)
    score = F.when(F.col("ref").isNull(), F.lit(None).cast("double")).when(F.col("flat"), 0.0).when(F.col("low") & (F.col("run") >= min_run), 0.0).otherwise(1.0)
    return d.select("device", "channel", "window_start", score.alias("score"))


def upper_median(c: str) -> Column:
    s = F.sort_array(F.collect_list(c))
    return F.get(s, F.floor(F.size(s) / 2).cast("int"))


def drift(w: DataFrame, scale: str = "pooled", z: float = 4.0, baseline: int = 5) -> DataFrame:
    """(device, channel, mode, window_start, score): 0 where a window's mean is more than z scales from the baseline's centre.

    The baseline is the group's first ``baseline`` windows; groups of no more windows score 1. The scale is the
    baseline's pooled standard error, or with ``mad`` 1.4826 times the median absolute deviation of all windows if that is larger.
    """
    r = F.col("readings")
    s = w.select("device", "channel", "mode", "window_start", mean(r).alias("m"), std(r).alias("sd"), autocorrelation(r).alias("rho"), F.size(r).alias("n"))
    keys = ["device", "channel", "mode"]
    s = s.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy("window_start")))
    base = s.where(F.col("k") <= baseline).groupBy(*keys).agg(upper_median("sd").alias("sw"), F.avg("rho").alias("rho0"), upper_median("m").alias("centre"), F.min_by("n", "k").alias("n0"))
    size = s.groupBy(*keys).agg(F.count("*").alias("size"))
    d = s.join(base, keys).join(size, keys)
    pooled = F.col("sw") * F.sqrt((1 + F.col("rho0")) / (F.col("n0") * (1 - F.col("rho0"))))
    if scale == "mad":
        off = d.groupBy(*keys).agg((1.4826 * F.median(F.abs(F.col("m") - F.col("centre")))).alias("mad"))
        d = d.join(off, keys)
        sigma = F.greatest("mad", pooled)
    elif scale == "pooled":
        sigma = pooled
    else:
        raise ValueError("scale is pooled or mad")
    far = F.abs(F.col("m") - F.col("centre")) > z * sigma
    score = F.when(F.col("size") <= baseline, 1.0).when((sigma > 0) & far, 0.0).otherwise(1.0)
    return d.select(*keys, "window_start", score.alias("score"))


def usual_value(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, usual): the most frequent value, the smallest of equals."""
    c = df.where(F.col(value).isNotNull()).groupBy(*keys, value).count()
    return c.groupBy(*keys).agg(F.min_by(F.col(value), F.struct((-F.col("count")).alias("n"), F.col(value))).alias("usual"))


def planned_faults(w: DataFrame, plans: DataFrame, gap_ratio: float = 5.0) -> DataFrame:
    """(device, channel, window_start, score): windows of sentinels score 1 inside a plan of their device (start <= t < end), else 0; device stops 1; gaps null; others 1."""
    fault = w.withColumn("off", sentinel(F.col("readings")))
    inside = fault.join(plans, (fault.device == plans.plan_device) & (fault.window_start >= plans.plan_start) & (fault.window_start < plans.plan_end), "left_semi").select("device", "channel", "window_start").withColumn("inside", F.lit(True)).distinct()
    stops = device_stops(w).withColumn("stop", F.lit(True))
    d = fault.join(inside, ["device", "channel", "window_start"], "left").join(stops, ["device", "window_start"], "left")
    gap = F.col("span_ratio") > gap_ratio if "span_ratio" in w.columns else F.lit(False)
    score = F.when(F.col("off"), F.coalesce(F.col("inside"), F.lit(False)).cast("double")).when(F.col("stop"), 1.0).when(gap, F.lit(None).cast("double")).otherwise(1.0)
    return d.select("device", "channel", "window_start", score.alias("score"))


def multivariate(pivoted: DataFrame, group: str, device: str, order: str, channels: list[str], ref_frac: float = 0.3, var_frac: float = 0.9, margin: float = 3.0, min_rows: int = 20) -> DataFrame:
    """(device, order, t2, spe, flagged, top_channel): principal components of the earliest rows of each device, by group.

    A group's rows have to fit one task: it is for device types, not for open-ended keys.
    """
    import numpy as np
    import pandas as pd

    def run(g: pd.DataFrame) -> pd.DataFrame:
        use = [c for c in channels if g[c].notna().mean() >= 0.9]
        g = g.sort_values([device, order], kind="stable")
        whole = g.dropna(subset=use) if use else g.iloc[:0]
        out = g[[device, order]].assign(t2=np.nan, spe=np.nan, flagged=False, top_channel=None)
        rank = whole.groupby(device).cumcount()
        size = whole.groupby(device)[order].transform("size")
        ref = whole[rank < np.ceil(size * ref_frac)]
        if len(use) < 3 or len(ref) < min_rows:
            return out
        med = ref[use].median()
        mad = 1.4826 * (ref[use] - med).abs().median()
        keep = [c for c in use if mad[c] > 0]
        if len(keep) < 3:
            return out
        z, zr = ((x[keep] - med[keep]) / mad[keep] for x in (whole, ref))
        _, s, vt = np.linalg.svd(zr.to_numpy() - zr.to_numpy().mean(0), full_matrices=False)
        share = np.cumsum(s**2) / max(np.sum(s**2), 1e-12)
        k = int(np.searchsorted(share, var_frac)) + 1
        p, lam = vt[:k].T, np.maximum(s[:k] ** 2 / max(len(zr) - 1, 1), 1e-12)

        def stats(x):
            t = x @ p
            e = x - t @ p.T
            return (t * t / lam).sum(1), (e * e).sum(1), e

        t2r, sper, _ = stats(zr.to_numpy())
        t2, spe, e = stats(z.to_numpy())
        limit = lambda v: np.median(v) + 3 * 1.4826 * np.median(np.abs(v - np.median(v)))
        flagged = (t2 > margin * limit(t2r)) | (spe > margin * limit(sper))
        out.loc[whole.index, ["t2", "spe"]] = np.column_stack([t2, spe])
        out.loc[whole.index, "flagged"] = flagged
        out.loc[whole.index, "top_channel"] = np.where(flagged, np.array(keep, object)[(e * e).argmax(1)], None)
        return out

    kind = {f.name: f.dataType.simpleString() for f in pivoted.schema}
    return pivoted.groupBy(group).applyInPandas(run, f"{device} {kind[device]}, {order} {kind[order]}, t2 double, spe double, flagged boolean, top_channel string")


def envelopes(w: DataFrame, keys: list[str], ref_frac: float = 0.3, margin: float = 3.0, min_windows: int = 5, max_violation: float = 0.05) -> DataFrame:
    """(keys, lo, hi, n_ref, violation): median -+ margin * 1.4826 * MAD of the readings of each group's earliest windows.

    Groups with too few windows, no spread, or more than ``max_violation`` of the later readings outside are left out.
    """
    order = Window.partitionBy(*keys).orderBy("window_start")
    size = w.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= min_windows)
    d = w.join(size, keys).withColumn("_k", F.row_number().over(order)).withColumn("_ref", F.col("_k") <= F.ceil(F.col("_n") * ref_frac))
    x = d.select(*keys, "_ref", F.explode("readings").alias("x"))
    c = x.where("_ref").groupBy(*keys).agg(F.median("x").alias("_c"), F.count("*").alias("n_ref"))
    s = x.where("_ref").join(c, keys).groupBy(*keys, "_c", "n_ref").agg((1.4826 * F.median(F.abs(F.col("x") - F.col("_c")))).alias("_s")).where("_s > 0")
    b = s.select(*keys, (F.col("_c") - margin * F.col("_s")).alias("lo"), (F.col("_c") + margin * F.col("_s")).alias("hi"), "n_ref")
    late = x.where("not _ref").join(b, keys).groupBy(*keys).agg(F.avg(((F.col("x") < F.col("lo")) | (F.col("x") > F.col("hi"))).cast("double")).alias("violation"))
    return b.join(late, keys, "left").where(F.coalesce("violation", F.lit(0.0)) <= max_violation)
