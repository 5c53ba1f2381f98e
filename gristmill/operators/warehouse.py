"""Warehouse layers over samples: operational rows, day tables, views, scorecard, health, metric freeze, run ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HAN = r"[\x{4E00}-\x{9FFF}]"
TERMINAL = ("SUCCESS", "FAILED", "TIMEOUT", "SKIPPED")


def ods(samples: DataFrame, run: DataFrame, key: str, dataset: Column, text: str = "text") -> DataFrame:
    """One operational row per sample: dataset, id, lengths, digest, whether it was kept, who dropped it, scores as JSON."""
    scores = [c for c in run.columns if c.startswith("score_")]
    said = run.select(key, F.col("dropped_by").isNull().alias("is_kept"), "dropped_by", F.to_json(F.struct(*(F.round(c, 6).alias(c[6:]) for c in scores))).alias("scores_json"))
    t = F.coalesce(F.col(text), F.lit(""))
    slim = samples.select(F.col(key), dataset.alias("dataset"), F.length(t).alias("text_len"), F.regexp_count(t, F.lit(HAN)).alias("chars_han"), F.md5(t).alias("text_md5"))
    return slim.join(said, key)


def missing_days(rows: DataFrame, done: DataFrame, day: str) -> DataFrame:
    """The rows of days that ``done`` has no partition for: an increment writes no day twice."""
    return rows.join(done.select(day).distinct(), day, "left_anti").select(rows.columns)


def match_counts(facts: DataFrame, joined_version: str, key: str) -> DataFrame:
    """(n_total, n_no_key, n_unmatched): facts without a key, and facts with one that met no version."""
    k = F.col(key)
    return facts.agg(F.count("*").alias("n_total"), F.count_if(k.isNull()).alias("n_no_key"), F.count_if(k.isNotNull() & F.col(joined_version).isNull()).alias("n_unmatched"))


def views(spark: SparkSession, tables: dict[str, tuple[DataFrame | None, str]], aliases: dict[str, str]) -> DataFrame:
    """Register a view for each table (an empty one of the stated schema where there is none) and for each alias; (view, n_columns, is_empty)."""
    made = {name: spark.createDataFrame([], schema) if df is None else df for name, (df, schema) in tables.items()}
    made |= {alias: made[name] for alias, name in aliases.items()}
    out = []
    for name, df in made.items():
        df.createOrReplaceTempView(name)
        out.append((name, len(df.columns), df.isEmpty()))
    return spark.createDataFrame(sorted(out), "view string, n_columns int, is_empty boolean")


def band_alert(days: DataFrame, key: str, day: str, count: str, ratio: float = 0.5, last: int = 7) -> DataFrame:
    """``days`` with typical and low: a day under ``ratio`` times the median of the ``last`` positive days before it."""
    positive = days.where(F.col(count) > 0)
    w = Window.partitionBy(key).orderBy(day).rowsBetween(-last, -1)
    seen = F.array_sort(F.collect_list(count).over(w))  # ``last`` values at most
    half = lambda x, n: (F.get(x, F.floor((n - 1) / 2).cast("int")) + F.get(x, F.floor(n / 2).cast("int"))) / 2
    typical = F.when(F.size("_seen") > 0, half(F.col("_seen"), F.size("_seen")))
    return positive.withColumn("_seen", seen).withColumn("typical", typical).drop("_seen").withColumn("low", F.coalesce(F.col(count) < ratio * F.col("typical"), F.lit(False)))


def shares(df: DataFrame, group: str, value: str, tiles: int = 4) -> DataFrame:
    """(group, n, worst, mean, tile, cumulative): groups in tiles by mean, and the running share of their rows from the worst mean on."""
    g = df.groupBy(group).agg(F.count("*").alias("n"), F.min(value).alias("worst"), F.avg(value).alias("mean"))
    w = Window.orderBy("mean", group)  # one row a group
    return g.select(group, "n", "worst", F.round("mean", 6).alias("mean"), F.ntile(tiles).over(w).alias("tile"), F.round(F.sum("n").over(w) / F.sum("n").over(Window.partitionBy()), 6).alias("cumulative"))


def scorecard(per_op: DataFrame, dimensions: dict[str, list[str]], targets: dict[str, float]) -> DataFrame:
    """(dataset, dimension, ops_total, ops_evaluated, score, status) from (dataset, op, n_scored, n_dropped).

    An operator counts as evaluated if it scored or dropped; a dimension's score is its share of passed
    scores, null without any; without target or score there is no status but UNKNOWN.
    """
    ops = F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.lit(o).alias("op")) for d, names in dimensions.items() for o in names)))
    want = per_op.select("dataset").distinct().select("dataset", ops.alias("x")).select("dataset", "x.*")
    seen = (F.coalesce("n_scored", F.lit(0)) > 0) | (F.coalesce("n_dropped", F.lit(0)) > 0)
    g = want.join(per_op, ["dataset", "op"], "left").groupBy("dataset", "dimension")
    g = g.agg(F.count("*").alias("ops_total"), F.count_if(seen).alias("ops_evaluated"), F.sum(F.when(seen, F.col("n_scored"))).alias("s"), F.sum(F.when(seen, F.col("n_dropped"))).alias("d"))
    score = F.when(F.col("s") > 0, F.round(F.greatest(F.col("s") - F.coalesce("d", F.lit(0)), F.lit(0)) / F.col("s"), 6))
    target = F.element_at(F.create_map(*(x for k, v in targets.items() for x in (F.lit(k), F.lit(float(v))))), F.col("dimension"))
    d = g.withColumn("score", score).withColumn("target", target)
    status = F.when(F.col("score").isNull() | F.col("target").isNull(), "UNKNOWN").when(F.col("score") >= F.col("target"), "PASS").otherwise("BREACH")
    return d.select("dataset", "dimension", "ops_total", "ops_evaluated", "score", status.alias("status"))


def dataset_health(card: DataFrame) -> DataFrame:
    """(dataset, health, coverage): scores weighted by how many operators stand behind them; null where none does."""
    scored = F.col("score").isNotNull()
    weight = F.when(scored, F.col("ops_evaluated"))
    return card.groupBy("dataset").agg(F.round(F.try_divide(F.sum(F.col("score") * weight), F.sum(weight)), 6).alias("health"), F.round(F.sum("ops_evaluated") / F.sum("ops_total"), 6).alias("coverage"))


def pipeline_health(runs: DataFrame) -> DataFrame:
    """(n_runs, n_running, n_terminal, success_rate) of (status): what still runs is no failure."""
    over = F.col("status").isin(*TERMINAL)
    return runs.agg(F.count("*").alias("n_runs"), F.count_if(F.col("status") == "RUNNING").alias("n_running"), F.count_if(over).alias("n_terminal"), F.round(F.try_divide(F.count_if(F.col("status") == "SUCCESS"), F.count_if(over)), 6).alias("success_rate"))


def watermarks(events: DataFrame, key: str, at: str, before: DataFrame | None = None) -> DataFrame:
    """(key, high): the latest time of each key; never moves back."""
    now = events.groupBy(key).agg(F.max(at).alias("high"))
    return now if before is None else now.unionByName(before.select(key, "high")).groupBy(key).agg(F.max("high").alias("high"))


def verify_metrics(now: DataFrame, frozen: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """(name, value, frozen_value, state): same, moved, new, gone or error (a null value)."""
    d = now.select("name", "value").join(frozen.select("name", F.col("value").alias("frozen_value"), F.lit(True).alias("_f")), "name", "full_outer").join(now.select("name", F.lit(True).alias("_n")), "name", "left")
    state = F.when(F.col("_n").isNull(), "gone").when(F.col("_f").isNull(), "new").when(F.col("value").isNull() | F.col("frozen_value").isNull(), "error").when(F.abs(F.col("value") - F.col("frozen_value")) <= tolerance, "same").otherwise("moved")
    return d.select("name", "value", "frozen_value", state.alias("state"))


def reached(edges: DataFrame, start: DataFrame, down: bool = True) -> DataFrame:
    """(node, depth): all that ``start`` (node) leads to over (src, dst), or comes from, with the least number of steps."""
    from gristmill.plans.store import materialize

    a, b = ("src", "dst") if down else ("dst", "src")
    front = materialize(start.select("node").distinct().withColumn("depth", F.lit(0)), "reached")
    found, depth = front, 0
    while front.take(1):
        depth += 1
        step = edges.join(front.select(F.col("node").alias(a)), a, "left_semi").select(F.col(b).alias("node")).distinct()
        front = materialize(step.join(found.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth)), "reached")
        found = found.unionByName(front)
    return found.where("depth > 0")
