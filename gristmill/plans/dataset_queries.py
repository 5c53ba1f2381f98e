"""Queries over training-set production."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.functions import text as T
from gristmill.operators import dataset, funnel
from gristmill.sources.tables import table

PROMPT_CHARS = 2000  # the reference's limit (tuning/judge_data.py)

Q: dict = {}
O: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            O[name] = sql
        return f

    return add


_SPLIT = "WITH h AS (SELECT doc_id, text, list_reduce(list_transform(string_split(substr(sha256(cast(doc_id as varchar)), 1, 8), ''), lambda c: cast(strpos('0123456789abcdef', c) - 1 as bigint)), lambda a, b: a * 16 + b) % 10000 / 10000.0 AS u FROM documents), s AS (SELECT doc_id, text, CASE WHEN u < 0.1 THEN 'val' WHEN u < 0.2 THEN 'test' ELSE 'train' END AS split FROM h) "


@query("split_leakage", _SPLIT + "SELECT md5(text) AS digest, list_sort(list(DISTINCT split)) AS splits, count(*) AS n FROM s GROUP BY 1 HAVING count(DISTINCT split) > 1")
def split_leakage(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", dataset.split(F.col("doc_id").cast("string"), 0.1, 0.1).alias("split"))
    return dataset.cross_leaks(d, "doc_id", "text", "split")


@query("split_near_leakage")
def split_near_leakage(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", dataset.split(F.col("doc_id").cast("string"), 0.1, 0.1).alias("split"))
    return dataset.near_leaks(d, "doc_id", "text", "split")


@query("decontamination")
def decontamination(spark, sf):
    return dataset.decontaminate(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text"))


@query("contamination_recall")
def contamination_recall(spark, sf):
    mixed = dataset.contaminate(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), 0.3)
    run = funnel.run(mixed, funnel.TEXT_FUNNEL, carry=["dirty"])
    return dataset.recall_by_kind(run.select(F.col("dropped_seq").isNotNull().alias("dropped"), "dirty"))


@query("routing_cost", "WITH r AS (SELECT CASE WHEN n_chars >= 200 AND n_chars < 2000 THEN 'llm' ELSE 'rule' END AS tier FROM documents) SELECT count(*) AS n, sum(CASE WHEN tier = 'llm' THEN 51 ELSE 1 END)::bigint AS cost, count(*) * 51 AS full_cost, round(1 - sum(CASE WHEN tier = 'llm' THEN 51 ELSE 1 END) / cast(count(*) * 51 as double), 6) AS saved FROM r")
def routing_cost(spark, sf):
    return dataset.cost_estimate(table(spark, sf, "documents").select(dataset.route(F.col("n_chars"), 200, 2000).alias("tier")), "tier")


@query("lineage_edges")
def lineage_edges(spark, sf):
    run = funnel.run(table(spark, sf, "documents").select("doc_id", "text"), funnel.TEXT_FUNNEL, "doc_id", carry=[])
    return dataset.lineage(funnel.verdicts(run, funnel.TEXT_FUNNEL, "doc_id"), "doc_id")[1]


@query("threshold_scan", "WITH d AS (SELECT quality, n_chars FROM documents JOIN labels USING (doc_id)) SELECT cast(t as int) AS threshold, count(*) FILTER (WHERE n_chars < t AND quality = 0) AS caught, count(*) FILTER (WHERE n_chars < t AND quality = 1) AS killed, round(count(*) FILTER (WHERE n_chars < t AND quality = 0) / nullif(cast(count(*) FILTER (WHERE quality = 0) as double), 0), 6) AS recall FROM d, range(0, 2001, 250) r(t) GROUP BY t")
def threshold_scan(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id")
    steps = range(0, 2001, 250)
    bad = F.col("quality") == 0
    row = d.agg(F.count_if(bad).alias("bad"), *(F.count_if((F.col("n_chars") < t) & bad).alias(f"c{t}") for t in steps), *(F.count_if((F.col("n_chars") < t) & ~bad).alias(f"k{t}") for t in steps))
    return row.select(F.explode(F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(f"c{t}").alias("caught"), F.col(f"k{t}").alias("killed"), F.round(F.try_divide(f"c{t}", "bad"), 6).alias("recall")) for t in steps))).alias("x")).select("x.*")


@query("event_freshness", "SELECT event_type, max(ts) AS last_ts, date_diff('day', max(cast(ts as date)), date '2030-01-01') AS age_days, CASE WHEN date_diff('day', max(cast(ts as date)), date '2030-01-01') > 2000 THEN 'stale' ELSE 'fresh' END AS state FROM events GROUP BY 1")
def event_freshness(spark, sf):
    age = F.datediff(F.lit("2030-01-01").cast("date"), F.to_date(F.max("ts"))).cast("long")
    return table(spark, sf, "events").groupBy("event_type").agg(F.max("ts").alias("last_ts"), age.alias("age_days")).withColumn("state", F.when(F.col("age_days") > 2000, "stale").otherwise("fresh"))


@query("sessions", "WITH g AS (SELECT *, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events), s AS (SELECT user_id, ts, sum(CASE WHEN gap IS NULL OR gap >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g) SELECT user_id, min(ts) AS start, max(ts) AS last, count(*) AS n FROM s GROUP BY user_id, k")
def sessions(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy("user_id", F.session_window("ts", "30 minutes")).agg(F.min("ts").alias("start"), F.max("ts").alias("last"), F.count("*").alias("n")).drop("session_window")


@query("sft_rows")
def sft_rows(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return d.select(F.col("doc_id").alias("id"), F.concat(F.lit("Is this text fit for training?\n"), F.substring(T.strip("text"), 1, PROMPT_CHARS)).alias("prompt"), F.when(F.col("quality") == 1, '{"score": 9}').otherwise('{"score": 1}').alias("answer"))
