"""Queries over events, orders and vectors: sensor windows, lake layers, search, sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.operators import dedup, evaluate, lake, sampling, sensor, vectors
from gristmill.sources.tables import table

Q: dict = {}
O: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            O[name] = sql
        return f

    return add


def windows(spark, sf) -> DataFrame:
    """Events as sensor windows: a device per user, a channel per event type, a window per day."""
    e = table(spark, sf, "events")
    g = e.groupBy(F.col("user_id").alias("device"), F.col("event_type").alias("channel"), F.to_date("ts").alias("window_start"))
    return g.agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", "value"))), lambda x: x["value"]).alias("readings"), F.min("ts").alias("start"), F.max("ts").alias("end"))


_W = "WITH w AS (SELECT user_id AS device, event_type AS channel, cast(ts as date) AS window_start, list(value ORDER BY ts, event_id) AS readings, min(ts) AS s, max(ts) AS e FROM events GROUP BY ALL) "
_WS = _W + ", s AS (SELECT device, channel, window_start, list_stddev_pop(readings) AS sd, list_max(readings) = list_min(readings) AS flat, list_avg(readings) AS m, len(readings) AS n FROM w) "


@query("window_statistics", _WS + "SELECT device, channel, window_start, round(m, 6) AS mean, round(coalesce(sd, 0), 6) AS std, n FROM s")
def window_statistics(spark, sf):
    r = F.col("readings")
    return windows(spark, sf).select("device", "channel", "window_start", F.round(sensor.mean(r), 6).alias("mean"), F.round(sensor.std(r), 6).alias("std"), F.size(r).cast("long").alias("n"))


@query("device_stop", _WS + "SELECT device, window_start FROM s GROUP BY ALL HAVING count(*) >= 2 AND bool_and(flat)")
def device_stop(spark, sf):
    return sensor.device_stops(windows(spark, sf))


@query(
    "stuck_runs",
    _WS
    + """, h AS (SELECT device, channel, list(sd ORDER BY sd) AS a FROM s WHERE NOT flat GROUP BY ALL),
ref AS (SELECT device, channel, a[cast(floor(0.75 * (len(a) - 1)) as int) + 1] AS r FROM h),
l AS (SELECT s.*, r, coalesce(NOT flat AND sd < 0.9 * r, false) AS low FROM s LEFT JOIN ref USING (device, channel)),
i AS (SELECT *, sum(cast(NOT low as int)) OVER (PARTITION BY device, channel ORDER BY window_start) AS island FROM l),
k AS (SELECT *, sum(cast(low as int)) OVER (PARTITION BY device, channel, island ORDER BY window_start) AS run FROM i)
SELECT device, channel, window_start, CASE WHEN r IS NULL THEN NULL WHEN flat THEN 0.0::double WHEN low AND run >= 3 THEN 0.0::double ELSE 1.0::double END AS score FROM k""",
)
def stuck_runs(spark, sf):
    return sensor.stuck(windows(spark, sf), alpha=0.9, min_run=3)


@query(
    "drift_baseline",
    _WS
    + """, k AS (SELECT device, channel, window_start, m, row_number() OVER (PARTITION BY device, channel ORDER BY window_start) AS k FROM s)
SELECT device, channel, count(*) AS n, round(list_sort(list(m) FILTER (WHERE k <= 5))[cast(floor(least(count(*), 5) / 2.0) as int) + 1], 6) AS centre FROM k GROUP BY device, channel""",
)
def drift_baseline(spark, sf):
    from pyspark.sql import Window

    r = F.col("readings")
    s = windows(spark, sf).select("device", "channel", "window_start", sensor.mean(r).alias("m"))
    s = s.withColumn("k", F.row_number().over(Window.partitionBy("device", "channel").orderBy("window_start")))
    base = s.where("k <= 5").groupBy("device", "channel").agg(F.round(sensor.upper_median("m"), 6).alias("centre"))
    return s.groupBy("device", "channel").agg(F.count("*").alias("n")).join(base, ["device", "channel"])


@query("sensor_drift")
def sensor_drift(spark, sf):
    return sensor.drift(windows(spark, sf).withColumn("mode", F.lit("run")), scale="mad")


@query("sensor_range", _W + ", b AS (SELECT channel, quantile_cont(x, 0.05) AS lo, quantile_cont(x, 0.95) AS hi FROM (SELECT event_type AS channel, value AS x FROM events) GROUP BY 1) SELECT device, w.channel, window_start, round(1 - len(list_filter(readings, lambda x: x < lo OR x > hi)) / cast(len(readings) as double), 6) AS score FROM w JOIN b USING (channel)")
def sensor_range(spark, sf):
    e = table(spark, sf, "events")
    b = e.groupBy(F.col("event_type").alias("channel")).agg(F.percentile("value", 0.05).alias("lo"), F.percentile("value", 0.95).alias("hi"))
    return windows(spark, sf).join(b, "channel").select("device", "channel", "window_start", F.round(sensor.in_range(F.col("readings"), F.col("lo"), F.col("hi")), 6).alias("score"))


@query("span_ratio", _W + "SELECT device, channel, window_start, CASE WHEN len(readings) >= 2 THEN round((epoch_us(e) - epoch_us(s)) / 1e6 / ((len(readings) - 1) / 0.001), 6) END AS ratio FROM w")
def span_ratio(spark, sf):
    return windows(spark, sf).select("device", "channel", "window_start", F.round(sensor.span_ratio(F.col("start"), F.col("end"), F.size("readings"), F.lit(0.001)), 6).alias("ratio"))


@query("unit_mode", "WITH c AS (SELECT user_id AS device, event_type AS unit, count(*) AS n FROM events GROUP BY user_id, event_type) SELECT device, unit AS usual FROM (SELECT *, row_number() OVER (PARTITION BY device ORDER BY n DESC, unit) AS k FROM c) WHERE k = 1")
def unit_mode(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("device"), F.col("event_type").alias("unit"))
    return sensor.usual_value(e, ["device"], "unit")


@query("interval_join", "WITH p AS (SELECT user_id, ts AS s, ts + INTERVAL 6 HOUR AS e FROM events WHERE event_type = 'signup') SELECT event_id FROM events v WHERE EXISTS (SELECT 1 FROM p WHERE p.user_id = v.user_id AND v.ts >= s AND v.ts < e)")
def interval_join(spark, sf):
    e = table(spark, sf, "events")
    p = e.where("event_type = 'signup'").select(F.col("user_id").alias("u"), F.col("ts").alias("s"), (F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("t"))
    return e.join(p, (F.col("user_id") == F.col("u")) & (F.col("ts") >= F.col("s")) & (F.col("ts") < F.col("t")), "left_semi").select("event_id")


@query(
    "fault_vs_maintenance",
    _W
    + """, p AS (SELECT user_id AS device, cast(ts as date) AS a, cast(ts as date) + 2 AS b FROM events WHERE event_type = 'signup'),
st AS (SELECT device, window_start FROM w GROUP BY ALL HAVING count(*) >= 2 AND bool_and(list_max(readings) = list_min(readings)) AND NOT bool_or(list_min(readings) = -999 AND list_max(readings) = -999))
SELECT device, channel, window_start, CASE WHEN list_min(readings) = -999 AND list_max(readings) = -999 THEN cast(EXISTS (SELECT 1 FROM p WHERE p.device = w.device AND window_start >= a AND window_start < b) as double) ELSE 1.0::double END AS score FROM w""",
)
def fault_vs_maintenance(spark, sf):
    e = table(spark, sf, "events")
    plans = e.where("event_type = 'signup'").select(F.col("user_id").alias("plan_device"), F.to_date("ts").alias("plan_start"), F.date_add(F.to_date("ts"), 2).alias("plan_end"))
    return sensor.planned_faults(windows(spark, sf), plans)


@query("sensor_multivariate")
def sensor_multivariate(spark, sf):
    w = windows(spark, sf).select("device", "channel", "window_start", sensor.mean(F.col("readings")).alias("m"))
    names = sorted(r[0] for r in w.select("channel").distinct().collect())
    wide = w.groupBy(F.pmod("device", F.lit(7)).alias("kind"), F.pmod("device", F.lit(35)).alias("device"), "window_start").pivot("channel", names).agg(F.avg("m"))
    return sensor.multivariate(wide, "kind", "device", "window_start", names)


@query("robust_scale", "WITH c AS (SELECT event_type, median(value) AS centre, count(value) AS n FROM events GROUP BY 1) SELECT event_type, n, round(centre, 6) AS centre, round(1.4826 * median(abs(value - centre)), 6) AS scale FROM events JOIN c USING (event_type) GROUP BY event_type, n, centre")
def robust_scale(spark, sf):
    return evaluate.mad(table(spark, sf, "events"), ["event_type"], "value").select("event_type", "n", F.round("centre", 6).alias("centre"), F.round("scale", 6).alias("scale"))


@query("volume_anomalies", "WITH d AS (SELECT event_type, cast(ts as date) AS day, count(*) AS n FROM events GROUP BY ALL), c AS (SELECT event_type, median(n) AS centre FROM d GROUP BY 1 HAVING count(*) >= 8), m AS (SELECT event_type, centre, 1.4826 * median(abs(n - centre)) AS scale FROM d JOIN c USING (event_type) GROUP BY ALL) SELECT event_type, day, n, CASE WHEN n > centre + 1.5 * scale THEN 'spike' ELSE 'drop' END AS kind FROM d JOIN m USING (event_type) WHERE scale > 0 AND (n > centre + 1.5 * scale OR n < greatest(0, centre - 1.5 * scale))")
def volume_anomalies(spark, sf):
    d = table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return lake.volume_anomalies(d, "event_type", "day", "n", width=1.5)


@query(
    "psi_events",
    """WITH o AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS half FROM events), b AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS k, count(*) OVER () AS n FROM events, o WHERE ts < half),
e AS (SELECT list(DISTINCT value) AS x FROM b WHERE k IN (SELECT least(cast(floor(n * i / 10.0) as bigint), n - 1) FROM (SELECT max(n) AS n FROM b), range(1, 10) t(i))),
v AS (SELECT ts < half AS base, len(list_filter(x, lambda c: value >= c)) AS bin FROM events, o, e),
s AS (SELECT bin, count(*) FILTER (WHERE base) / cast((SELECT count(*) FROM v WHERE base) as double) AS p, count(*) FILTER (WHERE NOT base) / cast((SELECT count(*) FROM v WHERE NOT base) as double) AS q FROM v GROUP BY bin),
r AS (SELECT sum((greatest(q, 1e-6) - greatest(p, 1e-6)) * ln(greatest(q, 1e-6) / greatest(p, 1e-6))) AS psi, count(*) AS n_bins FROM s)
SELECT round(psi, 6) AS psi, n_bins, CASE WHEN psi > 0.25 THEN 'significant' WHEN psi > 0.10 THEN 'moderate' ELSE 'stable' END AS level FROM r""",
)
def psi_events(spark, sf):
    e = table(spark, sf, "events").select(F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "value")
    lo, hi = e.agg(F.min("us"), F.max("us")).first()
    half = lo + (hi - lo) / 2
    return evaluate.psi(e.where(F.col("us") < half), e.where(F.col("us") >= half), "value")


@query("score_p50", "SELECT event_type, min(value) AS score_min, median(value) AS score_p50, max(value) AS score_max, count(*) FILTER (WHERE value IS NULL) AS n_unscored FROM events GROUP BY 1")
def score_p50(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.min("value").alias("score_min"), F.median("value").alias("score_p50"), F.max("value").alias("score_max"), F.count_if(F.col("value").isNull()).alias("n_unscored"))


# ---------------------------------------------------------------- lake

_OBS = "WITH ob AS (SELECT o_custkey AS device, cast(o_orderdate as date) AS day, min(o_orderpriority) AS attr FROM orders GROUP BY ALL), ch AS (SELECT *, lag(attr) OVER (PARTITION BY device ORDER BY day) AS p FROM ob), d AS (SELECT device, attr, day AS valid_from, lead(day) OVER (PARTITION BY device ORDER BY day) AS valid_to, row_number() OVER (PARTITION BY device ORDER BY day) AS version FROM ch WHERE p IS NULL OR p <> attr) "


def _dim(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("device"), F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("attr"))
    return lake.scd2(o, ["device"], ["attr"], "day")


@query("scd2_dimension", _OBS + "SELECT device, attr, valid_from, valid_to, version, valid_to IS NULL AS is_current FROM d")
def scd2_dimension(spark, sf):
    return _dim(spark, sf).select("device", "attr", "valid_from", "valid_to", F.col("version").cast("long").alias("version"), "is_current")


@query("scd2_pit_join", _OBS + "SELECT o_orderkey, attr, version FROM orders LEFT JOIN d ON device = o_custkey AND valid_from <= cast(o_orderdate as date) AND (valid_to IS NULL OR cast(o_orderdate as date) < valid_to)")
def scd2_pit_join(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("device"), F.to_date("o_orderdate").alias("day"))
    return lake.point_in_time(o, _dim(spark, sf), ["device"], "day").select("o_orderkey", "attr", F.col("version").cast("long").alias("version"))


@query("dim_changes", _OBS + ", g AS (SELECT device, valid_from AS changed_at, version, lag(attr) OVER (PARTITION BY device ORDER BY version) AS old, attr AS new FROM d) SELECT * FROM g WHERE version > 1")
def dim_changes(spark, sf):
    return lake.changes(_dim(spark, sf), ["device"], "attr").withColumn("version", F.col("version").cast("long"))


@query("dws_day", "SELECT event_type AS dataset, cast(ts as date) AS event_date, count(*) AS n_total, count(*) FILTER (WHERE value >= 10) AS n_kept, count(DISTINCT user_id) AS n_devices, round(avg(length(props)), 6) AS avg_len, median(length(props)) AS median_len, round(1 - count(*) FILTER (WHERE value >= 10) / cast(count(*) as double), 6) AS drop_rate FROM events GROUP BY ALL")
def dws_day(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy(F.col("event_type").alias("dataset"), F.to_date("ts").alias("event_date")).agg(F.count("*").alias("n_total"), F.count_if(F.col("value") >= 10).alias("n_kept"), F.count_distinct("user_id").alias("n_devices"), F.round(F.avg(F.length("props")), 6).alias("avg_len"), F.median(F.length("props")).alias("median_len"), F.round(1 - F.count_if(F.col("value") >= 10) / F.count("*"), 6).alias("drop_rate"))


@query("dws_op_day", "WITH s AS (SELECT cast(ts as date) AS d, event_type AS op, count(*) AS n_scored, median(value) AS p50 FROM events WHERE value >= 5 GROUP BY ALL), x AS (SELECT cast(ts as date) AS d, event_type AS op, count(*) AS n_dropped FROM events WHERE value < 10 GROUP BY ALL) SELECT coalesce(s.d, x.d) AS event_date, coalesce(s.op, x.op) AS op, coalesce(n_scored, 0) AS n_scored, coalesce(n_dropped, 0) AS n_dropped, round(n_dropped / nullif(cast(n_scored as double), 0), 6) AS drop_rate, round(p50, 6) AS score_p50 FROM s FULL OUTER JOIN x ON s.d = x.d AND s.op = x.op")
def dws_op_day(spark, sf):
    e = table(spark, sf, "events").select(F.to_date("ts").alias("event_date"), F.col("event_type").alias("op"), "value")
    s = e.where("value >= 5").groupBy("event_date", "op").agg(F.count("*").alias("a"), F.median("value").alias("p50"))
    x = e.where("value < 10").groupBy("event_date", "op").agg(F.count("*").alias("b"))
    z = F.lit(0).cast("long")
    return s.join(x, ["event_date", "op"], "full_outer").select("event_date", "op", F.coalesce("a", z).alias("n_scored"), F.coalesce("b", z).alias("n_dropped"), F.round(F.try_divide("b", "a"), 6).alias("drop_rate"), F.round("p50", 6).alias("score_p50"))


@query("ads_health", "SELECT event_type AS dataset, count(*) AS n_total, min(cast(ts as date)) AS first_event_date, max(cast(ts as date)) AS last_event_date, count(DISTINCT cast(ts as date)) AS n_partitions, date_diff('day', max(cast(ts as date)), date '2030-01-01') AS freshness_days, count(DISTINCT user_id) AS n_devices FROM events GROUP BY 1")
def ads_health(spark, sf):
    d = F.to_date("ts")
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("dataset")).agg(F.count("*").alias("n_total"), F.min(d).alias("first_event_date"), F.max(d).alias("last_event_date"), F.count_distinct(d).alias("n_partitions"), F.datediff(F.lit("2030-01-01").cast("date"), F.max(d)).cast("long").alias("freshness_days"), F.count_distinct("user_id").alias("n_devices"))


@query("contract_checks", "SELECT 'required' AS rule, 'text' AS \"column\", count(*) FILTER (WHERE text IS NULL OR text = '') AS n_bad, n_bad = 0 AS ok FROM documents UNION ALL SELECT 'unique', 'doc_id', count(doc_id) - count(DISTINCT doc_id), count(doc_id) = count(DISTINCT doc_id) FROM documents UNION ALL SELECT 'allowed', 'lang', count(*) FILTER (WHERE lang IS NOT NULL AND lang NOT IN ('en', 'fr', 'de')), count(*) FILTER (WHERE lang NOT IN ('en', 'fr', 'de')) = 0 FROM documents UNION ALL SELECT 'max_len', 'text', count(*) FILTER (WHERE length(text) > 5000), count(*) FILTER (WHERE length(text) > 5000) = 0 FROM documents UNION ALL SELECT 'min_value', 'n_chars', count(*) FILTER (WHERE n_chars < 20), count(*) FILTER (WHERE n_chars < 20) = 0 FROM documents")
def contract_checks(spark, sf):
    return lake.check_contract(table(spark, sf, "documents"), [{"column": "text", "required": True}, {"column": "doc_id", "unique": True}, {"column": "lang", "allowed": ["en", "fr", "de"]}, {"column": "text", "max_len": 5000}, {"column": "n_chars", "min_value": 20}])


@query("map_explode")
def map_explode(spark, sf):
    return table(spark, sf, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("op", "score"))


# ---------------------------------------------------------------- vectors and sampling


@query("cosine_topk", "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: cast(x as double)) AS v FROM embeddings), s AS (SELECT q.vec_id AS query_id, c.vec_id AS id, list_cosine_similarity(q.v, c.v) AS score FROM e q, e c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id) SELECT query_id, id, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s) WHERE rank <= 5")
def cosine_topk(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = vectors.search_rows(e, e.where("id % 50 = 0"), 6).where("id <> query_id").drop("rank")
    return vectors.topk(found, 5).select("query_id", "id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query("tie_rank", "WITH s AS (SELECT user_id AS query_id, event_id AS id, floor(value) AS score FROM events), t AS (SELECT query_id, score AS t FROM s WHERE id IN (SELECT min(event_id) FROM events GROUP BY user_id)) SELECT s.query_id, count(*) FILTER (WHERE score >= t) AS rank FROM s JOIN t USING (query_id) GROUP BY 1")
def tie_rank(spark, sf):
    s = table(spark, sf, "events").select(F.col("user_id").alias("query_id"), F.col("event_id").alias("id"), F.floor("value").alias("score"))
    t = s.groupBy(F.col("query_id").alias("q")).agg(F.min("id").alias("target"))
    return vectors.pessimistic_rank(s, t)


@query("recall_mrr", "WITH s AS (SELECT user_id AS query_id, event_id AS id, floor(value) AS score FROM events), t AS (SELECT query_id, score AS t FROM s WHERE id IN (SELECT min(event_id) FROM events GROUP BY user_id)), r AS (SELECT s.query_id, count(*) FILTER (WHERE score >= t) AS rank FROM s JOIN t USING (query_id) GROUP BY 1) SELECT count(*) AS n, round(avg(cast(rank <= 1 as double)), 6) AS recall_at_1, round(avg(cast(rank <= 5 as double)), 6) AS recall_at_5, round(avg(cast(rank <= 10 as double)), 6) AS recall_at_10, round(avg(1.0 / rank), 6) AS mrr FROM r")
def recall_mrr(spark, sf):
    return evaluate.retrieval(tie_rank(spark, sf))


@query("semantic_prune")
def semantic_prune(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return vectors.prune_clusters(e, 0.3)


@query("stratified_quota")
def stratified_quota(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang")
    return sampling.stratified_sample(d, "lang", 200, {"fr": 1.5})


@query("random_sample")
def random_sample(spark, sf):
    return sampling.random_sample(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang"), 100)


@query("text_minhash")
def text_minhash(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return dedup.near_duplicates(d)


@query("minhash_greedy")
def minhash_greedy(spark, sf):
    every = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    compared = F.coalesce(F.length("text") >= 8, F.lit(False))  # the reference compares no shorter texts, and keeps them
    return dedup.greedy_duplicates(every.where(compared)).unionByName(every.where(~compared).select("id", F.lit(True).alias("kept")))


@query("alerts", "SELECT event_type AS kind, CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS dataset, CASE max(CASE WHEN value < 5 THEN 1 WHEN value < 50 THEN 2 ELSE 3 END) WHEN 1 THEN 'info' WHEN 2 THEN 'warning' ELSE 'error' END AS severity, count(*) AS n, max(ts) AS last_at FROM events GROUP BY ALL")
def alerts(spark, sf):
    e = table(spark, sf, "events")
    v = F.col("value")
    return lake.converge_alerts(e.select(F.col("event_type").alias("kind"), F.when(F.pmod("user_id", F.lit(2)) == 0, "even").otherwise("odd").alias("dataset"), F.when(v < 5, "info").when(v < 50, "warning").otherwise("error").alias("severity"), F.col("ts").alias("at")))


@query("sensor_envelopes")
def sensor_envelopes(spark, sf):
    return sensor.envelopes(windows(spark, sf).groupBy("channel", "window_start").agg(F.flatten(F.collect_list("readings")).alias("readings")), ["channel"], max_violation=0.5)
