"""Queries that judge the text funnel and sensor checks against labels and baselines."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.functions import text as T
from gristmill.operators import detection, funnel
from gristmill.plans import event_queries as E
from gristmill.plans import text_queries as X
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


_FORM = "CASE WHEN quality = 0 THEN 'low_quality' WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END"
_BY = "CASE seq " + " ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(X._OPS)) + " END"
_LABELLED = X._FUNNEL + f", l AS (SELECT g.doc_id, seq, {_BY} AS dropped_by, {_FORM} AS form, h, quality, toxic FROM g JOIN labels USING (doc_id))"
_RECALL = _LABELLED + ", fr AS (SELECT form, count(*) AS n, count(*) FILTER (WHERE seq < 5) AS caught, count(*) FILTER (WHERE seq = 5) AS dedup_only, count(*) FILTER (WHERE seq IS NULL) AS kept FROM l GROUP BY form), k AS (SELECT *, round((caught + CASE WHEN form = 'clean' THEN dedup_only ELSE 0 END) / cast(n as double), 6) AS rate FROM fr)"


def _form():
    return F.when(F.col("quality") == 0, "low_quality").when(F.col("toxic") == 1, "toxic").otherwise("clean")


def _labelled(spark, sf):
    return X._funnel(spark, sf).join(table(spark, sf, "labels"), "doc_id").withColumn("form", _form())


@query("form_recall", _RECALL + " SELECT * FROM k")
def form_recall(spark, sf):
    return detection.form_recall(_labelled(spark, sf), "form")


LEVELS = {"low_quality": (0.9, 0.3), "toxic": (0.5, None)}


@query(
    "slo_judgement",
    _RECALL
    + """, c AS (SELECT form, round(count(DISTINCT h) / cast(count(*) as double), 4) AS ceiling FROM l GROUP BY form),
sl AS (SELECT k.*, ceiling, CASE WHEN form = 'low_quality' THEN 0.9::double END AS target, CASE WHEN form = 'low_quality' THEN 0.3::double END AS budget FROM k LEFT JOIN c USING (form))
SELECT *, CASE WHEN budget IS NULL THEN 'NO_SLO' WHEN 1 - rate <= budget THEN 'PASS' WHEN rate >= ceiling - 5e-4 THEN 'CEILING' ELSE 'BREACH' END AS verdict FROM sl""",
)
def slo_judgement(spark, sf):
    run = _labelled(spark, sf)
    texts = table(spark, sf, "documents").select("doc_id", "text").join(table(spark, sf, "labels"), "doc_id").withColumn("form", _form())
    return detection.judge_levels(detection.form_recall(run, "form"), LEVELS, detection.ceilings(texts, "form"))


_FLAGS = {"doc_length": "doc_length < 30 OR doc_length > 50000", "line_repetition": "line_repetition < 0.8", "char_repetition": "char_repetition < 0.8", "boilerplate": "boilerplate < 0.8", "pii_detect": "pii_detect < 0.9"}


@query(
    "operator_pr",
    X._FUNNEL
    + ", l AS (SELECT g.*, quality = 0 AS low, toxic = 1 AS toxic_ FROM g JOIN labels USING (doc_id)) "
    + " UNION ALL ".join(
        f"SELECT '{o}' AS op, count(*) FILTER (WHERE {f}) AS n_flagged, round(coalesce(count(*) FILTER (WHERE ({f}) AND (low OR toxic_)) / nullif(cast(count(*) FILTER (WHERE {f}) as double), 0), 0.0), 4) AS precision, round(coalesce(count(*) FILTER (WHERE ({f}) AND low) / nullif(cast(count(*) FILTER (WHERE low) as double), 0), 0.0), 4) AS recall_low, round(coalesce(count(*) FILTER (WHERE ({f}) AND toxic_) / nullif(cast(count(*) FILTER (WHERE toxic_) as double), 0), 0.0), 4) AS recall_toxic FROM l"
        for o, f in _FLAGS.items()
    ),
)
def operator_pr(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text").join(table(spark, sf, "labels"), "doc_id")
    d = d.select("text", F.coalesce(F.col("quality") == 0, F.lit(False)).alias("low"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"))
    return detection.alone(d, funnel.TEXT_FUNNEL, ["low", "toxic"])


@query("funnel_by_form", _LABELLED + " SELECT form, coalesce(dropped_by, 'kept') AS stage, count(*) AS n FROM l GROUP BY ALL")
def funnel_by_form(spark, sf):
    return _labelled(spark, sf).groupBy("form", F.coalesce("dropped_by", F.lit("kept")).alias("stage")).agg(F.count("*").alias("n"))


@query("drop_samples", X._FUNNEL + f", d AS (SELECT doc_id, {_BY} AS dropped_by FROM g WHERE seq IS NOT NULL), dr AS (SELECT *, row_number() OVER (PARTITION BY dropped_by ORDER BY doc_id) AS k FROM d) SELECT dropped_by, count(*) AS n, list(doc_id ORDER BY doc_id) FILTER (WHERE k <= 3) AS samples FROM dr GROUP BY dropped_by")
def drop_samples(spark, sf):
    from pyspark.sql import Window

    d = X._funnel(spark, sf).where("dropped_by is not null").select("doc_id", "dropped_by")
    few = d.withColumn("k", F.row_number().over(Window.partitionBy("dropped_by").orderBy("doc_id"))).where("k <= 3").groupBy("dropped_by").agg(F.array_sort(F.collect_list("doc_id")).alias("samples"))
    return d.groupBy("dropped_by").agg(F.count("*").alias("n")).join(few, "dropped_by")


@query(
    "drop_review",
    X._FUNNEL
    + " UNION ALL ".join(
        f"SELECT doc_id, '{o}' AS op, {'cast(NULL as double)' if o == 'exact_text' else f'round({o}, 6)'} AS score, "
        + ("'batch_drop_no_score'" if o == "exact_text" else f"CASE WHEN {o} < {low} THEN 'score_below_min' ELSE 'score_above_max' END")
        + f" AS rule FROM g WHERE seq = {i}"
        for i, (o, low) in enumerate(zip(X._OPS, (30, 0.8, 0.8, 0.8, 0.9, 0), strict=True))
    ),
)
def drop_review(spark, sf):
    v = funnel.verdicts(X._funnel(spark, sf), funnel.TEXT_FUNNEL, "doc_id").where("decision = 'drop'")
    return v.select("doc_id", "op", F.round("score", 6).alias("score"), "rule")


@query("op_scores_long", X._FUNNEL + " UNION ALL ".join(f"SELECT doc_id, '{o}' AS op, round({o}, 6) AS score FROM g WHERE (seq IS NULL OR seq >= {i})" for i, o in enumerate(X._OPS[:-1])))
def op_scores_long(spark, sf):
    v = funnel.verdicts(X._funnel(spark, sf), funnel.TEXT_FUNNEL, "doc_id").where("score is not null")
    return v.select("doc_id", "op", F.round("score", 6).alias("score"))


@query("parameter_grid", "WITH d AS (SELECT doc_length, line_repetition, quality FROM (" + X._SCORES + ") JOIN labels USING (doc_id)) SELECT cast(a as double) AS a, cast(b as double) AS b, count(*) FILTER (WHERE doc_length < a OR line_repetition < b) AS n_flagged, count(*) FILTER (WHERE (doc_length < a OR line_repetition < b) AND quality = 0) AS caught FROM d, (VALUES (30), (100), (300)) x(a), (VALUES (0.5), (0.8), (0.95)) y(b) GROUP BY ALL")
def parameter_grid(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    d = d.select("quality", F.inline(F.array(F.struct(T.doc_length("text").alias("n"), T.line_repetition("text").alias("r")))))
    return detection.grid(d, lambda a, b: (F.col("n") < a) | (F.col("r") < b), [30, 100, 300], [0.5, 0.8, 0.95], F.col("quality") == 0)


_CURVE = "SELECT cast(t as double) AS threshold, round(count(*) FILTER (WHERE n_chars < t) / nullif(cast(count(n_chars) as double), 0), 6) AS rate FROM {0}, (VALUES (100), (500), (1000), (5000)) v(t) GROUP BY t"


@query("threshold_gate", "WITH a AS (" + _CURVE.format("documents") + "), e AS (SELECT * FROM documents WHERE lang = 'en'), b AS (" + _CURVE.format("e") + ") SELECT threshold, a.rate, b.rate AS frozen_rate, coalesce(abs(a.rate - b.rate) <= 0.02, a.rate IS NULL AND b.rate IS NULL) AS ok FROM a FULL OUTER JOIN b USING (threshold)")
def threshold_gate(spark, sf):
    d = table(spark, sf, "documents")
    return detection.gate(detection.curve(d, "n_chars", [100, 500, 1000, 5000]), detection.curve(d.where("lang = 'en'"), "n_chars", [100, 500, 1000, 5000]), 0.02)


_U = "list_reduce(list_transform(string_split(substr(sha256(seed || ':' || doc_id), 1, 8), ''), lambda c: cast(strpos('0123456789abcdef', c) - 1 as bigint)), lambda a, b: a * 16 + b) % 10000 / 10000.0"


@query(
    "random_drop_baseline",
    f"WITH d AS (SELECT seed, quality = 0 AS dirty FROM documents JOIN labels USING (doc_id), range(0, 10) s(seed) WHERE {_U} < 0.1), p AS (SELECT seed, count(*) FILTER (WHERE dirty) / cast(count(*) as double) AS p FROM d GROUP BY seed) SELECT count(p) AS n, round(avg(p), 6) AS mean, round(stddev_samp(p), 6) AS std, round(avg(p) - 1.96 * stddev_samp(p) / sqrt(count(p)), 6) AS low, round(avg(p) + 1.96 * stddev_samp(p) / sqrt(count(p)), 6) AS high, round(min(p), 6) AS least, round(max(p), 6) AS most FROM p",
)
def random_drop_baseline(spark, sf):
    d = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id")
    return detection.drop_summary(detection.random_drops(d, "doc_id", F.col("quality") == 0, 0.1, range(10)))


@query("noise_floor", "WITH m AS (SELECT event_type, user_id % 3 AS seed, avg(value) AS v FROM events GROUP BY ALL), g AS (SELECT event_type, max(v) - min(v) AS spread, avg(v) AS m FROM m GROUP BY 1) SELECT round(max(spread), 6) AS floor, round(max(m) - min(m), 6) AS difference, CASE WHEN max(m) - min(m) > max(spread) THEN 'differs' ELSE 'within_noise' END AS verdict FROM g")
def noise_floor(spark, sf):
    m = table(spark, sf, "events").groupBy("event_type", F.pmod("user_id", F.lit(3)).alias("seed")).agg(F.avg("value").alias("v"))
    return detection.noise_floor(m, "event_type", "v")


@query(
    "parity_gate",
    X._FUNNEL + ", a AS (SELECT CASE WHEN lang = 'en' THEN 'clean' WHEN lang = 'fr' THEN 'synth' ELSE 'dirty' END AS arm, count(*) AS n, count(seq) AS f FROM g JOIN documents USING (doc_id) GROUP BY 1), ra AS (SELECT min(n) AS n, max(f / cast(n as double)) FILTER (WHERE arm = 'clean') AS clean, max(f / cast(n as double)) FILTER (WHERE arm = 'synth') AS synth, max(f / cast(n as double)) FILTER (WHERE arm = 'dirty') AS dirty FROM a) SELECT round(clean, 6) AS clean, round(synth, 6) AS synth, round(dirty, 6) AS dirty, CASE WHEN n < 30 THEN 'TOO_FEW' WHEN synth > clean + 0.01 THEN 'SYNTH_FLAGGED' WHEN dirty < 5 * clean THEN 'DIRTY_MISSED' ELSE 'PASS' END AS verdict FROM ra",
)
def parity_gate(spark, sf):
    """The gate over the languages as arms, as the tables hold no synthesised rows."""
    run = X._funnel(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    arm = F.when(F.col("lang") == "en", "clean").when(F.col("lang") == "fr", "synth").otherwise("dirty")
    return detection.parity(run.groupBy(arm.alias("arm")).agg(F.count("*").alias("n"), F.count("dropped_seq").alias("n_flagged")))


_STUCK = "WITH z AS (" + E.O["stuck_runs"] + ") "


@query("unscored_windows", _STUCK + ", g AS (SELECT device, channel, count(*) AS n, count(*) FILTER (WHERE score IS NULL) AS u FROM z GROUP BY ALL) SELECT cast(sum(n) as bigint) AS n_windows, cast(sum(u) as bigint) AS n_unscored, round(sum(u) / cast(sum(n) as double), 6) AS unscored_rate, count(*) AS n_channels, count(*) FILTER (WHERE n = u) AS n_channels_unscored FROM g")
def unscored_windows(spark, sf):
    return detection.unscored(E.stuck_runs(spark, sf), ["device", "channel"])


@query("reachability", E._W + ", g AS (SELECT device, channel, count(*) AS n FROM w GROUP BY ALL) SELECT 'stuck' AS \"check\", 10::bigint AS needs, count(*) AS n_groups, count(*) FILTER (WHERE n < 10) AS n_short FROM g UNION ALL SELECT 'drift', 6, count(*), count(*) FILTER (WHERE n < 6) FROM g UNION ALL SELECT 'envelope', 5, count(*), count(*) FILTER (WHERE n < 5) FROM g")
def reachability(spark, sf):
    return detection.reachability(E.windows(spark, sf), ["device", "channel"], {"stuck": 10, "drift": 6, "envelope": 5})


@query("routing_effect", "WITH s AS (SELECT doc_id, n_chars, cast(n_chars >= 200 AND n_chars < 2000 as bigint) AS llm FROM documents) SELECT count(*) AS n, count(*) FILTER (WHERE llm = 1 OR n_chars >= 200) AS n_preserved, count(*) * 2 AS calls_before, cast(sum(1 + llm) as bigint) AS calls_after, round(1 - sum(1 + llm) / cast(count(*) * 2 as double), 6) AS saved FROM s")
def routing_effect(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    asked = (F.col("n_chars") >= 200) & (F.col("n_chars") < 2000)
    full = d.select("doc_id", F.lit(2).cast("long").alias("calls"), (F.col("n_chars") >= 200).cast("double").alias("value"))
    routed = d.select("doc_id", (1 + asked.cast("long")).alias("calls"), F.when(asked | (F.col("n_chars") >= 200), (F.col("n_chars") >= 200).cast("double")).otherwise(F.lit(1.0)).alias("value"))
    return detection.routing_effect(full, routed, "doc_id", "value")
