"""Queries over sample files, lake partitions and warehouse layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.operators import evaluate, funnel, lake, tuning, warehouse
from gristmill.plans import event_queries as E
from gristmill.plans import text_queries as X
from gristmill.plans.store import new_path
from gristmill.sources import samples
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


# ---------------------------------------------------------------- files


@query("jsonl_roundtrip", "SELECT doc_id, sha256(coalesce(text, '')) AS digest, lang, n_chars FROM documents")
def jsonl_roundtrip(spark, sf):
    path = new_path(spark, "jsonl")
    table(spark, sf, "documents").write.json(path)
    back = samples.read_jsonl(spark, path, "doc_id long, text string, lang string, source string, n_chars long")
    return back.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"), "lang", "n_chars")


@query("outcome_sink", X._FUNNEL + "SELECT CASE WHEN seq IS NULL THEN 'cleaned' ELSE 'dropped' END AS kind, coalesce(" + "CASE seq " + " ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(X._OPS)) + " END, '') AS dropped_by, count(*) AS n, cast(sum(doc_id) as bigint) AS ids FROM g GROUP BY ALL")
def outcome_sink(spark, sf):
    path = new_path(spark, "outcome")
    samples.write_outcome(X._funnel(spark, sf).select("doc_id", "dropped_seq", "dropped_by"), path)
    sources = [samples.Source("texts", k, f"{path}/{k}") for k in ("cleaned", "dropped")]
    back = samples.read_sources(spark, sources, "doc_id long, dropped_by string")
    return back.groupBy("kind", F.coalesce("dropped_by", F.lit("")).alias("dropped_by")).agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query("upload_check", "SELECT count(*) AS n_lines, count(*) FILTER (WHERE lang = 'fr') AS n_bad, count(*) FILTER (WHERE lang IS DISTINCT FROM 'fr' AND trim(coalesce(text, '')) = '') AS empty_text, count(*) FILTER (WHERE lang IS DISTINCT FROM 'fr' AND coalesce(lang, '') = '') AS empty_lang, false AS ok FROM documents")
def upload_check(spark, sf):
    """The documents as lines, those in one language cut in their middle."""
    d = table(spark, sf, "documents")
    line = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.lit("line").alias("what"), "text", "lang"))
    lines = d.select(F.when(F.col("lang") == "fr", F.substring(line, 1, 14)).otherwise(line).alias("value"))
    return samples.check_upload(samples.parse_lines(lines, "id string, text string, lang string"), ["text", "lang"], ["id", "text", "lang"])


def _lake(spark, sf):
    path = new_path(spark, "lake")
    lake.write_partitions(table(spark, sf, "documents").select("doc_id", "n_chars", F.coalesce("lang", F.lit("unknown")).alias("lang")), path, ["lang"])
    return path


@query("lake_scan", "SELECT doc_id, n_chars, lang FROM documents WHERE lang = 'de' AND n_chars > 500")
def lake_scan(spark, sf):
    return samples.scan(spark, _lake(spark, sf), (F.col("lang") == "de") & (F.col("n_chars") > 500)).select("doc_id", "n_chars", "lang")


@query("lake_partitions", "SELECT coalesce(lang, 'unknown') AS lang, count(*) AS n_rows, lang IS NULL AS is_undated FROM documents GROUP BY ALL")
def lake_partitions(spark, sf):
    return samples.partitions(samples.scan(spark, _lake(spark, sf)), ["lang"]).select("lang", "n_rows", "is_undated")


@query("prune_report")
def prune_report(spark, sf):
    return samples.prune_report(samples.scan(spark, _lake(spark, sf)), F.col("lang") == "de")


# ---------------------------------------------------------------- layers


@query("ods_samples", X._FUNNEL + "SELECT g.doc_id, coalesce(lang, 'unknown') AS dataset, length(coalesce(text, '')) AS text_len, len(regexp_extract_all(coalesce(text, ''), '[\\x{4E00}-\\x{9FFF}]')) AS chars_han, h AS text_md5, seq IS NULL AS is_kept, CASE seq " + " ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(X._OPS)) + " END AS dropped_by FROM g JOIN documents USING (doc_id)")
def ods_samples(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return warehouse.ods(d, X._funnel(spark, sf), "doc_id", F.coalesce("lang", F.lit("unknown"))).drop("scores_json")


@query("ods_increment", "SELECT event_type, count(*) AS n FROM events WHERE cast(ts as date) NOT IN (SELECT cast(ts as date) FROM events WHERE event_type = 'signup' AND value < 0.2) GROUP BY 1")
def ods_increment(spark, sf):
    e = table(spark, sf, "events").select("event_type", "value", F.to_date("ts").alias("day"))
    return warehouse.missing_days(e, e.where("event_type = 'signup' and value < 0.2"), "day").groupBy("event_type").agg(F.count("*").alias("n"))


@query("dwd_match", E._OBS + ", j AS (SELECT c_custkey, version FROM customer LEFT JOIN d ON device = c_custkey AND valid_from <= date '1996-06-30' AND (valid_to IS NULL OR date '1996-06-30' < valid_to)) SELECT count(*) AS n_total, count(*) FILTER (WHERE c_custkey IS NULL) AS n_no_key, count(*) FILTER (WHERE c_custkey IS NOT NULL AND version IS NULL) AS n_unmatched FROM j")
def dwd_match(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("device"), F.lit("1996-06-30").cast("date").alias("day"))
    return warehouse.match_counts(lake.point_in_time(c, E._dim(spark, sf), ["device"], "day"), "version", "device")


@query("warehouse_views", "SELECT 'ods_documents' AS \"view\", 5 AS n_columns, (SELECT count(*) = 0 FROM documents) AS is_empty UNION ALL SELECT 'ods_labels', 3, (SELECT count(*) = 0 FROM labels) UNION ALL SELECT 'ods_media', 2, true UNION ALL SELECT 'texts', 5, (SELECT count(*) = 0 FROM documents)")
def warehouse_views(spark, sf):
    return warehouse.views(spark, {"ods_documents": (table(spark, sf, "documents"), ""), "ods_labels": (table(spark, sf, "labels"), ""), "ods_media": (None, "id long, audio binary")}, {"texts": "ods_documents"})


@query("scalar_subquery", "SELECT doc_id, n_chars FROM documents d WHERE n_chars > 2 * (SELECT avg(n_chars) FROM documents x WHERE x.lang = d.lang)")
def scalar_subquery(spark, sf):
    return spark.sql("SELECT doc_id, n_chars FROM {d} d WHERE n_chars > 2 * (SELECT avg(n_chars) FROM {d} x WHERE x.lang = d.lang)", d=table(spark, sf, "documents").select("doc_id", "lang", "n_chars"))


@query("row_band_alert", "WITH d AS (SELECT event_type, cast(ts as date) AS day, count(*) AS n FROM events GROUP BY ALL), m AS (SELECT *, median(n) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS typical FROM d) SELECT event_type, day, n, typical, coalesce(n < 0.9 * typical, false) AS low FROM m")
def row_band_alert(spark, sf):
    d = table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return warehouse.band_alert(d, "event_type", "day", "n", ratio=0.9)


@query("group_shares", "WITH g AS (SELECT source, count(*) AS n, min(n_chars) AS worst, avg(n_chars) AS m FROM documents GROUP BY 1) SELECT source, n, worst, round(m, 6) AS mean, ntile(4) OVER (ORDER BY m, source) AS tile, round(sum(n) OVER (ORDER BY m, source) / (SELECT cast(sum(n) as double) FROM g), 6) AS cumulative FROM g")
def group_shares(spark, sf):
    return warehouse.shares(table(spark, sf, "documents"), "source", "n_chars")


_PER_OP = X._FUNNEL + ", v AS (" + " UNION ALL ".join(f"SELECT coalesce(lang, '?') AS dataset, '{o}' AS op, count({o if o != 'exact_text' else 'NULL'}) AS n_scored, count(*) FILTER (WHERE seq = {i}) AS n_dropped FROM g JOIN documents USING (doc_id) WHERE seq IS NULL OR seq >= {i} GROUP BY 1" for i, o in enumerate(X._OPS)) + ")"
_DIMENSIONS = {"form": ["doc_length", "line_repetition", "char_repetition"], "safety": ["boilerplate", "pii_detect", "perplexity"], "uniqueness": ["exact_text"]}
_CARD = _PER_OP + ", w AS (SELECT dataset, dimension, t.op FROM (SELECT DISTINCT dataset FROM v) v0, (VALUES " + ", ".join(f"('{d}', '{o}')" for d, ops in _DIMENSIONS.items() for o in ops) + ") t(dimension, op)), sc AS (SELECT w.dataset, dimension, count(*) AS ops_total, count(*) FILTER (WHERE n_scored > 0 OR n_dropped > 0) AS ops_evaluated, sum(n_scored) FILTER (WHERE n_scored > 0 OR n_dropped > 0) AS s, sum(n_dropped) FILTER (WHERE n_scored > 0 OR n_dropped > 0) AS d FROM w LEFT JOIN v ON v.dataset = w.dataset AND v.op = w.op GROUP BY ALL), cd AS (SELECT dataset, dimension, ops_total, ops_evaluated, CASE WHEN s > 0 THEN round(greatest(s - coalesce(d, 0), 0) / cast(s as double), 6) END AS score FROM sc)"


def _card(spark, sf):
    v = funnel.verdicts(X._funnel(spark, sf), funnel.TEXT_FUNNEL, "doc_id").join(table(spark, sf, "documents").select("doc_id", F.coalesce("lang", F.lit("?")).alias("dataset")), "doc_id")
    per_op = v.groupBy("dataset", "op").agg(F.count("score").alias("n_scored"), F.count_if(F.col("decision") == "drop").alias("n_dropped"))
    return warehouse.scorecard(per_op, _DIMENSIONS, {"form": 0.9, "safety": 0.99})


@query("scorecard", _CARD + " SELECT *, CASE WHEN score IS NULL OR dimension = 'uniqueness' THEN 'UNKNOWN' WHEN score >= CASE dimension WHEN 'form' THEN 0.9 ELSE 0.99 END THEN 'PASS' ELSE 'BREACH' END AS status FROM cd")
def scorecard(spark, sf):
    return _card(spark, sf)


@query("dataset_health", _CARD + " SELECT dataset, round(sum(score * ops_evaluated) / cast(sum(ops_evaluated) FILTER (WHERE score IS NOT NULL) as double), 6) AS health, round(sum(ops_evaluated) / cast(sum(ops_total) as double), 6) AS coverage FROM cd GROUP BY dataset")
def dataset_health(spark, sf):
    return warehouse.dataset_health(_card(spark, sf))


_STATUS = "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'RUNNING' WHEN 'click' THEN 'TIMEOUT' ELSE 'SUCCESS' END"


@query("pipeline_health", f"WITH r AS (SELECT {_STATUS} AS status FROM events) SELECT count(*) AS n_runs, count(*) FILTER (WHERE status = 'RUNNING') AS n_running, count(*) FILTER (WHERE status <> 'RUNNING') AS n_terminal, round(count(*) FILTER (WHERE status = 'SUCCESS') / cast(count(*) FILTER (WHERE status <> 'RUNNING') as double), 6) AS success_rate FROM r")
def pipeline_health(spark, sf):
    return warehouse.pipeline_health(table(spark, sf, "events").select(F.expr(_STATUS).alias("status")))


@query("watermarks", "SELECT event_type, max(ts) AS high FROM events GROUP BY 1")
def watermarks(spark, sf):
    e = table(spark, sf, "events")
    before = warehouse.watermarks(e.where("value < 10"), "event_type", "ts")
    return warehouse.watermarks(e.where("value >= 10"), "event_type", "ts", before)


@query("metric_verify", "WITH a AS (SELECT event_type AS name, round(avg(value), 6) AS value FROM events WHERE event_type <> 'view' GROUP BY 1), b AS (SELECT event_type AS name, CASE WHEN event_type = 'error' THEN NULL ELSE round(avg(value) + CASE WHEN event_type = 'click' THEN 1 ELSE 0 END, 6) END AS value FROM events WHERE event_type <> 'signup' GROUP BY event_type) SELECT coalesce(a.name, b.name) AS name, a.value, b.value AS frozen_value, CASE WHEN a.name IS NULL THEN 'gone' WHEN b.name IS NULL THEN 'new' WHEN a.value IS NULL OR b.value IS NULL THEN 'error' WHEN abs(a.value - b.value) <= 1e-9 THEN 'same' ELSE 'moved' END AS state FROM a FULL OUTER JOIN b ON a.name = b.name")
def metric_verify(spark, sf):
    m = table(spark, sf, "events").groupBy(F.col("event_type").alias("name")).agg(F.avg("value").alias("v"))
    now = m.where("name <> 'view'").select("name", F.round("v", 6).alias("value"))
    frozen = m.where("name <> 'signup'").select("name", F.when(F.col("name") != "error", F.round(F.col("v") + (F.col("name") == "click").cast("int"), 6)).alias("value"))
    return warehouse.verify_metrics(now, frozen)


@query("lineage_downstream", "WITH RECURSIVE e AS (SELECT DISTINCT cast(n_regionkey as varchar) AS src, 'n' || n_nationkey AS dst FROM nation UNION SELECT DISTINCT 'n' || c_nationkey, c_mktsegment FROM customer), r(node, depth) AS (SELECT '1', 0 UNION SELECT dst, depth + 1 FROM r JOIN e ON src = node) SELECT node, min(depth) AS depth FROM r WHERE depth > 0 GROUP BY node")
def lineage_downstream(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_regionkey").cast("string").alias("src"), F.concat(F.lit("n"), "n_nationkey").alias("dst"))
    c = table(spark, sf, "customer").select(F.concat(F.lit("n"), "c_nationkey").alias("src"), F.col("c_mktsegment").alias("dst"))
    return warehouse.reached(n.unionByName(c).distinct(), spark.createDataFrame([("1",)], "node string"))


# ---------------------------------------------------------------- sensors


@query("unit_consistency", "WITH c AS (SELECT user_id, event_type AS unit, count(*) AS n FROM events GROUP BY ALL), u AS (SELECT user_id, unit AS usual FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, unit) AS k FROM c) WHERE k = 1) SELECT event_id, cast(event_type = usual as double) AS score FROM events JOIN u USING (user_id)")
def unit_consistency(spark, sf):
    from gristmill.operators import sensor

    e = table(spark, sf, "events").select("event_id", "user_id", F.col("event_type").alias("unit"))
    return e.join(sensor.usual_value(e, ["user_id"], "unit"), "user_id").select("event_id", (F.col("unit") == F.col("usual")).cast("double").alias("score"))


@query(
    "count_windows",
    "WITH s AS (SELECT user_id, ts, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events), w AS (SELECT user_id, k * 8 AS start, value, ts FROM s, range(0, 1000000) r(k) WHERE k BETWEEN i // 8 - 1 AND i // 8 AND i >= k * 8 AND i < k * 8 + 16 AND k * 8 + 16 <= n) SELECT user_id, start, count(*) AS n, round(avg(value), 6) AS mean, min(ts) AS window_start, max(ts) AS window_end FROM w GROUP BY user_id, start",
)
def count_windows(spark, sf):
    """Windows of 16 readings every 8; what is left at the end makes none."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    s = table(spark, sf, "events").select("user_id", "ts", "value", (F.row_number().over(w) - 1).alias("i"), F.count("*").over(Window.partitionBy("user_id")).alias("n"))
    k = F.floor(F.col("i") / 8)
    s = s.select("user_id", "ts", "value", "n", F.explode(F.array((k - 1) * 8, k * 8)).alias("start")).where("start >= 0 and start + 16 <= n")
    return s.groupBy("user_id", "start").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.min("ts").alias("window_start"), F.max("ts").alias("window_end"))


@query("same_channel_runs", "WITH s AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS island FROM events) SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type, island) AS run_length, cast(count(*) OVER (PARTITION BY user_id, event_type, island) < 3 as double) AS score FROM s")
def same_channel_runs(spark, sf):
    """Runs of one leading channel: from three in a row on they are a defect of the channel, fewer are passing noise."""
    from pyspark.sql import Window

    order = lambda *k: F.row_number().over(Window.partitionBy(*k).orderBy("ts", "event_id"))
    s = table(spark, sf, "events").withColumn("island", order("user_id") - order("user_id", "event_type"))
    n = F.count("*").over(Window.partitionBy("user_id", "event_type", "island"))
    return s.select("event_id", n.alias("run_length"), (n < 3).cast("double").alias("score"))


@query("extract_summary", f"WITH n AS (SELECT lower(regexp_extract(url, '^([a-z]+)://', 1)) AS scheme, length({X._NOISE}) AS n FROM pages), g AS (SELECT scheme, list_sort(list(n)) AS a FROM n GROUP BY 1) SELECT scheme, len(a) AS n_evaluated, a[cast(round_even(0.1 * (len(a) - 1), 0) as int) + 1] AS p10, a[cast(round_even(0.5 * (len(a) - 1), 0) as int) + 1] AS p50, a[cast(round_even(0.9 * (len(a) - 1), 0) as int) + 1] AS p90 FROM g")
def extract_summary(spark, sf):
    """Nearest-rank percentiles of what is left of pages; counted by length first, so no list of all pages is built."""
    from pyspark.sql import Window

    from gristmill.operators import extract

    p = table(spark, sf, "pages").select(F.lower(F.regexp_extract("url", "^([a-z]+)://", 1)).alias("scheme"), F.length(extract.strip_noise(F.col("html"))).alias("n"))
    c = p.groupBy("scheme", "n").agg(F.count("*").alias("c")).withColumn("hi", F.sum("c").over(Window.partitionBy("scheme").orderBy("n"))).withColumn("all", F.sum("c").over(Window.partitionBy("scheme")))
    at = lambda q: F.min(F.when(F.col("hi") > F.bround(q * (F.col("all") - 1)), F.col("n")))
    return c.groupBy("scheme").agg(F.max("all").alias("n_evaluated"), at(0.1).alias("p10"), at(0.5).alias("p50"), at(0.9).alias("p90"))


# ---------------------------------------------------------------- tuning rows

_FACTS = "SELECT doc_id, list_filter(list_transform(flatten(list_transform(string_split(substr(coalesce(text, ''), 1, 500), chr(10))[2:], lambda l: string_split(regexp_replace(l, '([。！？])', '\\1' || chr(1), 'g'), chr(1)))), lambda x: regexp_replace(x, '^" + X._WS + "+|" + X._WS + "+$', '', 'g')), lambda x: length(x) >= 15 AND regexp_matches(x, '[0-9%]|「[^」]+」|“[^”]+”')) AS facts FROM documents"


@query("fact_sentences", f"SELECT * FROM ({_FACTS}) WHERE len(facts) > 0")
def fact_sentences(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tuning.facts(F.col("text")).alias("facts")).where(F.size("facts") > 0)


@query("number_swap", f"SELECT doc_id, facts[1] AS fact, regexp_extract(facts[1], '^([^0-9]*[0-9]*)[0-9]', 1) || cast((cast(regexp_extract(facts[1], '^[^0-9]*[0-9]*([0-9])', 1) as int) + 1) % 10 as varchar) || substr(facts[1], length(regexp_extract(facts[1], '^([^0-9]*[0-9]*)[0-9]', 1)) + 2) AS swapped FROM ({_FACTS}) WHERE regexp_matches(coalesce(facts[1], ''), '[0-9]')")
def number_swap(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.get(tuning.facts(F.col("text")), F.lit(0)).alias("fact")).where(F.col("fact").rlike(r"\d"))
    return d.select("doc_id", "fact", tuning.swap_number(F.col("fact")).alias("swapped"))


@query("corrupted_facts")
def corrupted_facts(spark, sf):
    return tuning.corrupt_facts(fact_sentences(spark, sf), "doc_id", "facts")


_VARIANTS = f"SELECT doc_id, p[1] || chr(10) || chr(10) || p[2] AS s, text AS f FROM (SELECT doc_id, text, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: NOT regexp_full_match(x, '{X._WS}*')) AS p FROM documents) WHERE len(p) >= 3 AND len(list_filter(p[3:], lambda x: regexp_matches(x, '[0-9%「」“”]'))) > 0"


@query("text_variants", _VARIANTS)
def text_variants(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tuning.variants(F.col("text")).alias("v")).where("v is not null").select("doc_id", "v.*")


_HASH = "list_reduce(list_transform(string_split(substr(sha256({0}), 1, 8), ''), lambda c: cast(strpos('0123456789abcdef', c) - 1 as bigint)), lambda a, b: a * 16 + b) % 10000 / 10000.0"


@query("preference_pairs", f"WITH v AS ({_VARIANTS}), u AS (SELECT *, {_HASH.format(chr(39) + '0:place:' + chr(39) + ' || doc_id')} < 0.5 AS first FROM v) SELECT doc_id, sha256(CASE WHEN first THEN f ELSE s END) AS a, sha256(CASE WHEN first THEN s ELSE f END) AS b, CASE WHEN first THEN 'a' ELSE 'b' END AS chosen FROM u")
def preference_pairs(spark, sf):
    p = tuning.placed_pairs(text_variants(spark, sf), "doc_id", "f", "s")
    return p.select("doc_id", F.sha2("a", 256).alias("a"), F.sha2("b", 256).alias("b"), "chosen")


_K = lambda what: _HASH.format(f"'0:{what}:' || doc_id")


@query("preference_split", f"WITH u AS (SELECT CASE WHEN {_K('split')} < 0.25 THEN 'eval' ELSE 'train' END AS split, {_K('control')} < 0.1 AS c FROM documents) SELECT split, c AND split = 'train' AS is_control, count(*) AS n FROM u GROUP BY ALL")
def preference_split(spark, sf):
    d = tuning.preference_split(table(spark, sf, "documents").select("doc_id"), "doc_id")
    return d.groupBy("split", "is_control").agg(F.count("*").alias("n"))


@query("sft_isolated", "SELECT doc_id FROM documents WHERE coalesce(source, '') NOT IN (SELECT coalesce(source, '') FROM documents d JOIN labels l USING (doc_id) WHERE toxic = 1) ")
def sft_isolated(spark, sf):
    """Documents of sources that the held-out benchmark (the toxic rows) does not draw from."""
    d = table(spark, sf, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"))
    used = d.join(table(spark, sf, "labels").where("toxic = 1"), "doc_id").select("source").distinct()
    return d.join(used, "source", "left_anti").select("doc_id")


_STRIPPED = X._STRIP


@query(
    "paraphrase",
    f"""WITH t AS (SELECT doc_id, {_STRIPPED} AS t FROM documents), b AS (SELECT doc_id, regexp_extract(t, '[。．.!?！？：:;]*$') AS tail, t FROM t), c AS (SELECT doc_id, tail, substr(t, 1, length(t) - length(tail)) AS body FROM b), h AS (SELECT *, regexp_extract(body, '^(该条目：|具体而言，|概述：)', 1) AS there FROM c),
p AS (SELECT *, substr(body, length(there) + 1) AS rest FROM h), q AS (SELECT *, list_filter(list_transform(string_split(replace(rest, '，', ','), ','), lambda x: regexp_replace(x, '^{X._WS}+|{X._WS}+$', '', 'g')), lambda x: x <> '') AS parts FROM p)
SELECT doc_id, sha256(CASE WHEN len(parts) >= 2 THEN (CASE WHEN there = '' THEN '概述：' ELSE there END) || array_to_string(list_concat(parts[2:], parts[1:1]), '，') || tail ELSE rest || tail END) AS digest, len(parts) >= 2 AS changed FROM q""",
)
def paraphrase(spark, sf):
    d = table(spark, sf, "documents")
    out = tuning.paraphrase(F.col("text"), F.lit(tuning.LEADS[2]))
    clauses = F.size(F.filter(F.split(F.regexp_replace(F.regexp_replace(F.btrim(F.coalesce("text", F.lit("")), F.lit(X.T.WS_CHARS)), f"[{tuning.END_MARKS}]*$", ""), "^(" + "|".join(tuning.LEADS) + ")", ""), "[，,]"), lambda x: F.btrim(x, F.lit(X.T.WS_CHARS)) != ""))
    return d.select("doc_id", F.sha2(out, 256).alias("digest"), (clauses >= 2).alias("changed"))


@query("synthesis_plan")
def synthesis_plan(spark, sf):
    from gristmill.functions import text as T

    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    kinds = {"text_truncate_repair": (1.0, T.truncate_repair), "text_deredup": (1.0, T.cap_runs), "text_paraphrase": (2.0, lambda t: tuning.paraphrase(t, F.lit(tuning.LEADS[2])))}
    return tuning.synthesise(d, kinds, 0.3, 2)


_MIX = "WITH h AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('mix:' || doc_id), doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents WHERE lang IN ('en', 'fr', 'de')), m AS (SELECT min(CASE lang WHEN 'en' THEN n * 4 / 2.0 ELSE n * 4 / 1.0 END) AS most FROM h) SELECT doc_id, lang FROM h, m WHERE k <= floor(floor(most) * CASE lang WHEN 'en' THEN 2 ELSE 1 END / 4)"


@query("source_mix", _MIX)
def source_mix(spark, sf):
    return tuning.mix(table(spark, sf, "documents").select("doc_id", "lang"), "lang", {"en": 2.0, "fr": 1.0, "de": 1.0}, "doc_id")


@query("token_counts", "SELECT doc_id, least(octet_length(encode(coalesce(text, ''))), 512) AS n_tokens, octet_length(encode(coalesce(text, ''))) > 512 AS truncated FROM documents")
def token_counts(spark, sf):
    size = F.octet_length(F.coalesce("text", F.lit("")))
    return table(spark, sf, "documents").select("doc_id", F.size(tuning.byte_tokens(F.col("text"), 512)).alias("n_tokens"), (size > 512).alias("truncated"))


def _blocks(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", tuning.byte_tokens(F.col("text"), 700).alias("tokens"), F.when(evaluate.hash_fraction(F.col("doc_id").cast("string")) < 0.1, "val").otherwise("train").alias("split"))
    return tuning.pack_blocks(d, "doc_id", "tokens", "split", 512, 256)


@query("packed_blocks")
def packed_blocks(spark, sf):
    return _blocks(spark, sf)


@query("shard_manifest")
def shard_manifest(spark, sf):
    b = _blocks(spark, sf).select("split", "shard", "n_real", F.md5(F.concat_ws(",", "input_ids")).alias("h"))
    g = b.groupBy("split").agg(F.count_distinct("shard").alias("n_shards"), F.count("*").alias("n_blocks"), F.sum("n_real").alias("n_tokens"), F.round(1 - F.sum("n_real") / (512 * F.count("*")), 6).alias("padding"), F.sum(F.conv(F.substring("h", 1, 15), 16, 10).cast("decimal(38,0)")).cast("string").alias("digest"))
    return g


@query("budget_ledger", "WITH c AS (SELECT doc_id, CASE WHEN n_chars < 500 THEN 1 WHEN n_chars < 2000 THEN 20 ELSE 50 END AS cost FROM documents), s AS (SELECT *, coalesce(sum(cost) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM c) SELECT doc_id, cost, cast(b as bigint) AS spent_before, b + cost <= 5000 AS asked FROM s")
def budget_ledger(spark, sf):
    cost = F.when(F.col("n_chars") < 500, 1).when(F.col("n_chars") < 2000, 20).otherwise(50)
    return tuning.degrade(table(spark, sf, "documents").select("doc_id", cost.alias("cost")), "doc_id", "cost", 5000)


@query("routing_memory", "SELECT tiers, count(*) AS n, cast(sum(n_chars // 4) as bigint) AS tokens, min(doc_id) AS example FROM (SELECT doc_id, n_chars, CASE WHEN n_chars < 200 THEN 'rule' WHEN n_chars < 2000 THEN 'rule|llm' ELSE 'rule|model' END AS tiers FROM documents) GROUP BY tiers")
def routing_memory(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars", F.when(F.col("n_chars") < 200, "rule").when(F.col("n_chars") < 2000, "rule|llm").otherwise("rule|model").alias("tiers"))
    return d.groupBy("tiers").agg(F.count("*").alias("n"), F.sum(F.floor(F.col("n_chars") / 4)).alias("tokens"), F.min("doc_id").alias("example"))
