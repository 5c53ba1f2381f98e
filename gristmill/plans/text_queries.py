"""Queries over texts, pages and their labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import text as T
from gristmill.operators import evaluate, extract, funnel
from gristmill.sources import connectors
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


# The classes are spelled out: DuckDB's \s and \w know ASCII alone.
_WS = r"[\x09-\x0D\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_STRIP = rf"regexp_replace(coalesce(text, ''), '^{_WS}+|{_WS}+$', '', 'g')"
_LINES = rf"list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '^{_WS}+|{_WS}+$', '', 'g')), lambda x: x <> '')"
_WORD = r"[\p{L}\p{M}\p{N}_]"
_BOILER = " + ".join(
    f"len(regexp_extract_all(coalesce(text, ''), '{p}'))"
    for p in ("扫码关注.{0,6}公众号", "点击(链接|原文).{0,10}(抢购|下载|查看)", "转载请注明出处", "免责声明", r"www\.[\p{L}\p{M}\p{N}_-]+\.c[no]", "下载 APP")
)
_PII = r" + ".join(f"cast(regexp_matches(coalesce(text, ''), '{p}') as int)" for p in (r"1[3-9]\d{9}", r"[\p{L}\p{M}\p{N}_.+-]+@[\p{L}\p{M}\p{N}_-]+\.[\p{L}\p{M}\p{N}_.]+", r"\d{17}[\dXx]"))
_SCORES = f"""
SELECT doc_id,
  cast(length({_STRIP}) as double) AS text_length,
  cast(length(regexp_replace(coalesce(text, ''), '{_WS}', '', 'g')) as double) AS doc_length,
  CASE WHEN len({_LINES}) < 2 THEN 1.0 ELSE len(list_distinct({_LINES})) / cast(len({_LINES}) as double) END AS line_repetition,
  cast(greatest(0.0, 1 - 0.2 * ({_BOILER})) as double) AS boilerplate,
  cast(greatest(0.0, 1 - 0.34 * ({_PII})) as double) AS pii_detect
FROM documents"""
_RUNS = f"""
WITH t AS (SELECT doc_id, {_STRIP} AS s FROM documents),
c AS (SELECT doc_id, s, unnest(range(1, length(s) + 1)) AS i FROM t),
d AS (SELECT doc_id, i, substr(s, i, 1) AS ch FROM c),
g AS (SELECT doc_id, ch, i - row_number() OVER (PARTITION BY doc_id, ch ORDER BY i) AS island FROM d),
r AS (SELECT doc_id, max(n) AS longest FROM (SELECT doc_id, ch, island, count(*) AS n FROM g GROUP BY ALL) GROUP BY doc_id)
SELECT doc_id, CASE WHEN length(s) < 4 THEN 1.0 ELSE round(1 - longest / cast(length(s) as double), 9) END AS score FROM t LEFT JOIN r USING (doc_id)"""


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


@query("text_scores", f"SELECT doc_id, text_length, doc_length, round(line_repetition, 9) AS line_repetition, round(boilerplate, 9) AS boilerplate, round(pii_detect, 9) AS pii_detect FROM ({_SCORES})")
def text_scores(spark, sf):
    r = lambda c, n: F.round(c.cast("double"), 9).alias(n)
    return _docs(spark, sf).select("doc_id", T.text_length("text").alias("text_length"), T.doc_length("text").alias("doc_length"), r(T.line_repetition("text"), "line_repetition"), r(T.boilerplate("text"), "boilerplate"), r(T.pii_detect("text"), "pii_detect"))


@query("char_repetition", _RUNS)
def char_repetition(spark, sf):
    return _docs(spark, sf).select("doc_id", F.round(T.char_repetition("text"), 9).alias("score"))


@query("chinese_ratio", f"SELECT doc_id, CASE WHEN n = 0 THEN 0.0 ELSE round(k / cast(n as double), 9) END AS score FROM (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[\\x{{4E00}}-\\x{{9FFF}}]')) AS k, length(regexp_replace(coalesce(text, ''), '{_WS}', '', 'g')) AS n FROM documents)")
def chinese_ratio(spark, sf):
    return _docs(spark, sf).select("doc_id", F.round(T.script_ratio("text"), 9).alias("score"))


@query("whitespace_ratio", f"SELECT lang, round(avg(CASE WHEN length(text) = 0 THEN 0.0 ELSE len(regexp_extract_all(text, '{_WS}')) / cast(length(text) as double) END), 6) AS mean_ratio, round(median(CASE WHEN length(text) = 0 THEN 0.0 ELSE len(regexp_extract_all(text, '{_WS}')) / cast(length(text) as double) END), 6) AS median_ratio FROM documents GROUP BY lang")
def whitespace_ratio(spark, sf):
    return _docs(spark, sf).groupBy("lang").agg(F.round(F.avg(T.whitespace_ratio("text")), 6).alias("mean_ratio"), F.round(F.median(T.whitespace_ratio("text")), 6).alias("median_ratio"))


_FUNNEL = f"""
WITH s AS ({_SCORES}),
r AS (SELECT doc_id, score AS char_repetition FROM ({_RUNS})),
j AS (SELECT s.*, r.char_repetition, md5(coalesce(d.text, '')) AS h FROM s JOIN r USING (doc_id) JOIN documents d USING (doc_id)),
f AS (SELECT *, CASE WHEN doc_length < 30 OR doc_length > 50000 THEN 0 WHEN line_repetition < 0.8 THEN 1 WHEN char_repetition < 0.8 THEN 2 WHEN boilerplate < 0.8 THEN 3 WHEN pii_detect < 0.9 THEN 4 END AS seq5 FROM j),
m AS (SELECT h, min(doc_id) AS first FROM f WHERE seq5 IS NULL GROUP BY h),
g AS (SELECT f.*, coalesce(seq5, CASE WHEN f.doc_id <> m.first THEN 5 END) AS seq FROM f LEFT JOIN m USING (h))
"""
_OPS = ("doc_length", "line_repetition", "char_repetition", "boilerplate", "pii_detect", "exact_text")


def _funnel(spark, sf):
    return funnel.run(_docs(spark, sf).select("doc_id", "text"), funnel.TEXT_FUNNEL, "doc_id", carry=[])


@query("funnel_documents", _FUNNEL + "SELECT doc_id, seq AS dropped_seq, CASE seq " + " ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(_OPS)) + " END AS dropped_by FROM g")
def funnel_documents(spark, sf):
    return _funnel(spark, sf).select("doc_id", "dropped_seq", "dropped_by")


@query(
    "funnel_stats",
    _FUNNEL
    + " UNION ALL ".join(
        f"SELECT {i} AS seq, '{o}' AS op, count(*) FILTER (WHERE seq IS NULL OR seq >= {i}) AS n_in, count(*) FILTER (WHERE seq IS NULL OR seq > {i}) AS n_out, count(*) FILTER (WHERE seq = {i}) AS n_dropped, "
        + ", ".join(f"round({f}({o if o != 'exact_text' else 'cast(NULL as double)'}) FILTER (WHERE seq IS NULL OR seq >= {i}), 6) AS {n}" for f, n in (("min", "score_min"), ("median", "score_p50"), ("max", "score_max")))
        + " FROM g"
        for i, o in enumerate(_OPS)
    ),
)
def funnel_stats(spark, sf):
    s = funnel.stats(_funnel(spark, sf), funnel.TEXT_FUNNEL)
    return s.select("seq", "op", "n_in", "n_out", "n_dropped", *(F.round(c, 6).alias(c) for c in ("score_min", "score_p50", "score_max")))


@query(
    "verdict_rules",
    _FUNNEL
    + "SELECT op, decision, rule, count(*) AS n FROM ("
    + " UNION ALL ".join(
        f"SELECT '{o}' AS op, CASE WHEN seq = {i} THEN 'drop' ELSE 'keep' END AS decision, CASE WHEN {'true' if o == 'exact_text' else 'false'} THEN CASE WHEN seq = {i} THEN 'batch_drop_no_score' ELSE 'no_score_kept' END WHEN {low} THEN 'score_below_min' WHEN {high} THEN 'score_above_max' ELSE 'within_threshold' END AS rule FROM g WHERE seq IS NULL OR seq >= {i}"
        for i, (o, low, high) in enumerate(zip(_OPS, ("doc_length < 30", "line_repetition < 0.8", "char_repetition < 0.8", "boilerplate < 0.8", "pii_detect < 0.9", "false"), ("doc_length > 50000", *["false"] * 5), strict=True))
    )
    + ") GROUP BY ALL",
)
def verdict_rules(spark, sf):
    v = funnel.verdicts(_funnel(spark, sf), funnel.TEXT_FUNNEL, "doc_id")
    return v.groupBy("op", "decision", "rule").agg(F.count("*").alias("n"))


@query("sample_fingerprint", "SELECT doc_id, sha256('text_article' || chr(0) || coalesce(text, '') || chr(0)) AS fingerprint FROM documents")
def sample_fingerprint(spark, sf):
    return _docs(spark, sf).select("doc_id", F.sha2(F.concat(F.lit("text_article\0"), F.coalesce("text", F.lit("")), F.lit("\0")), 256).alias("fingerprint"))


@query("exact_dup", "SELECT doc_id, first AS duplicate_of FROM documents JOIN (SELECT md5(text) AS h, min(doc_id) AS first FROM documents GROUP BY 1) ON md5(text) = h WHERE doc_id <> first")
def exact_dup(spark, sf):
    d = _docs(spark, sf).select("doc_id", F.md5("text").alias("h"))
    return d.join(d.groupBy("h").agg(F.min("doc_id").alias("duplicate_of")), "h").where("doc_id <> duplicate_of").select("doc_id", "duplicate_of")


_PR = _FUNNEL + ", l AS (SELECT g.doc_id, seq IS NOT NULL AS dropped, quality = 0 AS dirty FROM g JOIN labels USING (doc_id)), c AS (SELECT count(*) FILTER (WHERE dropped AND dirty) AS tp, count(*) FILTER (WHERE dropped AND NOT dirty) AS fp, count(*) FILTER (WHERE NOT dropped AND dirty) AS fn, count(*) FILTER (WHERE NOT dropped AND NOT dirty) AS tn FROM l) "


def _labelled(spark, sf):
    return _funnel(spark, sf).join(table(spark, sf, "labels"), "doc_id").select((F.col("dropped_seq").isNotNull()).alias("dropped"), (F.col("quality") == 0).alias("dirty"))


@query("pr_vs_labels", _PR + "SELECT tp, fp, fn, round(coalesce(tp / nullif(cast(tp + fp as double), 0), 0.0), 4) AS precision, round(coalesce(tp / nullif(cast(tp + fn as double), 0), 0.0), 4) AS recall FROM c")
def pr_vs_labels(spark, sf):
    return evaluate.precision_recall(_labelled(spark, sf), "dropped", "dirty")


@query("kappa", _PR + ", p AS (SELECT cast(tp + tn as double) / (tp + fp + fn + tn) AS po, (cast(tp + fp as double) * (tp + fn) + cast(fn + tn as double) * (fp + tn)) / (cast(tp + fp + fn + tn as double) * (tp + fp + fn + tn)) AS pe, tp + fp + fn + tn AS n FROM c) SELECT n, round((po - pe) / nullif(1 - pe, 0), 6) AS kappa FROM p")
def kappa(spark, sf):
    return evaluate.kappa(_labelled(spark, sf), "dropped", "dirty")


@query("quality_buckets", f"WITH s AS ({_SCORES}) SELECT CASE WHEN line_repetition IS NULL OR line_repetition < 0.5 THEN 'low' WHEN line_repetition < 0.9 THEN 'mid' ELSE 'high' END AS bucket, lang, count(*) AS n, round(avg(doc_length), 6) AS mean_length FROM s JOIN documents USING (doc_id) GROUP BY ALL")
def quality_buckets(spark, sf):
    s = _docs(spark, sf).select("lang", T.line_repetition("text").alias("q"), T.doc_length("text").alias("n"))
    return s.groupBy(evaluate.bucket(F.col("q"), (0.5, 0.9)).alias("bucket"), "lang").agg(F.count("*").alias("n"), F.round(F.avg("n"), 6).alias("mean_length"))


@query("judge_sampling")
def judge_sampling(spark, sf):
    draw = F.conv(F.substring(F.sha1(F.concat(F.lit("7:"), F.col("doc_id").cast("string"))), 1, 8), 16, 10).cast("double") / 4294967295
    return _docs(spark, sf).where(draw < 0.1).select("doc_id")


@query("split_hash", "WITH h AS (SELECT doc_id, list_reduce(list_transform(string_split(substr(sha256(cast(doc_id as varchar)), 1, 8), ''), lambda c: cast(strpos('0123456789abcdef', c) - 1 as bigint)), lambda a, b: a * 16 + b) % 10000 / 10000.0 AS u FROM documents) SELECT CASE WHEN u < 0.1 THEN 'val' WHEN u < 0.2 THEN 'test' ELSE 'train' END AS split, count(*) AS n, sum(doc_id) AS ids FROM h GROUP BY 1")
def split_hash(spark, sf):
    u = evaluate.hash_fraction(F.col("doc_id").cast("string"))
    s = F.when(u < 0.1, "val").when(u < 0.2, "test").otherwise("train")
    return _docs(spark, sf).groupBy(s.alias("split")).agg(F.count("*").alias("n"), F.sum("doc_id").cast("decimal(38,0)").cast("long").alias("ids"))


_HEX = "list_reduce(list_transform(string_split(substr(h, {at}, 15), ''), lambda c: cast(strpos('0123456789abcdef', c) - 1 as hugeint)), lambda a, b: a * 16 + b)"


@query("table_fingerprint", f"SELECT cast(sum({_HEX.format(at=1)}) as varchar) || ':' || cast(sum({_HEX.format(at=16)}) as varchar) AS fingerprint, count(*) AS n FROM (SELECT md5(doc_id || '|' || coalesce(lang, '') || '|' || coalesce(source, '') || '|' || n_chars) AS h FROM documents)")
def table_fingerprint(spark, sf):
    return evaluate.fingerprint(_docs(spark, sf).select("doc_id", "lang", "source", "n_chars"))


@query("url_dedupe", "SELECT page_id, url FROM (SELECT page_id, url, row_number() OVER (PARTITION BY url ORDER BY page_id) AS k FROM pages) WHERE k = 1")
def url_dedupe(spark, sf):
    return table(spark, sf, "pages").groupBy("url").agg(F.min("page_id").alias("page_id")).select("page_id", "url")


@query("raw_store", "SELECT sha256(html) AS sha256, list_sort(list(DISTINCT url)) AS urls, min(page_id) AS first_page, octet_length(encode(min(html))) AS n_bytes FROM pages GROUP BY 1")
def raw_store(spark, sf):
    p = table(spark, sf, "pages")
    return p.groupBy(F.sha2("html", 256).alias("sha256")).agg(F.array_sort(F.collect_set("url")).alias("urls"), F.min("page_id").alias("first_page"), F.octet_length(F.min("html")).cast("long").alias("n_bytes"))


_NOISE = "html"
for _t in extract.DROPPED:
    _NOISE = f"regexp_replace({_NOISE}, '<{_t}\\b[^>]*>.*?</{_t}\\s*>', '', 'gsi')"
_NOISE = f"regexp_replace({_NOISE}, '<!--.*?-->', '', 'gs')"


@query("html_paragraph_count", f"SELECT page_id, length({_NOISE}) AS n_clean, len(regexp_extract_all({_NOISE}, '(?si)<p[^>]*>(.*?)</p>', 1)) AS n_paragraphs, len(regexp_extract_all(html, '(?si)<br\\s*/?>')) AS n_breaks FROM pages")
def html_paragraph_count(spark, sf):
    clean = extract.strip_noise(F.col("html"))
    return table(spark, sf, "pages").select("page_id", F.length(clean).cast("long").alias("n_clean"), F.size(extract.paragraphs_raw(clean)).cast("long").alias("n_paragraphs"), F.regexp_count("html", F.lit(r"(?i)<br\s*/?>")).cast("long").alias("n_breaks"))


@query("html_articles")
def html_articles(spark, sf):
    return extract.articles(table(spark, sf, "pages"), "html").select("page_id", "title", "paragraphs", "extractor", "attempts")


@query("normalized_documents")
def normalized_documents(spark, sf):
    return _docs(spark, sf).select("doc_id", T.normalized("text").alias("new")).select("doc_id", "new.text", "new.rules")


@query("normalize_summary")
def normalize_summary(spark, sf):
    d = _docs(spark, sf).select("text", T.normalized("text").alias("done")).select("text", F.col("done.text").alias("new"), "done.rules")
    return d.agg(F.count("*").alias("n"), F.count_if(F.size("rules") > 0).alias("n_changed"), F.count_if((F.col("new") == "") & (F.col("text") != "")).alias("n_emptied"), F.round(F.median(T.whitespace_ratio("text")), 6).alias("ws_before"), F.round(F.median(T.whitespace_ratio("new")), 6).alias("ws_after"))


@query("conversation_turns", "SELECT conv_id, count(*) AS n_turns, string_agg(DISTINCT role, '|' ORDER BY role) AS roles, sum(length(text)) AS n_chars, min(turn) AS first_turn FROM conversations GROUP BY conv_id")
def conversation_turns(spark, sf):
    c = table(spark, sf, "conversations")
    return c.groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.array_join(F.array_sort(F.collect_set("role")), "|").alias("roles"), F.sum(F.length("text")).alias("n_chars"), F.min("turn").alias("first_turn"))


@query("benchmark_exact_leak", "SELECT doc_id, item_id FROM documents d JOIN benchmark b ON md5(d.text) = md5(b.text)")
def benchmark_exact_leak(spark, sf):
    d, b = _docs(spark, sf).select("doc_id", F.md5("text").alias("h")), table(spark, sf, "benchmark").select("item_id", F.md5("text").alias("h"))
    return d.join(b, "h").select("doc_id", "item_id")


@query("synth_repair", "SELECT doc_id, CASE WHEN regexp_matches(s, '\\p{P}$') OR s = '' THEN coalesce(text, '') ELSE s || '。' END AS text FROM (SELECT doc_id, text, " + _STRIP + " AS s FROM documents)")
def synth_repair(spark, sf):
    return _docs(spark, sf).select("doc_id", T.truncate_repair("text").alias("text"))


@query("synth_cap_runs")
def synth_cap_runs(spark, sf):
    return _docs(spark, sf).select("doc_id", T.cap_runs("text").alias("text"))


@query("page_links", "WITH l AS (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href=[\"'']([^\"''#]+)[\"'']', 1))) AS url FROM pages) SELECT page_id, url FROM l")
def page_links(spark, sf):
    return connectors.listing_links(table(spark, sf, "pages").select("page_id", "html")).select("page_id", "url")
