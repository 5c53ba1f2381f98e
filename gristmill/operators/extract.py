"""Article extraction from HTML by expressions, tiered, with the reasons for each failure."""

from __future__ import annotations

import html as _html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Blocks that go with all they hold.
DROPPED = ("script", "style", "noscript", "svg", "iframe", "template", "select", "button", "form", "nav", "header", "footer", "aside")
MIN_CHARS = 80


def strip_noise(html: Column) -> Column:
    for tag in DROPPED:
        html = F.regexp_replace(html, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
    return F.regexp_replace(html, r"(?s)<!--.*?-->", "")


def noise_counts(html: Column) -> Column:
    """Blocks by tag that :func:`strip_noise` takes out, where nothing is nested."""
    return F.map_filter(F.create_map(*(x for t in DROPPED for x in (F.lit(t), F.regexp_count(html, F.lit(rf"(?is)<{t}\b[^>]*>.*?</{t}\s*>"))))), lambda k, v: v > 0)


def paragraphs_raw(clean: Column) -> Column:
    return F.regexp_extract_all(clean, F.lit(r"(?is)<p[^>]*>(.*?)</p>"), F.lit(1))


def unescape(c: Column) -> Column:
    @F.pandas_udf("string")
    def entities(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else _html.unescape(t))

    return entities(c)


_SEP = "\x01"


def _tidy(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)[\s\x{00A0}\x{3000}\x1C-\x1F&&[^\x01]]+", " "))


def articles(pages: DataFrame, html: str = "html", min_chars: int = MIN_CHARS) -> DataFrame:
    """``pages`` with title, paragraphs, extractor (null where none worked) and attempts.

    One Arrow call per page for the entities: paragraphs travel joined.
    """
    raw = F.coalesce(F.col(html), F.lit(""))
    clean = strip_noise(raw)
    d = pages.withColumn("_clean", clean)
    has_p, has_br = F.col("_clean").rlike(r"(?is)<p[^>]*>.*?</p>"), F.col("_clean").rlike(r"(?i)<br\s*/?>")
    chunks = F.when(has_p, paragraphs_raw(F.col("_clean"))).otherwise(F.split("_clean", r"(?i)<br\s*/?>"))
    bare = F.transform(chunks, lambda x: F.regexp_replace(F.regexp_replace(x, "<[^>]+>", ""), _SEP, " "))
    heading = lambda c, t: F.regexp_extract(c, rf"(?is)<{t}[^>]*>(.*?)</{t}>", 1)
    title = F.when(F.col("_clean").rlike(r"(?is)<h1[^>]*>.*?</h1>"), heading(F.col("_clean"), "h1")).when(raw.rlike(r"(?is)<h1[^>]*>.*?</h1>"), heading(raw, "h1")).otherwise(heading(raw, "title"))
    joined = F.concat(F.regexp_replace(title, "<[^>]+>", ""), F.lit(_SEP), F.array_join(bare, _SEP))
    d = d.withColumn("_found", has_p | has_br).withColumn("_parts", F.split(unescape(joined), _SEP))
    paras = F.filter(F.transform(F.slice("_parts", 2, 1_000_000), _tidy), lambda x: x != "")
    d = d.withColumn("_p", F.when(F.col("_found"), paras)).withColumn("_t", _tidy(F.element_at("_parts", 1)))
    size = F.aggregate(F.coalesce("_p", F.array().cast("array<string>")), F.lit(0), lambda a, x: a + F.length(x))
    reason = F.when(~F.col("_found"), "no_container").when(F.size("_p") == 0, "no_paragraphs").when(size < min_chars, "too_short").otherwise("ok")
    d = d.withColumn("_r", reason)
    good = F.col("_r") == "ok"
    out = d.withColumn("title", F.when(good, F.col("_t"))).withColumn("paragraphs", F.when(good, F.col("_p"))).withColumn("extractor", F.when(good, F.lit("heuristic")))
    out = out.withColumn("attempts", F.array(F.concat(F.lit("heuristic:"), F.col("_r"))))
    return out.drop("_clean", "_found", "_parts", "_p", "_t", "_r")
