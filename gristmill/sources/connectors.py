"""Candidates for ingestion from fetched listings, feeds and sitemaps; fetching itself is not the engine's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BYTES = 5_000_000


def safe_xml(c: Column, max_bytes: int = MAX_BYTES) -> Column:
    """Documents that declare types or entities, or are too large, are not read."""
    return c.isNotNull() & ~c.rlike(r"(?i)<!(DOCTYPE|ENTITY)") & (F.octet_length(c) <= max_bytes)


def _inner(item: Column, *names: str) -> Column:
    found = [F.trim(F.regexp_replace(F.regexp_extract(item, rf"(?s)<{n}(?:\s[^>]*)?>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</{n}>", 1), r"\s+", " ")) for n in names]
    return F.coalesce(*(F.when(f != "", f) for f in found))


def feed_entries(df: DataFrame, xml: str = "xml") -> DataFrame:
    """(columns of ``df`` without the feed, link, title, published) of RSS items and Atom entries that have a link."""
    items = F.regexp_extract_all(F.col(xml), F.lit(r"(?s)<(?:item|entry)\b.*?</(?:item|entry)>"), F.lit(0))
    d = df.where(safe_xml(F.col(xml))).select(*(c for c in df.columns if c != xml), F.explode(items).alias("_i"))
    href = F.regexp_extract("_i", r"""<link\b[^>]*\bhref=["']([^"']+)["']""", 1)
    link = F.coalesce(_inner(F.col("_i"), "link"), F.when(href != "", href))
    return d.withColumn("link", link).withColumn("title", _inner(F.col("_i"), "title")).withColumn("published", _inner(F.col("_i"), "pubDate", "published", "updated")).where("link is not null").drop("_i")


def sitemap_locations(df: DataFrame, xml: str = "xml") -> DataFrame:
    """(columns of ``df`` without the map, loc, is_index): pages, or further maps where the document is an index."""
    locations = F.transform(F.regexp_extract_all(F.col(xml), F.lit(r"(?s)<loc>\s*(.*?)\s*</loc>"), F.lit(1)), lambda x: F.replace(x, F.lit("&amp;"), F.lit("&")))
    return df.where(safe_xml(F.col(xml))).select(*(c for c in df.columns if c != xml), F.explode(locations).alias("loc"), F.col(xml).rlike(r"<sitemapindex\b").alias("is_index"))


def listing_links(df: DataFrame, html: str = "html", pattern: str = r"href=[\"']([^\"'#]+)[\"']") -> DataFrame:
    """(columns of ``df`` without the page, url, pos): each page's links in order, a link once."""
    links = F.array_distinct(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1)))
    return df.select(*(c for c in df.columns if c != html), F.posexplode(links).alias("pos", "url"))


def unseen(candidates: DataFrame, seen: DataFrame, url: str = "url", order: str | None = None) -> DataFrame:
    """Candidates whose url is not in ``seen``, the first of equal urls by ``order``."""
    fresh = candidates.join(seen.select(url).distinct(), url, "left_anti")
    if order is None:
        return fresh.dropDuplicates([url])
    first = fresh.groupBy(url).agg(F.min_by(F.struct(*fresh.columns), F.col(order)).alias("_s"))
    return first.select("_s.*")


def news_id(prefix: str, url: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.md5(url), 1, 10))


def event_date(meta_date: Column, url: Column, key: Column) -> Column:
    """A row's day: from its metadata (YYYY-..), else from its url (/YYYY/M-D/), else from its id (_YYYYMMDDThhmmss); null if unknown."""
    u = r"/(\d{4})/(\d{1,2})-(\d{1,2})/"
    from_url = F.when(url.rlike(u), F.concat_ws("-", F.regexp_extract(url, u, 1), F.lpad(F.regexp_extract(url, u, 2), 2, "0"), F.lpad(F.regexp_extract(url, u, 3), 2, "0")))
    i = r"_(\d{4})(\d{2})(\d{2})T\d{6}$"
    from_id = F.when(key.rlike(i), F.concat_ws("-", *(F.regexp_extract(key, i, k) for k in (1, 2, 3))))
    return F.coalesce(F.when(meta_date.rlike(r"^\d{4}-"), F.substring(meta_date, 1, 10)), from_url, from_id)
