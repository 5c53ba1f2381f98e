"""URL filtering: given host and path rules first, association rules for the rest.

Spark's FP-growth mines sets of URL tokens, together with a label token, from the labelled pages
(a page's label is its document's: blocked where quality is 0 or the text is toxic). Association
rules whose consequent is the label are pruned by support, confidence and lift. They are matched
by an inverted index: each rule is filed under its rarest token, a URL's distinct tokens are
looked up there, and a rule fires if the URL holds all its tokens.

Edge cases: a null url, or one without ``://``, has empty host and path and is allowed by the
method; without labels, or with labels of one kind only, no rule is mined; repeated pages are
judged alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.plans.store import materialize

BLOCK = "label=block"
MIN_SUPPORT = 0.002
MIN_PAGES = 5
MIN_CONFIDENCE = 0.5
MIN_LIFT = 1.5
BROADCAST_RULES = 20_000
# The rules that are given. (rule, verdict)
GIVEN = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host and path columns (an existing one of that name is replaced)."""
    rest = pages.withColumn("_u", F.col(url).cast("string"))
    at = F.expr("CASE WHEN locate('://', _u) > 0 THEN substring(_u, locate('://', _u) + 3) ELSE '' END")
    rest = rest.withColumn("_rest", F.coalesce(at, F.lit("")))
    host = F.regexp_extract("_rest", r"^([^/?#]*)", 1)
    path = F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return rest.withColumn("host", lower).withColumn("path", path).drop("_u", "_rest")


def given_rule(host: Column, path: Column, rules=GIVEN) -> tuple[Column, Column]:
    """(rule, verdict) of the longest given rule that fits, null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, word in sorted(rules, key=lambda r: len(r[0])):
        name, _, tail = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + tail)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL: scheme, site (the host's last two labels), words of the labels below it, path segments, query names; digits are folded."""

    def tagged(tag: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))

    fold = lambda c: F.regexp_replace(F.lower(c), r"[0-9]+", "0")
    url = F.coalesce(url, F.lit(""))
    labels = F.split(host, r"\.")
    site = F.substring_index(host, ".", -2)
    below = F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 2, F.lit(0)))
    return F.array_distinct(
        F.concat(
            F.when(F.locate("://", url) > 0, F.array(F.concat(F.lit("scheme="), F.lower(F.substring_index(url, "://", 1))))).otherwise(F.array().cast("array<string>")),
            tagged("site=", F.array(site)),
            tagged("word=", F.flatten(F.transform(below, lambda x: F.split(fold(x), r"[^\p{L}0-9]+")))),
            tagged("path=", F.split(fold(path), "/")),
            tagged("query=", F.transform(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda x: fold(F.substring_index(x, "=", 1)))),
        )
    )


def mine(tokenised: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT, min_pages: int = MIN_PAGES) -> DataFrame:
    """(rule_id, items, confidence, support) of rules that say block. ``tokenised`` has items (array) and blocked (boolean).

    A rule's support is ``min_support`` of the labelled pages, and ``min_pages`` of them, at least.
    """
    tokenised = materialize(tokenised, "labelled-urls")
    min_support = min(1.0, max(min_support, min_pages / max(1, tokenised.count())))
    baskets = tokenised.select(F.when(F.col("blocked"), F.concat("items", F.array(F.lit(BLOCK)))).otherwise(F.col("items")).alias("items"))
    rules = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets).associationRules
    kept = rules.where((F.col("consequent")[0] == BLOCK) & (F.col("lift") >= min_lift))
    return kept.select(F.xxhash64(F.array_sort("antecedent")).alias("rule_id"), F.array_sort("antecedent").alias("items"), "confidence", "support")


def matches(tokenised: DataFrame, rules: DataFrame, key: str, broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """(key, confidence): the most confident rule that fires on each row, by inverted index; rows without one are absent."""
    n = rules.count()
    if n == 0:
        return tokenised.select(key, F.lit(0.0).alias("confidence")).where(F.lit(False))
    frequency = rules.select(F.explode("items").alias("token")).groupBy("token").count()
    ranked = rules.select("rule_id", "items", "confidence", F.explode("items").alias("token")).join(frequency, "token")
    filed = ranked.groupBy("rule_id").agg(F.first("items").alias("needs"), F.first("confidence").alias("confidence"), F.min(F.struct("count", "token")).alias("least")).select(F.col("least.token").alias("token"), "needs", "confidence")
    index = materialize(filed, "url-rules")
    hits = tokenised.select(key, "items", F.explode("items").alias("token"))
    joined = hits.join(F.broadcast(index) if n <= broadcast_rules else index, "token")
    fired = joined.where(F.size(F.array_except("needs", "items")) == 0)
    return fired.groupBy(key).agg(F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, labels: DataFrame, key: str = "page_id", url: str = "url", label_key: str = "doc_id", **options) -> DataFrame:
    """(key, host, path, rule, verdict, method_confidence) for every row of ``pages``."""
    slim = parts(pages.select(F.col(key).alias("id"), F.col(url).cast("string").alias("url")))
    rule, verdict = given_rule(F.col("host"), F.col("path"))
    slim = slim.withColumn("rule", rule).withColumn("given", verdict)
    known = labels.where(F.col(label_key).isNotNull()).groupBy(F.col(label_key).alias("id")).agg((F.coalesce(F.min("quality") == 0, F.lit(False)) | F.coalesce(F.max("toxic") == 1, F.lit(False))).alias("blocked"))
    said = slim.withColumn("items", tokens(F.col("url"), F.col("host"), F.col("path")))
    rules = materialize(mine(said.join(known, "id").select("items", "blocked"), **options), "mined")
    # each distinct token set is matched once
    distinct = said.where("given is null").select(F.to_json("items").alias("set"), "items").dropDuplicates(["set"])
    found = matches(distinct, rules, "set")
    out = said.withColumn("set", F.when(F.col("given").isNull(), F.to_json("items"))).join(found, "set", "left")
    method = F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return out.select(F.col("id").alias(key), "host", "path", "rule", F.coalesce("given", method).alias("verdict"), F.col("confidence").alias("method_confidence"))


def op1_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return judge(pages, labels)
