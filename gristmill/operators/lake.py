"""Lake layers: partitioned tables, slowly changing dimensions, day and dataset aggregates, contracts, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace the partitions that ``df`` has rows for, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*by).parquet(path)


def scd2(observed: DataFrame, keys: list[str], attrs: list[str], day: str) -> DataFrame:
    """Versions of each key: a row per change of its attributes, with valid_from, valid_to (null: open), version, is_current.

    Null and '' are the same attribute value. Of several values on a day the earliest by attribute order counts.
    """
    value = F.concat_ws("\x1f", *(F.coalesce(F.col(a).cast("string"), F.lit("")) for a in attrs))
    daily = observed.groupBy(*keys, F.col(day).alias("valid_from")).agg(F.min(F.struct(value.alias("_v"), *attrs)).alias("_s")).select(*keys, "valid_from", "_s._v", *(f"_s.{a}" for a in attrs))
    w = Window.partitionBy(*keys).orderBy("valid_from")
    changed = daily.withColumn("_p", F.lag("_v").over(w)).where(F.col("_p").isNull() | (F.col("_p") != F.col("_v")))
    out = changed.withColumn("valid_to", F.lead("valid_from").over(w)).withColumn("version", F.row_number().over(w))
    return out.withColumn("is_current", F.col("valid_to").isNull()).drop("_v", "_p")


def point_in_time(facts: DataFrame, dim: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Facts with the version that held on their day."""
    d = dim.select(*(F.col(k).alias(f"_{k}") for k in keys), *(c for c in dim.columns if c not in keys))
    on = (facts[day] >= d["valid_from"]) & (d["valid_to"].isNull() | (facts[day] < d["valid_to"]))
    for k in keys:
        on = on & (facts[k] == d[f"_{k}"])
    return facts.join(d, on, "left").drop(*(f"_{k}" for k in keys))


def changes(dim: DataFrame, keys: list[str], attr: str) -> DataFrame:
    """(keys, changed_at, version, old, new) of every version after the first."""
    w = Window.partitionBy(*keys).orderBy("version")
    return dim.withColumn("old", F.lag(attr).over(w)).where("version > 1").select(*keys, F.col("valid_from").alias("changed_at"), "version", "old", F.col(attr).alias("new"))


def check_contract(df: DataFrame, rules: list[dict]) -> DataFrame:
    """(rule, column, n_bad, ok) of all rules in one pass.

    Rules: {"column", "required"|"unique"|"allowed"|"min_len"|"max_len"|"min_value"|"max_value": value}.
    """
    wanted = []
    for r in rules:
        c = F.col(r["column"])
        kind = next(k for k in r if k != "column")
        v = r[kind]
        bad = {
            "required": lambda: F.count_if(c.isNull() | (c.cast("string") == "")),
            "unique": lambda: F.count(c) - F.count_distinct(c),
            "allowed": lambda: F.count_if(c.isNotNull() & ~c.isin(list(v))),
            "min_len": lambda: F.count_if(F.length(c) < v),
            "max_len": lambda: F.count_if(F.length(c) > v),
            "min_value": lambda: F.count_if(c < v),
            "max_value": lambda: F.count_if(c > v),
        }[kind]()
        wanted.append(F.struct(F.lit(kind).alias("rule"), F.lit(r["column"]).alias("column"), bad.cast("long").alias("n_bad")))
    rows = df.agg(F.array(*wanted).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    return rows.withColumn("ok", F.col("n_bad") == 0)


def evaluate_metrics(spark: SparkSession, metrics: list[dict]) -> list[dict]:
    """Each metric's SQL, columns by name; an error becomes a row of its own."""
    out = []
    for m in metrics:
        try:
            out.append({"name": m["name"], "values": spark.sql(m["sql"]).first().asDict(), "error": None})
        except Exception as e:  # noqa: BLE001  the gate reports it
            out.append({"name": m["name"], "values": {}, "error": str(e).splitlines()[0]})
    return out


def volume_anomalies(days: DataFrame, key: str, day: str, count: str, least: int = 8, width: float = 3.0) -> DataFrame:
    """Days outside median +- width * 1.4826 * MAD of their dataset, for datasets of ``least`` days or more; kind is spike or drop."""
    c = days.groupBy(key).agg(F.median(count).alias("centre"), F.count("*").alias("_days")).where(F.col("_days") >= least)
    d = days.join(c, key)
    m = d.groupBy(key).agg((1.4826 * F.median(F.abs(F.col(count) - F.col("centre")))).alias("scale"))
    d = d.join(m, key).where("scale > 0")
    low, high = F.greatest(F.lit(0.0), F.col("centre") - width * F.col("scale")), F.col("centre") + width * F.col("scale")
    kind = F.when(F.col(count) > high, "spike").when(F.col(count) < low, "drop")
    return d.withColumn("kind", kind).where("kind is not null").select(key, day, count, "kind")


SEVERITY = ("info", "warning", "error", "critical")


def converge_alerts(alerts: DataFrame) -> DataFrame:
    """(kind, dataset, severity, n, last_at): one alert per kind and dataset, as severe as its worst."""
    level = F.array_position(F.array(*(F.lit(s) for s in SEVERITY)), F.col("severity"))
    g = alerts.groupBy("kind", "dataset").agg(F.max(level).cast("int").alias("_l"), F.count("*").alias("n"), F.max("at").alias("last_at"))
    return g.select("kind", "dataset", F.get(F.array(*(F.lit(s) for s in SEVERITY)), F.col("_l") - 1).alias("severity"), "n", "last_at")


def prometheus(metrics: DataFrame) -> DataFrame:
    """(line) of the text format, from (name, labels map<string,string>, value)."""
    pairs = F.array_sort(F.transform(F.map_entries("labels"), lambda e: F.concat(e["key"], F.lit('="'), F.regexp_replace(e["value"], r'(["\\])', r"\\$1"), F.lit('"'))))
    return metrics.select(F.concat(F.col("name"), F.when(F.size("labels") > 0, F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))).otherwise(""), F.lit(" "), F.col("value").cast("string")).alias("line"))
