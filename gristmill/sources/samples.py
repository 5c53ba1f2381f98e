"""Samples as JSON lines, and partitioned lake tables: reading, checking, writing, what a filter has to read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BAD = "_bad_line"


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line. Lines end at \\n alone, so the other Unicode line separators stay in texts."""
    return spark.read.schema(schema).option("lineSep", "\n").option("encoding", "UTF-8").json(path)


def parse_lines(lines: DataFrame, schema: str, line: str = "value", key: str = "id") -> DataFrame:
    """The columns of ``schema`` and ``_bad_line`` (the line, where it is no such object). A byte order mark is passed over, a missing id is made from a hash of the line, empty lines are left out."""
    clean = F.regexp_replace(F.col(line), "^\\x{FEFF}", "")
    parsed = F.from_json(clean, f"{schema}, {BAD} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    d = lines.where(F.trim(clean) != "").select(parsed.alias("r")).select("r.*")
    return d.withColumn(key, F.coalesce(F.col(key), F.when(F.col(BAD).isNull(), F.concat(F.lit("row"), F.sha2(F.to_json(F.struct(*[c for c in d.columns if c != BAD])), 256)))))


def check_upload(rows: DataFrame, required: list[str], fields: list[str]) -> DataFrame:
    """(n_lines, n_bad, per required field its empty ones, ok) of :func:`parse_lines`'s rows; blank counts as empty."""
    good = F.col(BAD).isNull()
    empty = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    missing = [c for c in required if c not in fields]
    if missing:
        raise ValueError(f"required fields are not there: {', '.join(missing)}")
    d = rows.agg(F.count("*").alias("n_lines"), F.count_if(~good).alias("n_bad"), *(F.count_if(good & empty(c)).alias(f"empty_{c}") for c in required))
    return d.withColumn("ok", sum((F.col(f"empty_{c}") for c in required), F.col("n_bad")) == 0)


def write_outcome(run: DataFrame, path: str) -> None:
    """``cleaned`` and ``dropped`` (with the operator) below ``path``, as JSON lines."""
    run.where("dropped_by is null").drop("dropped_by", "dropped_seq").write.mode("overwrite").json(f"{path}/cleaned")
    run.where("dropped_by is not null").drop("dropped_seq").write.mode("overwrite").json(f"{path}/dropped")


@dataclass(frozen=True)
class Source:
    """A data set's files: kind is raw, cleaned or dropped."""

    name: str
    kind: str
    path: str


def read_sources(spark: SparkSession, sources: list[Source], schema: str) -> DataFrame:
    """All sources in one frame, with ``dataset`` and ``kind``."""
    names = {(s.name, s.kind) for s in sources}
    if len(names) < len(sources):
        raise ValueError("a data set has two sources of one kind")
    if unknown := {s.kind for s in sources} - {"raw", "cleaned", "dropped"}:
        raise ValueError(f"unknown kinds: {', '.join(sorted(unknown))}")
    out = None
    for s in sources:
        one = read_jsonl(spark, s.path, schema).withColumns({"dataset": F.lit(s.name), "kind": F.lit(s.kind)})
        out = one if out is None else out.unionByName(one)
    return out


def scan(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """A partitioned table; partition values stay text, and a condition on them prunes files."""
    df = spark.read.option("basePath", path).parquet(path)
    return df if where is None else df.where(where)


def partitions(df: DataFrame, by: list[str], undated: str = "unknown") -> DataFrame:
    """(by..., n_files, n_bytes, n_rows, is_undated): what lies in each partition, from file metadata."""
    f = df.select(*by, F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).groupBy(*by, "f", "s").agg(F.count("*").alias("n"))
    g = f.groupBy(*by).agg(F.count("*").alias("n_files"), F.sum("s").alias("n_bytes"), F.sum("n").alias("n_rows"))
    return g.withColumn("is_undated", F.col(by[-1]).isNull() | (F.col(by[-1]) == undated))


def prune_report(df: DataFrame, where: Column) -> DataFrame:
    """(n_files, n_read, n_bytes, bytes_read, skipped): files that a condition on partition columns leaves to read; ``skipped`` is null where nothing matched."""
    read = lambda d: d.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).distinct()
    every, some = read(df), read(df.where(where)).withColumn("hit", F.lit(1))
    d = every.join(some, ["f", "s"], "left").agg(F.count("*").alias("n_files"), F.count("hit").alias("n_read"), F.sum("s").alias("n_bytes"), F.coalesce(F.sum(F.when(F.col("hit") == 1, F.col("s"))), F.lit(0)).alias("bytes_read"))
    return d.withColumn("skipped", F.when(F.col("n_read") > 0, F.round(1 - F.col("bytes_read") / F.col("n_bytes"), 6)))
