from pyspark.sql import functions as F

from gristmill.operators.funnel import Stage
from gristmill.streaming import gate

STAGES = [Stage("doc_length", min=10), Stage("pii_detect", min=0.9)]


def test_gate_and_dedup_on_a_stream(spark, tmp_path):
    rows = [(1, "a text that is long enough"), (2, "short"), (3, "a text that is long enough"), (4, "write to a.b@c.org about it")]
    spark.createDataFrame(rows, "id long, text string").withColumn("ts", F.timestamp_seconds(F.col("id") * 60)).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long, text string, ts timestamp").parquet(str(tmp_path / "in"))
    q = gate.gate(gate.exact_dedup(stream, "ts"), STAGES).writeStream.format("memory").queryName("gated").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r["id"]: list(r["flags"]) for r in spark.table("gated").collect()}
    assert len(got) == 3 and got[2] == ["doc_length"] and got[4] == ["pii_detect"]


def test_windows_and_idempotent_sink(spark, tmp_path):
    spark.range(100).select(F.timestamp_seconds(F.col("id") * 30).alias("ts"), F.col("id").alias("v")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, v long").parquet(str(tmp_path / "in"))
    w = gate.windowed(stream, "ts", [], "10 minutes", total=F.sum("v"), n=F.count("*")).select(F.col("window.start").alias("start"), F.date_format("window.start", "HH").alias("hour"), "total", "n")
    q = w.writeStream.outputMode("update").foreachBatch(gate.partition_sink(str(tmp_path / "out"), ["hour"])).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.sum("n")).first()[0] == 100
