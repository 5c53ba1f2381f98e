"""Tables written between steps.

Lineage is cut by writing Parquet under the folder named in ``spark.checkpoint.dir``
(shared by driver and executors) and reading it back, so a lost executor never costs
more than the step that was running.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; one of our own only where none is set (local tests)."""
    known = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not known:
        known = spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        known = "file://" + tempfile.mkdtemp(prefix="gristmill-")
        spark.conf.set("spark.checkpoint.dir", known)
    return known.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/gristmill/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._gristmill_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`materialize` that no later plan reads."""
    path = getattr(df, "_gristmill_path", None)
    if path is None:
        return
    sc = df.sparkSession.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more; for loops that shuffle much."""
    spark.sparkContext._jvm.System.gc()
