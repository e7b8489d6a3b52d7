"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for large runs.  Everything else keeps Spark's default.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM never compiles methods above 8,000 bytes of bytecode.  A stage whose fused code
    # would be longer runs faster unfused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "tesela", master: str | None = None, **conf: str) -> SparkSession:
    """Create or reuse a session.  `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master.startswith("local"):
        return f"{tempfile.gettempdir()}/tesela-local"
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{_work(spark)}/{label}-{uuid.uuid4().hex}"


def _work(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tesela/{spark.sparkContext.applicationId}"


def clear_work(spark: SparkSession) -> None:
    """Delete what this application has written below the shared folder.  To be called at its
    end: results that were not saved elsewhere still read those tables."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_work(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df, label: str = "stage"):
    """Write `df` to the shared folder and read it back.

    Used where a result is read by several later jobs: the written table survives lost
    executors, while a cached block would be computed again from the start.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
