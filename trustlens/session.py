"""Spark session helpers.

The library never creates its own session inside an operator; callers pass one.
``get_spark`` is a convenience for tests, ``bench.py`` and local runs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(master: str | None = None, partitions: int | None = None,
              app: str = "trustlens") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    partitions = partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is. Only when it is unset (local tests) a scratch folder is created.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        master = spark.conf.get("spark.master", "local")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors of {master} share")
        current = tempfile.mkdtemp(prefix="trustlens-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back: the lineage is cut and the plan runs a single time (an RDD
    checkpoint of an uncached plan computes it twice). Executors lost later
    re-read the files instead of recomputing the upstream plan."""
    import uuid
    path = checkpoint_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
