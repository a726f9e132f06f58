"""Session settings every job in this package relies on."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime settings: safe to set on a session somebody else created.
RUNTIME_CONF = {
    # All calendar arithmetic is UTC; timestamps without a zone are read as UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split at run time; forced because the split is worth an extra shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Only the partitions a job produced are replaced, never the whole table.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Long texts: a batch for a Python worker is bounded by bytes, well below its share of memory. Both the
    # executor and the worker hold it, and the executor keeps its buffers.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session; its Python workers can import this package."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[1])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build(app: str = "tidegrid", master: str | None = None, **conf) -> SparkSession:
    """Create a session; ``conf`` uses underscores for dots (``spark_driver_memory="4g"``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), str(value))
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder every executor can see, under the cluster's checkpoint folder.

    Where no checkpoint folder is set, it is below the warehouse, which executors share too.
    """
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base is None:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
