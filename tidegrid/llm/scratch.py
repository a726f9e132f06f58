"""Intermediate tables in the folder that all executors share, and joins with sides of a checked size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.session import shared_dir
from tidegrid.sizing import materialize, plan_bytes

# A side is broadcast up to this many bytes of its stored size; beyond it the join shuffles.
BROADCAST_BYTES = 24 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh shared folder and read it back: lineage ends, the size is known."""
    return materialize(df, shared_dir(df.sparkSession, name))


def checked(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of a stored table within ``limit``; leave a larger one to a shuffle join."""
    size = plan_bytes(df)
    return F.broadcast(df) if size is not None and size <= limit else df


def hash_share(h: Column) -> Column:
    """The place of a 64-bit hash in its range, from 0 to 1: a share of the distinct hashes lies below each number."""
    return h.cast("double") / 2.0**64 + 0.5


def table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str]) -> DataFrame:
    """The named columns of a test table; other columns are never read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)
