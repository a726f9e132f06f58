"""Joins whose behaviour does not depend on one side happening to be small or even.

``bounded_broadcast`` only hints a side whose optimizer size estimate is under a limit;
``spread_join`` adds a salted shuffle join for the case that it is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024
# Bytes of the large side that one sub-key of a salted join should hold.
BYTES_PER_SALT = 64 * 1024 * 1024
_SALT = "__salt"


def plan_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df``, or None where the client does not expose it."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
    except AttributeError:
        return None
    return int(str(stats.sizeInBytes()))


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast when the estimate is known and within ``limit``; else leave the plan alone."""
    size = plan_bytes(df)
    return F.broadcast(df) if size is not None and size <= limit else df


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a shared folder and read it back.

    Cuts lineage so that a lost executor does not recompute everything before, lets several readers
    share the work, and gives the planner the real size.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(df: DataFrame) -> int:
    """Tasks of a shuffle in this session, which follow the size of the cluster."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def salts_for(df: DataFrame) -> int:
    """Sub-keys that spread one hot key of ``df``: by its size, at most one per task of a shuffle."""
    size, widest = plan_bytes(df), shuffle_width(df)
    return widest if size is None else max(1, min(widest, -(-size // BYTES_PER_SALT)))


def affordable_salts(big: DataFrame, small: DataFrame) -> int:
    """Sub-keys for ``big`` whose repeats of ``small`` stay within the size of ``big``.

    Where ``small`` turns out to be the larger side it is not repeated; a hot key is then split at run time.
    """
    size, repeated = plan_bytes(big), plan_bytes(small)
    return salts_for(big) if not size or not repeated else max(1, min(salts_for(big), size // repeated))


def spread_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    salt_from: Sequence[str],
    how: str = "inner",
    salts: int | None = None,
    limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Equi join that stays even when one value of ``on`` holds much of ``big``.

    ``small`` is broadcast if its size is checked to fit. Otherwise rows of ``big`` are spread over
    ``salts`` sub-keys by a hash of ``salt_from`` and ``small`` is repeated once per sub-key, so a
    hot key is shared by ``salts`` tasks, by default as many as the size of ``big`` asks for. Works for inner, left, left_semi and left_anti joins.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    keys = list(on)
    size = plan_bytes(small)
    if size is not None and size <= limit:
        return big.join(F.broadcast(small), keys, how)
    salts = salts_for(big) if salts is None else salts
    left = big.withColumn(_SALT, F.pmod(F.xxhash64(*salt_from), F.lit(salts)).cast("int"))
    right = small.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, _SALT], how).drop(_SALT)
