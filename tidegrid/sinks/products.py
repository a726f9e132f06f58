"""Regridded records and annual products as partitioned Parquet."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.session import shared_dir
from tidegrid.sizing import materialize, spread_join

REGRIDDED_PARTITIONS = ["ds", "grid", "field", "year"]
PRODUCT_PARTITIONS = ["ds", "grid", "field", "year"]


# Rows that a task sorts and writes where compact rows are expanded after the shuffle.
ROWS_PER_TASK = 1 << 20


def spread_by_rows(df: DataFrame, partitions: Sequence[str], weight: Column, spread: Sequence[Column],
                   rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Distribute rows that stand for ``weight`` rows each by output folder, about ``rows_per_task`` to a task.

    A rebalance goes by the bytes of the compact rows, a few of which may stand for very many. A folder of
    more rows is cut into parts by a hash of ``spread``; small folders share tasks.
    """
    folders = materialize(df.groupBy(*partitions).agg(F.sum(weight).alias("__n")), shared_dir(df.sparkSession, "folders"))
    total = folders.agg(F.sum("__n")).first()[0] or 0
    parts = folders.select(*partitions, F.ceil(F.col("__n") / rows_per_task).alias("__parts")).filter("__parts > 1")
    cut = spread_join(df, parts, list(partitions), salt_from=list(partitions), how="left")
    part = F.pmod(F.xxhash64(*spread), F.coalesce("__parts", F.lit(1)))
    return cut.withColumn("__part", part).repartition(max(1, -(-total // rows_per_task)), *partitions, "__part").select(*df.columns)


def _write(df: DataFrame, path: str, partitions: Sequence[str], order: Sequence[str], mode: str,
           finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Rebalance by output folder, then write sorted files.

    Rebalancing splits a folder that holds much of the data over several tasks and merges small
    ones, so neither one huge file nor thousands of tiny ones come out. ``finish`` works on the rows
    where they are written, after the shuffle; those with gaps are distributed by the rows they become.
    """
    if "gap_dates" in df.columns:
        weight = F.when(F.col("gap_dates").isNull(), F.lit(1)).otherwise(F.size("gap_dates") * F.size("gap_cells"))
        rows = spread_by_rows(df, partitions, weight, [F.coalesce("date", F.get("gap_dates", F.lit(0))), F.coalesce("cell_id", F.get("gap_cells", F.lit(0)))])
    else:
        rows = df.hint("rebalance", *partitions)
    (
        (rows if finish is None else finish(rows))
        .sortWithinPartitions(*partitions, *order)
        .write.mode(mode).option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions).parquet(path)
    )


def write_regridded(records: DataFrame, path: str) -> None:
    """Regridded values; only the partitions present in ``records`` are replaced."""
    rows = records if "year" in records.columns else records.withColumn("year", F.year("date"))
    _write(rows, path, REGRIDDED_PARTITIONS, ["date", "cell_id"], "overwrite")


def write_product(series: DataFrame, path: str, time: str = "time", finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """An annual product sorted by time and cell. Years without a value must be left out before.

    With ``finish`` the series may be compact, such as one with gaps that are filled while writing.
    """
    _write(series, path, PRODUCT_PARTITIONS, [time, "cell_id"], "overwrite", finish)


def write_facts(facts: DataFrame, path: str) -> None:
    """One row per product and scale; only the products in ``facts`` are replaced."""
    (
        facts.hint("rebalance", *PRODUCT_PARTITIONS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PRODUCT_PARTITIONS, "scale").parquet(path)
    )
