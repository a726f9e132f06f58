"""Late and re-published data as streams over the batch operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidegrid.functions import text
from tidegrid.operators import harvest, planning
from tidegrid.sinks.store import StateStore, label

# Longest month: a month is only closed once data of the month after the next could be complete.
MONTH_DAYS = 31


def read_listing(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.parquet",
                 files_per_trigger: int | None = None) -> DataFrame:
    """Listing files as a stream; new files in the folder are new batches."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def follow_listing(listing: DataFrame, store: StateStore, checkpoint: str) -> StreamingQuery:
    """Queue new and re-published files in the granule table.

    Each batch is diffed against the current snapshot and merged into the next one. Re-running a
    batch finds nothing new, because queued rows carry the publication time they were seen with.
    """

    def batch(rows: DataFrame, _: int) -> None:
        latest = harvest.latest_per_key(rows, ["ds", "filename"], ["mod_time", "url"])
        datasets = [r.ds for r in rows.select("ds").distinct().collect()]  # a row per dataset of the batch
        known = store.read("granule", datasets=datasets).withColumn("download_time", F.coalesce("download_time", "mod_time"))
        fresh = planning.needs_harvest(latest, known.withColumn(
            "success", F.coalesce(F.col("success"), F.lit(True))))
        queued = fresh.select(
            text.stable_id("ds", "filename").alias("id"), "ds", "filename", "date", "url", "mod_time",
            F.lit(None).cast("boolean").alias("success"))
        store.upsert("granule", queued, set_columns=["url", "mod_time", "success"])

    return (
        listing.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def follow_transformations(tx: DataFrame, store: StateStore, checkpoint: str) -> StreamingQuery:
    """Merge finished transformations and re-open the years they touch.

    A re-opened year's aggregation row loses its success flag, which the next aggregation plan sees.
    """

    def batch(rows: DataFrame, _: int) -> None:
        latest = harvest.latest_per_key(rows, planning.TX_KEY, ["completed", "id"])
        change = store.transaction()
        change.upsert("transformation", latest)
        # a row per dataset and year of the batch: only these partitions are planned over
        years = [r[0] for r in latest.select(label("transformation")).distinct().collect()]
        touched = planning.years_with_tx(latest)
        tx_rows = change.read("transformation", years).withColumn("year", F.year("date").cast("int"))
        tx_rows = tx_rows.join(touched, planning.AGG_KEY, "left_semi").drop("year")
        stale = planning.agg_plan(tx_rows, change.read("aggregation", years))
        reopened = stale.filter(F.col("reason") == "newer transformation").select(
            *planning.AGG_KEY, F.lit(False).alias("success"), F.lit("reopened").alias("message"))
        change.upsert("aggregation", reopened, set_columns=["success", "message"])
        change.commit()

    return (
        tx.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def monthly_means(values: DataFrame, keys: Sequence[str], time: str = "ts", value: str = "value",
                  lateness_days: int = 7) -> DataFrame:
    """Mean of present values per (keys, calendar month) over a stream.

    Months differ in length, so the event-time column is the month's end and the watermark trails
    by a month and the allowed lateness; a month's state is dropped after that.
    """
    end = F.add_months(F.trunc(F.col(time).cast("date"), "MM"), 1).cast("timestamp")
    return (
        values.withColumn("month_end", end)
        .withWatermark("month_end", f"{MONTH_DAYS + lateness_days} days")
        .groupBy(*keys, "month_end")
        .agg(F.avg(value).alias("mean_value"), F.count(value).alias("n_valid"))
    )


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Drain a stream into Parquet and wait for it."""
    query = (
        df.writeStream.outputMode(mode).format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


