"""From listed files to a harvest plan and back to state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions import text
from tidegrid.operators import harvest, planning, state
from tidegrid.schemas import DatasetConfig
from tidegrid.sinks.store import StateStore


def plan(listing: DataFrame, config: DatasetConfig, known: DataFrame, compare: str = "timestamp") -> DataFrame:
    """Files of a dataset to fetch: filtered, selected by the dataset's strategy, diffed with state."""
    rows = harvest.candidates(listing, config)
    if config.strategy == "month_to_days":
        rows = harvest.month_to_days(rows).withColumns({
            "filename": F.col("daily_filename"), "date": F.col("day").cast("timestamp")}).drop("daily_filename", "day")
    elif config.strategy == "series_slice":
        raise ValueError("a series is sliced after its file is fetched; see plan_slices")
    elif config.strategy != "plain":
        picked = harvest.select(rows, config.strategy)
        # keep the strategy's date, take everything else from the listing
        rows = rows.drop("date").join(picked.select("ds", "url", F.col("date").cast("timestamp").alias("date")), ["ds", "url"])
    # a file listed twice is fetched once, from the latest publication
    latest = harvest.latest_per_key(rows, ["ds", "filename"], ["mod_time", "url"])
    return planning.needs_harvest(latest, known, compare=compare)


def plan_slices(steps: DataFrame, config: DatasetConfig, known: DataFrame, compare: str = "timestamp") -> DataFrame:
    """Monthly slices of fetched multi-month files that need work.

    ``steps`` has one row per time step: ds, url, mod_time and time. A month found in several files
    is taken from the latest publication.
    """
    slices = harvest.series_slice(steps, ["ds", "url", "mod_time"]).withColumn("date", F.col("month").cast("timestamp"))
    in_range = slices.filter(text.in_range("date", config.start, config.end))
    latest = harvest.latest_per_key(in_range, ["ds", "filename"], ["mod_time", "url"])
    return planning.needs_harvest(latest, known, compare=compare)


def record(store: StateStore, attempts: DataFrame, files: DataFrame, now: Column) -> None:
    """Write harvest attempts to the granule table and refresh the rows of their datasets."""
    change = store.transaction()
    change.upsert("granule", state.granule_results(attempts, change.read("granule"), files, now))
    tried = attempts.select("ds").distinct()
    change.upsert("dataset", state.dataset_rows(change.read("granule").join(tried, "ds", "left_semi"), now))
    change.commit()
