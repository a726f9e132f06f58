"""Incremental forms, drained over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.schemas import AGGREGATION, TRANSFORMATION
from tidegrid.session import shared_dir
from tidegrid.sinks.store import StateStore
from tidegrid.sources.state import with_defaults
from tidegrid.streaming import jobs
from tidegrid.workload.registry import Views, query, ts_text
from tidegrid.workload.sqltext import TS, sql


@query("stream_listing", sql("b_granule", f"""
    SELECT ds, count(*) AS n, {TS.format('max(mod_time)')} AS last_mod FROM b_granule GROUP BY ds"""))
def stream_listing(v: Views):
    """New and re-published files queued from a stream of listings."""
    root = shared_dir(v.spark, "listing")
    listed = v.granule.select("ds", F.concat(F.lit("https://h/"), "filename").alias("url"), "filename", "mod_time", "date", "hemi")
    older = listed.withColumn("mod_time", F.col("mod_time") - F.make_interval(days=F.lit(400)))
    older.write.mode("append").parquet(f"{root}/in")
    listed.write.mode("append").parquet(f"{root}/in")
    store = StateStore(v.spark, f"{root}/state")
    stream = jobs.read_listing(v.spark, f"{root}/in", listed.schema, files_per_trigger=8)
    jobs.follow_listing(stream, store, f"{root}/checkpoint").awaitTermination()
    out = store.read("granule").groupBy("ds").agg(F.count(F.lit(1)).alias("n"), F.max("mod_time").alias("last_mod"))
    return out.withColumn("last_mod", ts_text("last_mod"))


@query("stream_reopen", sql("b_tx b_agg", """
    SELECT a.ds, a.grid, a.field, a.year, a.success AND NOT coalesce(t.last > a.agg_time, FALSE) AS success
    FROM b_agg a LEFT JOIN (SELECT ds, grid, field, CAST(year(date) AS INTEGER) AS year, max(completed) AS last FROM b_tx WHERE success GROUP BY ALL) t USING (ds, grid, field, year)"""))
def stream_reopen(v: Views):
    """Late transformations re-open their years."""
    root = shared_dir(v.spark, "reopen")
    tx = with_defaults(v.tx, TRANSFORMATION)
    tx.write.parquet(f"{root}/in")
    store = StateStore(v.spark, f"{root}/state")
    store.commit("aggregation", with_defaults(v.agg, AGGREGATION))
    stream = jobs.read_listing(v.spark, f"{root}/in", tx.schema)
    jobs.follow_transformations(stream, store, f"{root}/checkpoint").awaitTermination()
    return store.read("aggregation").select("ds", "grid", "field", "year", "success")


@query("stream_monthly", sql("b_val", f"""
    SELECT event_type, user_id, {TS.format("date_trunc('month', ts) + INTERVAL 1 MONTH")} AS month_end, round(avg(value), 8) AS mean_value, count(value) AS n_valid
    FROM b_val GROUP BY ALL"""))
def stream_monthly(v: Views):
    """Monthly means kept up to date over a stream of events."""
    root = shared_dir(v.spark, "monthly")
    schema = v.table("events").schema
    events = jobs.read_listing(v.spark, v.dir, schema, glob="events.parquet")
    rows = events.select("event_type", "user_id", F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"))
    means = jobs.monthly_means(rows, ["event_type", "user_id"])

    # update mode keeps every month's latest value; the whole batch output is written by version
    def write(batch, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(f"{root}/out")

    means.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    last = v.spark.read.parquet(f"{root}/out").groupBy("event_type", "user_id", "month_end").agg(F.max_by(F.struct("mean_value", "n_valid"), "epoch").alias("r"))
    return last.select("event_type", "user_id", ts_text("month_end").alias("month_end"), F.round("r.mean_value", 8).alias("mean_value"), "r.n_valid")
