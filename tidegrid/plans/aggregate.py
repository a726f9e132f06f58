"""From regridded records to daily and monthly annual products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.text import product_name, stable_id
from tidegrid.functions.timebounds import month_window, time_window
from tidegrid.operators import planning, state, temporal
from tidegrid.operators.regrid import dataset_attributes, product_attributes, record_attributes
from tidegrid.schemas import DatasetConfig
from tidegrid.sinks.packing import numbered_cells, pack_whole, write_blocks
from tidegrid.sinks.partials import monthly_from_partials, stored_partials, update_partials
from tidegrid.sinks.products import write_facts, write_product
from tidegrid.sinks.provenance import members, provenance_lines, write_lineage
from tidegrid.sinks.store import StateStore
from tidegrid.sizing import bounded_broadcast, materialize, spread_join

SERIES_KEYS = ("ds", "grid", "field")


def merged_series(records: DataFrame, keys: Sequence[str] = SERIES_KEYS, unique: bool = False) -> DataFrame:
    """One value per (series, date, cell): hemispheres of a date merged by priority.

    ``unique`` says that a hemisphere has at most one record per date; otherwise file names break ties.
    """
    order = [temporal.hemi_priority("hemi")] + ([] if unique else [F.col("filename")])
    return temporal.hemi_merge(records, [*keys, "date"], order)


def one_record_per_hemisphere(tx: DataFrame) -> bool:
    """Whether no (series, date, hemisphere) has several records, read from the state table alone."""
    records = tx.filter("success").groupBy("ds", "grid", "field", "date", "hemi").agg(F.count(F.lit(1)).alias("n"))
    return records.filter(F.col("n") > 1).isEmpty()


def _period(config: DatasetConfig) -> str:
    return "AVG_MON" if config.time_scale == "monthly" else "AVG_DAY"


def daily_rows(series: DataFrame, cells: DataFrame, config: DatasetConfig, stats: DataFrame | None = None,
               keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """The annual series with compact rows for missing dates; years without data are left out."""
    rows = temporal.savable(series, keys, stats=stats).drop("year")
    dates = rows.select(*keys, "date").distinct()
    gaps = temporal.missing_months(dates, keys) if config.time_scale == "monthly" else temporal.missing_days(dates, keys)
    packed = temporal.with_gaps(rows, gaps.drop("year"), cells, keys, cell_on=["grid"])
    return packed.withColumn("year", temporal.gap_year())


def daily_product(series: DataFrame, cells: DataFrame, config: DatasetConfig, stats: DataFrame | None = None,
                  keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """The annual series with empty records for missing dates; years without data are left out."""
    return temporal.fill_gaps(daily_rows(series, cells, config, stats, keys), keys, _period(config))


def monthly_product(series: DataFrame, config: DatasetConfig, stats: DataFrame | None = None,
                    days: DataFrame | None = None, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Monthly means of the years that have data, straight from the sparse series."""
    rows = temporal.savable(series, keys, stats=stats).drop("year")
    return temporal.monthly_mean(rows, keys, skipna=config.skipna, drop_empty=config.drop_empty_days, days=days)


def write_products(series: DataFrame, cells: DataFrame, config: DatasetConfig, daily_path: str, monthly_path: str,
                   staging: str, partials_path: str | None = None) -> DataFrame:
    """Write a dataset's annual products and return the statistics of its years.

    The merged series is stored once and read by every step; the small per-year and per-month tables
    are stored too, so the joins on them are planned with their real size. With ``partials_path`` monthly
    means come from kept sums, of which only months whose series changed are computed again.
    """
    series = materialize(series, f"{staging}/series")
    stats = materialize(temporal.year_stats(series, SERIES_KEYS), f"{staging}/stats")
    monthly_only = config.time_scale == "monthly"
    write_product(
        daily_rows(series, cells, config, stats), monthly_path if monthly_only else daily_path,
        finish=lambda rows: temporal.fill_gaps(rows, SERIES_KEYS, _period(config)))
    if config.do_monthly and not monthly_only and partials_path is not None:
        years = materialize(stats.filter("has_data").select(*planning.AGG_KEY), f"{staging}/years")
        update_partials(series, partials_path, SERIES_KEYS, years)
        kept = stored_partials(series.sparkSession, partials_path, [series.schema[k] for k in SERIES_KEYS], series.schema["cell_id"])
        kept = spread_join(kept, years, planning.AGG_KEY, salt_from=["cell_id"], how="left_semi")
        write_product(monthly_from_partials(kept, SERIES_KEYS, skipna=config.skipna, drop_empty=config.drop_empty_days), monthly_path)
    elif config.do_monthly and not monthly_only:
        days = None
        if config.drop_empty_days and not config.skipna:
            days = materialize(temporal.days_with_data(series, SERIES_KEYS), f"{staging}/days")
        write_product(monthly_product(series, config, stats, days), monthly_path)
    return stats


def rebuild(store: StateStore, config: DatasetConfig, files: DataFrame, products: DataFrame) -> int:
    """Give years whose state row is missing one, where the product is as new as all its inputs; returns the commit.

    ``files`` has (output_path, mtime) of regridded records, ``products`` (ds, grid, field, year, product_mtime).
    """
    change = store.transaction()
    tx, agg = (change.read(t).filter(F.col("ds") == config.ds) for t in ("transformation", "aggregation"))
    checked = planning.agg_output_check(planning.agg_plan(tx, agg), tx, files, products)
    change.upsert("aggregation", planning.rebuilt_agg_rows(checked, F.lit(config.a_version)))
    return change.commit()


def plan(store: StateStore, targets: DataFrame, versions: DataFrame) -> DataFrame:
    """(ds, grid, field, year) to aggregate.

    A changed aggregation version brings every year of the dataset; otherwise years without a
    successful aggregation or with a newer transformation.
    """
    todo = planning.agg_plan(store.read("transformation"), store.read("aggregation"))
    fresh = todo.filter(F.col("reason").isNotNull()).select(*planning.AGG_KEY)
    every = planning.agg_plan_all_years(targets, store.read("dataset"), versions)
    return fresh.unionByName(every).distinct()


def product_facts(series: DataFrame, stats: DataFrame, config: DatasetConfig, grid_types: DataFrame) -> DataFrame:
    """One row per annual product (ds, grid, field, year, scale): valid range, time coverage, attributes.

    The windows come from the dates of the records, gaps included, not from their cells.
    """
    keys = list(planning.AGG_KEY)
    monthly_only = config.time_scale == "monthly"
    years = stats.filter("has_data").select(*keys, "valid_min", "valid_max")
    dates = temporal.savable(series, SERIES_KEYS, stats=stats).select(*SERIES_KEYS, F.col("date").cast("date").alias("date"), "year").distinct()
    gaps = (temporal.missing_months if monthly_only else temporal.missing_days)(dates.drop("year"), SERIES_KEYS)
    window = time_window(start="date", period=_period(config))
    own = dates.unionByName(gaps.withColumn("date", F.col("date").cast("date"))).withColumn("w", window).select(*keys, F.col("w.start").alias("time_start"), F.col("w.end").alias("time_end"))
    covered = temporal.time_coverage(own, keys, "P1M" if monthly_only else "P1D").withColumn("scale", F.lit("monthly" if monthly_only else "daily"))
    if config.do_monthly and not monthly_only:
        months = years.select(*keys, F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")).withColumn("w", month_window("year", "month"))
        months = months.select(*keys, F.col("w.start").alias("time_start"), F.col("w.end").alias("time_end"))
        covered = covered.unionByName(temporal.time_coverage(months, keys, "P1M").withColumn("scale", F.lit("monthly")))
    fields = series.sparkSession.createDataFrame([(f.name, f.long_name, f.standard_name, f.units) for f in config.fields], "field string, long_name string, standard_name string, units string")
    facts = covered.join(years, keys).join(F.broadcast(fields), "field", "left").join(bounded_broadcast(grid_types), "grid", "left")
    described = record_attributes(facts, "grid", product_name("ds", "grid", "scale", "field", "year"))
    general = dataset_attributes(config.extra, F.col("grid"), F.col("grid_type"), config.t_version)
    both = F.map_concat(F.map_filter("attrs", lambda k, _: k != "interpolated_grid"), general)
    return described.withColumn("attrs", product_attributes(both)).select(
        *keys, "scale", "valid_min", "valid_max", "coverage_start", "coverage_end", "resolution", "attrs")


def write_packed(series: DataFrame, cells: DataFrame, config: DatasetConfig, stats: DataFrame, path: str) -> None:
    """Records of the annual products as blocks of big-endian floats, in order of time and offset.

    A grid's cells are numbered from 0 in order of their ids; every block of every record comes out.
    """
    spark, keys = series.sparkSession, [*planning.AGG_KEY, "date"]
    rows = temporal.savable(series, SERIES_KEYS, stats=stats).withColumn("date", F.col("date").cast("date"))
    numbered, sizes = None, []
    for grid in [r.grid for r in stats.select("grid").distinct().collect()]:  # a row per grid
        own = numbered_cells(cells.filter(F.col("grid") == grid).select("cell_id").distinct(), f"{path}/_order-{grid}").withColumn("grid", F.lit(grid))
        sizes.append((grid, own.count()))
        numbered = own if numbered is None else numbered.unionByName(own)
    if numbered is None:
        return
    dates = rows.select(*keys).distinct()
    gaps = (temporal.missing_months if config.time_scale == "monthly" else temporal.missing_days)(dates.drop("year"), SERIES_KEYS)
    records = dates.unionByName(gaps.select(*SERIES_KEYS, "year", F.col("date").cast("date").alias("date")))
    records = records.join(F.broadcast(spark.createDataFrame(sizes, "grid string, n_cells long")), "grid")
    values = spread_join(rows, numbered, ["grid", "cell_id"], salt_from=["date"]).select(*keys, "position", "value")
    write_blocks(pack_whole(values, records, keys), f"{path}/blocks")


def run(store: StateStore, records: DataFrame, cells: DataFrame, todo: DataFrame, config: DatasetConfig,
        daily_path: str, monthly_path: str, staging: str, now: Column, facts_path: str | None = None,
        packed_path: str | None = None, lineage_path: str | None = None, partials_path: str | None = None) -> None:
    """Aggregate the dataset's planned years, write the products, record the outcome; other datasets stay as they are.

    A planned year without any record in ``records`` fails; one whose records hold no value succeeds
    with a note and without a product. With their paths given, the job also writes a row of facts per
    product, packed records, and the lineage of what it aggregated, and keeps monthly sums, so that the
    monthly means of a re-opened year are computed again for its changed months only. State rows and the dataset's status are
    one commit, made last: a run that dies before leaves products that the next one replaces.
    """
    keys = list(planning.AGG_KEY)
    todo = materialize(todo.filter(F.col("ds") == config.ds), f"{staging}/todo")
    wanted = spread_join(records.withColumn("year", F.year("date")), todo, keys, salt_from=["cell_id"], how="left_semi").drop("year")
    tx = store.read("transformation", datasets=[config.ds]).filter(F.col("ds") == config.ds)
    series = materialize(merged_series(wanted, unique=one_record_per_hemisphere(tx)), f"{staging}/merged")
    stats = write_products(series, cells, config, daily_path, monthly_path, staging, partials_path)
    if facts_path is not None:
        types = store.read("grid").select("grid", "grid_type")
        write_facts(product_facts(series, stats, config, types), facts_path)
    if packed_path is not None:
        write_packed(series, cells, config, stats, packed_path)

    found, empty = F.col("has_data").isNotNull(), ~F.col("has_data")
    monthly_only = config.time_scale == "monthly"
    folder = lambda root: F.when(F.col("has_data"), F.concat_ws("/", F.lit(root.rstrip("/")), *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys])).otherwise("")
    name = lambda scale: stable_id(*keys, F.lit(config.a_version), F.lit(scale), now)
    rows = todo.join(stats, keys, "left").select(
        *keys, found.alias("success"), now.alias("started"), now.alias("agg_time"), F.lit(config.a_version).alias("version"),
        F.when(found, "").otherwise("Aggregation failed: no records of this year").alias("message"),
        F.when(found & empty, "Empty year (no data present in grid), not saving to disk.").otherwise("").alias("notes"),
        *([] if monthly_only else [folder(daily_path).alias("daily_path"), name("daily").alias("daily_uuid")]),
        *([folder(monthly_path).alias("monthly_path"), name("monthly").alias("monthly_uuid")] if monthly_only or config.do_monthly else []))
    change = store.transaction()
    change.upsert("aggregation", planning.with_ids(rows, change.read("aggregation"), planning.AGG_KEY).drop("reused"))
    agg = change.read("aggregation").filter(F.col("ds") == config.ds)
    status = state.aggregation_status(agg).select(
        "ds", F.col("status").alias("aggregation_status"), F.lit(config.a_version).alias("aggregation_version"),
        now.alias("last_aggregation"))
    change.upsert("dataset", status)
    if lineage_path is not None:
        done = spread_join(agg, todo, keys, salt_from=["id"], how="left_semi").filter("success")
        inputs = members(tx, store.read("granule", datasets=[config.ds]))
        inputs = spread_join(inputs, done.select(*keys), keys, salt_from=["filename"], how="left_semi")
        write_lineage(provenance_lines(inputs, done, change.read("dataset")), done, lineage_path)
    change.commit()
