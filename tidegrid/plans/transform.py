"""From harvested granules to regridded records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.masks import apply_masks
from tidegrid.functions.geo import METRES_PER_DEGREE
from tidegrid.functions.layout import source_index
from tidegrid.functions.text import hemi_tag, transformed_name
from tidegrid.functions.timebounds import record_window
from tidegrid.functions.units import apply_post
from tidegrid.operators import planning, state
from tidegrid.operators.mapping import Packs, ensure_mapping, filesystem, fingerprint, read_packs
from tidegrid.operators.regrid import MEDIANS, crowded, on_full_grid, record_stats, regrid
from tidegrid.plans.maintenance import mapping_mark
from tidegrid.schemas import DatasetConfig, FieldConfig
from tidegrid.sinks.products import write_regridded
from tidegrid.sinks.store import StateStore
from tidegrid.sizing import bounded_broadcast as checked_broadcast
from tidegrid.sizing import materialize
from tidegrid.sources.cells import read_cells, to_long, with_fields

RECORD_KEYS = ("ds", "filename", "date", "hemi")


def _groups(fields: Sequence[FieldConfig]) -> list[tuple[tuple[str, ...], tuple[str, ...], list[FieldConfig]]]:
    """Fields that share masks and post-transformations; masks accumulate in field order."""
    seen: list[str] = []
    groups: dict[tuple, list[FieldConfig]] = {}
    for f in fields:
        seen += [m for m in f.pre_transformations if m not in seen]
        groups.setdefault((tuple(seen), f.post_transformations), []).append(f)
    return [(masks, post, members) for (masks, post), members in groups.items()]


def regrid_dataset(obs: DataFrame, mapping: DataFrame | Packs, config: DatasetConfig, grid: str,
                   keys: Sequence[str] = RECORD_KEYS) -> DataFrame:
    """All fields of a dataset on one grid, with record windows and units.

    ``obs`` is wide: record keys, ``src_id`` and one column per variable; a bounds variable is an
    array, a center time is ``time``. Fields with the same masks and post-transformations share one
    scan. Only cells the mapping reaches come out.
    """
    names = [f.name for f in config.fields]
    bounds = config.time_bounds_var if config.time_bounds_var in obs.columns else None
    window = record_window(
        "date", config.time_scale,
        bounds_start=F.try_element_at(bounds, F.lit(1)) if bounds else None,
        bounds_end=F.try_element_at(bounds, F.lit(-1)) if bounds else None,
        center=F.col("time") if "time" in obs.columns else F.col("date"), next_day_end=config.next_day_end)
    # the window belongs to the record: it travels with the keys
    wide = with_fields(obs, names).withColumn("w", window).withColumns(
        {"time_start": F.col("w.start"), "time": F.col("w.center"), "time_end": F.col("w.end")}).drop("w")
    keys = [*keys, "time_start", "time", "time_end"]
    bounded = config.mapping_operation in MEDIANS and crowded(mapping)
    out = None
    for masks, post, members in _groups(config.fields):
        cols = [f.name for f in members]
        long = to_long(apply_masks(wide, masks), [*keys, "src_id"], cols)
        units = F.create_map(*[F.lit(x) for f in members for x in (f.name, f.units)])
        part = (
            regrid(long, mapping, [*keys, "field"], config.mapping_operation, bounded=bounded)
            .withColumns({"grid": F.lit(grid), "units": units[F.col("field")]})
        )
        part = apply_post(part, post)
        out = part if out is None else out.unionByName(part)
    return out


def plan(store: StateStore, config: DatasetConfig, targets: DataFrame, source_files: DataFrame,
         outputs: DataFrame) -> DataFrame:
    """Combinations of the dataset's granules, grids and fields with ids, reasons and problems."""
    mine = F.col("ds") == config.ds
    hemi = hemi_tag("filename", config.hemi_north, config.hemi_south)
    granules = store.read("granule").filter(mine & F.col("success")).withColumn("hemi", hemi)
    tx = store.read("transformation").filter(mine)
    versions = store.spark.createDataFrame([(config.ds, config.t_version)], "ds STRING, t_version DOUBLE")
    mtimes = source_files.select("path", F.col("mtime").alias("source_mtime"))
    want = planning.tx_plan(granules.drop("id", "success"), targets, tx, versions).join(mtimes, "path", "left")
    checked = planning.output_is_current(want, outputs)
    return planning.with_ids(planning.triage(checked), tx, planning.TX_KEY)


def begin(store: StateStore, planned: DataFrame, now: Column, staging: str) -> DataFrame:
    """One snapshot with rebuilt, unprocessable and in-progress rows, before work starts.

    The plan is stored first, so the three kinds of rows and the work itself read one and the same
    list; it is returned.
    """
    planned = materialize(planned, f"{staging}/plan")
    todo = planning.work_items(planned)
    ready = todo.filter(F.col("problem").isNull())
    rows = (
        planning.rebuilt_tx_rows(planned)
        .unionByName(state.unprocessable_rows(todo, now), allowMissingColumns=True)
        .unionByName(state.in_progress_rows(ready, now), allowMissingColumns=True)
    )
    touched = ["in_progress", "success", "started", "completed", "message", "origin_checksum"]
    store.upsert("transformation", rows, set_columns=touched)
    return ready


def source_cells_of(obs: DataFrame, config: DatasetConfig, shape: tuple[int, int] | None) -> DataFrame:
    """Give every observation its source cell number; an array position is numbered as ``transpose`` says."""
    if "src_id" in obs.columns:
        return obs
    if shape is None:
        raise ValueError("cells by row and col need the shape of the source grid")
    return obs.withColumn("src_id", source_index("row", "col", *shape, transpose=config.transpose))


def write_records(records: DataFrame, path: str, staging: str) -> None:
    """Write regridded records next to those of other files.

    A file's earlier records are replaced. Only the folders that get new records are rewritten, from a
    stored copy of their other rows.
    """
    spark, parts = records.sparkSession, ["ds", "grid", "field", "year"]
    records = materialize(records.withColumn("year", F.year("date")), f"{staging}/records")
    fs, folder = filesystem(spark, path)
    if fs.exists(folder):
        touched = records.select(*parts).distinct()
        old = spark.read.schema(records.schema).parquet(path).join(touched, parts, "left_semi")
        old = old.join(records.select("ds", "grid", "field", "filename").distinct(), ["ds", "grid", "field", "filename"], "left_anti")
        records = records.unionByName(materialize(old, f"{staging}/kept"))
    write_regridded(records, path)


def run(store: StateStore, config: DatasetConfig, ready: DataFrame, cells_path: str, sources: DataFrame, grids: DataFrame,
        mapping_path: str, records_path: str, staging: str, now: Column, shape: tuple[int, int] | None = None) -> DataFrame:
    """Regrid the planned combinations, write the records and return and record one result for each.

    ``ready`` is what ``begin`` returned. ``cells_path`` holds the granules' cells (filename and either
    src_id or row and col, next to the variables), ``sources`` the source cells (src_id, lon, lat and, for
    a dataset by hemisphere, hemi), ``grids`` the target cells with grid and grid_type. Records cover the
    whole grid. A combination without cells in the input fails; a missing field is an empty record with a
    warning. A grid whose mapping cannot be made fails with the reason, and the others go on.
    """
    spark = store.spark
    ready = materialize(ready, f"{staging}/ready")
    names = [f.name for f in config.fields]
    obs = source_cells_of(read_cells(spark, cells_path, config.preprocessing, names), config, shape)
    todo = ready.select("ds", "filename", "date", F.coalesce("hemi", F.lit("")).alias("hemi")).distinct()
    obs = obs.drop("ds", "date", "hemi").join(checked_broadcast(todo), "filename")
    present = obs.select("filename").distinct()
    spacing = float(config.data_res or 1.0) * METRES_PER_DEGREE
    out, marks, broken = None, {}, []
    for grid in [r.grid for r in ready.select("grid").distinct().orderBy("grid").collect()]:
        target = grids.filter(F.col("grid") == grid)
        for hemi in [r.hemi for r in todo.select("hemi").distinct().orderBy("hemi").collect()]:
            own = sources.filter(F.col("hemi") == hemi) if hemi and "hemi" in sources.columns else sources
            key = (config.ds, grid, hemi, config.t_version)
            try:
                ensure_mapping(spark, mapping_path, key, target, own, spacing)
                marks[mapping_mark(*key)] = fingerprint(target, own, spacing)
                mapping = read_packs(spark, mapping_path, *key, marks[mapping_mark(*key)])
            except (ValueError, PySparkException) as e:
                broken.append((grid, hemi, f"mapping of the grid failed: {type(e).__name__}: {next(iter(str(e).splitlines()), '')[:200]}"))
                continue
            values = regrid_dataset(obs.filter(F.col("hemi") == hemi), mapping, config, grid)
            out = values if out is None else out.unionByName(values)
    if out is None and not broken:
        return ready.select("id", *planning.TX_KEY).withColumn("success", F.lit(True))
    # a row per failed grid and hemisphere
    failed = spark.createDataFrame(broken, "grid string, hemi string, failure string")
    ready = ready.withColumn("hemi", F.coalesce("hemi", F.lit(""))).join(F.broadcast(failed), ["grid", "hemi"], "left")
    results = ready.select("id", *planning.TX_KEY, F.lit(False).alias("success"), F.col("failure").alias("message")).filter("message IS NOT NULL")
    ready = ready.filter(F.col("failure").isNull())
    if out is not None:
        done = _write_regridded(spark, ready, present, obs, out, grids, names, records_path, staging)
        results = results.unionByName(state.failure_fanout(ready.select("id", *planning.TX_KEY), done, default="no cells of this granule in the input"))
    folder = F.concat(F.lit(records_path.rstrip("/") + "/ds="), "ds", F.lit("/grid="), "grid", F.lit("/field="), "field")
    results = materialize(results.withColumns({
        "output_name": transformed_name("grid", "field", "filename"), "output_path": folder,
        "checksum": F.lit(None).cast("string")}), f"{staging}/results")
    finish(store, results, now, F.lit(config.t_version), marks)
    return results


def _write_regridded(spark: SparkSession, ready: DataFrame, present: DataFrame, obs: DataFrame, out: DataFrame, grids: DataFrame,
                     names: Sequence[str], records_path: str, staging: str) -> DataFrame:
    """Write the records of the combinations that have cells; returns what was done for each of these."""
    wanted = ready.select("ds", "filename", "grid", "field").distinct()
    values = materialize(out.join(checked_broadcast(wanted), ["ds", "filename", "grid", "field"], "left_semi"), f"{staging}/values")
    windows = ["time_start", "time", "time_end", "units"]
    heads = ["ds", "filename", "grid", "field"]
    per_record = values.groupBy(*heads).agg(*[F.first(c).alias(c) for c in windows])
    records = ready.join(present, "filename", "left_semi").select(*heads, "date", F.coalesce("hemi", F.lit("")).alias("hemi")).join(per_record, heads, "left")
    full = on_full_grid(values.select(*heads, "cell_id", "value"), grids.select("grid", "cell_id"), records, heads)
    write_records(full, records_path, staging)

    # what was regridded is staged; the written records are not read again
    stats = records.select(*heads).join(record_stats(values, heads), heads, "left")
    absent = [n for n in names if n not in obs.columns]
    return ready.join(present, "filename", "left_semi").join(stats, heads).select(
        *heads, F.lit(True).alias("success"),
        F.when(F.col("field").isin(absent), F.concat(F.lit("Field '"), "field", F.lit("' missing from source data"))).otherwise("").alias("message"))


def finish(store: StateStore, results: DataFrame, now: Column, version: Column, marks: Mapping[str, str] | None = None) -> None:
    """Record returned results, the status of their datasets and the mappings used, all in one commit."""
    updates, _ = state.result_updates(results, now, version)
    change = store.transaction()
    change.rewrite("transformation", updates, ["id"], lambda tx: state.record_results(tx, updates))
    tx = change.read("transformation")
    touched = tx.join(updates.select("id").distinct(), "id", "left_semi").select("ds").distinct()
    status = state.transformation_status(tx.join(touched, "ds", "left_semi")).select(
        "ds", F.col("status").alias("transformation_status"), now.alias("last_transformation"))
    change.upsert("dataset", status)
    for name, mark in (marks or {}).items():
        change.mark(name, mark)
    change.commit()
