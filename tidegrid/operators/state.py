"""Writes to the state tables, as functions from old rows and news to new rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions import text
from tidegrid.operators.planning import TX_KEY, _true
from tidegrid.session import shared_dir
from tidegrid.sizing import bounded_broadcast, materialize, spread_join

IN_PROGRESS_MESSAGE = "Transformation in progress (or interrupted before completion)"


def upsert(current: DataFrame, updates: DataFrame, key: Sequence[str],
           set_columns: Iterable[str] | None = None) -> DataFrame:
    """Merge updates by key: named columns take the update's value, others keep theirs, new keys come in.

    A column present in ``updates`` and listed in ``set_columns`` is written even when the new value
    is NULL; other update columns only fill in for new keys. Of several updates with one key the largest
    row by its values, in column order, counts.
    """
    key = list(key)
    if news := [c for c in updates.columns if c not in key]:
        updates = updates.groupBy(*key).agg(F.max(F.struct(*news)).alias("__news")).select(*key, "__news.*")
    else:
        updates = updates.distinct()
    written = set(updates.columns if set_columns is None else set_columns) - set(key)
    cur = current.select(*key, F.lit(True).alias("__c"), *[F.col(c).alias("c_" + c) for c in current.columns if c not in key])
    upd = updates.select(*key, F.lit(True).alias("__u"), *[F.col(c).alias("u_" + c) for c in updates.columns if c not in key])
    joined = cur.join(upd, key, "full_outer")
    out = []
    for c in current.columns:
        if c in key:
            out.append(F.col(c))
        elif c not in updates.columns:
            out.append(F.col("c_" + c).alias(c))
        elif c in written:
            out.append(F.when(F.col("__u").isNotNull(), F.col("u_" + c)).otherwise(F.col("c_" + c)).alias(c))
        else:
            out.append(F.when(F.col("__c").isNull(), F.col("u_" + c)).otherwise(F.col("c_" + c)).alias(c))
    return joined.select(*out)


def in_progress_rows(plan: DataFrame, started: Column) -> DataFrame:
    """Transformation rows to write before work starts; ``plan`` has an ``id`` per combination."""
    return plan.select(
        "id", *TX_KEY, "date", "hemi", F.col("path").alias("source_path"),
        F.col("checksum").alias("origin_checksum"), F.lit(True).alias("in_progress"),
        F.lit(False).alias("success"), started.alias("started"),
        F.lit(IN_PROGRESS_MESSAGE).alias("message"),
    )


def result_updates(results: DataFrame, completed: Column, version: Column) -> tuple[DataFrame, DataFrame]:
    """Finished work as updates keyed by ``id``; results without an id are returned separately.

    File columns are set only on success; on failure the earlier ones stay.
    """
    ok = _true("success")
    updates = results.filter(F.col("id").isNotNull()).select(
        "id", F.lit(False).alias("in_progress"), ok.alias("success"), completed.alias("completed"),
        "message", *[F.when(ok, F.col(c)).alias(c) for c in ("output_name", "output_path", "checksum")],
        F.when(ok, version).alias("version"),
    )
    return updates, results.filter(F.col("id").isNull())


def record_results(tx: DataFrame, updates: DataFrame) -> DataFrame:
    """Apply finished work to the transformation table."""
    u = updates.select("id", F.lit(True).alias("__u"), *[F.col(c).alias("u_" + c) for c in updates.columns if c != "id"])
    always = ("in_progress", "success", "completed", "message")
    on_success = ("output_name", "output_path", "checksum", "version")
    cols = []
    for c in tx.columns:
        if c in always and c in updates.columns:
            cols.append(F.when(F.col("__u"), F.col("u_" + c)).otherwise(F.col(c)).alias(c))
        elif c in on_success and c in updates.columns:
            cols.append(F.when(_true("u_success"), F.col("u_" + c)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return tx.join(u, "id", "left").select(*cols)


def unprocessable_rows(plan: DataFrame, completed: Column) -> DataFrame:
    """Failed rows, with the reason, for combinations whose granule has a ``problem``."""
    return plan.filter(F.col("problem").isNotNull()).select(
        "id", *TX_KEY, "date", "hemi", F.coalesce("path", F.lit("")).alias("source_path"),
        F.lit(False).alias("in_progress"), F.lit(False).alias("success"),
        completed.alias("started"), completed.alias("completed"), F.col("problem").alias("message"),
        *([F.col("checksum").alias("origin_checksum")] if "checksum" in plan.columns else []),
    )


def failure_fanout(plan: DataFrame, results: DataFrame, key: Sequence[str] = tuple(TX_KEY),
                   default: str = "no result returned") -> DataFrame:
    """One result per planned combination; those without one failed."""
    got = results.select(*key, F.col("success").alias("got"), F.col("message").alias("got_message"))
    return plan.join(got, list(key), "left").withColumns({
        "success": _true("got"),
        "message": F.when(F.col("got").isNull(), F.lit(default)).otherwise(F.coalesce("got_message", F.lit(""))),
    }).drop("got", "got_message")


def granule_results(attempts: DataFrame, state: DataFrame, files: DataFrame, attempted: Column,
                    key: Sequence[str] = ("ds", "filename")) -> DataFrame:
    """Granule rows after a harvest attempt.

    A success takes path, size, checksum and time from the file; a failure blanks them, keeps its
    message and the earlier download time. An existing id stays.
    """
    old = state.select(*key, F.col("id").alias("old_id"), F.col("download_time").alias("old_download"))
    disk = files.select("filename", F.col("path").alias("f_path"), F.col("size").alias("f_size"),
                        F.col("mtime").alias("f_mtime"), F.col("checksum").alias("f_checksum"))
    ok = _true("success")
    return (
        attempts.join(old, list(key), "left").join(disk, "filename", "left")
        .select(
            F.coalesce("old_id", text.stable_id(*key)).alias("id"), *key,
            F.date_trunc("day", F.col("date").cast("timestamp")).alias("date"), "url",
            F.date_trunc("day", F.col("mod_time").cast("timestamp")).alias("mod_time"),
            ok.alias("success"),
            F.when(ok, F.col("f_path")).otherwise(F.lit("")).alias("path"),
            F.when(ok, F.col("f_checksum")).alias("checksum"),
            F.when(ok, F.col("f_size")).otherwise(F.lit(0)).cast("bigint").alias("size"),
            F.when(ok, F.lit("")).otherwise(F.col("message")).alias("message"),
            F.when(ok, F.col("f_mtime")).otherwise(F.col("old_download")).alias("download_time"),
            attempted.alias("last_attempt"), F.col("duration"),
        )
    )


def purge_range(state: DataFrame, ranges: DataFrame, date: str = "date") -> DataFrame:
    """Keep rows inside their dataset's configured range; ``ranges`` has (ds, start, end)."""
    r = ranges.select("ds", F.col("start").alias("__start"), F.col("end").alias("__end"))
    return (
        state.join(bounded_broadcast(r), "ds")
        .filter(F.col(date).between(F.col("__start"), F.col("__end"))).drop("__start", "__end")
    )


def purge_version(tx: DataFrame, versions: DataFrame) -> DataFrame:
    """Keep transformation rows whose version equals the configured one (datasets without a config stay)."""
    v = versions.select("ds", F.lit(True).alias("__has"), F.col("t_version").alias("__v"))
    return (
        tx.join(bounded_broadcast(v), "ds", "left")
        .filter(F.col("__has").isNull() | F.col("version").eqNullSafe(F.col("__v"))).drop("__has", "__v")
    )


def outdated(rows: DataFrame, ranges: DataFrame, versions: DataFrame | None = None, date: str = "date") -> DataFrame:
    """Rows to delete: outside their dataset's range (both ends are inside), or of another version than configured.

    ``ranges`` has (ds, start, end), ``versions`` (ds, t_version); datasets without an entry and rows
    without a date stay. A row without a version is of another one.
    """
    r = ranges.select("ds", F.col("start").alias("__start"), F.col("end").alias("__end"))
    rows = spread_join(rows, r, ["ds"], salt_from=[date], how="left")
    bad = F.coalesce((F.col(date) < F.col("__start")) | (F.col(date) > F.col("__end")), F.lit(False))
    if versions is not None:
        v = versions.select("ds", F.lit(True).alias("__has"), F.col("t_version").alias("__v"))
        rows = spread_join(rows, v, ["ds"], salt_from=[date], how="left")
        bad = bad | (_true("__has") & ~F.col("version").eqNullSafe(F.col("__v")))
    return rows.filter(bad).drop("__start", "__end", "__has", "__v")


def purge_missing_files(granules: DataFrame, files: DataFrame, path: str = "path") -> DataFrame:
    """Keep granules whose file exists."""
    return granules.join(files.select(path), path, "left_semi")


def orphans(granules: DataFrame, files: DataFrame, path: str = "path") -> DataFrame:
    """Granules whose file is gone."""
    return granules.join(files.select(path), path, "left_anti")


def changed_grids(grids: DataFrame, found: DataFrame) -> DataFrame:
    """Registered grids whose file checksum differs; ``found`` has (grid, grid_type, path, checksum)."""
    now = found.select("grid", F.col("checksum").alias("new_checksum"))
    return grids.join(now, "grid").filter(F.col("checksum") != F.col("new_checksum")).select("grid")


def cascade(dependents: DataFrame, changed: DataFrame) -> DataFrame:
    """Dependent state rows that survive a change of grids.

    The changed grids are stored first, so the join knows their size: an estimate from the tables that they
    come from would have the dependents sorted by grid, all rows of a grid in one task.
    """
    names = materialize(changed.select("grid").distinct(), shared_dir(changed.sparkSession, "changed-grids"))
    return spread_join(dependents, names, ["grid"], salt_from=dependents.columns, how="left_anti")


def register_grids(grids: DataFrame, found: DataFrame, added: Column) -> DataFrame:
    """Grid table after registration: new grids come in, changed ones are updated, others stay."""
    fresh = found.withColumn("added", added).withColumn("id", text.stable_id("grid"))
    same = grids.select("grid", "checksum")
    news = fresh.join(same, ["grid", "checksum"], "left_anti")
    return upsert(grids, news.select("grid", "grid_type", "path", "checksum", "added", "id"), ["grid"],
                  set_columns=["grid_type", "path", "checksum", "added"])


# Stage status texts are fixed values shown to users.
def _status(ok: Column, bad: Column, none: str, no_success: str, failed: str, fine: str) -> Column:
    return (
        F.when((ok == 0) & (bad == 0), F.lit(none)).when(ok == 0, F.lit(no_success))
        .when(bad > 0, F.concat(bad.cast("string"), F.lit(failed))).otherwise(F.lit(fine))
    )


def _counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count_if(F.col("success")).alias("n_success"), F.count_if(~F.col("success")).alias("n_failed"),
        F.count_if(F.col("success").isNull()).alias("n_queued"))


def _harvest_status(ok: Column, bad: Column, queued: Column) -> Column:
    """Status of a harvest; files that wait for their download are no successes."""
    nothing = "No usable granules harvested (either all failed or no data collected)"
    known = _status(ok, bad, nothing, nothing, " harvested granules failed", "All granules successfully harvested")
    waiting = F.concat(queued.cast("string"), F.lit(" granules queued"))
    return F.when(queued == 0, known).when((ok == 0) & (bad == 0), waiting).when(bad == 0, waiting).otherwise(F.concat_ws(", ", known, waiting))


def harvest_status(granules: DataFrame, keys: Sequence[str] = ("ds",)) -> DataFrame:
    return _counts(granules, keys).withColumns({
        "n_granules": F.col("n_success") + F.col("n_failed") + F.col("n_queued"),
        "status": _harvest_status(F.col("n_success"), F.col("n_failed"), F.col("n_queued")),
    }).drop("n_queued")


def transformation_status(tx: DataFrame, keys: Sequence[str] = ("ds",)) -> DataFrame:
    return _counts(tx, keys).withColumn("status", _status(
        F.col("n_success"), F.col("n_failed"), "No transformations performed",
        "No successful transformations", " transformations failed", "All transformations successful")).drop("n_queued")


def aggregation_status(agg: DataFrame, keys: Sequence[str] = ("ds",)) -> DataFrame:
    return _counts(agg, keys).withColumn("status", _status(
        F.col("n_success"), F.col("n_failed"), "No aggregations performed",
        "No successful aggregations", " aggregations failed", "All aggregations successful")).drop("n_queued")


def for_all(status: DataFrame, datasets: DataFrame, text_when_absent: str) -> DataFrame:
    """Status of every dataset, those without rows included."""
    return datasets.select("ds").join(status, "ds", "left").withColumns({
        "n_success": F.coalesce("n_success", F.lit(0)), "n_failed": F.coalesce("n_failed", F.lit(0)),
        "status": F.coalesce("status", F.lit(text_when_absent)),
    })


def dataset_dates(granules: DataFrame, keys: Sequence[str] = ("ds",)) -> DataFrame:
    """First and last usable date, last download and the file it brought; one pass."""
    ok = F.col("success")
    when = F.when(F.col("download_time").isNotNull(), F.struct("download_time", "filename"))
    return granules.groupBy(*keys).agg(
        F.min(F.when(ok, F.col("date"))).alias("start_date"),
        F.max(F.when(ok, F.col("date"))).alias("end_date"),
        F.max("download_time").alias("last_download"),
        F.max_by("filename", when).alias("last_file"),
    )


def dataset_rows(granules: DataFrame, checked: Column) -> DataFrame:
    """Dataset-table updates after a harvest: status, counts and dates in one aggregate."""
    ok = F.col("success")
    n_ok, n_bad, n_queued = F.count_if(ok), F.count_if(~ok), F.count_if(ok.isNull())
    return granules.groupBy("ds").agg(
        (n_ok + n_bad + n_queued).alias("n_granules"), n_ok.alias("n_success"), n_bad.alias("n_failed"),
        F.min(F.when(ok, F.col("date"))).alias("start_date"),
        F.max(F.when(ok, F.col("date"))).alias("end_date"),
        F.max("download_time").alias("last_download"),
        _harvest_status(n_ok, n_bad, n_queued).alias("harvest_status"),
    ).withColumn("last_checked", checked)


def batch_errors(results: DataFrame) -> DataFrame:
    """The errors of a batch: each message of a dataset with its number, the most frequent first (``rank``)."""
    errors = results.filter(~F.col("success")).groupBy("ds", F.coalesce("message", F.lit("")).alias("message")).agg(F.count(F.lit(1)).alias("n"))
    by_number = Window.partitionBy("ds").orderBy(F.desc("n"), "message")
    return errors.withColumn("rank", F.row_number().over(by_number))


def batch_summary(results: DataFrame) -> DataFrame:
    """Batch totals: results, errors and error share."""
    return results.groupBy("ds").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(~F.col("success")).alias("errors"),
        F.count_if(F.col("success")).alias("processed"))
