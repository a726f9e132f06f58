"""What needs work: diffs of listings, state and output inventories."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions import text
from tidegrid.sizing import bounded_broadcast

# Fixed value: smallest usable source file in bytes.
MIN_FILE_BYTES = 100
# Fixed value: grids of this family hold no polar data.
NON_POLAR_GRID_TAG = "TPOSE"

TX_KEY = ["ds", "filename", "grid", "field"]
AGG_KEY = ["ds", "grid", "field", "year"]


def _true(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(False))


def with_prefix(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys, *[F.col(c).alias(prefix + c) for c in df.columns if c not in keys])


def needs_harvest(remote: DataFrame, state: DataFrame, keys: Sequence[str] = ("ds", "filename"),
                  compare: str = "timestamp") -> DataFrame:
    """Listed files that are new, failed before, or were published again after their download.

    ``compare='date'`` compares calendar days, so a second publication on the download day is not
    seen as newer.
    """
    if compare not in ("timestamp", "date"):
        raise ValueError(f"unknown comparison {compare}")
    got = state.select(*keys, F.lit(True).alias("known"), "success", "download_time")
    stale = F.col("download_time").cast(compare) < F.col("mod_time").cast(compare)
    joined = remote.join(got, list(keys), "left")
    reason = (
        F.when(F.col("known").isNull(), F.lit("new"))
        .when(~_true("success"), F.lit("failed before"))
        .when(F.coalesce(stale, F.lit(True)), F.lit("stale"))
    )
    return joined.select(*remote.columns, reason.alias("reason")).filter(F.col("reason").isNotNull())


def needs_download(remote: DataFrame, files: DataFrame, key: str = "filename") -> DataFrame:
    """Files absent locally, or not newer than the published one."""
    have = files.select(key, F.col("mtime").alias("local_time"))
    return remote.join(have, key, "left").filter(
        F.col("local_time").isNull() | (F.col("local_time") <= F.col("mod_time"))
    ).drop("local_time")


def eligible_grids(grids: DataFrame, hemispheric: bool, wanted: Iterable[str] | None = None) -> DataFrame:
    """Registered grids to use: the requested ones, without non-polar grids for polar datasets."""
    if wanted is not None:
        grids = grids.filter(F.col("grid").isin(list(wanted)))
    return grids.filter(~F.col("grid").contains(NON_POLAR_GRID_TAG)) if hemispheric else grids


def tx_targets(fields: DataFrame, grids: DataFrame) -> DataFrame:
    """(ds, grid, field) combinations of the configuration.

    ``grids`` carries ``ds`` too, so this is an equi join of two configuration-sized tables.
    """
    return fields.select("ds", "field").join(grids.select("ds", "grid"), "ds")


def tx_plan(granules: DataFrame, targets: DataFrame, tx: DataFrame, versions: DataFrame) -> DataFrame:
    """Every (granule, grid, field) with why it needs work, or NULL ``reason`` if it is current.

    ``versions`` has (ds, t_version). A combination with no state row gets reason ``no state`` and
    is settled by ``tx_output_check``.
    """
    config = targets.join(versions, "ds")
    want = granules.join(bounded_broadcast(config), "ds")
    state = tx.select(
        *TX_KEY, F.lit(True).alias("known"), F.col("id").alias("tx_id"),
        F.col("success").alias("tx_success"), F.col("version").alias("tx_version"), "origin_checksum",
    )
    reason = (
        F.when(F.col("known").isNull(), F.lit("no state"))
        .when(~_true("tx_success"), F.lit("failed before"))
        .when(~F.col("tx_version").eqNullSafe(F.col("t_version")), F.lit("version changed"))
        .when(~F.col("origin_checksum").eqNullSafe(F.col("checksum")), F.lit("source changed"))
    )
    return want.join(state, TX_KEY, "left").withColumn("reason", reason).drop(
        "known", "tx_success", "tx_version", "origin_checksum")


def output_is_current(plan: DataFrame, outputs: DataFrame) -> DataFrame:
    """Flag ``current``: an output exists, is newer than its source and has the current version.

    ``outputs`` has the transformation key, ``output_mtime``, ``output_version`` and whatever a
    rebuilt state row needs; ``plan`` has ``source_mtime`` and ``t_version``.
    """
    flag = (
        F.col("output_mtime").isNotNull() & F.col("source_mtime").isNotNull()
        & (F.col("output_mtime") > F.col("source_mtime"))
        & F.col("output_version").eqNullSafe(F.col("t_version"))
    )
    return plan.join(outputs, TX_KEY, "left").withColumn("current", _true(flag))


def rebuilt_tx_rows(checked: DataFrame) -> DataFrame:
    """State rows of outputs that are current although their state row is missing."""
    return checked.filter((F.col("reason") == "no state") & F.col("current")).select(
        text.stable_id(*TX_KEY).alias("id"), *TX_KEY, "date",
        F.col("path").alias("source_path"), F.col("checksum").alias("origin_checksum"),
        F.lit(False).alias("in_progress"), F.lit(True).alias("success"),
        F.col("output_mtime").alias("started"), F.col("output_mtime").alias("completed"),
        text.transformed_name("grid", "field", "filename").alias("output_name"),
        F.col("t_version").alias("version"), F.lit("").alias("message"),
    )


def work_items(checked: DataFrame) -> DataFrame:
    """Combinations to transform: any reason, except a current output without state."""
    return checked.filter(
        F.col("reason").isNotNull() & ~((F.col("reason") == "no state") & F.col("current")))


def triage(granules: DataFrame, path: str = "path", size: str = "size") -> DataFrame:
    """Add ``problem``: why a granule cannot be processed, NULL when it can."""
    n = F.coalesce(F.col(size), F.lit(0))
    no_path = F.nullif(F.col(path), F.lit("")).isNull()
    return granules.withColumn(
        "problem",
        F.when(no_path, F.lit("Granule not harvested properly: no source file path recorded."))
        .when(n < MIN_FILE_BYTES, F.concat(
            F.lit("Granule not harvested properly: source file missing or too small ("),
            n.cast("bigint").cast("string"), F.lit(" bytes)."))),
    )


def with_ids(plan: DataFrame, state: DataFrame, key: Sequence[str]) -> DataFrame:
    """Reuse the id of an existing row, else derive one from the key."""
    known = state.select(*key, F.col("id").alias("known_id"))
    return (
        plan.join(known, list(key), "left")
        .withColumns({
            "id": F.coalesce("known_id", text.stable_id(*key)),
            "reused": F.col("known_id").isNotNull(),
        }).drop("known_id")
    )


def years_with_tx(tx: DataFrame) -> DataFrame:
    """Distinct years that have a successful transformation, per (ds, grid, field)."""
    return tx.filter(_true("success")).select(
        "ds", "grid", "field", F.year("date").cast("int").alias("year")).distinct()


def agg_plan(tx: DataFrame, agg: DataFrame) -> DataFrame:
    """Every (ds, grid, field, year) with transformations, and why it must be aggregated.

    One aggregate of the transformation state and one join replace a lookup per year. ``reason`` is
    NULL when the successful aggregation is at least as new as every transformation.
    """
    done = (
        tx.filter(_true("success"))
        .groupBy("ds", "grid", "field", F.year("date").cast("int").alias("year"))
        .agg(F.max("completed").alias("last_completed"), F.count(F.lit(1)).alias("n_tx"))
    )
    last = agg.filter(_true("success")).groupBy(*AGG_KEY).agg(F.max("agg_time").alias("agg_time"))
    reason = (
        F.when(F.col("agg_time").isNull(), F.lit("no state"))
        .when(F.col("last_completed") > F.col("agg_time"), F.lit("newer transformation"))
    )
    return done.join(last, AGG_KEY, "left").withColumn("reason", reason)


def agg_plan_all_years(targets: DataFrame, datasets: DataFrame, versions: DataFrame) -> DataFrame:
    """All years of datasets whose recorded aggregation version is set and differs from the config."""
    changed = (
        datasets.join(bounded_broadcast(versions), "ds")
        .filter(F.col("aggregation_version").isNotNull()
                & (F.col("aggregation_version") != F.col("a_version")))
        .select("ds", F.explode(F.sequence(F.year("start_date"), F.year("end_date"))).alias("year"))
    )
    return targets.join(bounded_broadcast(changed), "ds").select(*AGG_KEY)


def agg_output_check(plan: DataFrame, tx: DataFrame, files: DataFrame, products: DataFrame) -> DataFrame:
    """Settle ``no state`` years by files: current when the product is as new as every input.

    ``files`` has (output_path, mtime) of transformed files, ``products`` (key, product_mtime).
    """
    inputs = (
        tx.filter(_true("success")).withColumn("year", F.year("date").cast("int"))
        .join(files.select("output_path", "mtime"), "output_path", "left")
        .groupBy(*AGG_KEY)
        .agg(F.max("mtime").alias("last_input"), F.count_if(F.col("mtime").isNull()).alias("n_absent"))
    )
    current = (
        F.col("product_mtime").isNotNull() & F.col("last_input").isNotNull()
        & (F.col("n_absent") == 0) & (F.col("last_input") <= F.col("product_mtime"))
    )
    return (
        plan.join(inputs, AGG_KEY, "left").join(products, AGG_KEY, "left")
        .withColumn("current", _true(current))
    )


def rebuilt_agg_rows(checked: DataFrame, a_version: Column) -> DataFrame:
    """State rows of products that are current although their state row is missing."""
    return checked.filter((F.col("reason") == "no state") & F.col("current")).select(
        text.stable_id(*AGG_KEY).alias("id"), *AGG_KEY, F.lit(True).alias("success"),
        F.col("product_mtime").alias("agg_time"), a_version.alias("version"), F.lit("").alias("message"))


def representative(granules: DataFrame, keys: Sequence[str] = ("ds", "hemi")) -> DataFrame:
    """One granule per dataset and hemisphere that has a file, the first by name."""
    usable = granules.filter(F.nullif(F.col("path"), F.lit("")).isNotNull())
    rest = [c for c in granules.columns if c not in keys]
    return usable.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.col("filename")).alias("g")).select(*keys, "g.*")


def unknown_grids(wanted: DataFrame, grids: DataFrame) -> DataFrame:
    """Requested grids that are not registered."""
    return wanted.join(grids.select("grid"), "grid", "left_anti")


def only(df: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a configuration-sized list."""
    return df.join(bounded_broadcast(allowed.select(key).distinct()), key, "left_semi")


def config_match(found: DataFrame, config: DataFrame) -> DataFrame:
    """Datasets on disk against configurations, both directions."""
    a = found.select("ds").distinct().withColumn("on_disk", F.lit(True))
    b = config.select("ds").distinct().withColumn("configured", F.lit(True))
    return a.join(b, "ds", "full_outer").select(
        "ds", _true("on_disk").alias("on_disk"), _true("configured").alias("configured"))
