"""Keep the state in step with configurations, files and grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.operators import state
from tidegrid.operators.mapping import invalidate_mappings
from tidegrid.operators.planning import AGG_KEY, _true
from tidegrid.schemas import KEYS
from tidegrid.session import shared_dir
from tidegrid.sinks.store import StateStore
from tidegrid.sizing import bounded_broadcast, materialize

MAPPING_MARK = "mapping/"


def mapping_mark(ds: str, grid: str, hemi: str, t_version: float) -> str:
    """Name under which the state says which mapping of a key is in use."""
    return f"{MAPPING_MARK}{grid}/{ds}/{hemi or 'all'}/{t_version}"


def run(store: StateStore, ranges: DataFrame, versions: DataFrame, files: DataFrame, grids: DataFrame, now: Column,
        mapping_path: str | None = None) -> int:
    """Purge outdated rows, register grids and drop what a changed grid makes void, in one commit; returns its number.

    Granules go that lie outside their dataset's range or whose file (``files``: path) is gone;
    transformations that lie outside the range, have another version than configured or belong to a
    changed grid. Aggregations of a changed grid go; years that lose a successful transformation are
    re-opened. ``grids`` holds the grid files found (grid, grid_type, path, checksum): new ones come in,
    changed ones are updated, and their mappings are no longer valid with the same commit; their folders
    are deleted after it, so a crash in between leaves folders that nothing uses.
    """
    spark, change = store.spark, store.transaction()
    known = change.read("grid")
    # a row per grid
    changed = materialize(state.changed_grids(known, grids).distinct(), shared_dir(spark, "changed-grids"))
    names = [r.grid for r in changed.collect()]

    granules = change.read("granule")
    lost = state.orphans(granules, files).unionByName(state.outdated(granules, ranges))
    change.delete("granule", lost)

    tx = change.read("transformation")
    old = state.outdated(tx, ranges, versions).select(*KEYS["transformation"], "success", "date")
    of_grid = tx.join(bounded_broadcast(changed), "grid", "left_semi").select(*old.columns)
    gone = materialize(old.unionByName(of_grid), shared_dir(spark, "gone-transformations"))
    change.delete("transformation", gone)

    change.delete("aggregation", changed, ["grid"])
    years = gone.filter(_true("success")).select("ds", "grid", "field", F.year("date").cast("int").alias("year")).distinct()
    reopened = change.read("aggregation").select(*AGG_KEY).join(years, AGG_KEY, "left_semi").select(
        *AGG_KEY, F.lit(False).alias("success"), F.lit("reopened").alias("message"))
    change.upsert("aggregation", reopened, set_columns=["success", "message"])

    change.replace("grid", state.register_grids(known, grids, now))
    for name in [m for m in change.marks if m.startswith(MAPPING_MARK) and m.split("/")[1] in names]:
        change.mark(name, None)
    number = change.commit()
    if mapping_path is not None:
        for name in names:
            invalidate_mappings(spark, mapping_path, grid=name)
    return number
