"""Apply a mapping to observation cells and reduce per target cell."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.masks import UnknownFunction
from tidegrid.operators.mapping import Packs, meet, near_positions
from tidegrid.operators.median import HELD, bounded_median
from tidegrid.operators.packmedian import median_over_packs
from tidegrid.session import shared_dir
from tidegrid.sizing import BROADCAST_LIMIT_BYTES, affordable_salts, materialize, shuffle_width, spread_join

Reducer = Callable[[str, list[str]], Column]


def _strict(aggregate: Column, value: str) -> Column:
    """Missing as soon as one member is missing."""
    return F.when(F.count(value) == F.count(F.lit(1)), aggregate)


def _nearest(value: str, ties: list[str]) -> Column:
    return F.min_by(value, F.struct("dist_m", "src_id", *ties))


# Operation names used by dataset configurations.
OPERATIONS: dict[str, Reducer] = {
    "mean": lambda v, ties: _strict(F.avg(v), v),
    "nanmean": lambda v, ties: F.avg(v),
    "median": lambda v, ties: _strict(F.median(v), v),
    "nanmedian": lambda v, ties: F.median(v),
    "nearest": _nearest,
}
DEFAULT_OPERATION = "mean"
# Whether a missing member voids the median.
MEDIANS = {"median": True, "nanmedian": False}
# Whether a missing member voids the mean.
MEANS = {"mean": True, "nanmean": False}
# Values of a pack of sources that are folded with one search; records that are folded at once.
SHEET = 1 << 14
RECORDS_AT_ONCE = 64


def reducer(operation: str) -> Reducer:
    if operation not in OPERATIONS:
        raise UnknownFunction(f"unknown mapping operation {operation}; known: {sorted(OPERATIONS)}")
    return OPERATIONS[operation]


# Cell numbers that make one block of a grid when records are filled up.
BLOCK = 1024


def regrid(
    obs: DataFrame,
    mapping: DataFrame | Packs,
    keys: Sequence[str],
    operation: str = DEFAULT_OPERATION,
    allow_nearest: bool = True,
    value: str = "value",
    ties: Sequence[str] = (),
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    bounded: bool = False,
) -> DataFrame:
    """Value per (record keys, target cell).

    Means and medians over a mapping in packs are taken pack by pack, so that pairs are neither joined nor moved;
    other operations, and medians that are ``bounded``, take its pairs. A mapping of pairs is broadcast when its size is checked to fit, and each task then folds its own
    records before anything is shuffled. A larger mapping is joined on ``src_id``, salted by record
    so that a source cell with very many records does not land in one task; the salts repeat the mapping,
    so there are only as many as keep that within the size of the observations. ``ties`` orders several
    observations of one source cell in one record for the ``nearest`` operation, which goes by the mapping's
    ``rank`` (the order of ``dist_m`` and ``src_id`` within a cell) where it has one. ``bounded`` is for
    medians over more values of a cell than a task may hold (see ``crowded``): the joined values are
    stored and large groups searched.
    """
    reduce = reducer(operation)
    if isinstance(mapping, Packs):
        plain = isinstance(obs.schema[value].dataType, (T.FractionalType, T.IntegralType)) and not isinstance(obs.schema[value].dataType, T.DecimalType)
        if operation in MEDIANS and plain and not bounded:
            return _medians(obs, mapping, keys, operation, allow_nearest, value, broadcast_limit)
        if operation in MEANS and plain:
            out = _mean_over_packs(obs, mapping, keys, value, MEANS[operation], broadcast_limit)
            rest = regrid(obs, mapping.nearest, keys, operation, value=value, broadcast_limit=broadcast_limit)
            return out.unionByName(rest) if allow_nearest else out
        mapping = mapping.pairs()
    used = mapping if allow_nearest else mapping.filter(F.col("kind") == "radius")
    ranked = operation == "nearest" and "rank" in mapping.columns
    used = used.select("src_id", "cell_id", "rank" if ranked else "dist_m")
    seen = obs.select(*keys, "src_id", value, *ties)
    if ranked:
        # one value per source first, so that rank alone orders a cell's values: numbers of fixed width, which
        # are folded by hash as the joined rows come, where a struct would have all of them sorted
        if ties:
            seen = seen.groupBy(*keys, "src_id").agg(F.min_by(value, F.struct(*ties)).alias(value))
        ties, reduce = (), lambda v, _: F.min_by(v, "rank")
    joined = spread_join(
        seen, used, ["src_id"], salt_from=list(keys), salts=affordable_salts(seen, used), limit=broadcast_limit)
    if bounded and operation in MEDIANS:
        joined = materialize(joined.select(*keys, "cell_id", value), shared_dir(obs.sparkSession, "median-values"))
        return bounded_median(joined, [*keys, "cell_id"], value, strict=MEDIANS[operation])
    return joined.groupBy(*keys, "cell_id").agg(reduce(value, list(ties)).alias(value))


def _sheets(seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Placed values in rows (zone, box of the pack, records) of about ``SHEET`` values of one pack.

    ``seen`` has (zone, pack, place, x, y, z, total, n, m) per record and source, so a record has at most
    a pack's positions in a row.
    """
    ends = [f(c).alias(f"{e}{c}") for e, f in (("lo", F.min), ("hi", F.max)) for c in "xyz"]
    cells = F.collect_list(F.struct("place", "x", "y", "z", "total", "n", "m")).alias("cells")
    records = seen.repartition(shuffle_width(seen), "zone").groupBy("zone", "pack", *keys).agg(cells, *ends)
    before = Window.partitionBy("zone", "pack").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    records = records.withColumn("run", F.floor(F.coalesce(F.sum(F.size("cells")).over(before), F.lit(0)) / SHEET))
    ends = [f(f"{e}{c}").alias(f"{e}{c}") for e, f in (("lo", F.min), ("hi", F.max)) for c in "xyz"]
    return records.groupBy("zone", "pack", "run").agg(F.collect_list(F.struct(F.struct(*keys).alias("k"), "cells")).alias("records"), *ends)


def _fold(t: pa.StructArray, records: pa.StructArray) -> Iterator[pa.RecordBatch]:
    """Sum and counts of a sheet's values for each of its records and each target that they are within reach of."""
    lists, flat = records.field("cells"), records.field("cells").flatten()
    rec = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    cell = {f.name: flat.field(f.name).to_numpy(zero_copy_only=False) for f in flat.type}
    _, first, col = np.unique(cell["place"], return_index=True, return_inverse=True)
    # a product with zero keeps numbers apart only if they are finite: others are counted by kind
    total, kinds = cell["total"], [cell["n"], cell["m"]]
    odd = not np.isfinite(total).all()
    if odd:
        kinds += [np.isnan(total), total == np.inf, total == -np.inf]
        total = np.where(np.isfinite(total), total, 0.0)
    columns = [total, *kinds]
    for low, high, target, source, _ in near_positions(t, {c: cell[c][first] for c in "xyz"}):
        linked = np.zeros((high - low, len(first)))
        linked[target - low, source] = 1.0
        for r in range(0, len(lists), RECORDS_AT_ONCE):
            own = (rec >= r) & (rec < r + RECORDS_AT_ONCE)
            used, at = np.unique(col[own], return_inverse=True)
            held = np.zeros((len(columns), len(used), min(RECORDS_AT_ONCE, len(lists) - r)))
            for k, c in enumerate(columns):
                held[k, at, rec[own] - r] = c[own]
            near = linked[:, used]
            sums = [near @ h for h in held]
            cells, found = np.nonzero(sums[2])
            out = [s[cells, found] for s in sums]
            if odd:
                nan, up, down = (x > 0 for x in out[3:])
                out[0] = np.select([nan | (up & down), up, down], [np.nan, np.inf, -np.inf], out[0])
            yield pa.RecordBatch.from_arrays(
                [records.field("k").take(pa.array(found + r)), t.field("cell_id").take(pa.array(cells + low)), pa.array(out[0]),
                 pa.array(np.rint(out[1]).astype(np.int64)), pa.array(np.rint(out[2]).astype(np.int64))], ["k", "cell_id", "total", "n", "m"])


def _fold_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield from _fold(batch.column(0)[i].values, batch.column(1)[i].values)


def _mean_over_packs(obs: DataFrame, packs: Packs, keys: Sequence[str], value: str, strict: bool, broadcast_limit: int) -> DataFrame:
    """Mean per (record keys, target cell) of the sources in its radius.

    Observations are reduced to a sum and counts for each record and source and sent to the source's zone,
    where packs meet the targets in reach of them. What is shuffled after that is a row for each record,
    target and task, so nothing that is moved grows with the pairs.
    """
    v = F.col(value).cast("double")
    seen = obs.groupBy(*keys, "src_id").agg(F.coalesce(F.sum(v), F.lit(0.0)).alias("total"), F.count(v).alias("n"), F.count(F.lit(1)).alias("m"))
    placed = packs.placed()
    # rows in memory are several times as large as stored positions
    seen = spread_join(seen, placed, ["src_id"], salt_from=list(keys), salts=affordable_salts(obs, placed), limit=broadcast_limit // 4)
    key = T.StructType([obs.schema[k] for k in keys])
    out = T.StructType([T.StructField("k", key), T.StructField("cell_id", T.LongType()), T.StructField("total", T.DoubleType()),
                        T.StructField("n", T.LongType()), T.StructField("m", T.LongType())])
    folded = meet(_sheets(seen, keys), packs.targets).select("t", "records").mapInArrow(_fold_all, out)
    sums = folded.select(*[F.col("k")[k].alias(k) for k in keys], "cell_id", "total", "n", "m").groupBy(*keys, "cell_id").agg(
        *[F.sum(c).alias(f"__{c}") for c in ("total", "n", "m")])
    whole = F.col("__n") == F.col("__m") if strict else F.col("__n") > 0
    return sums.select(*keys, "cell_id", F.when(whole, F.col("__total") / F.col("__n")).alias(value))


def _medians(obs: DataFrame, packs: Packs, keys: Sequence[str], operation: str, allow_nearest: bool, value: str, broadcast_limit: int) -> DataFrame:
    """Median per (record keys, target cell), fallback included.

    Cells that come at several positions, or without an id, take the pairs, as their values have to be put together.
    """
    cells = materialize(packs.cells(), shared_dir(obs.sparkSession, "cells"))
    several = cells.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col("cell_id").isNull()).select("cell_id")
    rest, out = packs.nearest, None
    if not several.isEmpty():
        other = several.select(F.col("cell_id").alias("__cell"))
        apart = F.col("cell_id").eqNullSafe(F.col("__cell"))
        cells, rest = cells.join(other, apart, "left_anti"), rest.join(other, apart, "left_anti")
        out = regrid(obs, packs.only(several).pairs(), keys, operation, allow_nearest, value, broadcast_limit=broadcast_limit)
    found = median_over_packs(obs, packs, cells, keys, value, MEDIANS[operation], broadcast_limit)
    out = found if out is None else out.unionByName(found)
    return out.unionByName(regrid(obs, rest, keys, operation, value=value, broadcast_limit=broadcast_limit)) if allow_nearest else out


def crowded(mapping: DataFrame | Packs, held: int = HELD) -> bool:
    """Whether some target cell has more source cells than a task may hold values of; reads the mapping's counts only."""
    mapping = mapping.pairs() if isinstance(mapping, Packs) else mapping
    return not mapping.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > held).isEmpty()


def on_full_grid(regridded: DataFrame, cells: DataFrame, records: DataFrame, keys: Sequence[str],
                 value: str = "value", cell_on: Sequence[str] = ("grid",)) -> DataFrame:
    """Every target cell of every record, missing where nothing was mapped.

    ``records`` has one row per record; ``cell_on`` (usually the grid) ties records to their cells
    (``cell_id``). Records and cells meet block by block: a record's values within a block of ``BLOCK``
    cell numbers are one row, and so are the block's cells, so shuffles move values that are there and
    the cells that are missing are added after the last one.
    """
    if not cell_on:
        raise ValueError("name the columns that tie records to the cells of their grid")
    block = F.floor(F.col("cell_id") / BLOCK).alias("__block")
    blocks = cells.groupBy(*cell_on, block).agg(F.collect_set("cell_id").alias("__cells"))
    spine = spread_join(records, blocks.select(*cell_on, "__block"), list(cell_on), salt_from=list(keys))
    # few narrow rows, each of which becomes a block of cells: as many tasks as a shuffle has, whatever their size
    spine = spine.repartition(shuffle_width(cells), *keys, "__block")
    held = regridded.select(*keys, block, F.struct("cell_id", value).alias("__row")).groupBy(*keys, "__block").agg(F.collect_list("__row").alias("__rows"))
    sheets = spine.join(held, [*keys, "__block"], "left")
    kind = regridded.schema[value].dataType.simpleString()
    # a hot grid has many sheets, so its blocks are spread by block
    full = spread_join(sheets, blocks, [*cell_on, "__block"], salt_from=list(keys))
    ids = F.transform("__rows", lambda r: r["cell_id"])
    inside = F.when(F.size(F.array_except(ids, "__cells")) == 0, F.col("__rows")).otherwise(F.filter("__rows", lambda r: F.array_contains("__cells", r["cell_id"])))
    known = F.coalesce(inside, F.expr(f"CAST(array() AS array<struct<cell_id: {regridded.schema['cell_id'].dataType.simpleString()}, {value}: {kind}>>)"))
    empty = F.transform(F.array_except("__cells", F.transform(known, lambda r: r["cell_id"])), lambda c: F.struct(c.alias("cell_id"), F.lit(None).cast(kind).alias(value)))
    return full.withColumn("__row", F.explode(F.concat(known, empty))).select(*records.columns, *[c for c in cell_on if c not in records.columns], "__row.cell_id", f"__row.{value}")


def record_stats(values: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Valid range and validity of each record, with the note an empty record carries."""
    n = F.count(value)
    return values.groupBy(*keys).agg(
        F.min(value).alias("valid_min"), F.max(value).alias("valid_max"), n.alias("n_valid"),
        (n > 0).alias("has_data"),
        F.when(n > 0, F.lit("")).otherwise(F.lit(" -- empty record -- ")).alias("notes"),
    )


def record_attributes(fields: DataFrame, grid: Column | str, filename: Column | str) -> DataFrame:
    """Descriptive attributes of a record as one map column ``attrs``."""
    g = F.col(grid) if isinstance(grid, str) else grid
    f = F.col(filename) if isinstance(filename, str) else filename
    pairs = {
        "long_name": F.col("long_name"), "standard_name": F.col("standard_name"),
        "units": F.col("units"), "original_filename": f, "original_field_name": F.col("field"),
        "interpolation_parameters": F.lit("bin averaging"), "interpolated_grid": g,
    }
    entries = [e for k, v in pairs.items() for e in (F.lit(k), v)]
    return fields.withColumn("attrs", F.create_map(*entries))


# Dataset attributes copied from the configuration.
DATASET_ATTRIBUTES = (
    "original_dataset_title", "original_dataset_short_name", "original_dataset_url",
    "original_dataset_reference", "original_dataset_doi", "notes",
)


def dataset_attributes(raw: Mapping[str, object], grid: Column | str, grid_type: Column | str, t_version: float) -> Column:
    """Dataset-level attributes of a record as a map; absent settings are left out. Grid and type are texts or columns."""
    pairs = {k: raw[k] for k in DATASET_ATTRIBUTES if raw.get(k) is not None}
    pairs.update({"interpolated_grid": grid, "interpolated_grid_id": grid, "model_grid_type": grid_type,
                  "transformation_version": t_version})
    return F.create_map(*[x if isinstance(x, Column) else F.lit(str(x)) for kv in pairs.items() for x in kv])


def product_attributes(attrs: Column | str) -> Column:
    """Drop source-file attributes; the original field name stays."""
    m = F.col(attrs) if isinstance(attrs, str) else attrs
    return F.map_filter(m, lambda k, v: ~k.contains("original") | (k == "original_field_name"))
