"""Source and target grid cells."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.geo import METRES_PER_DEGREE, Projection, inverse, wrap_lon
from tidegrid.schemas import GRID_CELL


def source_cells(ids: DataFrame, dims: Sequence[int], extent: Sequence[float], proj: Projection,
                 id_col: str = "src_id") -> DataFrame:
    """Positions of the cells of a regular projected grid, cell 0 at the upper left.

    ``dims`` is (columns, rows); ``extent`` is (left, lower, right, upper) in projected units.
    ``ids`` carries the cell numbers; everything else is column arithmetic.
    """
    cols, rows = dims
    left, lower, right, upper = extent
    col = F.col(id_col) % cols
    row = F.floor(F.col(id_col) / cols)
    x = F.lit(left) + (col + 0.5) * ((right - left) / cols)
    y = F.lit(upper) - (row + 0.5) * ((upper - lower) / rows)
    lon, lat = inverse(proj, x, y)
    return ids.select(
        "*", row.cast("bigint").alias("row"), col.cast("bigint").alias("col"),
        wrap_lon(lon).alias("lon"), lat.alias("lat"),
    )


def generate(spark: SparkSession, dims: Sequence[int], extent: Sequence[float], proj: Projection) -> DataFrame:
    """Every cell of a source grid, generated on the executors."""
    ids = spark.range(dims[0] * dims[1]).withColumnRenamed("id", "src_id")
    return source_cells(ids, dims, extent, proj)


def target_radius(columns: Iterable[str]) -> Column:
    """Cell radius from whichever measure a grid carries; NULL means the grid is unsupported."""
    have = set(columns)
    # Radius variables in order of preference.
    options = [F.col(c) for c in ("effective_grid_radius", "effective_radius", "RAD") if c in have]
    if "rA" in have:
        options.append(F.sqrt("rA") * 0.5)
    if not options:
        return F.lit(None).cast("double")
    return F.coalesce(*options)


def read_grid(spark: SparkSession, path: str, names: Iterable[str] | None = None) -> DataFrame:
    """Target cells, partitioned by grid so a name filter prunes folders."""
    cells = spark.read.schema(GRID_CELL).parquet(path)
    return cells if names is None else cells.filter(F.col("grid").isin(list(names)))


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail while planning when a grid table lacks a required column."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"grid lacks columns {missing}")
    return df


def grid_stats(sources: DataFrame, targets: DataFrame, data_res: float, cap: int | None = None) -> DataFrame:
    """One row: spacing bounds of the source grid, largest target radius, neighbour bound (limited only by a given ``cap``)."""
    widest = targets.agg(F.max("radius_m")).scalar()
    needed = F.floor(F.pow(F.col("max_radius_m") * 2 / F.col("min_spacing_m"), F.lit(2.0)))
    return sources.agg(
        (F.cos(F.radians(F.max(F.abs("lat")))) * data_res * METRES_PER_DEGREE).alias("min_spacing_m")
    ).select(
        "min_spacing_m", F.lit(data_res * METRES_PER_DEGREE).alias("max_spacing_m"), widest.alias("max_radius_m")
    ).withColumn("neighbours", F.greatest(F.lit(1), needed if cap is None else F.least(F.lit(cap), needed)).cast("int"))


def neighbour_bound(max_radius_m: float, min_spacing_m: float, cap: int | None = None) -> int:
    """Most source cells a target can need, at least 1; limited only if ``cap`` is given."""
    needed = int((max_radius_m * 2 / min_spacing_m) ** 2)
    return max(1, needed if cap is None else min(cap, needed))
