"""Positions of grid cells in flat output, as index arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("bigint")


def llc_row(tile: Column | str, j: Column | str, size: int | Column) -> Column:
    """Row in the compact (13 * size, size) layout; the column is ``i``.

    Tiles 0 to 6 are stacked. Tiles 7 to 9 and 10 to 12 each form a face of ``size`` rows whose
    three tiles lie side by side, so their rows interleave.
    """
    t, row = _c(tile), _c(j)
    n = F.lit(size).cast("bigint") if isinstance(size, int) else _c(size)
    return (
        F.when(t <= 6, t * n + row)
        .when(t <= 9, n * 7 + row * 3 + (t - 7))
        .otherwise(n * 10 + row * 3 + (t - 10))
    )


def flat_index(grid_type: str, size: int | Column, j: Column | str, i: Column | str,
               tile: Column | str | None = None) -> Column:
    """Offset of a cell in one output record; ``size`` is the number of columns."""
    n = F.lit(size).cast("bigint") if isinstance(size, int) else _c(size)
    if grid_type == "llc":
        if tile is None:
            raise ValueError("an llc grid needs a tile column")
        return llc_row(tile, j, size) * n + _c(i)
    if grid_type == "latlon":
        return _c(j) * n + _c(i)
    raise ValueError(f"unknown grid type {grid_type}")


def source_index(row: Column | str, col: Column | str, n_rows: int, n_cols: int,
                 transpose: bool = False) -> Column:
    """Source cell number of an array position; ``transpose`` reads the array by columns."""
    r, c = _c(row), _c(col)
    return c * n_rows + r if transpose else r * n_cols + c
