"""Post-transformations of a regridded value column and fill values at the sink."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.masks import UnknownFunction
from tidegrid.functions.timebounds import calendar_day

# Missing-value markers of the packed and of the array files.
BINARY_FILL = -9999.0
FLOAT_FILL = 9.969209968386869e36

Post = Callable[[DataFrame, str], DataFrame]
_REGISTRY: dict[str, Post] = {}


def register_post(name: str) -> Callable[[Post], Post]:
    def add(fn: Post) -> Post:
        _REGISTRY[name] = fn
        return fn

    return add


def post_names() -> list[str]:
    return sorted(_REGISTRY)


def apply_post(df: DataFrame, names: Iterable[str], value: str = "value") -> DataFrame:
    """Apply registered post-transformations in order; an unknown name raises while planning."""
    wanted = list(names)
    missing = [n for n in wanted if n not in _REGISTRY]
    if missing:
        raise UnknownFunction(f"unknown post-transformations {missing}; known: {post_names()}")
    for name in wanted:
        df = _REGISTRY[name](df, value)
    return df


# Function names below are fixed values: dataset configurations refer to them.
@register_post("meters_to_cm")
def meters_to_cm(df: DataFrame, value: str = "value") -> DataFrame:
    return df.withColumns({value: F.col(value) * 100, "units": F.lit("cm")})


@register_post("kelvin_to_celsius")
def kelvin_to_celsius(df: DataFrame, value: str = "value") -> DataFrame:
    return df.withColumns({value: F.col(value) - 273.15, "units": F.lit("Celsius")})


@register_post("seaice_concentration_to_fraction")
def seaice_concentration_to_fraction(df: DataFrame, value: str = "value") -> DataFrame:
    return df.withColumns({value: F.col(value) / 100.0, "units": F.lit("1")})


@register_post("MEaSUREs_fix_time")
def center_day_window(df: DataFrame, value: str = "value", time: str = "time") -> DataFrame:
    """Reset the record window to the calendar day of its center time."""
    w = calendar_day(time)
    return df.withColumns({"time_start": w["start"], "time_end": w["end"]})


def fill_missing(col: Column | str, fill: float = BINARY_FILL) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(fill))


def unfill(col: Column | str, fill: float = BINARY_FILL) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(c, F.lit(fill))


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Ingest rule: NaN becomes NULL in floating-point columns."""
    names = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")
    ]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in names})
