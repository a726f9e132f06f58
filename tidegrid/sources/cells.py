"""Observation cells: reading, nested groups, missing fields."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.masks import UnknownFunction
from tidegrid.functions.units import nan_to_null

Pre = Callable[[DataFrame, Sequence[str]], DataFrame]
_REGISTRY: dict[str, Pre] = {}


def register_pre(name: str) -> Callable[[Pre], Pre]:
    def add(fn: Pre) -> Pre:
        _REGISTRY[name] = fn
        return fn

    return add


def apply_pre(df: DataFrame, name: str | None, fields: Sequence[str]) -> DataFrame:
    """Run a dataset's pre-processing; an unknown name raises while planning."""
    if not name:
        return df
    if name not in _REGISTRY:
        raise UnknownFunction(f"unknown pre-processing {name}; known: {sorted(_REGISTRY)}")
    return _REGISTRY[name](df, fields)


# Function names and group names below are fixed values of the dataset configurations.
@register_pre("ATL20_V004_monthly")
def monthly_group(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Root coordinates plus the chosen variables of the ``monthly`` group that it has."""
    keep = [c for c in df.columns if c not in ("monthly", *fields)]
    have = df.schema["monthly"].dataType.names
    return df.select(*keep, *[F.col(f"monthly.{f}").alias(f) for f in fields if f in have])


@register_pre("nsidc_seaice_nt_extraction")
def supplementary_group(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Base variables plus one variable of the ``cdr_supplementary`` group."""
    return df.withColumn("raw_nt_seaice_conc", F.col("cdr_supplementary.raw_nt_seaice_conc"))


def read_cells(spark: SparkSession, path: str, preprocessing: str | None = None,
               fields: Sequence[str] = ()) -> DataFrame:
    """Observation cells with NaN turned to NULL at the door."""
    return nan_to_null(apply_pre(spark.read.parquet(path), preprocessing, fields))


def merge_on_coordinates(base: DataFrame, other: DataFrame, on: Sequence[str] = ("y", "x"),
                         how: str = "inner") -> DataFrame:
    """Put variables of two tables of the same grid side by side."""
    return base.join(other, list(on), how)


def with_fields(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Guarantee every configured field: an absent one is all missing, with a warning to record."""
    absent = [f for f in fields if f not in df.columns]
    for f in absent:
        df = df.withColumn(f, F.lit(None).cast("double"))
    note = "; ".join(f"Field '{f}' missing from source data — empty record created" for f in absent)
    return df.withColumn("message", F.lit(note))


def to_long(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row per cell and field."""
    return df.unpivot(list(keys), list(fields), "field", "value")
