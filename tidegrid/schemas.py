"""Typed tables and configuration objects.

State lives in five Parquet tables (granule, transformation, aggregation, dataset, grid). Cell data
is long: one row per (record, cell). A missing value is NULL everywhere; fill values exist only in
packed output.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field as dc_field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(), "BOOLEAN": T.BooleanType(), "INT": T.IntegerType(), "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(), "TIMESTAMP": T.TimestampType(),
}


def _schema(spec: str) -> T.StructType:
    """Flat schema from ``name TYPE`` pairs; needs no session."""
    pairs = (part.split() for part in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


REMOTE_GRANULE = _schema("ds STRING, url STRING, filename STRING, mod_time TIMESTAMP, date TIMESTAMP, hemi STRING")

GRANULE = _schema(
    "id STRING, ds STRING, filename STRING, date TIMESTAMP, url STRING, mod_time TIMESTAMP,"
    " path STRING, checksum STRING, size BIGINT, success BOOLEAN, message STRING,"
    " download_time TIMESTAMP, last_attempt TIMESTAMP, duration INT"
)

TRANSFORMATION = _schema(
    "id STRING, ds STRING, filename STRING, grid STRING, field STRING, date TIMESTAMP, hemi STRING,"
    " source_path STRING, origin_checksum STRING, in_progress BOOLEAN, success BOOLEAN,"
    " started TIMESTAMP, completed TIMESTAMP, output_name STRING, output_path STRING,"
    " checksum STRING, version DOUBLE, message STRING"
)

AGGREGATION = _schema(
    "id STRING, ds STRING, grid STRING, field STRING, year INT, success BOOLEAN, started TIMESTAMP,"
    " agg_time TIMESTAMP, version STRING, message STRING, notes STRING, daily_path STRING,"
    " daily_bin_path STRING, monthly_path STRING, monthly_bin_path STRING, daily_uuid STRING,"
    " monthly_uuid STRING"
)

DATASET = _schema(
    "id STRING, ds STRING, short_name STRING, title STRING, source STRING, time_scale STRING,"
    " variable STRING, harvester_type STRING, t_version DOUBLE, aggregation_version STRING,"
    " start_date TIMESTAMP, end_date TIMESTAMP, n_granules BIGINT, n_success BIGINT,"
    " n_failed BIGINT, last_checked TIMESTAMP, last_download TIMESTAMP,"
    " last_transformation TIMESTAMP, last_aggregation TIMESTAMP, harvest_status STRING,"
    " transformation_status STRING, aggregation_status STRING"
)

GRID = _schema("id STRING, grid STRING, grid_type STRING, path STRING, checksum STRING, added TIMESTAMP")

GRID_CELL = _schema(
    "grid STRING, grid_type STRING, cell_id BIGINT, tile INT, j INT, i INT, lon DOUBLE, lat DOUBLE,"
    " radius_m DOUBLE"
)

SOURCE_CELL = _schema("src_id BIGINT, row BIGINT, col BIGINT, lon DOUBLE, lat DOUBLE")

OBS_CELL = _schema(
    "ds STRING, filename STRING, date TIMESTAMP, hemi STRING, src_id BIGINT, field STRING, value DOUBLE"
)

MAPPING = _schema("cell_id BIGINT, src_id BIGINT, dist_m DOUBLE, rank INT, kind STRING")

TX_RESULT = _schema(
    "id STRING, grid STRING, field STRING, success BOOLEAN, output_name STRING, output_path STRING,"
    " checksum STRING, message STRING"
)

TABLES = {
    "granule": GRANULE,
    "transformation": TRANSFORMATION,
    "aggregation": AGGREGATION,
    "dataset": DATASET,
    "grid": GRID,
}

KEYS = {
    "granule": ["ds", "filename"],
    "transformation": ["ds", "filename", "grid", "field"],
    "aggregation": ["ds", "grid", "field", "year"],
    "dataset": ["ds"],
    "grid": ["grid"],
}

# Column names of exported state documents, by table. They must match the documents.
DOCUMENT_FIELDS = {
    "granule": {
        "id": "id", "ds": "dataset_s", "filename": "filename_s", "date": "date_dt",
        "url": "source_s", "mod_time": "modified_time_dt",
        "path": "pre_transformation_file_path_s", "checksum": "checksum_s", "size": "file_size_l",
        "success": "harvest_success_b", "message": "error_message_s",
        "download_time": "download_time_dt", "last_attempt": "last_attempt_dt",
        "duration": "download_duration_i",
    },
    "transformation": {
        "id": "id", "ds": "dataset_s", "grid": "grid_name_s", "field": "field_s",
        "date": "date_dt", "hemi": "hemisphere_s", "source_path": "pre_transformation_file_path_s",
        "origin_checksum": "origin_checksum_s", "in_progress": "transformation_in_progress_b",
        "success": "success_b", "started": "transformation_started_dt",
        "completed": "transformation_completed_dt", "output_name": "filename_s",
        "output_path": "transformation_file_path_s", "checksum": "transformation_checksum_s",
        "version": "transformation_version_f", "message": "error_message_s",
    },
    "aggregation": {
        "id": "id", "ds": "dataset_s", "grid": "grid_name_s", "field": "field_s", "year": "year_i",
        "success": "aggregation_success_b", "started": "aggregation_started_dt",
        "agg_time": "aggregation_time_dt", "version": "aggregation_version_s",
        "message": "error_message_s", "notes": "notes_s",
        "daily_path": "aggregated_daily_netCDF_path_s",
        "daily_bin_path": "aggregated_daily_bin_path_s",
        "monthly_path": "aggregated_monthly_netCDF_path_s",
        "monthly_bin_path": "aggregated_monthly_bin_path_s",
        "daily_uuid": "daily_aggregated_uuid_s", "monthly_uuid": "monthly_aggregated_uuid_s",
    },
    "grid": {
        "id": "id", "grid": "grid_name_s", "grid_type": "grid_type_s", "path": "grid_path_s",
        "checksum": "grid_checksum_s", "added": "date_added_dt",
    },
    "dataset": {
        "id": "id", "ds": "dataset_s", "short_name": "short_name_s",
        "title": "original_dataset_title_s", "source": "source_s",
        "time_scale": "data_time_scale_s", "harvester_type": "harvester_type_s",
        "t_version": "t_version_f", "aggregation_version": "aggregation_version_s",
        "start_date": "start_date_dt", "end_date": "end_date_dt", "n_granules": "n_granules_i",
        "n_success": "n_granules_success_i", "n_failed": "n_granules_failed_i",
        "last_checked": "last_checked_dt", "last_download": "last_download_dt",
        "last_transformation": "last_transformation_dt", "last_aggregation": "last_aggregation_dt",
        "harvest_status": "harvest_status_s", "transformation_status": "transformation_status_s",
        "aggregation_status": "aggregation_status_s",
    },
}


@dataclass(frozen=True)
class FieldConfig:
    name: str
    long_name: str = ""
    standard_name: str = ""
    units: str = ""
    pre_transformations: tuple[str, ...] = ()
    post_transformations: tuple[str, ...] = ()

    @classmethod
    def of(cls, raw: Mapping[str, Any]) -> "FieldConfig":
        return cls(
            raw["name"], raw.get("long_name", ""), raw.get("standard_name", ""),
            raw.get("units", ""), tuple(raw.get("pre_transformations") or ()),
            tuple(raw.get("post_transformations") or ()),
        )


# How existing configurations, which do not say it, are treated. File name tags left out
# by provider type, selection strategies by dataset name, and the datasets whose window ends a day after
# the center time.
EXCLUDED_TAGS = {"cmr": ("NRT",), "osisaf": ("icdrft",)}
STRATEGY_BY_NAME = {
    "ATL20_V004_daily": "month_to_days",
    "ATL21_V003_daily": "month_to_days",
    "TELLUS_GRAC-GRFO_MASCON_CRI_GRID_RL06.3_V4": "series_slice",
    "RDEFT4": "month_end",
}
NEAREST_MONTH_PREFIX = "TELLUS_GR"
NEXT_DAY_END_TAG = "DEBIAS_LOCEAN"


def default_strategy(ds: str) -> str:
    """Selection strategy of a dataset whose configuration names none."""
    return STRATEGY_BY_NAME.get(ds, "month_nearest" if NEAREST_MONTH_PREFIX in ds else "plain")


@dataclass(frozen=True)
class DatasetConfig:
    """One dataset's settings; ``of`` reads the same keys the YAML files use."""

    ds: str
    start: str
    end: str
    fields: tuple[FieldConfig, ...]
    date_regex: str = r"\d{8}"
    date_format: str = "%Y%m%d"
    time_scale: str = "daily"
    hemi_north: str | None = None
    hemi_south: str | None = None
    t_version: float = 1.0
    a_version: str = "1.0"
    data_res: str | float | None = None
    mapping_operation: str = "mean"
    transpose: bool = False
    time_bounds_var: str | None = None
    preprocessing: str | None = None
    do_monthly: bool = False
    drop_empty_days: bool = True
    skipna: bool = False
    provider: str | None = None
    strategy: str = "plain"
    variable: str = ""
    active: bool = True
    exclude: tuple[str, ...] = ("NRT",)
    next_day_end: bool = False
    extra: Mapping[str, Any] = dc_field(default_factory=dict, compare=False)

    @classmethod
    def of(cls, raw: Mapping[str, Any]) -> "DatasetConfig":
        hemi = raw.get("hemi_pattern") or {}
        return cls(
            ds=raw["ds_name"], start=str(raw["start"]), end=str(raw["end"]),
            fields=tuple(FieldConfig.of(f) for f in raw["fields"]),
            date_regex=raw.get("filename_date_regex", r"\d{8}"),
            date_format=raw.get("filename_date_fmt", "%Y%m%d"),
            time_scale=raw.get("data_time_scale", "daily"),
            hemi_north=hemi.get("north"), hemi_south=hemi.get("south"),
            t_version=float(raw.get("t_version", 1.0)), a_version=str(raw.get("a_version", "")),
            data_res=raw.get("data_res"), mapping_operation=raw.get("mapping_operation", "mean"),
            transpose=bool(raw.get("transpose", False)),
            time_bounds_var=raw.get("time_bounds_var"),
            preprocessing=raw.get("preprocessing"),
            do_monthly=bool(raw.get("do_monthly_aggregation", False)),
            drop_empty_days=bool(raw.get("remove_nan_days_from_data", True)),
            skipna=bool(raw.get("skipna_in_mean", False)),
            provider=raw.get("provider"),
            strategy=raw.get("strategy") or default_strategy(raw["ds_name"]),
            exclude=tuple(raw.get("exclude", EXCLUDED_TAGS.get(raw.get("harvester_type", ""), ()))),
            next_day_end=bool(raw.get("next_day_end", NEXT_DAY_END_TAG in raw["ds_name"])),
            variable=next((str(v) for k, v in raw.items() if k == "variable" or k.endswith("_variable")), ""), active=bool(raw.get("active", True)), extra=dict(raw),
        )


_NAMES = T.ArrayType(T.StringType())
CONFIG_TABLE = _schema(
    "ds STRING, start STRING, end STRING, time_scale STRING, hemi_north STRING, hemi_south STRING,"
    " t_version DOUBLE, a_version STRING, strategy STRING, variable STRING, active BOOLEAN"
).add("fields", T.ArrayType(
    _schema("name STRING, long_name STRING, standard_name STRING, units STRING")
    .add("pre_transformations", _NAMES).add("post_transformations", _NAMES)
))


def config_table(spark: SparkSession, configs: Iterable[DatasetConfig]) -> DataFrame:
    """Configurations as a DataFrame, one row per dataset."""
    rows = [
        (
            c.ds, c.start, c.end, c.time_scale, c.hemi_north, c.hemi_south, c.t_version,
            c.a_version, c.strategy, c.variable, c.active,
            [(f.name, f.long_name, f.standard_name, f.units, list(f.pre_transformations),
              list(f.post_transformations)) for f in c.fields],
        )
        for c in configs
    ]
    return spark.createDataFrame(rows, CONFIG_TABLE)
