"""Quality masks: DataFrame to DataFrame, built from column expressions only.

A mask sets values to NULL; it never drops rows. All masks are idempotent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Mask = Callable[..., DataFrame]

# Meaning of the quality bits, lowest bit first.
QA_FLAG_MEANINGS = (
    "BT_weather_filter_applied",
    "NT_weather_filter_applied",
    "land_spillover_applied",
    "no_input_data",
    "invalid_ice_mask_applied",
    "spatial_interpolation_applied",
    "temporal_interpolation_applied",
    "melt_start_detected",
)
# Rejected quality bits 3, 5 and 6.
QA_REJECT_BITS = 8 + 32 + 64
# Fixed value: coldest accepted sea surface temperature in kelvin, exclusive.
SST_FLOOR_K = 272.65

_REGISTRY: dict[str, Mask] = {}


class UnknownFunction(KeyError):
    """A configured function name is not registered."""


def register_mask(name: str) -> Callable[[Mask], Mask]:
    def add(fn: Mask) -> Mask:
        _REGISTRY[name] = fn
        return fn

    return add


def mask_names() -> list[str]:
    return sorted(_REGISTRY)


def apply_masks(df: DataFrame, names: Iterable[str], **columns) -> DataFrame:
    """Apply registered masks in order; an unknown name raises while planning."""
    wanted = list(dict.fromkeys(names))
    missing = [n for n in wanted if n not in _REGISTRY]
    if missing:
        raise UnknownFunction(f"unknown masks {missing}; known: {mask_names()}")
    for name in wanted:
        df = df.transform(_REGISTRY[name], **columns.get(name, {}))
    return df


def _qa_rejected(qa: str) -> Column:
    return F.coalesce(F.col(qa).cast("bigint").bitwiseAND(F.lit(QA_REJECT_BITS)), F.lit(0)) != 0


def _null_where(df: DataFrame, bad: Column, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.when(~bad, F.col(c)) for c in columns})


@register_mask("sst_ice")
def sst_ice(
    df: DataFrame, sst: str = "analysed_sst", ice: str = "sea_ice_fraction",
    floor_k: float = SST_FLOOR_K,
) -> DataFrame:
    """Drop temperatures under ice (when an ice column exists) or at and below the floor."""
    bad = F.coalesce(F.col(sst) <= floor_k, F.lit(False))
    if ice in df.columns:
        bad = bad | F.coalesce(F.col(ice) > 0, F.lit(False))
    return _null_where(df, bad, [sst])


@register_mask("negatives")
def negatives(df: DataFrame, keep: Iterable[str] = ("lat", "lon"), columns: Iterable[str] | None = None) -> DataFrame:
    """Drop negative values of every floating-point column except coordinates."""
    skip = set(keep)
    names = list(columns) if columns is not None else [
        f.name for f in df.schema.fields
        if f.dataType.typeName() in ("double", "float") and f.name not in skip
    ]
    return df.withColumns({c: F.when(F.col(c) >= 0, F.col(c)) for c in names})


@register_mask("range_flag")
def range_flag(
    df: DataFrame, columns: Iterable[str] = ("nsidc_nt_seaice_conc", "cdr_seaice_conc"),
    flag: str = "spatial_interpolation_flag",
) -> DataFrame:
    """Keep concentrations of at most 1 that were not spatially interpolated."""
    return df.withColumns({
        c: F.when((F.col(c) <= 1) & F.col(flag).isNull(), F.col(c)) for c in columns
    })


@register_mask("qa_bits")
def qa_bits(
    df: DataFrame, columns: Iterable[str] = ("cdr_seaice_conc", "cdr_seaice_conc_stdev"),
    qa: str = "cdr_seaice_conc_qa_flag",
) -> DataFrame:
    """Drop values whose quality byte has a rejected bit."""
    return _null_where(df, _qa_rejected(qa), columns)


@register_mask("qa_range")
def qa_range(
    df: DataFrame, columns: Iterable[str] = ("cdr_seaice_conc", "cdr_seaice_conc_stdev"),
    qa: str = "cdr_seaice_conc_qa_flag",
) -> DataFrame:
    """As ``qa_bits``, and also drop all columns where the first is above 1."""
    names = list(columns)
    bad = _qa_rejected(qa) | F.coalesce(F.col(names[0]) > 1, F.lit(False))
    return _null_where(df, bad, names)


@register_mask("land")
def land(
    df: DataFrame, columns: Iterable[str] = ("lwe_thickness", "uncertainty"), mask: str = "land_mask",
) -> DataFrame:
    """Keep ocean cells (land mask equal to 0)."""
    return df.withColumns({c: F.when(F.col(mask) == 0, F.col(c)) for c in columns})


# Function names existing dataset configurations use, and the mask each stands for.
CONFIG_NAMES = {
    "AVHRR_remove_ice_or_near_ice": "sst_ice",
    "RDEFT4_remove_negative_values": "negatives",
    "G02202v4_mask_flagged_conc": "range_flag",
    "mask_nsidc_seaice": "qa_range",
    "G02202v5_mask_flagged_conc": "qa_bits",
    "GRACE_MASCON": "land",
}
for _config_name, _name in CONFIG_NAMES.items():
    _REGISTRY[_config_name] = _REGISTRY[_name]


def presence(col: Column | str) -> Column:
    """1 where the value is positive, else 0, missing included."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c > 0, F.lit(1.0)).otherwise(F.lit(0.0))


def qa_layers(df: DataFrame, qa: str = "cdr_seaice_conc_qa_flag") -> DataFrame:
    """One row per quality bit: ``bit``, its ``flag`` value, its ``meaning`` and whether it ``is_set``."""
    meanings = F.array(*[F.lit(m) for m in QA_FLAG_MEANINGS])
    return (
        df.select("*", F.posexplode(meanings).alias("bit", "meaning"))
        .withColumn("flag", F.pow(F.lit(2), F.col("bit")).cast("int"))
        .withColumn("is_set", F.col(qa).cast("bigint").bitwiseAND(F.col("flag").cast("bigint")) != 0)
    )


def mask_diagnostics(before: str, after: str) -> list[Column]:
    """Aggregates comparing a column before and after masking."""
    return [
        F.count_if(F.col(before) > 1).alias("over_one_before"),
        F.count_if(F.col(after) > 1).alias("over_one_after"),
        F.sum(before).alias("sum_before"),
        F.sum(after).alias("sum_after"),
    ]
