"""File names, dates in file names, hemisphere tags, output names."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strftime directive to Spark datetime pattern letter.
STRFTIME_PATTERNS = {
    "%Y": "yyyy", "%m": "MM", "%d": "dd", "%j": "DDD",
    "%H": "HH", "%M": "mm", "%S": "ss", "%b": "MMM",
}

NEAR_REAL_TIME_TAG = "NRT"
FAST_TRACK_TAG = "icdrft"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def basename(col: Column | str) -> Column:
    """Text after the last slash."""
    return F.substring_index(_c(col), "/", -1)


def stem(col: Column | str) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(basename(col), r"\.[^.]*$", "")


def spark_pattern(fmt: str) -> str:
    """Translate a strftime format; literal letters are quoted."""
    out, i = [], 0
    while i < len(fmt):
        token = fmt[i:i + 2]
        if token in STRFTIME_PATTERNS:
            out.append(STRFTIME_PATTERNS[token])
            i += 2
        elif fmt[i] == "%":
            raise ValueError(f"unsupported date directive {token}")
        else:
            out.append(f"'{fmt[i]}'" if fmt[i].isalpha() else fmt[i])
            i += 1
    return "".join(out)


def filename_date(col: Column | str, regex: str, fmt: str) -> Column:
    """First match of ``regex`` in a name, parsed by a strftime format; NULL when it does not parse."""
    found = F.regexp_extract(_c(col), regex, 0)
    return F.try_to_timestamp(F.nullif(found, F.lit("")), F.lit(spark_pattern(fmt)))


# Accepted spellings of a configured range bound.
BOUND_FORMATS = ("%Y%m%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d")


def bound(text: str) -> Column:
    """A configured range bound; ``NOW`` is the query's current time."""
    if text == "NOW":
        return F.current_timestamp()
    for fmt in BOUND_FORMATS:
        try:
            parsed = datetime.strptime(text, fmt)
        except ValueError:
            continue
        return F.lit(parsed.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    raise ValueError(f"unreadable date bound {text}")


def bound_year(text: str) -> int:
    """Calendar year of a configured bound."""
    return datetime.now(timezone.utc).year if text == "NOW" else int(text[:4])


def in_range(col: Column | str, start: str, end: str) -> Column:
    """Inclusive on both ends."""
    return _c(col).between(bound(start), bound(end))


def without_tags(col: Column | str, tags: Iterable[str] = (NEAR_REAL_TIME_TAG,)) -> Column:
    """True where the name contains none of ``tags``."""
    keep = F.lit(True)
    for tag in tags:
        keep = keep & ~_c(col).contains(tag)
    return keep


def hemi_tag(col: Column | str, north: str | None, south: str | None) -> Column:
    """``nh`` or ``sh`` by pattern, north tested first; empty for datasets without hemispheres."""
    if not north and not south:
        return F.lit("")
    return (
        F.when(_c(col).contains(north), F.lit("nh"))
        .when(_c(col).contains(south), F.lit("sh"))
        .otherwise(F.lit(""))
    )


def resolution(col: Column | str) -> Column:
    """``"10/111"`` or ``"0.25"`` as a number."""
    clean = F.regexp_replace(_c(col).cast("string"), " ", "")
    parts = F.split(clean, "/")
    num = F.get(parts, F.lit(0)).try_cast("double")
    den = F.get(parts, F.lit(1)).try_cast("double")
    return F.when(clean.contains("/"), F.try_divide(num, den)).otherwise(clean.try_cast("double"))


def transformed_name(grid, field, filename) -> Column:
    """Name of a regridded record: grid, field and source stem."""
    return F.concat(F.concat_ws("_", _c(grid), _c(field), stem(filename)), F.lit(".nc"))


def product_name(ds, grid, time_scale, field, year) -> Column:
    """Name of an annual product, without extension."""
    return F.concat_ws(
        "_", _c(ds), _c(grid), F.upper(_c(time_scale)), _c(field), _c(year).cast("string")
    )


def provenance_name(ds, field, grid, year) -> Column:
    return F.concat(
        F.concat_ws("_", _c(ds), _c(field), _c(grid), _c(year).cast("string")),
        F.lit("_descendants.json"),
    )


def mapping_name(grid, hemi, version) -> Column:
    """Key of a stored mapping."""
    h = F.nullif(_c(hemi), F.lit(""))
    return F.concat_ws("_", _c(grid), h, F.concat(F.lit("v"), _c(version).cast("string")), F.lit("factors"))


def record_label(field, grid) -> Column:
    """Canonical label of a regridded variable."""
    return F.concat(_c(field), F.lit("_interpolated_to_"), _c(grid))


def stable_id(*cols) -> Column:
    """Reproducible row id; unlike a random one it survives task retries."""
    return F.md5(F.concat_ws("|", *[_c(c).cast("string") for c in cols]))
