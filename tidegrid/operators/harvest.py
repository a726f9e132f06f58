"""Choose listed files: filters and the per-dataset selection strategies."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions import text
from tidegrid.functions.masks import UnknownFunction
from tidegrid.functions.timebounds import midpoint, time_window
from tidegrid.schemas import DatasetConfig
from tidegrid.sizing import bounded_broadcast

# Fixed value: days a granule may lie from the date it stands for.
TOLERANCE_DAYS = 7
# Fixed value: days before the month end that still stand for the month.
MONTH_END_SLACK = 2


def candidates(listing: DataFrame, config: DatasetConfig) -> DataFrame:
    """Listed files of a dataset with name, date and hemisphere; out-of-range and excluded names go."""
    named = listing.withColumn("filename", text.basename("url"))
    return (
        named.filter(text.without_tags("filename", config.exclude))
        .withColumn("date", text.filename_date("filename", config.date_regex, config.date_format))
        .filter(text.in_range("date", config.start, config.end))
        .withColumns({
            "ds": F.lit(config.ds),
            "hemi": text.hemi_tag("filename", config.hemi_north, config.hemi_south),
            "year": F.year("date"),
        })
    )


def latest_per_key(rows: DataFrame, keys: Iterable[str], order: Iterable[Column | str]) -> DataFrame:
    """The last row per key in ``order``.

    A first-row rank: Spark keeps one row per key and task before it shuffles, so a hot key costs a
    row per task, and columns nobody reads are pruned.
    """
    w = Window.partitionBy(*keys).orderBy(*[(F.col(c) if isinstance(c, str) else c).desc() for c in order])
    return rows.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") == 1).drop("__rank")


def _day(date: str = "date") -> Column:
    return F.col(date).cast("date")


def month_nearest(rows: DataFrame, keys: Iterable[str] = ("ds",), legacy_exclude_last: bool = False) -> DataFrame:
    """Per month, the granule closest to the first within the tolerance.

    Months run from the first to the last granule of the dataset; ``legacy_exclude_last`` leaves the
    last one out. A later address replaces an earlier one of the same date; on equal distance the
    earlier date wins. A granule is near at most two month starts, so no range join is needed.
    """
    keys = list(keys)
    one_per_date = latest_per_key(rows.withColumn("day", _day()), [*keys, "day"], ["url"])
    span = one_per_date.groupBy(*keys).agg(
        F.trunc(F.min("day"), "MM").alias("first_month"), F.trunc(F.max("day"), "MM").alias("last_month")
    )
    first = F.trunc("day", "MM")
    near = (
        one_per_date.withColumn("month", F.explode(F.array(first, F.add_months(first, 1))))
        .withColumn("delta", F.abs(F.datediff("day", "month")))
        .filter(F.col("delta") <= TOLERANCE_DAYS)
    )
    picked = near.groupBy(*keys, "month").agg(
        F.min_by(F.struct("url", "day", "delta"), F.struct("delta", "day")).alias("p")
    ).select(*keys, "month", "p.*")
    upper = F.col("month") < F.col("last_month") if legacy_exclude_last else F.col("month") <= F.col("last_month")
    return (
        picked.join(bounded_broadcast(span), keys)
        .filter((F.col("month") >= F.col("first_month")) & upper)
        .select(*keys, "month", "url", F.col("day").alias("date"))
    )


def series_slice(steps: DataFrame, keys: Iterable[str] = ("ds", "url"), time: str = "time",
                 start: str | None = None, end: str | None = None) -> DataFrame:
    """Cut a multi-month series into months: the step closest to each month's center.

    The tolerance is shorter than half a month, so a step can only stand for its own month. The
    slice is dated to the month start. ``start`` and ``end`` columns give the file's coverage.
    """
    keys = list(keys)
    t = F.col(time).cast("timestamp")
    rows = steps.withColumn("month", F.trunc(t.cast("date"), "MM"))
    center = time_window(start=F.col("month"), period="AVG_MON")["center"]
    off = F.abs(F.unix_micros(t) - F.unix_micros(center))
    rows = rows.withColumn("off", off).filter(F.col("off") <= TOLERANCE_DAYS * 86_400_000_000)
    if start and end:
        rows = rows.filter(F.col("month").between(
            F.trunc(F.col(start).cast("date"), "MM"), F.trunc(F.col(end).cast("date"), "MM")))
    return rows.groupBy(*keys, "month").agg(
        F.min_by(t, F.struct("off", t.alias("t"))).alias("step_time")
    ).withColumn("filename", F.concat(
        F.col(keys[0]), F.lit("_"), F.date_format("month", "yyyyMMdd"), F.lit(".nc")))


def month_end_pick(rows: DataFrame, keys: Iterable[str] = ("ds",)) -> DataFrame:
    """Per month, the granule of the last day, else one or two days earlier; dated to the first."""
    keys = list(keys)
    day = _day()
    near = (
        rows.withColumns({"day": day, "month": F.trunc(day, "MM")})
        .filter(F.datediff(F.last_day("day"), "day") <= MONTH_END_SLACK)
    )
    return near.groupBy(*keys, "month").agg(
        F.max_by(F.struct("url", "day"), F.struct("day", "url")).alias("p")
    ).select(*keys, F.col("month").alias("date"), "p.url", F.col("p.day").alias("picked_day"))


def month_to_days(rows: DataFrame, date: str = "date", filename: str = "filename") -> DataFrame:
    """One row per calendar day of a monthly container, with the daily file's name."""
    first = F.trunc(_day(date), "MM")
    day = F.explode(F.sequence(first, F.last_day(first), F.expr("INTERVAL 1 DAY"))).alias("day")
    name = F.col(filename)
    # Parts of the container's name that stay in the daily name.
    daily = F.concat(
        F.substring(name, 1, 9), F.date_format("day", "yyyyMMdd"),
        F.substring(name, F.length(name) - 9, F.lit(7)), F.lit(".nc"),
    )
    return rows.select("*", day).withColumn("daily_filename", daily)


def day_of_slice(begin: Column | str, end: Column | str) -> Column:
    """Date of a daily slice: the day holding the middle of its time span."""
    return midpoint(begin, end).cast("date")


STRATEGIES: dict[str, Callable[..., DataFrame]] = {
    "plain": lambda rows, **_: rows,
    "month_nearest": month_nearest,
    "month_end": month_end_pick,
    "series_slice": series_slice,
    "month_to_days": month_to_days,
}


def select(rows: DataFrame, strategy: str, **kwargs) -> DataFrame:
    """Apply a dataset's selection strategy by name."""
    if strategy not in STRATEGIES:
        raise UnknownFunction(f"unknown strategy {strategy}; known: {sorted(STRATEGIES)}")
    return STRATEGIES[strategy](rows, **kwargs)
