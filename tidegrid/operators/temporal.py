"""Hemisphere merge, calendar gaps, densified series, monthly means, yearly statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.timebounds import month_window, time_window
from tidegrid.sizing import shuffle_width, spread_join

# Fixed value: a monthly record stands for a month when it is this close to the first.
MONTH_TOLERANCE_DAYS = 7
# Cells and dates that one compact row of a gap stands for.
GAP_CELLS, GAP_DATES = 1024, 16


def hemi_priority(hemi: Column | str = "hemi") -> Column:
    """North first, then south, then anything else."""
    h = F.col(hemi) if isinstance(hemi, str) else hemi
    return F.when(h == "nh", 0).when(h == "sh", 1).otherwise(2)


def hemi_merge(records: DataFrame, keys: Sequence[str], order: Sequence[Column], cell: str = "cell_id",
               value: str = "value") -> DataFrame:
    """First non-missing value per (keys, cell) in ``order``; any number of overlapping records.

    A single numeric order column keeps the aggregate on fixed-width buffers, which Spark hashes;
    several columns, or text, make it sort. Give one where records of a hemisphere are unique.
    """
    rank = F.when(F.col(value).isNotNull(), order[0] if len(order) == 1 else F.struct(*order))
    return records.groupBy(*keys, cell).agg(F.min_by(value, rank).alias(value))


def _year_of(date: str) -> Column:
    return F.year(F.col(date).cast("date"))


def missing_days(records: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """Days of each (keys, year) without a record. A group holds at most 366 distinct dates."""
    day = F.col(date).cast("date")
    year = F.col("year")
    spine = F.sequence(F.make_date(year, F.lit(1), F.lit(1)), F.make_date(year, F.lit(12), F.lit(31)))
    return (
        records.select(*keys, _year_of(date).alias("year"), day.alias("day"))
        .groupBy(*keys, "year").agg(F.collect_set("day").alias("seen"))
        .select(*keys, "year", F.explode(F.array_except(spine, F.col("seen"))).alias("date"))
    )


def _near_month_starts(date: str) -> Column:
    """Month starts within the tolerance of a record's date: none, one, or the next month's."""
    day = F.col(date).cast("date")
    first = F.trunc(day, "MM")
    both = F.array(first, F.add_months(first, 1))
    return F.filter(both, lambda m: F.abs(F.datediff(day, m)) <= MONTH_TOLERANCE_DAYS)


def missing_months(records: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """Month starts of each (keys, year) with no record of that year within the tolerance."""
    year = F.col("year")
    spine = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda m: F.make_date(year, m, F.lit(1)))
    near = F.explode_outer(_near_month_starts(date)).alias("month")
    seen = F.collect_set(F.when(F.year("month") == year, F.col("month")))
    return (
        records.select(*keys, _year_of(date).alias("year"), near)
        .groupBy(*keys, "year").agg(seen.alias("seen"))
        .select(*keys, "year", F.explode(F.array_except(spine, F.col("seen"))).alias("date"))
    )


def date_difference(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """Set difference of dates."""
    return wanted.subtract(present)


def with_gaps(series: DataFrame, gaps: DataFrame, cells: DataFrame, keys: Sequence[str],
              cell_on: Sequence[str] = ("grid",), value: str = "value") -> DataFrame:
    """``series`` and, for its gap dates, compact rows that ``fill_gaps`` turns into empty records.

    A compact row stands for up to ``GAP_DATES`` dates of one year on up to ``GAP_CELLS`` cells, so what
    a shuffle moves are the rows that are present, and half a byte for each one that is not. ``gaps``
    has keys and ``date``; ``cells`` has ``cell_id`` and the ``cell_on`` columns that tie them to gaps.
    """
    if not cell_on:
        raise ValueError("name the columns that tie gaps to the cells of their grid")
    day = F.col("date").cast("date")
    blocks = cells.groupBy(*cell_on, F.floor(F.col("cell_id") / GAP_CELLS).alias("__block")).agg(F.sort_array(F.collect_set("cell_id")).alias("gap_cells"))
    extra = [c for c in cell_on if c not in keys]
    chunks = gaps.groupBy(*keys, *extra, F.year(day).alias("__year"), F.floor(F.dayofyear(day) / GAP_DATES).alias("__chunk")).agg(
        F.sort_array(F.collect_set(day)).alias("gap_dates"))
    spine = spread_join(blocks, chunks, list(cell_on), salt_from=["__block"], salts=shuffle_width(cells))
    # few narrow rows, each of which becomes many: as many tasks as a shuffle has, whatever their size
    spine = spine.repartition(shuffle_width(cells), *keys, "__block", "__year", "__chunk")
    present = series.select(*keys, day.alias("date"), "cell_id", value)
    return present.unionByName(spine.select(*keys, "gap_dates", "gap_cells"), allowMissingColumns=True)


def gap_year() -> Column:
    """Year of a row of ``with_gaps``."""
    return F.year(F.coalesce("date", F.col("gap_dates")[0]))


def fill_gaps(packed: DataFrame, keys: Sequence[str], period: str = "AVG_DAY", value: str = "value") -> DataFrame:
    """The rows of ``with_gaps``, compact ones expanded, each with its record's window; other columns stay."""
    rest = [c for c in packed.columns if c not in (*keys, "date", "cell_id", value, "gap_dates", "gap_cells")]
    rows = packed.withColumn("__date", F.explode_outer("gap_dates")).withColumn("__cell", F.explode_outer("gap_cells"))
    rows = rows.withColumns({"date": F.coalesce("date", "__date"), "cell_id": F.coalesce("cell_id", "__cell")})
    return rows.withColumn("w", time_window(start="date", period=period)).select(
        *keys, "date", "cell_id", value, F.col("w.start").alias("time_start"),
        F.col("w.center").alias("time"), F.col("w.end").alias("time_end"), *rest)


def densify(series: DataFrame, gaps: DataFrame, cells: DataFrame, keys: Sequence[str],
            cell_on: Sequence[str] = ("grid",), period: str = "AVG_DAY", value: str = "value") -> DataFrame:
    """Append an all-missing record, with its window, for every gap date.

    ``gaps`` has keys and ``date``; ``cells`` has ``cell_id`` and the ``cell_on`` columns. A writer that
    shuffles its rows does so before ``fill_gaps``, see ``sinks.products.write_product``.
    """
    return fill_gaps(with_gaps(series, gaps, cells, keys, cell_on, value), keys, period, value)


def drop_empty_days(series: DataFrame, keys: Sequence[str], date: str = "date", value: str = "value") -> DataFrame:
    """Remove days on which no cell has a value.

    Validity is one pre-aggregated row per day joined back, not a window, so a day with very many
    cells is never gathered in one task.
    """
    day = [*keys, date]
    valid = series.groupBy(*day).agg(F.count(value).alias("n")).filter(F.col("n") > 0).drop("n")
    return spread_join(series, valid, day, salt_from=["cell_id"], how="left_semi")


def days_with_data(series: DataFrame, keys: Sequence[str], date: str = "date", value: str = "value") -> DataFrame:
    """Days of each (keys, year, month) on which some cell has a value; days fold before they are counted."""
    day = F.col(date).cast("date")
    return (
        series.filter(F.col(value).isNotNull())
        .select(*keys, F.year(day).alias("year"), F.month(day).alias("month"), day.alias("d"))
        .groupBy(*keys, "year", "month").agg(F.count_distinct("d").alias("need"))
    )


def monthly_mean(
    series: DataFrame,
    keys: Sequence[str],
    skipna: bool = False,
    drop_empty: bool = True,
    date: str = "date",
    value: str = "value",
    cell: str = "cell_id",
    days: DataFrame | None = None,
) -> DataFrame:
    """Twelve monthly means per (keys, cell, year) with their windows.

    ``series`` needs no densifying: a day without a row counts as missing. With ``skipna`` missing
    days are left out of the mean; without it one missing day voids the month. ``drop_empty`` first
    leaves out days on which no cell of the record has a value.

    One shuffle: twelve conditional sums fold on the map side. The days each month must have come
    from the calendar, or from a small per-month count of days with data (``days``, computed by
    ``days_with_data`` unless a stored one is given).
    """
    day = F.col(date).cast("date")
    month = F.month(day)
    # sums and counts of the twelve months side by side: one shuffle, no month spine to join
    months = range(1, 13)
    flat = (
        series.select(*keys, cell, F.year(day).alias("year"), month.alias("m"), F.col(value).alias("v"))
        .groupBy(*keys, cell, "year")
        .agg(
            *[F.sum(F.when(F.col("m") == m, F.col("v"))).alias(f"s{m}") for m in months],
            *[F.count(F.when(F.col("m") == m, F.col("v"))).alias(f"n{m}") for m in months],
        )
    )
    long = flat.select(
        *keys, cell, "year",
        F.explode(F.array(*[
            F.struct(F.lit(m).alias("month"), F.col(f"s{m}").alias("s"), F.col(f"n{m}").alias("n"))
            for m in months
        ])).alias("p"),
    ).select(*keys, cell, "year", "p.*")
    mean = F.when(F.col("n") > 0, F.col("s") / F.col("n"))
    if skipna:
        out = long.withColumn(value, mean)
    elif not drop_empty:
        calendar = F.day(F.last_day(F.make_date(F.col("year"), F.col("month"), F.lit(1))))
        out = long.withColumn(value, F.when(F.col("n") == calendar, mean))
    else:
        valid = days_with_data(series, keys, date, value) if days is None else days
        on = [*keys, "year", "month"]
        out = spread_join(long, valid, on, salt_from=[cell], how="left").withColumn(
            value, F.when(F.col("n") == F.col("need"), mean))
    w = month_window("year", "month")
    return out.withColumn("w", w).select(
        *keys, cell, "year", "month", value, F.col("w.start").alias("time_start"),
        F.col("w.center").alias("time"), F.col("w.end").alias("time_end"),
    )


def year_stats(series: DataFrame, keys: Sequence[str], date: str = "date", value: str = "value") -> DataFrame:
    """Valid range of each (keys, year) and whether there is anything to save."""
    return series.groupBy(*keys, _year_of(date).alias("year")).agg(
        F.min(value).alias("valid_min"), F.max(value).alias("valid_max"),
        F.count(value).alias("n_valid"), (F.count(value) > 0).alias("has_data"),
    )


def savable(series: DataFrame, keys: Sequence[str], date: str = "date", value: str = "value",
            stats: DataFrame | None = None) -> DataFrame:
    """Rows of years that have at least one value; ``stats`` saves recomputing ``year_stats``."""
    full = (year_stats(series, keys, date, value) if stats is None else stats).filter("has_data").select(*keys, "year")
    rows = series.withColumn("year", _year_of(date))
    return spread_join(rows, full, [*keys, "year"], salt_from=["cell_id"], how="left_semi")


def time_coverage(series: DataFrame, keys: Sequence[str], resolution: str,
                  start: str = "time_start", end: str = "time_end") -> DataFrame:
    """First window start and last window end, with the resolution label (P1D or P1M)."""
    return series.groupBy(*keys).agg(
        F.min(start).alias("coverage_start"), F.max(end).alias("coverage_end"),
        F.lit(resolution).alias("resolution"),
    )
