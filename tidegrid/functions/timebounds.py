"""Averaging windows and record windows as column expressions (UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Averaging period codes.
PERIODS = {
    "AVG_DAY": {"days": 1},
    "AVG_WEEK": {"weeks": 1},
    "AVG_MON": {"months": 1},
    "AVG_YEAR": {"years": 1},
}
# Fixed value: origin of encoded product times.
TIME_EPOCH = "1980-01-01 00:00:00"


def _ts(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp")


def midpoint(start: Column | str, end: Column | str) -> Column:
    """Instant halfway between two instants."""
    a, b = F.unix_micros(_ts(start)), F.unix_micros(_ts(end))
    return F.timestamp_micros(a + F.shiftright(b - a, 1))


def _interval(period: str) -> Column:
    return F.make_interval(**{unit: F.lit(n) for unit, n in PERIODS[period].items()})


def time_window(start: Column | str | None = None, end: Column | str | None = None,
                period: str = "AVG_DAY") -> Column:
    """Struct of start, center and end; exactly one bound is given, the other follows."""
    if (start is None) == (end is None):
        raise ValueError("give exactly one of start and end")
    if period not in PERIODS:
        raise ValueError(f"unknown averaging period {period}")
    if start is not None:
        lo = _ts(start)
        hi = lo + _interval(period)
    else:
        hi = _ts(end)
        lo = hi - _interval(period)
    return F.struct(lo.alias("start"), midpoint(lo, hi).alias("center"), hi.alias("end"))


def calendar_day(col: Column | str) -> Column:
    """Struct of start and end of the calendar day holding an instant."""
    day = F.date_trunc("day", _ts(col))
    return F.struct(day.alias("start"), (day + F.make_interval(days=F.lit(1))).alias("end"))


def month_window(year: Column | str, month: Column | str) -> Column:
    """Window of a calendar month given as numbers."""
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    first = F.make_date(y, m, F.lit(1))
    return time_window(end=F.add_months(first, 1), period="AVG_MON")


def normalise_instant(text: Column | str) -> Column:
    """Text such as ``20200115`` or ``2020-01-15T10:00:00Z`` as an instant, NULL when malformed."""
    t = F.regexp_replace((F.col(text) if isinstance(text, str) else text).cast("string"), "Z", "")
    dashed = F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2))
    return F.when(t.contains("-"), t).otherwise(dashed).try_cast("timestamp")


def record_window(
    date: Column | str,
    time_scale: str,
    bounds_start: Column | str | None = None,
    bounds_end: Column | str | None = None,
    center: Column | str | None = None,
    next_day_end: bool = False,
    legacy_bounds: bool = False,
) -> Column:
    """Window of a regridded record.

    Daily records end at the bounds variable's end, or a day after the record date; monthly records
    end on the first of the next month. ``next_day_end`` ends the window one day after ``center``.
    ``legacy_bounds`` takes the first bound for both ends. Missing bounds fall back to the date.
    """
    d = _ts(date)
    if time_scale == "monthly":
        period = "AVG_MON"
        end = F.add_months(F.trunc(d, "MM"), 1).cast("timestamp")
    elif time_scale == "daily":
        period = "AVG_DAY"
        end = F.date_trunc("day", d) + F.make_interval(days=F.lit(1))
        if bounds_start is not None:
            last = bounds_start if legacy_bounds or bounds_end is None else bounds_end
            end = F.coalesce(normalise_instant(last), end)
    else:
        raise ValueError(f"unknown time scale {time_scale}")
    if next_day_end:
        if center is None:
            raise ValueError("next_day_end needs a center time")
        end = F.coalesce(_ts(center), d) + F.make_interval(days=F.lit(1))
    return time_window(end=end, period=period)


def hours_since_epoch(col: Column | str, epoch: str = TIME_EPOCH) -> Column:
    """Product time encoding: hours since the epoch (window centers are whole hours)."""
    origin = F.unix_seconds(F.lit(epoch).cast("timestamp"))
    return (F.unix_seconds(_ts(col)) - origin) / F.lit(3600.0)


def since(now: Column | str | None, days: int) -> Column:
    """Cutoff instant ``days`` before ``now`` (current time by default)."""
    base = F.current_timestamp() if now is None else _ts(now)
    return base - F.make_interval(days=F.lit(days))
