from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegrid.operators import temporal as ops


def records(spark, days):
    return spark.createDataFrame([("f", date.fromisoformat(d)) for d in days], "field string, date date")


def test_merge_takes_the_first_valid(spark, rows):
    df = spark.createDataFrame(
        [(date(2020, 1, 1), "nh", 1, None), (date(2020, 1, 1), "sh", 1, 5.0), (date(2020, 1, 1), "nh", 2, 1.0),
         (date(2020, 1, 1), "sh", 2, 2.0), (date(2020, 1, 2), "nh", 1, None), (date(2020, 1, 2), "sh", 1, None),
         (date(2020, 1, 1), "", 3, 7.0)], "date date, hemi string, cell_id bigint, value double")
    for order in ([ops.hemi_priority()], [ops.hemi_priority(), F.col("hemi")]):
        got = rows(ops.hemi_merge(df, ["date"], order), "date", "cell_id", "value")
        assert got == [(date(2020, 1, 1), 1, 5.0), (date(2020, 1, 1), 2, 1.0), (date(2020, 1, 1), 3, 7.0), (date(2020, 1, 2), 1, None)]


def test_missing_days(spark):
    out = [r.date for r in ops.missing_days(records(spark, ["2020-01-01", "2020-01-02", "2020-01-04", "2020-01-04"]), ["field"]).collect()]
    assert len(out) == 363 and date(2020, 1, 3) in out and date(2020, 12, 31) in out


@pytest.mark.parametrize("days,absent,present", [
    (["2020-01-01", "2020-02-01", "2020-04-01"], ["2020-03-01"], ["2020-01-01", "2020-04-01"]),
    (["2020-01-01", "2020-02-03"], ["2020-03-01"], ["2020-02-01"]),
    (["2020-01-25"], ["2020-01-01"], ["2020-02-01"]),
    (["2020-01-24"], ["2020-01-01", "2020-02-01"], []),
    (["2019-12-28"], ["2019-01-01", "2019-12-01"], []),
])
def test_missing_months(spark, days, absent, present):
    out = {r.date.isoformat() for r in ops.missing_months(records(spark, days), ["field"]).collect()}
    assert set(absent) <= out and not out & set(present)
    assert all(d[:4] == days[0][:4] for d in out)


@pytest.fixture
def year(spark):
    """Two cells over 2020: cell 2 misses 5 March, both miss 10 March, 20 March has no rows, April is whole."""
    out, day = [], date(2020, 1, 1)
    while day.year == 2020:
        if day != date(2020, 3, 20):
            for cell in (1, 2):
                gone = day == date(2020, 3, 10) or (cell == 2 and day == date(2020, 3, 5))
                out.append(("f", day, cell, None if gone else float(day.day * cell)))
        day += timedelta(days=1)
    return spark.createDataFrame(out, "field string, date date, cell_id bigint, value double")


@pytest.mark.parametrize("skipna,drop", [(True, True), (True, False), (False, True), (False, False)])
@pytest.mark.parametrize("stored", [True, False])
def test_monthly_mean(year, skipna, drop, stored):
    days = ops.days_with_data(year, ["field"]) if stored else None
    out = {(r.cell_id, r.month): r for r in ops.monthly_mean(year, ["field"], skipna, drop, days=days).collect()}
    assert len(out) == 24
    april = sum(range(1, 31)) / 30
    assert out[1, 4].value == pytest.approx(april) and out[2, 4].value == pytest.approx(2 * april)
    days1 = [d for d in range(1, 32) if d not in (10, 20)]
    days2 = [d for d in days1 if d != 5]
    march1, march2 = sum(days1) / len(days1), 2 * sum(days2) / len(days2)
    assert out[1, 3].value == (pytest.approx(march1) if skipna or drop else None)
    assert out[2, 3].value == (pytest.approx(march2) if skipna else None)
    assert out[1, 2].time_start == datetime(2020, 2, 1) and out[1, 2].time_end == datetime(2020, 3, 1)
    assert out[1, 2].time == datetime(2020, 2, 15, 12)


def test_absent_months_are_emitted_missing(spark):
    df = spark.createDataFrame([("f", date(2020, 1, 5), 1, 2.0)], "field string, date date, cell_id bigint, value double")
    out = {r.month: r.value for r in ops.monthly_mean(df, ["field"], skipna=True).collect()}
    assert out == {1: 2.0, **{m: None for m in range(2, 13)}}


def test_densify_and_drop(spark, rows):
    s = spark.createDataFrame([("f", date(2020, 1, 1), 1, 2.0), ("f", date(2020, 1, 2), 1, None)], "field string, date date, cell_id bigint, value double")
    gaps = spark.createDataFrame([("f", date(2020, 1, 3))], "field string, date date")
    cells = spark.createDataFrame([(1,), (2,)], "cell_id bigint")
    full = ops.densify(s, gaps.withColumn("grid", F.lit("g")), cells.withColumn("grid", F.lit("g")), ["field"])
    assert rows(full, "date", "cell_id", "value", "time") == [
        (date(2020, 1, 1), 1, 2.0, datetime(2020, 1, 1, 12)), (date(2020, 1, 2), 1, None, datetime(2020, 1, 2, 12)),
        (date(2020, 1, 3), 1, None, datetime(2020, 1, 3, 12)), (date(2020, 1, 3), 2, None, datetime(2020, 1, 3, 12))]
    assert rows(ops.drop_empty_days(full, ["field"]), "date") == [(date(2020, 1, 1),)]


def test_empty_years_are_not_saved(spark, rows):
    s = spark.createDataFrame([("f", date(2020, 1, 1), 1, 2.0), ("f", date(2021, 1, 2), 1, None)], "field string, date date, cell_id bigint, value double")
    assert rows(ops.savable(s, ["field"]), "year") == [(2020,)]
    assert rows(ops.year_stats(s, ["field"]), "year", "has_data", "valid_max") == [(2020, True, 2.0), (2021, False, None)]


def test_gaps_pass_the_shuffle_as_compact_rows(spark, tmp_path):
    """What is written equals the densified series; the shuffle before the sink moves present rows and compact ones only."""
    from tidegrid.sinks.products import write_product

    days = [date(2020, 1, 1), date(2020, 3, 1)]
    s = spark.createDataFrame([("D", "g", "f", d, c, float(c)) for d in days for c in range(0, 3000, 7)], "ds string, grid string, field string, date date, cell_id bigint, value double")
    cells = spark.range(3000).select(F.lit("g").alias("grid"), F.col("id").alias("cell_id"))
    keys = ["ds", "grid", "field"]
    gaps = ops.missing_days(s.select(*keys, "date").distinct(), keys).drop("year")
    packed = ops.with_gaps(s, gaps, cells, keys).withColumn("year", ops.gap_year())
    assert packed.count() <= s.count() + 3 * (366 // ops.GAP_DATES + 1)
    write_product(packed, str(tmp_path / "p"), finish=lambda rows: ops.fill_gaps(rows, keys))
    got = spark.read.parquet(str(tmp_path / "p"))
    assert got.count() == s.count() + 364 * 3000 and got.filter("value IS NOT NULL").count() == s.count()
    assert got.select("date", "cell_id").distinct().count() == got.count()
    want = ops.densify(s, gaps, cells, keys)
    cols = ["date", "cell_id", "value", "time_start", "time", "time_end"]
    check = lambda df: df.select(F.count(F.lit(1)), F.sum(F.xxhash64(*cols).cast("decimal(38,0)"))).first()
    assert check(got) == check(want)


def test_files_are_sorted_by_time_and_cell(spark, tmp_path):
    """Rows of every file of a product stand in the order of time, then cell."""
    from tidegrid.sinks.products import write_product

    s = spark.createDataFrame([("D", "g", "f", date(2020, 1, 1 + d), c, 1.0) for d in (5, 2, 9) for c in (4, 1, 2500)], "ds string, grid string, field string, date date, cell_id bigint, value double")
    cells = spark.createDataFrame([("g", c) for c in (1, 4, 2500)], "grid string, cell_id bigint")
    keys = ["ds", "grid", "field"]
    gaps = ops.missing_days(s.select(*keys, "date").distinct(), keys).drop("year")
    write_product(ops.with_gaps(s, gaps, cells, keys).withColumn("year", ops.gap_year()), str(tmp_path / "p"), finish=lambda rows: ops.fill_gaps(rows, keys))
    import pyarrow.parquet as pq

    for file in (tmp_path / "p").rglob("*.parquet"):
        rows_ = list(zip(*[pq.ParquetFile(file).read(columns=[c])[c].to_pylist() for c in ("time", "cell_id")]))
        assert rows_ == sorted(rows_)
