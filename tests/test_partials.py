"""Monthly means from kept sums: the same as from the whole series, at the price of the changed months."""

import random
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidegrid.operators.temporal import monthly_mean
from tidegrid.plans import aggregate
from tidegrid.schemas import DatasetConfig
from tidegrid.sinks.partials import monthly_from_partials, stored_partials, update_partials

KIND = "grid string, field string, date date, cell_id bigint, value double"
KEYS = ["grid", "field"]


def daily(seed=1):
    r, first = random.Random(seed), date(2019, 11, 1)
    rows = [(g, f, first + timedelta(days=d), c, None if r.random() < 0.02 or d % 40 == 0 else float(r.randint(0, 50)))
            for g, f in (("a", "h"), ("a", "t=1/2"), ("b", "h")) for d in range(0, 130) for c in range(6) if (d, c) != (3, 2) and not (g == "b" and d > 70)]
    return rows + [("c", "h", date(2020, 2, 3), 9, None)]


def kept(spark, path, frame):
    return stored_partials(spark, path, [frame.schema[k] for k in KEYS], frame.schema["cell_id"])


def files(path):
    out = {}
    for p in Path(path).rglob("*.parquet"):
        out.setdefault(str(p.parent.relative_to(path)), set()).add(p.name)
    return out


def same(rows, a, b):
    cols = [*KEYS, "cell_id", "year", "month", "time_start", "time", "time_end"]
    a, b = ({r[:-1]: r[-1] for r in rows(x, *cols, "value")} for x in (a, b))
    assert a.keys() == b.keys()
    assert all(a[k] == (None if b[k] is None else pytest.approx(b[k])) for k in a)


@pytest.mark.parametrize("skipna,drop_empty", [(True, True), (False, False), (False, True)])
def test_kept_sums_follow_the_series(spark, tmp_path, rows, skipna, drop_empty):
    path, data = str(tmp_path / "partials"), daily()
    frame = spark.createDataFrame(data, KIND).withColumn("total", F.lit("clash"))
    check = lambda f: same(rows, monthly_from_partials(kept(spark, path, f), KEYS, skipna, drop_empty), monthly_mean(f, KEYS, skipna, drop_empty))
    assert update_partials(frame.filter("false"), path, KEYS).count() == 0 and not Path(path).exists()
    assert update_partials(frame, path, KEYS).count() == 5 + 5 + 3 + 1
    check(frame)
    before = files(path)
    assert update_partials(frame.repartition(7), path, KEYS).count() == 0 and files(path) == before

    # one day changes: one folder is written again
    day = date(2020, 1, 20)
    changed = frame.withColumn("value", F.when((F.col("date") == day) & (F.col("grid") == "a") & (F.col("field") == "h"), 99.0).otherwise(F.col("value")))
    assert rows(update_partials(changed, path, KEYS), *KEYS, "year", "month") == [("a", "h", 2020, 1)]
    after = files(path)
    assert {k for k in after if after[k] != before[k]} == {"grid=a/field=h/year=2020/month=1"}
    check(changed)

    # a month loses its records, another gets its first ones
    moved = changed.filter("NOT (grid = 'b' AND month(date) = 12)").unionByName(
        spark.createDataFrame([("b", "h", date(2020, 5, d), 1, float(d)) for d in range(1, 32)], KIND), allowMissingColumns=True)
    assert rows(update_partials(moved, path, KEYS), "grid", "month") == [("b", 12), ("b", 5)]
    check(moved)
    assert update_partials(moved, path, KEYS).count() == 0


def test_other_years_stay(spark, tmp_path, rows):
    path = str(tmp_path / "partials")
    frame = spark.createDataFrame(daily(), KIND)
    update_partials(frame, path, KEYS)
    later = spark.createDataFrame(daily(2), KIND).filter("year(date) = 2020 AND grid = 'a'")
    years = later.select(*KEYS, F.year("date").alias("year")).distinct()
    assert {r.year for r in update_partials(later, path, KEYS, years).collect()} == {2020}
    want = frame.filter("NOT (year(date) = 2020 AND grid = 'a')").unionByName(later)
    same(rows, monthly_from_partials(kept(spark, path, frame), KEYS, True), monthly_mean(want, KEYS, True))


def test_products_from_kept_sums(spark, tmp_path, rows):
    """The aggregate job's monthly product is the same with kept sums, also when a year is opened again."""
    config = DatasetConfig.of({"ds_name": "D", "start": "20190101T00:00:00Z", "end": "20201231T00:00:00Z", "t_version": 1.0, "a_version": "1.0",
                               "do_monthly_aggregation": True, "skipna_in_mean": False, "fields": [{"name": "h", "units": "m"}]})
    cells = spark.createDataFrame([(g, c) for g in "ab" for c in range(6)], "grid string, cell_id bigint")
    for step in (1, 2):
        series = spark.createDataFrame(daily(step), KIND).filter("field = 'h' AND grid < 'c'").withColumn("ds", F.lit("D"))
        for kind, more in (("plain", {}), ("kept", {"partials_path": str(tmp_path / "partials")})):
            aggregate.write_products(series, cells, config, str(tmp_path / f"{kind}-d"), str(tmp_path / f"{kind}-m"), str(tmp_path / f"{kind}-s{step}"), **more)
        plain, kept_ = (spark.read.parquet(str(tmp_path / f"{kind}-m")) for kind in ("plain", "kept"))
        assert plain.count() == kept_.count() > 0
        same(rows, kept_, plain)
