"""Hemisphere merge, gaps, densified series, monthly means, products."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.operators import temporal as ops
from tidegrid.operators.planning import AGG_KEY
from tidegrid.schemas import AGGREGATION, TRANSFORMATION, DatasetConfig, FieldConfig
from tidegrid.session import shared_dir
from tidegrid.plans import aggregate
from tidegrid.sinks.partials import monthly_from_partials, stored_partials, update_partials
from tidegrid.sinks.products import write_regridded
from tidegrid.sinks.provenance import read_lineage
from tidegrid.sinks.store import StateStore
from tidegrid.sizing import materialize
from tidegrid.workload.registry import Views, query, ts_text
from tidegrid.workload.sqltext import TS, sql


def _day_text(df, *cols):
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


@query("hemi_merge", sql("b_series", "SELECT field, CAST(date AS VARCHAR) AS date, cell_id, value FROM b_series"))
def hemi_merge(v: Views):
    """First non-missing hemisphere per cell and date."""
    return _day_text(v.series, "date")


@query("hemi_merge_all", sql("b_val", """
    SELECT event_type AS field, user_id AS cell_id, arg_min(value, event_id) FILTER (value IS NOT NULL) AS value, count(*) AS n_overlaps
    FROM b_val GROUP BY ALL"""))
def hemi_merge_all(v: Views):
    """Any number of overlapping records, in a given order."""
    rows = v.value_events.select(F.col("event_type").alias("field"), F.col("user_id").alias("cell_id"), "value", "event_id")
    merged = ops.hemi_merge(rows, ["field"], [F.col("event_id")])
    n = rows.groupBy("field", "cell_id").agg(F.count(F.lit(1)).alias("n_overlaps"))
    return merged.join(n, ["field", "cell_id"])


@query("missing_days", sql("", """
    WITH have AS (SELECT o_orderstatus AS field, o_custkey % 50 AS grp, CAST(o_orderdate AS DATE) AS d FROM orders GROUP BY ALL),
         spine AS (SELECT field, grp, y, CAST(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
                   FROM (SELECT DISTINCT field, grp, year(d) AS y FROM have))
    SELECT field, grp, CAST(y AS INTEGER) AS year, CAST(d AS VARCHAR) AS date FROM spine ANTI JOIN have USING (field, grp, d)"""))
def missing_days(v: Views):
    """Days of each year without a record."""
    rows = v.orders.select(F.col("o_orderstatus").alias("field"), (F.col("o_custkey") % 50).alias("grp"), F.col("o_orderdate").alias("date"))
    return _day_text(ops.missing_days(rows, ["field", "grp"]), "date")


@query("missing_months", sql("", """
    WITH have AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders),
         spine AS (SELECT o_custkey, y, make_date(y, m, 1) AS month
                   FROM (SELECT DISTINCT o_custkey, year(d) AS y FROM have), (SELECT unnest(range(1, 13)) AS m))
    SELECT s.o_custkey, CAST(y AS INTEGER) AS year, CAST(month AS VARCHAR) AS date FROM spine s
    WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.o_custkey = s.o_custkey AND year(h.d) = s.y AND abs(date_diff('day', h.d, s.month)) <= 7)"""))
def missing_months(v: Views):
    """Months with no record within a week of the first."""
    rows = v.orders.select("o_custkey", F.col("o_orderdate").alias("date"))
    return _day_text(ops.missing_months(rows, ["o_custkey"]), "date")


@query("date_difference", sql("", """
    SELECT CAST(d AS VARCHAR) AS date FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem EXCEPT SELECT CAST(o_orderdate AS DATE) FROM orders)"""))
def date_difference(v: Views):
    """Ship dates that are not order dates."""
    day = lambda c: F.col(c).cast("date").alias("date")
    return _day_text(ops.date_difference(v.lineitem.select(day("l_shipdate")), v.orders.select(day("o_orderdate"))), "date")


@query("densify_days", sql("b_series", f"""
    WITH cells AS (SELECT DISTINCT cell_id FROM b_series),
         gaps AS (SELECT field, CAST(d AS DATE) AS date FROM (SELECT DISTINCT field FROM b_series),
                  (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-12-31', INTERVAL 1 DAY)) AS d) ANTI JOIN b_series ON b_series.date = CAST(d AS DATE)),
         al AS (SELECT field, date, cell_id, value FROM b_series UNION ALL SELECT field, date, cell_id, NULL FROM gaps, cells)
    SELECT field, strftime(date, '%Y-%m') AS ym, cell_id, count(*) AS n_days, count(value) AS n_valid,
           {TS.format('max(CAST(date AS TIMESTAMP)) + INTERVAL 12 HOUR')} AS last_center FROM al GROUP BY ALL"""))
def densify_days(v: Views):
    """Missing days appended as empty records on every cell."""
    dates = v.series.select("field", "date").distinct()
    cells = v.series.select("cell_id").distinct()
    gaps = ops.missing_days(dates, ["field"]).drop("year")
    grid = F.lit("users").alias("grid")
    full = ops.densify(v.series, gaps.select("*", grid), cells.select("*", grid), ["field"])
    return full.groupBy("field", F.date_format("date", "yyyy-MM").alias("ym"), "cell_id").agg(
        F.count(F.lit(1)).alias("n_days"), F.count("value").alias("n_valid"), ts_text(F.max("time")).alias("last_center"))


@query("drop_empty_days", sql("b_series", """
    WITH s AS (SELECT field, date, cell_id, CASE WHEN day(date) % 5 <> 0 THEN value END AS value FROM b_series)
    SELECT field, CAST(date AS VARCHAR) AS date, cell_id, value FROM s
    WHERE (field, date) IN (SELECT (field, date) FROM s WHERE value IS NOT NULL)"""))
def drop_empty_days(v: Views):
    """Days on which no cell has a value are removed."""
    s = v.series.withColumn("value", F.when(F.day("date") % 5 != 0, F.col("value")))
    return _day_text(ops.drop_empty_days(s, ["field"]), "date").select("field", "date", "cell_id", "value")


# lineitem as a daily series on a handful of cells: several years, gaps, missing values
_DAILY = """(SELECT l_returnflag AS field, l_suppkey % 4 AS cell_id, CAST(l_shipdate AS DATE) AS date,
    CASE WHEN min(l_discount) >= 0.01 OR day(CAST(l_shipdate AS DATE)) % 6 <> 0 THEN sum(l_quantity) END AS value
    FROM lineitem GROUP BY l_returnflag, l_suppkey % 4, CAST(l_shipdate AS DATE))"""


def _daily(v: Views):
    rows = v.lineitem.groupBy(
        F.col("l_returnflag").alias("field"), (F.col("l_suppkey") % 4).alias("cell_id"), F.col("l_shipdate").cast("date").alias("date")
    ).agg(F.min("l_discount").alias("lo"), F.sum("l_quantity").alias("q"))
    return rows.select("field", "cell_id", "date", F.when((F.col("lo") >= 0.01) | (F.day("date") % 6 != 0), F.col("q")).alias("value"))


def _monthly_sql(condition: str) -> str:
    return sql("", f"""
        WITH s AS {_DAILY},
             need AS (SELECT field, year(date) AS y, month(date) AS m, count(DISTINCT date) AS need FROM s WHERE value IS NOT NULL GROUP BY ALL),
             per AS (SELECT field, cell_id, year(date) AS y, month(date) AS m, count(value) AS n, sum(value) AS t FROM s GROUP BY ALL),
             spine AS (SELECT field, cell_id, y, m FROM (SELECT DISTINCT field, cell_id, year(date) AS y FROM s), (SELECT unnest(range(1, 13)) AS m))
        SELECT field, cell_id, CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month,
               round(CASE WHEN n > 0 AND {condition} THEN t / n END, 8) AS value,
               {TS.format('CAST(make_date(y, m, 1) AS TIMESTAMP)')} AS time_start,
               {TS.format("CAST(make_date(y, m, 1) AS TIMESTAMP) + INTERVAL 1 MONTH")} AS time_end
        FROM spine LEFT JOIN per USING (field, cell_id, y, m) LEFT JOIN need USING (field, y, m)""")


def _monthly(v: Views, skipna: bool, drop_empty: bool):
    out = ops.monthly_mean(_daily(v), ["field"], skipna=skipna, drop_empty=drop_empty)
    return out.select(
        "field", "cell_id", "year", "month", F.round("value", 8).alias("value"),
        ts_text("time_start").alias("time_start"), ts_text("time_end").alias("time_end"))


@query("monthly_mean_skipna", _monthly_sql("TRUE"))
def monthly_mean_skipna(v: Views):
    """Missing days are left out of the mean."""
    return _monthly(v, True, True)


@query("monthly_mean_strict", _monthly_sql("n = day(last_day(make_date(y, m, 1)))"))
def monthly_mean_strict(v: Views):
    """One missing day voids the month."""
    return _monthly(v, False, False)


@query("monthly_mean_strict_dropped", _monthly_sql("n = need"))
def monthly_mean_strict_dropped(v: Views):
    """One missing day voids the month, days empty everywhere aside."""
    return _monthly(v, False, True)


@query("monthly_mean_kept", _monthly_sql("n = need"))
def monthly_mean_kept(v: Views):
    """Means from kept sums: stored for an older state of the series, then only the changed months again."""
    series = materialize(_daily(v), shared_dir(v.spark, "series"))
    late = (F.month("date") == 3) & (F.day("date") > 20)
    path = shared_dir(v.spark, "partials")
    for rows in (series.filter(~late), series):
        update_partials(rows, path, ["field"])
    kept = stored_partials(v.spark, path, [series.schema["field"]], series.schema["cell_id"])
    out = monthly_from_partials(kept, ["field"])
    return out.select(
        "field", "cell_id", "year", "month", F.round("value", 8).alias("value"),
        ts_text("time_start").alias("time_start"), ts_text("time_end").alias("time_end"))


@query("monthly_mean_events", sql("b_series", """
    WITH c AS (SELECT DISTINCT field, year(date) AS y, cell_id FROM b_series),
    s AS (SELECT field, year(date) AS y, month(date) AS m, cell_id, round(avg(value), 8) AS value FROM b_series GROUP BY ALL)
    SELECT field, CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month, cell_id, value
    FROM c CROSS JOIN (SELECT unnest(range(1, 13)) AS m) LEFT JOIN s USING (field, y, m, cell_id)"""))
def monthly_mean_events(v: Views):
    """Monthly means of the merged records, all twelve months."""
    out = ops.monthly_mean(v.series, ["field"], skipna=True)
    return out.select("field", "year", "month", "cell_id", F.round("value", 8).alias("value"))


@query("year_minmax", sql("", f"""
    SELECT field, CAST(year(date) AS INTEGER) AS year, round(min(value), 6) AS valid_min, round(max(value), 6) AS valid_max,
           count(value) AS n_valid, count(value) > 0 AS has_data FROM {_DAILY} GROUP BY ALL"""))
def year_minmax(v: Views):
    """Valid range of each year."""
    out = ops.year_stats(_daily(v), ["field"])
    return out.withColumns({c: F.round(c, 6) for c in ("valid_min", "valid_max")})


@query("year_empty", sql("", f"""
    WITH s AS (SELECT field, cell_id, date, CASE WHEN year(date) <> 1997 THEN value END AS value FROM {_DAILY})
    SELECT field, CAST(year(date) AS INTEGER) AS year, count(*) AS n FROM s WHERE year(date) <> 1997 GROUP BY ALL"""))
def year_empty(v: Views):
    """Years without any value are not saved."""
    s = _daily(v).withColumn("value", F.when(F.year("date") != 1997, F.col("value")))
    return ops.savable(s, ["field"]).groupBy("field", "year").agg(F.count(F.lit(1)).alias("n"))


@query("time_coverage", sql("", f"""
    SELECT field, {TS.format('CAST(min(date) AS TIMESTAMP)')} AS coverage_start, {TS.format('max(date) + INTERVAL 1 DAY')} AS coverage_end, 'P1D' AS resolution
    FROM {_DAILY} GROUP BY field"""))
def time_coverage(v: Views):
    """First window start and last window end."""
    s = _daily(v).select("field", F.col("date").cast("timestamp").alias("time_start"), F.date_add("date", 1).cast("timestamp").alias("time_end"))
    out = ops.time_coverage(s, ["field"], "P1D")
    return out.select("field", ts_text("coverage_start").alias("coverage_start"), ts_text("coverage_end").alias("coverage_end"), "resolution")


_CONFIG = DatasetConfig(ds="DS0", start="20240101T00:00:00Z", end="NOW", fields=(FieldConfig("value"),), skipna=True, do_monthly=True)


@query("product_write", sql("b_series", """
    SELECT field, year, count(*) AS n, count(value) AS n_valid, round(sum(value), 6) AS total
    FROM (SELECT field, CAST(year(date) AS INTEGER) AS year, value FROM b_series) GROUP BY ALL"""))
def product_write(v: Views):
    """Records written by folder and read back."""
    path = shared_dir(v.spark, "regridded")
    write_regridded(v.series.withColumns({"ds": F.lit("DS0"), "grid": F.lit("g1")}), path)
    back = v.spark.read.parquet(path)
    return back.groupBy("field", "year").agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("n_valid"), F.round(F.sum("value"), 6).alias("total"))


@query("annual_products", sql("b_series", """
    SELECT field, 'daily' AS scale, 366 * c - 30 * c + n AS n, nv AS n_valid FROM
        (SELECT field, count(*) AS n, count(value) AS nv FROM b_series GROUP BY field),
        (SELECT count(DISTINCT cell_id) AS c FROM b_series)
    UNION ALL
    SELECT field, 'monthly', 12 * count(DISTINCT cell_id), count(DISTINCT cell_id) FILTER (value IS NOT NULL) FROM b_series GROUP BY field"""))
def annual_products(v: Views):
    """The whole aggregation job: merge, densify, monthly means, write, read back."""
    rows = v.rec.withColumns({"ds": F.lit("DS0"), "grid": F.lit("g1"), "filename": F.lit("f")})
    cells = v.rec.select(F.lit("g1").alias("grid"), "cell_id").distinct()
    root = shared_dir(v.spark, "products")
    daily, monthly = f"{root}/daily", f"{root}/monthly"
    aggregate.write_products(aggregate.merged_series(rows), cells, _CONFIG, daily, monthly, f"{root}/staging")
    sides = [v.spark.read.parquet(p).select("field", F.lit(n).alias("scale"), "value") for p, n in ((daily, "daily"), (monthly, "monthly"))]
    return sides[0].unionByName(sides[1]).groupBy("field", "scale").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_valid"))


_AGG_DS = "DS1"
_AGG_CONFIG = DatasetConfig(
    ds=_AGG_DS, start="19920101", end="NOW", a_version="2.0", fields=(FieldConfig("F", units="m"), FieldConfig("O", units="1")), do_monthly=True, skipna=True)
_AGG_CELLS = 3


@query("aggregate_job", sql("b_tx b_agg", f"""
    WITH tx AS (SELECT *, CAST(year(date) AS INTEGER) AS year FROM b_tx WHERE ds = '{_AGG_DS}' AND success),
    ok AS (SELECT * FROM b_agg WHERE ds = '{_AGG_DS}' AND success),
    years AS (SELECT ds, grid, field, year, max(completed) AS last, count(*) AS members FROM tx GROUP BY ALL),
    planned AS (SELECT years.*, agg_time IS NULL AND grid = 'N' AND year % 2 = 0 AS settled, agg_time IS NULL OR last > agg_time AS due FROM years LEFT JOIN ok USING (ds, grid, field, year)),
    todo AS (SELECT * FROM planned WHERE due AND NOT settled),
    v AS (SELECT DISTINCT grid, field, year, CAST(date AS DATE) AS d, c, CASE WHEN (field = 'F' AND year % 5 = 0) OR (day(date) + c) % 4 = 0 THEN NULL ELSE day(date) + c END AS value
        FROM tx JOIN todo USING (ds, grid, field, year), (SELECT unnest(range({_AGG_CELLS})) AS c) WHERE NOT (grid = 'A' AND year = 1993)),
    st AS (SELECT grid, field, year, count(value) AS n_valid, min(value) AS lo, max(value) AS hi FROM v GROUP BY ALL),
    days AS (SELECT grid, field, year, n_valid, lo, hi, CASE WHEN year % 4 = 0 THEN 366 ELSE 365 END AS days FROM st),
    done AS (SELECT grid, field, year, n_valid IS NOT NULL AS success,
        CASE WHEN n_valid IS NULL THEN 'Aggregation failed: no records of this year' ELSE '' END AS message,
        CASE WHEN n_valid = 0 THEN 'Empty year (no data present in grid), not saving to disk.' ELSE '' END AS notes,
        CASE WHEN n_valid > 0 THEN days * {_AGG_CELLS} ELSE 0 END AS n_rows, coalesce(n_valid, 0) AS n_valid, CASE WHEN n_valid > 0 THEN lo END AS lo, CASE WHEN n_valid > 0 THEN hi END AS hi,
        CASE WHEN n_valid > 0 THEN days ELSE 0 END AS packed, CASE WHEN n_valid > 0 THEN year || '-01-01/' || (year + 1) || '-01-01' END AS covered,
        CASE WHEN n_valid IS NOT NULL THEN members ELSE 0 END AS members
        FROM todo LEFT JOIN days USING (grid, field, year))
    SELECT grid, field, year, success, message, notes, CAST(n_rows AS BIGINT) AS n_rows, CAST(n_valid AS BIGINT) AS n_valid, CAST(lo AS DOUBLE) AS valid_min, CAST(hi AS DOUBLE) AS valid_max,
        CAST(packed AS BIGINT) AS packed, covered, CAST(members AS BIGINT) AS members FROM done
    UNION ALL SELECT grid, field, year, TRUE, '', NULL, 0, 0, NULL, NULL, 0, NULL, 0 FROM planned WHERE settled"""))
def aggregate_job(v: Views):
    """The aggregation job from saved state to products, facts, packed records, lineage and recorded outcomes.

    Years of grid N without state and with an even number have a current product and are settled by it;
    records of grid A lack 1993, which fails; field F has no value in every fifth year.
    """
    from tidegrid.sources.state import with_defaults

    root = shared_dir(v.spark, "aggregate-job")
    store = StateStore(v.spark, f"{root}/state")
    own = F.col("ds") == _AGG_DS
    tx = v.tx.filter(own).withColumn("output_path", F.concat(F.lit("/r/"), "id"))
    load = store.transaction()
    load.replace("transformation", with_defaults(tx, TRANSFORMATION))
    load.replace("aggregation", with_defaults(v.agg.filter(own), AGGREGATION))
    load.commit()
    stamp = lambda t: F.lit(t).cast("timestamp")
    good = tx.filter("success").withColumn("year", F.year("date").cast("int"))
    files = good.select("output_path", stamp("2001-01-01").alias("mtime"))
    products = good.filter("grid = 'N' AND year % 2 = 0").select(*AGG_KEY).distinct().withColumn("product_mtime", stamp("2001-06-01"))
    aggregate.rebuild(store, _AGG_CONFIG, files, products)

    value = F.when((F.col("field") == "F") & (F.col("year") % 5 == 0) | ((F.day("date") + F.col("cell_id")) % 4 == 0), None).otherwise(F.day("date") + F.col("cell_id"))
    cell = F.explode(F.sequence(F.lit(0), F.lit(_AGG_CELLS - 1)).cast("array<bigint>"))
    records = good.filter("NOT (grid = 'A' AND year = 1993)").withColumn("cell_id", cell).select(
        "ds", "grid", "field", F.col("date").cast("date").alias("date"), F.lit("").alias("hemi"), "filename", "cell_id", value.cast("double").alias("value"))
    cells = tx.select("grid").distinct().withColumn("cell_id", cell)
    versions = v.spark.createDataFrame([(_AGG_DS, "2.0")], "ds string, a_version string")
    targets = good.select("ds", "grid", "field").distinct()
    todo = aggregate.plan(store, targets, versions)
    paths = {f"{n}_path": f"{root}/{n}" for n in ("facts", "packed", "lineage")}
    aggregate.run(store, records, cells, todo, _AGG_CONFIG, f"{root}/daily", f"{root}/monthly", f"{root}/staging", stamp("2002-01-01"), **paths)

    key = ["grid", "field", "year"]
    count = lambda df, n: df.groupBy(*key).agg(F.count(F.lit(1)).alias(n))
    daily = v.spark.read.parquet(f"{root}/daily").groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_valid"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    facts = v.spark.read.parquet(f"{root}/facts").filter("scale = 'daily'").select(
        *key, "valid_min", "valid_max", F.concat_ws("/", day("coverage_start"), day("coverage_end")).alias("covered"))
    packed = count(v.spark.read.parquet(f"{root}/packed/blocks"), "packed")
    members = count(read_lineage(v.spark, f"{root}/lineage").filter("kind = 'transformation'"), "members")
    out = store.read("aggregation").filter((F.col("agg_time") == stamp("2002-01-01")) | (F.col("agg_time") == stamp("2001-06-01"))).select(*key, "success", "message", "notes")
    for side in (daily, facts, packed, members):
        out = out.join(side, key, "left")
    zero = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("n_rows", "n_valid", "packed", "members")}
    return out.withColumns(zero).select(*key, "success", "message", "notes", "n_rows", "n_valid", "valid_min", "valid_max", "packed", "covered", "members")
