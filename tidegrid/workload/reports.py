"""Status, coverage and failure reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.operators import reports as ops
from tidegrid.sources import files as src_files
from tidegrid.workload.registry import Views, query, ts_text
from tidegrid.workload.sqltext import TS, sql


def _datasets(v: Views):
    return v.config.select("ds", "variable")


@query("totals", sql("b_granule b_tx b_agg b_cfg", """
    SELECT 'granules' AS stage, count(*) AS n FROM b_granule WHERE ds IN (SELECT ds FROM b_cfg WHERE active)
    UNION ALL SELECT 'transformations', count(*) FROM b_tx WHERE ds IN (SELECT ds FROM b_cfg WHERE active)
    UNION ALL SELECT 'aggregations', count(*) FROM b_agg WHERE ds IN (SELECT ds FROM b_cfg WHERE active)
    UNION ALL SELECT 'datasets', count(*) FROM b_cfg WHERE active"""))
def totals(v: Views):
    """Rows per stage for active datasets."""
    return ops.totals(v.granule, v.tx, v.agg, v.config, v.config.filter("active"))


_COVERAGE = """SELECT ds, min(date) AS s, max(date) AS e, count(*) AS n FROM b_granule WHERE success AND ds IN (SELECT ds FROM b_cfg WHERE active) GROUP BY ds"""


@query("coverage", sql("b_granule b_cfg", f"SELECT ds, {TS.format('s')} AS start, {TS.format('e')} AS \"end\", n FROM ({_COVERAGE})"))
def coverage(v: Views):
    """First, last and number of usable granules."""
    out = ops.coverage(v.granule, v.config.filter("active"))
    return out.select("ds", ts_text("start").alias("start"), ts_text("end").alias("end"), "n")


@query("coverage_left", sql("b_granule b_cfg", f"""
    SELECT ds, variable, {TS.format('s')} AS start, n, has_data,
           CAST(row_number() OVER (PARTITION BY variable ORDER BY has_data DESC, s NULLS LAST, ds) AS INTEGER) AS position
    FROM (SELECT c.ds, CASE WHEN variable = '' THEN 'unassigned' ELSE variable END AS variable, s, coalesce(n, 0) AS n, s IS NOT NULL AS has_data
          FROM b_cfg c LEFT JOIN ({_COVERAGE}) x USING (ds))"""))
def coverage_left(v: Views):
    """All datasets in display order, those without data included."""
    out = ops.coverage_timeline(_datasets(v), ops.coverage(v.granule, v.config.filter("active")))
    return out.select("ds", "variable", ts_text("start").alias("start"), "n", "has_data", "position")


@query("daily_outcomes", sql("b_granule", """
    SELECT ds, CAST(CAST(date AS DATE) AS VARCHAR) AS day, success, count(*) AS n, CASE WHEN success THEN 'Success' ELSE 'Failed' END AS status
    FROM b_granule GROUP BY ALL"""))
def daily_outcomes(v: Views):
    """Granules per date and outcome."""
    return ops.daily_outcomes(v.granule).withColumn("day", F.col("day").cast("string"))


def _panel(table: str) -> str:
    return f"""SELECT ds, count(*) AS total, count(*) FILTER (success) AS successful, count(*) FILTER (NOT success) AS failed,
        round(count(*) FILTER (success) * 100.0::DOUBLE / count(*), 1) AS rate, CAST(CAST(max(date) FILTER (success) AS DATE) AS VARCHAR) AS latest FROM {table} GROUP BY ds"""


@query("panel_metrics", sql("b_granule", _panel("b_granule")))
def panel_metrics(v: Views):
    """Totals, rate and latest date per dataset, harvest."""
    return ops.panel_metrics(v.granule).withColumn("latest", F.col("latest").cast("string"))


@query("panel_metrics_tx", sql("b_tx", _panel("b_tx")))
def panel_metrics_tx(v: Views):
    """The same for transformations."""
    return ops.panel_metrics(v.tx).withColumn("latest", F.col("latest").cast("string"))


_RATE = "round(count(*) FILTER ({}) * 100.0::DOUBLE / nullif(count(*) FILTER ({}), 0), 1)"


@query("success_pivot", sql("b_tx", f"""
    SELECT grid, {_RATE.format("success AND field = 'F'", "field = 'F'")} AS "F", {_RATE.format("success AND field = 'O'", "field = 'O'")} AS "O" FROM b_tx GROUP BY grid"""))
def success_pivot(v: Views):
    """Success rate per grid with one column per field."""
    return ops.success_pivot(v.tx, ["F", "O"])


@query("success_rates", sql("b_tx", """
    SELECT grid, field, round(count(*) FILTER (success) * 100.0::DOUBLE / count(*), 1) AS rate FROM b_tx GROUP BY ALL"""))
def success_rates(v: Views):
    """Success rate per grid and field."""
    return ops.success_rates(v.tx)


def _holed(v: Views):
    """Aggregation state in which failed years of one field are absent."""
    return v.agg.filter("success OR field = 'F'")


@query("coverage_strip", sql("b_agg", """
    WITH a AS (SELECT * FROM b_agg WHERE success OR field = 'F'),
      spine AS (SELECT ds, grid, field, unnest(range(y0, y1 + 1)) AS year FROM (SELECT DISTINCT ds, grid, field FROM a) JOIN (SELECT ds, min(year) AS y0, max(year) AS y1 FROM a GROUP BY ds) USING (ds))
    SELECT ds, grid, field, CAST(year AS INTEGER) AS year, CASE WHEN success IS NULL THEN 'no aggregation' WHEN success THEN 'success' ELSE 'failed' END AS status
    FROM spine LEFT JOIN a USING (ds, grid, field, year)"""))
def coverage_strip(v: Views):
    """One cell per year: success, failed or none."""
    return ops.coverage_strip(_holed(v))


@query("last_write_wins", sql("b_tx", """
    SELECT ds, grid, field, year, CASE WHEN success THEN 'success' ELSE 'failed' END AS status
    FROM (SELECT ds, grid, field, CAST(year(date) AS INTEGER) AS year, success FROM b_tx
          QUALIFY row_number() OVER (PARTITION BY ds, grid, field, year(date) ORDER BY completed DESC, id DESC) = 1)"""))
def last_write_wins(v: Views):
    """Of several rows per year the last one decides."""
    rows = v.tx.select("ds", "grid", "field", F.year("date").cast("int").alias("year"), "success", F.struct("completed", "id").alias("agg_time"))
    return ops.coverage_strip(rows).filter("status <> 'no aggregation'")


@query("gf_summary", sql("b_agg", f"""
    SELECT ds, grid, field, min(year) AS first_year, max(year) AS last_year, count(DISTINCT year) AS years, count(*) FILTER (success) AS successful,
           count(*) FILTER (NOT success) AS failed, {TS.format('max(agg_time)')} AS last_run FROM b_agg GROUP BY ALL"""))
def gf_summary(v: Views):
    """Span, years, successes and failures per grid and field."""
    return ops.gf_summary(v.agg).withColumn("last_run", ts_text("last_run"))


_STAGED = """staged AS (
    SELECT 'Harvest' AS stage, ds, strftime(date, '%Y-%m-%d') AS date, filename AS detail, success, message FROM b_granule
    UNION ALL SELECT 'Transform', ds, strftime(date, '%Y-%m-%d'), grid || ' / ' || field, success, message FROM b_tx
    UNION ALL SELECT 'Aggregate', ds, CAST(year AS VARCHAR), grid || ' / ' || field, success, message FROM b_agg)"""


@query("failures", sql("b_granule b_tx b_agg", f"WITH {_STAGED} SELECT stage, ds, date, detail, message AS error FROM staged WHERE NOT success"))
def failures(v: Views):
    """Failed rows of all stages in one shape."""
    return ops.failures(v.granule, v.tx, v.agg)


@query("warnings", sql("b_granule b_tx b_agg", f"WITH {_STAGED} SELECT stage, ds, date, detail, message FROM staged WHERE success AND message <> ''"))
def warnings(v: Views):
    """Successful rows that carry a message."""
    return ops.warnings(v.granule, v.tx, v.agg)


@query("error_rollup", sql("b_granule b_tx b_agg", f"""
    WITH {_STAGED} SELECT CASE WHEN message = '' THEN '(no message)' ELSE message END AS error, count(*) AS n,
        string_agg(DISTINCT stage, ', ' ORDER BY stage) AS stages, string_agg(DISTINCT ds, ', ' ORDER BY ds) AS datasets FROM staged WHERE NOT success GROUP BY ALL"""))
def error_rollup(v: Views):
    """Failures grouped by message."""
    return ops.error_rollup(ops.failures(v.granule, v.tx, v.agg))


@query("activity_summary", sql("b_granule b_tx b_agg", f"""
    WITH {_STAGED} SELECT ds, count(*) FILTER (stage = 'Harvest') AS granules, count(*) FILTER (stage = 'Harvest' AND NOT success) AS harvest_failures,
        count(*) FILTER (stage = 'Transform') AS transformations, count(*) FILTER (stage = 'Transform' AND NOT success) AS transform_failures,
        count(*) FILTER (stage = 'Aggregate') AS aggregations, count(*) FILTER (stage = 'Aggregate' AND NOT success) AS agg_failures FROM staged GROUP BY ds"""))
def activity_summary(v: Views):
    """Totals and failures of the three stages per dataset."""
    return ops.activity_summary(v.granule, v.tx, v.agg)


@query("dataset_names", sql("b_granule b_tx b_agg", "SELECT ds FROM b_granule UNION SELECT ds FROM b_tx UNION SELECT ds FROM b_agg"))
def dataset_names(v: Views):
    """Datasets seen in any stage."""
    return ops.dataset_names(v.granule, v.tx, v.agg)


@query("product_report", sql("b_tx", """
    SELECT ds, grid, field, time_scale, count(*) AS files, min(year) AS first_year, max(year) AS last_year
    FROM (SELECT DISTINCT ds, grid, field, CAST(year(date) AS INTEGER) AS year, x.s AS time_scale FROM b_tx, (VALUES ('DAILY'), ('MONTHLY')) x(s)) GROUP BY ALL"""))
def product_report(v: Views):
    """Product files per dataset, grid, field and scale, from their paths."""
    years = v.tx.select("ds", "grid", "field", F.year("date").cast("string").alias("y"), F.explode(F.array(F.lit("DAILY"), F.lit("MONTHLY"))).alias("s")).distinct()
    path = F.concat(
        F.lit("/obs/"), "ds", F.lit("/transformed_products/"), "grid", F.lit("/aggregated/"), "field", F.lit("/netCDF/"),
        F.concat_ws("_", "ds", "grid", "s", "field", "y"), F.lit(".nc"))
    stray = path.alias("path"), F.concat(path, F.lit(".tmp")).alias("tmp")
    files = years.select(*stray).select(F.explode(F.array("path", "tmp")).alias("path"))
    return ops.product_report(src_files.product_inventory(files))


@query("dataset_status", sql("", """
    SELECT 'C' || c_custkey AS ds, CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE '—' END AS harvest_status, '—' AS transformation_status,
           c_name AS aggregation_status, '2000-01-01 00:00:00' AS last_checked, '—' AS last_transformation, '—' AS last_aggregation FROM customer"""))
def dataset_status(v: Views):
    """Status strip of every dataset; blanks show a dash."""
    none = F.lit(None).cast("timestamp")
    rows = v.table("customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ds"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).otherwise("  ").alias("harvest_status"),
        F.lit(None).cast("string").alias("transformation_status"), F.col("c_name").alias("aggregation_status"),
        F.lit("2000-01-01").cast("timestamp").alias("last_checked"), none.alias("last_transformation"), none.alias("last_aggregation"))
    return ops.dataset_strip(rows)


@query("failure_detail", sql("b_tx", "SELECT CAST(CAST(date AS DATE) AS VARCHAR) AS \"Date\", grid AS \"Grid\", field AS \"Field\", message AS \"Error\" FROM b_tx WHERE NOT success"))
def failure_detail(v: Views):
    """Failed transformations under display names."""
    rows = v.tx.withColumn("day", F.col("date").cast("date").cast("string"))
    return ops.detail_table(rows, {"day": "Date", "grid": "Grid", "field": "Field", "message": "Error"})


@query("warning_detail", sql("b_tx", "SELECT id AS \"Id\", message AS \"Message\" FROM b_tx WHERE success AND message <> ''"))
def warning_detail(v: Views):
    """Transformations with a warning under display names."""
    return ops.detail_table(v.tx, {"id": "Id", "message": "Message"}, warnings_only=True)
