"""Work plans and their bookkeeping."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.operators import planning as ops
from tidegrid.operators import state
from tidegrid.workload.registry import Views, query, ts_text
from tidegrid.workload.sqltext import TS, sql

_REMOTE = ["ds", "filename", "mod_time", "o_orderkey"]


def _known(v: Views):
    """Granule state: what is still open has not been harvested."""
    return v.granule.filter(F.col("o_orderstatus") != "O")


@query("harvest_plan", sql("b_granule", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'new' WHEN NOT success THEN 'failed before' ELSE 'stale' END AS reason
    FROM b_granule WHERE o_orderstatus = 'O' OR NOT success OR download_time < mod_time"""))
def harvest_plan(v: Views):
    """Listed files that are new, failed, or were published again."""
    return ops.needs_harvest(v.granule.select(*_REMOTE), _known(v)).select("o_orderkey", "reason")


@query("harvest_plan_by_day", sql("b_granule", """
    SELECT o_orderkey FROM b_granule
    WHERE o_orderstatus = 'O' OR NOT success OR CAST(download_time AS DATE) < CAST(mod_time + INTERVAL 6 HOUR AS DATE)"""))
def harvest_plan_by_day(v: Views):
    """The same with dates compared by day."""
    remote = v.granule.select(*_REMOTE).withColumn("mod_time", F.col("mod_time") + F.make_interval(hours=F.lit(6)))
    return ops.needs_harvest(remote, _known(v), compare="date").select("o_orderkey")


@query("download_plan", sql("b_granule", """
    SELECT o_orderkey FROM b_granule WHERE path = '' OR NOT success OR download_time <= mod_time"""))
def download_plan(v: Views):
    """Files absent locally or not newer than published."""
    files = v.granule.filter("success AND path <> ''").select("filename", F.col("download_time").alias("mtime"))
    return ops.needs_download(v.granule.select(*_REMOTE), files).select("o_orderkey")


def _gran(v: Views):
    return v.granule.filter("success").select(
        "ds", F.col("short").alias("filename"), "date", "hemi", "path", "checksum", "size", F.col("download_time").alias("source_mtime"))


def _targets(v: Views):
    """Grids and fields every dataset maps to."""
    grids = v.config.select("ds", F.explode(F.array(F.lit("A"), F.lit("N"), F.lit("R"))).alias("grid"))
    fields = v.config.select("ds", F.explode(F.array(F.lit("F"), F.lit("O"))).alias("field"))
    return ops.tx_targets(fields, grids)


_TX_WANT = """want AS (
    SELECT g.ds, g.short AS filename, x.grid, f.field, g.checksum, g.path, g.size, g.download_time AS source_mtime, c.t_version
    FROM b_granule g JOIN b_cfg c USING (ds), (VALUES ('A'), ('N'), ('R')) x(grid), (VALUES ('F'), ('O')) f(field) WHERE g.success),
  plan AS (SELECT w.*, t.id AS tx_id, CASE WHEN t.id IS NULL THEN 'no state' WHEN NOT t.success THEN 'failed before'
        WHEN t.version <> w.t_version THEN 'version changed' WHEN t.origin_checksum <> w.checksum THEN 'source changed' END AS reason
    FROM want w LEFT JOIN b_tx t USING (ds, filename, grid, field))"""


def _tx_plan(v: Views):
    return ops.tx_plan(_gran(v), _targets(v), v.tx, v.config.select("ds", "t_version"))


@query("tx_plan", sql("b_granule b_tx b_cfg", f"""
    WITH {_TX_WANT} SELECT filename, grid, field, reason FROM plan"""))
def tx_plan(v: Views):
    """Every granule, grid and field with why it needs work."""
    return _tx_plan(v).select("filename", "grid", "field", "reason")


def _outputs(v: Views):
    """Transformed files on disk, dated by the line items of the next grid."""
    return v.tx.select(
        "ds", "filename", "grid", "field", (F.col("date") + F.make_interval(days=F.lit(30))).alias("output_mtime"),
        F.col("version").alias("output_version"))


_FS = """, fs AS (
    SELECT p.*, t.date + INTERVAL 30 DAY AS output_mtime,
           coalesce(t.date + INTERVAL 30 DAY > p.source_mtime AND t.version = p.t_version, FALSE) AS current
    FROM plan2 p LEFT JOIN b_tx t USING (ds, filename, grid, field))"""
# state lost for grid R: its rows must be settled by the files
_LOST = _TX_WANT.replace("LEFT JOIN b_tx t", "LEFT JOIN (SELECT * FROM b_tx WHERE grid <> 'R') t").replace("plan AS", "plan2 AS")


def _checked(v: Views):
    lost = v.tx.filter(F.col("grid") != "R")
    plan = ops.tx_plan(_gran(v), _targets(v), lost, v.config.select("ds", "t_version"))
    return ops.output_is_current(plan, _outputs(v))


@query("tx_fs_fallback", sql("b_granule b_tx b_cfg", f"""
    WITH {_LOST} {_FS} SELECT filename, grid, field, reason FROM fs WHERE reason IS NOT NULL AND NOT (reason = 'no state' AND current)"""))
def tx_fs_fallback(v: Views):
    """Combinations without state are skipped only when a current output exists."""
    return ops.work_items(_checked(v)).select("filename", "grid", "field", "reason")


@query("rebuild_state", sql("b_granule b_tx b_cfg", f"""
    WITH {_LOST} {_FS} SELECT filename, grid, field, md5(concat_ws('|', ds, filename, grid, field)) AS id, {TS.format('output_mtime')} AS completed,
        grid || '_' || field || '_' || replace(filename, '.nc', '') || '.nc' AS output_name, t_version AS version
    FROM fs WHERE reason = 'no state' AND current"""))
def rebuild_state(v: Views):
    """State rows rebuilt from current outputs."""
    return ops.rebuilt_tx_rows(_checked(v)).select(
        "filename", "grid", "field", "id", ts_text("completed").alias("completed"), "output_name", "version")


@query("triage", sql("b_granule", """
    SELECT o_orderkey, CASE WHEN path = '' THEN 'Granule not harvested properly: no source file path recorded.'
        WHEN size < 100 THEN 'Granule not harvested properly: source file missing or too small (' || size || ' bytes).' END AS problem FROM b_granule"""))
def triage(v: Views):
    """Granules that cannot be processed, with the reason."""
    return ops.triage(v.granule).select("o_orderkey", "problem")


@query("id_reuse", sql("b_granule b_tx b_cfg", f"""
    WITH {_TX_WANT} SELECT filename, grid, field, coalesce(tx_id, md5(concat_ws('|', ds, filename, grid, field))) AS id, tx_id IS NOT NULL AS reused FROM plan"""))
def id_reuse(v: Views):
    """Existing ids are kept, new ones derive from the key."""
    return ops.with_ids(_tx_plan(v), v.tx, ops.TX_KEY).select("filename", "grid", "field", "id", "reused")


_NOW = "CAST('2002-01-01' AS TIMESTAMP)"


@query("prepopulate", sql("b_granule b_tx b_cfg", f"""
    WITH {_TX_WANT} SELECT filename, grid, field, coalesce(tx_id, md5(concat_ws('|', ds, filename, grid, field))) AS id, TRUE AS in_progress,
        FALSE AS success, checksum AS origin_checksum, '{state.IN_PROGRESS_MESSAGE}' AS message
    FROM plan WHERE reason IS NOT NULL AND path <> '' AND size >= 100"""))
def prepopulate(v: Views):
    """Rows written before work starts."""
    planned = ops.with_ids(ops.triage(_tx_plan(v).filter("reason IS NOT NULL")), v.tx, ops.TX_KEY)
    rows = state.in_progress_rows(planned.filter("problem IS NULL"), F.lit("2002-01-01").cast("timestamp"))
    return rows.select("filename", "grid", "field", "id", "in_progress", "success", "origin_checksum", "message")


@query("unprocessable", sql("b_granule b_tx b_cfg", f"""
    WITH {_TX_WANT} SELECT filename, grid, field, FALSE AS success, CASE WHEN path = '' THEN 'Granule not harvested properly: no source file path recorded.'
        ELSE 'Granule not harvested properly: source file missing or too small (' || size || ' bytes).' END AS message, {TS.format(_NOW)} AS completed
    FROM plan WHERE reason IS NOT NULL AND (path = '' OR size < 100)"""))
def unprocessable(v: Views):
    """Failed rows for granules that cannot be processed."""
    planned = ops.with_ids(ops.triage(_tx_plan(v).filter("reason IS NOT NULL")), v.tx, ops.TX_KEY)
    rows = state.unprocessable_rows(planned, F.lit("2002-01-01").cast("timestamp"))
    return rows.select("filename", "grid", "field", "success", "message", ts_text("completed").alias("completed"))


_AGG_PLAN = """done AS (SELECT ds, grid, field, CAST(year(date) AS INTEGER) AS year, max(completed) AS last_completed, count(*) AS n_tx
        FROM b_tx WHERE success GROUP BY ALL),
    aplan AS (SELECT d.*, a.agg_time, CASE WHEN a.agg_time IS NULL THEN 'no state' WHEN d.last_completed > a.agg_time THEN 'newer transformation' END AS reason
        FROM done d LEFT JOIN (SELECT * FROM b_agg WHERE success) a USING (ds, grid, field, year))"""


@query("agg_plan", sql("b_tx b_agg", f"WITH {_AGG_PLAN} SELECT ds, grid, field, year, n_tx, reason FROM aplan"))
def agg_plan(v: Views):
    """Years to aggregate, with the reason."""
    return ops.agg_plan(v.tx, v.agg).select("ds", "grid", "field", "year", "n_tx", "reason")


@query("agg_plan_all_years", sql("b_agg b_cfg", """
    SELECT a.ds, x.grid, f.field, CAST(unnest(range(y0, y1 + 1)) AS INTEGER) AS year
    FROM (SELECT ds, min(version) AS version, min(year) AS y0, max(year) AS y1 FROM b_agg GROUP BY ds) a JOIN b_cfg c USING (ds),
         (VALUES ('A'), ('N'), ('R')) x(grid), (VALUES ('F'), ('O')) f(field) WHERE a.version <> c.a_version"""))
def agg_plan_all_years(v: Views):
    """A changed aggregation version brings every year."""
    datasets = v.agg.groupBy("ds").agg(
        F.min("version").alias("aggregation_version"), F.make_date(F.min("year"), F.lit(1), F.lit(1)).alias("start_date"),
        F.make_date(F.max("year"), F.lit(12), F.lit(31)).alias("end_date"))
    return ops.agg_plan_all_years(_targets(v), datasets, v.config.select("ds", "a_version"))


def _agg_check(v: Views):
    tx = v.tx.withColumn("output_path", F.concat_ws("/", "ds", "grid", "field", "filename"))
    files = tx.filter("version = 1 OR year(date) > 1996").select("output_path", F.col("completed").alias("mtime"))
    products = v.tx.groupBy("ds", "grid", "field", F.year("date").cast("int").alias("year")).agg(
        (F.max("date") + F.make_interval(days=F.lit(5))).alias("product_mtime"))
    return ops.agg_output_check(ops.agg_plan(v.tx, v.agg), tx, files, products)


_AGG_FS = f"""{_AGG_PLAN}, prod AS (SELECT ds, grid, field, CAST(year(date) AS INTEGER) AS year, max(date) + INTERVAL 5 DAY AS product_mtime FROM b_tx GROUP BY ALL),
    inp AS (SELECT ds, grid, field, CAST(year(date) AS INTEGER) AS year, max(completed) FILTER (version = 1 OR year(date) > 1996) AS last_input,
                   count(*) FILTER (NOT (version = 1 OR year(date) > 1996)) AS n_absent FROM b_tx WHERE success GROUP BY ALL),
    chk AS (SELECT aplan.*, product_mtime, coalesce(n_absent = 0 AND last_input <= product_mtime, FALSE) AS current
            FROM aplan LEFT JOIN prod USING (ds, grid, field, year) LEFT JOIN inp USING (ds, grid, field, year))"""


@query("agg_fs_fallback", sql("b_tx b_agg", f"WITH {_AGG_FS} SELECT ds, grid, field, year, reason, current FROM chk"))
def agg_fs_fallback(v: Views):
    """Years without state are settled by files."""
    return _agg_check(v).select("ds", "grid", "field", "year", "reason", "current")


@query("agg_rebuild_state", sql("b_tx b_agg", f"""
    WITH {_AGG_FS} SELECT ds, grid, field, year, md5(concat_ws('|', ds, grid, field, year)) AS id, {TS.format('product_mtime')} AS agg_time
    FROM chk WHERE reason = 'no state' AND current"""))
def agg_rebuild_state(v: Views):
    """Aggregation rows rebuilt from current products."""
    rows = ops.rebuilt_agg_rows(_agg_check(v), F.lit("2.0"))
    return rows.select("ds", "grid", "field", "year", "id", ts_text("agg_time").alias("agg_time"))


@query("years_with_tx", sql("b_tx", "SELECT DISTINCT ds, grid, field, CAST(year(date) AS INTEGER) AS year FROM b_tx WHERE success"))
def years_with_tx(v: Views):
    """Years that have a successful transformation."""
    return ops.years_with_tx(v.tx)


@query("representative_granule", sql("b_granule", """
    SELECT ds, hemi, filename, checksum FROM b_granule WHERE path <> ''
    QUALIFY row_number() OVER (PARTITION BY ds, hemi ORDER BY filename) = 1"""))
def representative_granule(v: Views):
    """One granule per dataset and hemisphere."""
    return ops.representative(v.granule).select("ds", "hemi", "filename", "checksum")


@query("unknown_grids", sql("", """
    SELECT DISTINCT o_orderstatus AS grid FROM orders WHERE o_orderstatus NOT IN (SELECT l_linestatus FROM lineitem)"""))
def unknown_grids(v: Views):
    """Requested grids that are not registered."""
    wanted = v.orders.select(F.col("o_orderstatus").alias("grid")).distinct()
    return ops.unknown_grids(wanted, v.lineitem.select(F.col("l_linestatus").alias("grid")).distinct())


@query("eligible_grids", sql("", """
    SELECT DISTINCT 'SOSE_' || l_suppkey AS grid FROM lineitem WHERE l_suppkey % 2 = 0"""))
def eligible_grids(v: Views):
    """Polar datasets leave non-polar grids out."""
    name = F.when(F.col("l_suppkey") % 2 == 0, "SOSE_").otherwise("TPOSE_")
    grids = v.lineitem.select(F.concat(name, F.col("l_suppkey").cast("string")).alias("grid")).distinct()
    return ops.eligible_grids(grids, hemispheric=True)


@query("active_only", sql("b_granule b_cfg", "SELECT ds, count(*) AS n FROM b_granule WHERE ds IN (SELECT ds FROM b_cfg WHERE active) GROUP BY ds"))
def active_only(v: Views):
    """Rows of active datasets."""
    return ops.only(v.granule, v.config.filter("active"), "ds").groupBy("ds").agg(F.count(F.lit(1)).alias("n"))


@query("config_match", sql("b_granule", """
    SELECT coalesce(g.ds, c.ds) AS ds, g.ds IS NOT NULL AS on_disk, c.ds IS NOT NULL AS configured
    FROM (SELECT DISTINCT ds FROM b_granule) g FULL JOIN (SELECT 'DS' || c_custkey AS ds FROM customer WHERE c_acctbal > 0) c ON g.ds = c.ds"""))
def config_match(v: Views):
    """Datasets on disk against configurations."""
    cfg = v.table("customer").filter("c_acctbal > 0").select(F.concat(F.lit("DS"), F.col("c_custkey").cast("string")).alias("ds"))
    return ops.config_match(v.granule, cfg)
