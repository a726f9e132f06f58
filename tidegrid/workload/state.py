"""State scans, writes and stage status."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions import timebounds
from tidegrid.operators import state as ops
from tidegrid.operators import reports
from tidegrid.plans import maintenance
from tidegrid.schemas import AGGREGATION, DOCUMENT_FIELDS, GRANULE, GRID, TRANSFORMATION
from tidegrid.session import shared_dir
from tidegrid.sinks import provenance
from tidegrid.sinks.store import StateStore
from tidegrid.sizing import materialize
from tidegrid.sources import files as src_files
from tidegrid.sources import state as src
from tidegrid.workload.registry import Views, query, ts_text
from tidegrid.workload.sqltext import TS, sql

def _now():
    """A fixed present, so that results are comparable."""
    return F.lit("2002-01-01").cast("timestamp")


@query("state_scan", sql("b_tx", f"""
    SELECT filename, grid, field, {TS.format('date')} AS date FROM b_tx
    WHERE ds = 'DS1' AND success AND date >= TIMESTAMP '1997-01-01' AND date < TIMESTAMP '1998-01-01'"""))
def state_scan(v: Views):
    """Conjunction of predicates, half-open year, chosen columns."""
    where = [F.col("ds") == "DS1", F.col("success"), src.between_half_open("date", "1997-01-01", "1998-01-01")]
    return src.scan(v.tx, where, ["filename", "grid", "field", "date"]).withColumn("date", ts_text("date"))


@query("state_count", sql("b_tx", "SELECT count(*) AS n FROM b_tx WHERE NOT success"))
def state_count(v: Views):
    """Count without fetching."""
    return src.count(v.tx, [~F.col("success")])


@query("state_page", sql("b_granule", "SELECT id, filename FROM b_granule ORDER BY id LIMIT 1000"))
def state_page(v: Views):
    """Row limit in id order, a page of results."""
    return src.scan(v.granule.orderBy("id"), columns=["id", "filename"], limit=1000)


@query("state_ordered", sql("b_tx", """
    SELECT row_number() OVER (ORDER BY id) AS position, id FROM b_tx"""))
def state_ordered(v: Views):
    """Every row in id order, with its position."""
    return src.numbered(v.tx.select("id"), ["id"])


@query("column_defaults", sql("b_granule", f"""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN {TS.format('date')} END AS date, size, success, 'unknown' AS note FROM b_granule"""))
def column_defaults(v: Views):
    """Absent columns get defaults; text that does not parse becomes missing."""
    raw = v.granule.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("soon").alias("date"),
        F.col("size").cast("string").alias("size"), F.col("success").cast("string").alias("success"))
    schema = T.StructType.fromDDL("o_orderkey BIGINT, date TIMESTAMP, size BIGINT, success BOOLEAN, note STRING")
    return src.with_defaults(raw, schema, {"success": True, "note": "unknown"}).withColumn("date", ts_text("date"))


@query("documents_to_tables", sql("b_granule", f"""
    SELECT id, ds, filename, {TS.format('date')} AS date, size, success, message FROM b_granule"""))
def documents_to_tables(v: Views):
    """Exported state documents read as a typed table."""
    names = DOCUMENT_FIELDS["granule"]
    g = v.granule
    docs = g.select(F.lit("granule").alias("type_s"), *[
        (F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'") if c in ("date", "mod_time", "download_time") else F.col(c)).alias(names[c])
        for c in ("id", "ds", "filename", "date", "mod_time", "download_time", "path", "size", "success", "message")])
    other = docs.withColumn("type_s", F.lit("aggregation"))
    table = src.from_documents(docs.unionByName(other), "granule")
    return table.select("id", "ds", "filename", ts_text("date").alias("date"), "size", "success", "message")


@query("recent_window", sql("b_tx", """
    SELECT id, grid, field FROM b_tx WHERE started >= TIMESTAMP '2001-06-30' - INTERVAL 90 DAY"""))
def recent_window(v: Views):
    """Rows attempted within the last days."""
    return reports.recent(v.tx, "started", timebounds.since(F.lit("2001-06-30"), 90)).select("id", "grid", "field")


@query("dataset_detail", sql("b_granule", f"""
    SELECT {TS.format('date')} AS date, filename, success, message FROM b_granule WHERE ds = 'DS3'"""))
def dataset_detail(v: Views):
    """One dataset's granules by date."""
    return src.detail(v.granule, "DS3", ["date", "filename", "success", "message"], "date").withColumn("date", ts_text("date"))


@query("active_datasets", sql("", "SELECT 'C' || c_custkey AS ds FROM customer WHERE c_acctbal >= 0"))
def active_datasets(v: Views):
    """Datasets that are not deprecated."""
    c = v.table("customer").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ds"), (F.col("c_acctbal") >= 0).alias("active"))
    return src.active_names(c)


@query("explode_fields", sql("", """
    SELECT 'C' || c_custkey AS ds, CAST(p AS INTEGER) AS position, CASE p WHEN 0 THEN c_mktsegment ELSE 'acct' END AS field, CASE p WHEN 0 THEN 'K' ELSE 'm' END AS units
    FROM customer, (VALUES (0), (1)) x(p)"""))
def explode_fields(v: Views):
    """One row per dataset and field."""
    f = lambda n, u: F.struct(
        n.alias("name"), F.lit("").alias("long_name"), F.lit("").alias("standard_name"), F.lit(u).alias("units"),
        F.array().cast("array<string>").alias("pre_transformations"), F.array().cast("array<string>").alias("post_transformations"))
    c = v.table("customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ds"), F.array(f(F.col("c_mktsegment"), "K"), f(F.lit("acct"), "m")).alias("fields"))
    return src.field_rows(c).select("ds", "position", "field", "units")


def _old(v: Views):
    return v.granule.filter("o_orderstatus <> 'O'").select("ds", "filename", "size", "success", "message")


def _news(v: Views):
    return v.granule.filter("o_orderstatus <> 'F'").select("ds", "filename", (F.col("size") + 1).alias("size"), F.lit(None).cast("string").alias("message"), F.lit(True).alias("success"))


@query("upsert_state", sql("b_granule", """
    SELECT ds, filename, CASE WHEN o_orderstatus = 'F' THEN size ELSE size + 1 END AS size,
           CASE WHEN o_orderstatus = 'O' THEN TRUE ELSE success END AS success,
           CASE WHEN o_orderstatus = 'F' THEN message END AS message FROM b_granule"""))
def upsert_state(v: Views):
    """Named columns take the update, others stay, new keys come in."""
    return ops.upsert(_old(v), _news(v), ["ds", "filename"], set_columns=["size", "message"])


@query("snapshot_commit", sql("b_granule", """
    SELECT ds, count(*) AS n, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN size ELSE size + 1 END) AS BIGINT) AS total FROM b_granule GROUP BY ds"""))
def snapshot_commit(v: Views):
    """Two committed snapshots; readers see the newest."""
    store = StateStore(v.spark, shared_dir(v.spark, "state"))
    store.upsert("granule", _old(v))
    store.upsert("granule", _news(v), set_columns=["size", "message"])
    return store.read("granule").groupBy("ds").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"))


def _results(v: Views):
    t = v.tx
    return t.filter("grid <> 'N'").select(
        F.when(F.col("field") == "F", F.col("id")).alias("id"), (F.col("version") == 1).alias("success"),
        F.concat(F.lit("out_"), "filename").alias("output_name"), F.concat(F.lit("/o/"), "filename").alias("output_path"),
        F.lit("abc").alias("checksum"), F.when(F.col("version") == 1, "").otherwise("boom").alias("message"))


@query("record_results", sql("b_tx", f"""
    SELECT id, CASE WHEN u THEN FALSE ELSE TRUE END AS in_progress, CASE WHEN u THEN version = 1 ELSE success END AS success,
           CASE WHEN u THEN (CASE WHEN version = 1 THEN '' ELSE 'boom' END) ELSE message END AS message,
           CASE WHEN u AND version = 1 THEN 'out_' || filename END AS output_name,
           CASE WHEN u AND version = 1 THEN 3.0::DOUBLE ELSE version END AS version,
           {TS.format("CASE WHEN u THEN TIMESTAMP '2002-01-01' ELSE completed END")} AS completed
    FROM (SELECT *, grid <> 'N' AND field = 'F' AS u FROM b_tx)"""))
def record_results(v: Views):
    """Finished work recorded; file columns only on success; results without id are left out."""
    tx = v.tx.withColumns({
        "in_progress": F.lit(True), "output_name": F.lit(None).cast("string"), "output_path": F.lit(None).cast("string"), "checksum": F.lit(None).cast("string")})
    updates, _ = ops.result_updates(_results(v), _now(), F.lit(3.0))
    out = ops.record_results(tx, updates)
    return out.select("id", "in_progress", "success", "message", "output_name", "version", ts_text("completed").alias("completed"))


@query("results_without_id", sql("b_tx", "SELECT count(*) AS n FROM b_tx WHERE grid <> 'N' AND field <> 'F'"))
def results_without_id(v: Views):
    """Results that cannot be recorded."""
    return ops.result_updates(_results(v), _now(), F.lit(3.0))[1].agg(F.count(F.lit(1)).alias("n"))


@query("failure_fanout", sql("b_tx", """
    SELECT id, grid <> 'N' AND success AS success, CASE WHEN grid = 'N' THEN 'no result returned' ELSE message END AS message FROM b_tx"""))
def failure_fanout(v: Views):
    """Every planned combination gets a result."""
    plan = v.tx.select("ds", "filename", "grid", "field", "id")
    return ops.failure_fanout(plan, v.tx.filter("grid <> 'N'")).select("id", "success", "message")


@query("granule_result", sql("b_granule", f"""
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN id ELSE md5(concat_ws('|', ds, filename)) END AS id, success,
           CASE WHEN success THEN '/new/' || filename ELSE '' END AS path, CASE WHEN success THEN checksum END AS checksum,
           CASE WHEN success THEN size ELSE 0 END AS size, CASE WHEN success THEN '' ELSE message END AS message,
           {TS.format("CASE WHEN success THEN mod_time + INTERVAL 1 DAY WHEN o_orderstatus <> 'O' THEN download_time END")} AS download_time,
           {TS.format("date_trunc('day', mod_time)")} AS mod_time
    FROM b_granule"""))
def granule_result(v: Views):
    """Granule rows after a harvest attempt."""
    attempts = v.granule.select("ds", "filename", "date", F.lit("https://h").alias("url"), F.col("mod_time") + F.make_interval(hours=F.lit(5)), "success", "message", F.lit(3).alias("duration"), "o_orderkey")
    attempts = attempts.toDF("ds", "filename", "date", "url", "mod_time", "success", "message", "duration", "o_orderkey")
    known = v.granule.filter("o_orderstatus <> 'O'").select("ds", "filename", "id", "download_time")
    files = v.granule.filter("success").select(
        "filename", F.concat(F.lit("/new/"), "filename").alias("path"), "size", "checksum", (F.col("mod_time") + F.make_interval(days=F.lit(1))).alias("mtime"))
    out = ops.granule_results(attempts, known, files, _now()).join(v.granule.select("filename", "o_orderkey"), "filename")
    return out.select("o_orderkey", "id", "success", "path", "checksum", "size", "message", ts_text("download_time").alias("download_time"), ts_text("mod_time").alias("mod_time"))


@query("purge_range", sql("b_granule", """
    SELECT o_orderkey FROM b_granule WHERE date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-06-30'"""))
def purge_range(v: Views):
    """Rows outside the configured range go."""
    ranges = v.config.select("ds", F.lit("1996-01-01").cast("timestamp").alias("start"), F.lit("2000-06-30").cast("timestamp").alias("end"))
    return ops.purge_range(v.granule, ranges).select("o_orderkey")


@query("purge_version", sql("b_tx b_cfg", """
    SELECT id FROM b_tx LEFT JOIN (SELECT ds, t_version FROM b_cfg WHERE ds <> 'DS2') c USING (ds) WHERE t_version IS NULL OR version = t_version"""))
def purge_version(v: Views):
    """Rows of another version go; datasets without a config stay."""
    return ops.purge_version(v.tx, v.config.filter("ds <> 'DS2'")).select("id")


def _files(v: Views):
    return v.granule.filter("success AND path <> ''").select("path")


@query("orphan_rows", sql("b_granule", "SELECT o_orderkey FROM b_granule WHERE path = '' OR NOT success"))
def orphan_rows(v: Views):
    """Granules whose file is gone."""
    return ops.orphans(v.granule, _files(v)).select("o_orderkey")


@query("purge_missing_files", sql("b_granule", "SELECT o_orderkey FROM b_granule WHERE path <> '' AND success"))
def purge_missing_files(v: Views):
    """Granules whose file exists."""
    return ops.purge_missing_files(v.granule, _files(v)).select("o_orderkey")


def _grids(v: Views):
    g = v.lineitem.groupBy(F.concat(F.lit("S"), (F.col("l_suppkey") % 20).cast("string")).alias("grid")).agg(F.min("l_suppkey").alias("k"))
    reg = g.filter("k < 15").select("grid", F.concat(F.lit("id"), "grid").alias("id"), F.lit("llc").alias("grid_type"), F.lit("/old").alias("path"), F.col("k").cast("string").alias("checksum"), F.lit("2000-01-01").cast("timestamp").alias("added"))
    found = g.select("grid", F.lit("llc").alias("grid_type"), F.concat(F.lit("/g/"), "grid").alias("path"), F.when(F.col("k") > 9, "new").otherwise(F.col("k").cast("string")).alias("checksum"))
    return reg, found


_GRIDS = "g AS (SELECT 'S' || (l_suppkey % 20) AS grid, min(l_suppkey) AS k FROM lineitem GROUP BY ALL)"


@query("grid_cascade", sql("b_tx", f"""
    WITH {_GRIDS} SELECT grid, count(*) AS n FROM (SELECT 'S' || (l_suppkey % 20) AS grid FROM lineitem) WHERE grid NOT IN (SELECT grid FROM g WHERE k > 9 AND k < 15) GROUP BY grid"""))
def grid_cascade(v: Views):
    """Rows that depend on a changed grid go."""
    changed = ops.changed_grids(*_grids(v))
    rows = v.lineitem.select(F.concat(F.lit("S"), (F.col("l_suppkey") % 20).cast("string")).alias("grid"))
    return ops.cascade(rows, changed).groupBy("grid").agg(F.count(F.lit(1)).alias("n"))


@query("grid_register", sql("b_tx", f"""
    WITH {_GRIDS} SELECT grid, CASE WHEN k < 15 THEN 'id' || grid ELSE md5(grid) END AS id, CASE WHEN k > 9 THEN 'new' ELSE CAST(k AS VARCHAR) END AS checksum,
        CASE WHEN k > 9 THEN '/g/' || grid ELSE '/old' END AS path, CASE WHEN k > 9 THEN '2002-01-01 00:00:00' ELSE '2000-01-01 00:00:00' END AS added FROM g"""))
def grid_register(v: Views):
    """Grid table after new and changed grids are registered."""
    reg, found = _grids(v)
    return ops.register_grids(reg, found, _now()).select("grid", "id", "checksum", "path", ts_text("added").alias("added"))


_STATUS = """CASE WHEN n_success = 0 AND n_failed = 0 THEN '{none}' WHEN n_success = 0 THEN '{no}' WHEN n_failed > 0 THEN n_failed || '{bad}' ELSE '{fine}' END"""
_HNONE = "No usable granules harvested (either all failed or no data collected)"


def _counted(table: str, key: str) -> str:
    return f"(SELECT {key} AS k, count(*) FILTER (success) AS n_success, count(*) FILTER (NOT success) AS n_failed FROM {table} GROUP BY ALL)"


@query("harvest_status", sql("b_granule", f"""
    SELECT k AS ds, n_success, n_failed, n_success + n_failed AS n_granules, {_STATUS.format(none=_HNONE, no=_HNONE, bad=' harvested granules failed', fine='All granules successfully harvested')} AS status
    FROM (SELECT 'C' || o_custkey AS k, count(*) FILTER (o_orderstatus <> 'P') AS n_success, count(*) FILTER (o_orderstatus = 'P') AS n_failed FROM orders GROUP BY ALL)"""))
def harvest_status(v: Views):
    """Harvest status text and counts."""
    rows = v.orders.select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ds"), (F.col("o_orderstatus") != "P").alias("success"))
    return ops.harvest_status(rows)


@query("tx_status", sql("b_tx", f"""
    SELECT k AS filename, n_success, n_failed, {_STATUS.format(none='No transformations performed', no='No successful transformations', bad=' transformations failed', fine='All transformations successful')} AS status
    FROM {_counted('b_tx', 'filename')}"""))
def tx_status(v: Views):
    """Transformation status text."""
    return ops.transformation_status(v.tx, ["filename"])


@query("agg_status", sql("b_agg b_cfg", f"""
    SELECT c.ds, coalesce(n_success, 0) AS n_success, coalesce(n_failed, 0) AS n_failed,
        CASE WHEN n_success IS NULL THEN 'No aggregations performed' ELSE {_STATUS.format(none='No aggregations performed', no='No successful aggregations', bad=' aggregations failed', fine='All aggregations successful')} END AS status
    FROM b_cfg c LEFT JOIN {_counted('b_agg', 'ds')} ON k = c.ds"""))
def agg_status(v: Views):
    """Aggregation status text of every dataset."""
    return ops.for_all(ops.aggregation_status(v.agg), v.config, "No aggregations performed")


@query("dataset_dates", sql("b_granule", f"""
    SELECT ds, {TS.format('min(date) FILTER (success)')} AS start_date, {TS.format('max(date) FILTER (success)')} AS end_date,
           {TS.format('max(download_time)')} AS last_download, (SELECT filename FROM b_granule b WHERE b.ds = a.ds ORDER BY download_time DESC, filename DESC LIMIT 1) AS last_file
    FROM b_granule a GROUP BY ds"""))
def dataset_dates(v: Views):
    """First, last and latest-downloaded granule."""
    out = ops.dataset_dates(v.granule)
    return out.select("ds", *[ts_text(c).alias(c) for c in ("start_date", "end_date", "last_download")], "last_file")


@query("dataset_row", sql("b_granule", f"""
    SELECT ds, n_success + n_failed AS n_granules, n_success, n_failed, start_date, end_date, {_STATUS.format(none=_HNONE, no=_HNONE, bad=' harvested granules failed', fine='All granules successfully harvested')} AS harvest_status
    FROM (SELECT ds, count(*) FILTER (success) AS n_success, count(*) FILTER (NOT success) AS n_failed, {TS.format('min(date) FILTER (success)')} AS start_date,
                 {TS.format('max(date) FILTER (success)')} AS end_date FROM b_granule GROUP BY ds)"""))
def dataset_row(v: Views):
    """Dataset-table updates after a harvest, written and read back."""
    store = StateStore(v.spark, shared_dir(v.spark, "state"))
    store.upsert("dataset", ops.dataset_rows(v.granule, _now()))
    out = store.read("dataset")
    return out.select("ds", "n_granules", "n_success", "n_failed", ts_text("start_date").alias("start_date"), ts_text("end_date").alias("end_date"), "harvest_status")


@query("stage_writeback", sql("b_tx b_granule", f"""
    SELECT k AS ds, n_failed || ' transformations failed' AS transformation_status, '2002-01-01 00:00:00' AS last_transformation, n_granules
    FROM {_counted('b_tx', 'ds')} JOIN (SELECT ds, count(*) AS n_granules FROM b_granule GROUP BY ds) g ON g.ds = k"""))
def stage_writeback(v: Views):
    """Stage status written to the dataset table next to what is there."""
    store = StateStore(v.spark, shared_dir(v.spark, "state"))
    store.upsert("dataset", ops.dataset_rows(v.granule, _now()))
    status = ops.transformation_status(v.tx).select("ds", F.col("status").alias("transformation_status"), _now().alias("last_transformation"))
    store.upsert("dataset", status)
    return store.read("dataset").select("ds", "transformation_status", ts_text("last_transformation").alias("last_transformation"), "n_granules")


@query("batch_summary", sql("b_tx", """
    SELECT ds, count(*) AS total, count(*) FILTER (NOT success) AS errors, count(*) FILTER (success) AS processed FROM b_tx GROUP BY ds"""))
def batch_summary(v: Views):
    """Batch totals and errors."""
    return ops.batch_summary(v.tx)


@query("batch_errors", sql("b_tx", """
    SELECT ds, message, n, CAST(row_number() OVER (PARTITION BY ds ORDER BY n DESC, message) AS INTEGER) AS rank
    FROM (SELECT ds, message, count(*) AS n FROM b_tx WHERE NOT success GROUP BY ALL)"""))
def batch_errors(v: Views):
    """Error messages of each batch, the most frequent first."""
    return ops.batch_errors(v.tx)


def _members(v: Views):
    tx = v.tx.withColumn("source_path", F.concat(F.lit("/s/"), "filename"))
    granules = v.granule.select("ds", F.concat(F.lit("/s/"), "short").alias("path"), "checksum", "size")
    return provenance.members(tx, granules)


@query("provenance_json", sql("b_tx b_agg", """
    SELECT ds, grid, field, year, count(*) FILTER (k = 'p') AS products, count(*) FILTER (k = 't') AS transformations
    FROM (SELECT ds, grid, field, year, 'p' AS k FROM b_agg UNION ALL SELECT ds, grid, field, CAST(year(date) AS INTEGER), 't' FROM b_tx WHERE success) GROUP BY ALL"""))
def provenance_json(v: Views):
    """Members of each product, from the JSON lines."""
    datasets = v.config.select("ds", "variable", "t_version")
    return provenance.member_counts(provenance.provenance_lines(_members(v), v.agg, datasets))


@query("provenance_content", sql("b_tx b_granule", """
    SELECT t.ds, t.filename, grid, field, g.checksum, g.size FROM b_tx t LEFT JOIN b_granule g ON g.ds = t.ds AND g.short = t.filename WHERE t.success"""))
def provenance_content(v: Views):
    """The lines parse back to each member and its granule."""
    lines = provenance.provenance_lines(_members(v), v.agg, v.config.select("ds", "variable")).filter("kind = 'transformation'")
    p = F.from_json("json", "filename STRING, granule STRUCT<checksum: STRING, size: BIGINT>")
    return lines.withColumn("p", p).select("ds", "p.filename", "grid", "field", "p.granule.checksum", "p.granule.size")


@query("provenance_files", sql("b_tx b_agg", """
    SELECT ds, count(*) AS n FROM (SELECT ds FROM b_agg UNION ALL SELECT ds FROM b_tx WHERE success) GROUP BY ds"""))
def provenance_files(v: Views):
    """Provenance written as text and read back; products that have it are not written again."""
    path = shared_dir(v.spark, "provenance")
    # both writes read the same members and products: these are joined and grouped once
    held = materialize(_members(v), shared_dir(v.spark, "members"))
    agg = materialize(v.agg, shared_dir(v.spark, "aggregations"))
    lines = provenance.provenance_lines(held, agg, v.config.select("ds", "variable"))
    provenance.write_provenance(lines, path)
    provenance.write_provenance(lines, path, v.spark.read.text(path))
    return v.spark.read.text(path).groupBy("ds").agg(F.count(F.lit(1)).alias("n"))


@query("file_facts")
def file_facts(v: Views):
    """Size, time and checksum of the table files (file metadata is not visible to SQL)."""
    return src_files.checksums(v.spark, v.dir, "*.parquet").select("filename", "size", "checksum")


_RANGE = ("1996-01-01", "2000-06-30")


@query("maintenance_job", sql("b_granule b_tx b_agg b_cfg", f"""
    WITH known AS (SELECT DISTINCT grid FROM b_tx),
    g AS (SELECT * FROM b_granule WHERE success AND path <> '' AND (ds = 'DS3' OR date BETWEEN TIMESTAMP '{_RANGE[0]}' AND TIMESTAMP '{_RANGE[1]}')),
    t0 AS (SELECT b_tx.*, (ds <> 'DS3' AND NOT date BETWEEN TIMESTAMP '{_RANGE[0]}' AND TIMESTAMP '{_RANGE[1]}') OR (ds <> 'DS2' AND version <> t_version) OR grid = 'N' AS gone
        FROM b_tx LEFT JOIN b_cfg USING (ds)),
    lost AS (SELECT DISTINCT ds, grid, field, CAST(year(date) AS INTEGER) AS year, TRUE AS reopened FROM t0 WHERE gone AND success),
    a AS (SELECT b_agg.*, coalesce(reopened, FALSE) AS again FROM b_agg LEFT JOIN lost USING (ds, grid, field, year) WHERE grid <> 'N')
    SELECT 'granule' AS part, ds AS name, '' AS detail, count(*) AS n FROM g GROUP BY ALL
    UNION ALL SELECT 'transformation', ds || '/' || grid || '/' || field, '', count(*) FROM t0 WHERE NOT gone GROUP BY ALL
    UNION ALL SELECT 'aggregation', ds || '/' || grid || '/' || field || '/' || year,
        CASE WHEN again THEN 'reopened' ELSE message END || '/' || CASE WHEN success AND NOT again THEN 'true' ELSE 'false' END, 1 FROM a
    UNION ALL SELECT 'grid', grid, CASE WHEN grid = 'N' THEN 'new' ELSE 'old' END || '/' || CASE WHEN grid = 'A' THEN '2000-01-01' ELSE '2002-01-01' END, 1 FROM known
    UNION ALL SELECT 'mark', 'mapping/A/DS1/all/1.0', 'f', 1"""))
def maintenance_job(v: Views):
    """Purges, grid registration, its cascade and mapping marks, committed together.

    Grid A is registered and unchanged, N has another file now, R is new.
    """
    store = StateStore(v.spark, shared_dir(v.spark, "state"))
    load = store.transaction()
    load.replace("granule", src.with_defaults(v.granule, GRANULE))
    load.replace("transformation", src.with_defaults(v.tx, TRANSFORMATION))
    load.replace("aggregation", src.with_defaults(v.agg, AGGREGATION))
    # from the stored rows and once: the grids are asked for by several steps
    grids = materialize(load.read("transformation").select("grid").distinct(), shared_dir(v.spark, "grids"))
    found = grids.select("grid", F.lit("llc").alias("grid_type"), F.concat(F.lit("/g/"), "grid").alias("path"), F.when(F.col("grid") == "N", "new").otherwise("old").alias("checksum"))
    load.replace("grid", src.with_defaults(found.filter("grid <> 'R'").withColumns({"checksum": F.lit("old"), "id": F.col("grid"), "added": F.lit("2000-01-01").cast("timestamp")}), GRID))
    load.mark(maintenance.mapping_mark("DS1", "A", "", 1.0), "f")
    load.mark(maintenance.mapping_mark("DS1", "N", "", 1.0), "f")
    load.commit()
    ranges = v.config.filter("ds <> 'DS3'").select("ds", *[F.lit(x).cast("timestamp").alias(n) for n, x in zip(("start", "end"), _RANGE)])
    maintenance.run(store, ranges, v.config.filter("ds <> 'DS2'"), _files(v), found, _now())
    path = lambda *c: F.concat_ws("/", *c)
    count = F.count(F.lit(1)).alias("n")
    parts = [
        store.read("granule").groupBy(F.lit("granule").alias("part"), F.col("ds").alias("name"), F.lit("").alias("detail")).agg(count),
        store.read("transformation").groupBy(F.lit("transformation").alias("part"), path("ds", "grid", "field").alias("name"), F.lit("").alias("detail")).agg(count),
        store.read("aggregation").select(F.lit("aggregation"), path("ds", "grid", "field", F.col("year").cast("string")), path("message", F.col("success").cast("string")), F.lit(1)),
        store.read("grid").select(F.lit("grid"), "grid", path("checksum", F.date_format("added", "yyyy-MM-dd")), F.lit(1)),
        v.spark.createDataFrame([("mark", k, m, 1) for k, m in store.marks().items()], "part string, name string, detail string, n int"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.select("part", "name", "detail", F.col("n").cast("bigint").alias("n"))
