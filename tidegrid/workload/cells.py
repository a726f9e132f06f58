"""Masks, units, windows and names on cell rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.functions import masks, text, timebounds, units
from tidegrid.operators import regrid
from tidegrid.sources import cells as src_cells
from tidegrid.workload.registry import Views, query, ts_text
from tidegrid.workload.sqltext import TS, sql

# conc in hundredths of the value; qa cycles through all bytes
_CONC = """(SELECT event_id, user_id, event_type, value / 100 AS conc, value / 1000 AS stdev, event_id % 256 AS qa,
    CASE WHEN event_id % 11 = 0 THEN 1 END AS flag, value FROM b_val)"""


def _conc(v: Views):
    return v.value_events.select(
        "event_id", "user_id", "event_type", (F.col("value") / 100).alias("conc"), (F.col("value") / 1000).alias("stdev"),
        (F.col("event_id") % 256).alias("qa"), F.when(F.col("event_id") % 11 == 0, 1).alias("flag"), "value")


@query("mask_sst_ice", sql("", """
    SELECT event_id, CASE WHEN NOT (265 + user_id % 20 <= 272.65 OR event_id % 3 = 0) THEN CAST(265 + user_id % 20 AS DOUBLE) END AS analysed_sst
    FROM events"""))
def mask_sst_ice(v: Views):
    """Cold or ice-covered temperatures go; a missing ice fraction does not."""
    k = F.col("event_id") % 3
    rows = v.events.select(
        "event_id", (F.lit(265.0) + F.col("user_id") % 20).alias("analysed_sst"),
        F.when(k == 0, 0.2).when(k == 1, 0.0).alias("sea_ice_fraction"))
    return masks.apply_masks(rows, ["sst_ice"]).select("event_id", "analysed_sst")


@query("mask_negative", sql("b_val", """
    SELECT event_id, CASE WHEN value - 20 >= 0 THEN value - 20 END AS thickness, -1.5::DOUBLE - user_id AS lon FROM b_val"""))
def mask_negative(v: Views):
    """Negative values go, coordinates stay."""
    rows = v.value_events.select("event_id", (F.col("value") - 20).alias("thickness"), (F.lit(-1.5) - F.col("user_id")).alias("lon"))
    return masks.apply_masks(rows, ["negatives"])


@query("mask_range_flag", sql("b_val", f"""
    SELECT event_id, CASE WHEN conc <= 1 AND flag IS NULL THEN conc END AS conc, CASE WHEN stdev <= 1 AND flag IS NULL THEN stdev END AS stdev FROM {_CONC}"""))
def mask_range_flag(v: Views):
    """Out-of-range and interpolated concentrations go."""
    return masks.range_flag(_conc(v), columns=("conc", "stdev"), flag="flag").select("event_id", "conc", "stdev")


@query("mask_qa_bits", sql("b_val", f"""
    SELECT event_id, CASE WHEN qa & 104 = 0 THEN conc END AS conc, CASE WHEN qa & 104 = 0 THEN stdev END AS stdev FROM {_CONC}"""))
def mask_qa_bits(v: Views):
    """Values with a rejected quality bit go."""
    return masks.qa_bits(_conc(v), columns=("conc", "stdev"), qa="qa").select("event_id", "conc", "stdev")


@query("mask_qa_range", sql("b_val", f"""
    SELECT event_id, CASE WHEN qa & 104 = 0 AND coalesce(conc <= 1, TRUE) THEN conc END AS conc,
           CASE WHEN qa & 104 = 0 AND coalesce(conc <= 1, TRUE) THEN stdev END AS stdev FROM {_CONC}"""))
def mask_qa_range(v: Views):
    """Rejected quality bits and out-of-range concentrations void both columns."""
    return masks.qa_range(_conc(v), columns=("conc", "stdev"), qa="qa").select("event_id", "conc", "stdev")


@query("mask_land", sql("b_val", """
    SELECT event_id, CASE WHEN user_id % 2 = 0 THEN value END AS lwe_thickness, CASE WHEN user_id % 2 = 0 THEN value / 10 END AS uncertainty FROM b_val"""))
def mask_land(v: Views):
    """Land cells go."""
    rows = v.value_events.select(
        "event_id", F.col("value").alias("lwe_thickness"), (F.col("value") / 10).alias("uncertainty"),
        (F.col("user_id") % 2).cast("double").alias("land_mask"))
    return masks.apply_masks(rows, ["land"]).drop("land_mask")


@query("mask_chain", sql("b_val", f"""
    SELECT event_id, CASE WHEN conc <= 1 AND flag IS NULL AND qa & 104 = 0 THEN conc END AS conc FROM {_CONC}"""))
def mask_chain(v: Views):
    """Registered masks applied in order by name."""
    out = masks.apply_masks(
        _conc(v), ["range_flag", "qa_bits", "negatives"],
        range_flag={"columns": ("conc",), "flag": "flag"}, qa_bits={"columns": ("conc",), "qa": "qa"},
        negatives={"columns": ("conc",)})
    return out.select("event_id", "conc")


@query("qa_flag_layers", sql("b_val", f"""
    SELECT event_type, CAST(bit AS INTEGER) AS bit, meaning, count(*) FILTER ((qa & (1 << bit)) <> 0) AS n_set, count(*) AS n
    FROM {_CONC}, (VALUES {", ".join(f"({i}, '{m}')" for i, m in enumerate(masks.QA_FLAG_MEANINGS))}) f(bit, meaning)
    GROUP BY ALL"""))
def qa_flag_layers(v: Views):
    """The eight quality bits as layers."""
    return masks.qa_layers(_conc(v), "qa").groupBy("event_type", "bit", "meaning").agg(
        F.count_if("is_set").alias("n_set"), F.count(F.lit(1)).alias("n"))


@query("presence", sql("b_val", """
    SELECT event_id, CASE WHEN value - 10 > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS present FROM b_val"""))
def presence(v: Views):
    """1 where positive, else 0."""
    return v.value_events.select("event_id", masks.presence(F.col("value") - 10).alias("present"))


@query("mask_diagnostics", sql("b_val", f"""
    SELECT event_type, count(*) FILTER (conc > 1) AS over_one_before, count(*) FILTER (m > 1) AS over_one_after,
           round(sum(conc), 6) AS sum_before, round(sum(m), 6) AS sum_after
    FROM (SELECT *, CASE WHEN qa & 104 = 0 AND coalesce(conc <= 1, TRUE) THEN conc END AS m FROM {_CONC}) GROUP BY event_type"""))
def mask_diagnostics(v: Views):
    """Counts and sums before and after masking."""
    rows = _conc(v).withColumn("m", F.col("conc"))
    out = masks.qa_range(rows, columns=("m",), qa="qa").groupBy("event_type").agg(*masks.mask_diagnostics("conc", "m"))
    return out.withColumns({c: F.round(c, 6) for c in ("sum_before", "sum_after")})


def _unit(v: Views, name: str):
    return units.apply_post(v.value_events.select("event_id", "value"), [name])


@query("unit_cm", sql("b_val", "SELECT event_id, value * 100 AS value, 'cm' AS units FROM b_val"))
def unit_cm(v: Views):
    return _unit(v, "meters_to_cm")


@query("unit_celsius", sql("b_val", "SELECT event_id, value - 273.15::DOUBLE AS value, 'Celsius' AS units FROM b_val"))
def unit_celsius(v: Views):
    return _unit(v, "kelvin_to_celsius")


@query("unit_fraction", sql("b_val", "SELECT event_id, value / 100.0::DOUBLE AS value, '1' AS units FROM b_val"))
def unit_fraction(v: Views):
    return _unit(v, "seaice_concentration_to_fraction")


@query("fill_roundtrip", sql("b_val", "SELECT event_id, coalesce(value, -9999.0::DOUBLE) AS filled, value AS back FROM b_val"))
def fill_roundtrip(v: Views):
    """Missing to fill value and back."""
    f = v.value_events.select("event_id", units.fill_missing("value").alias("filled"))
    return f.withColumn("back", units.unfill("filled"))


def _window_sql(unit: str) -> str:
    mid = "make_timestamp((epoch_us({a}) + epoch_us({b})) // 2)"
    fwd, back = f"o_orderdate + INTERVAL 1 {unit}", f"o_orderdate - INTERVAL 1 {unit}"
    return sql("", f"""
        SELECT o_orderkey, {TS.format(fwd)} AS end_of, {TS.format(mid.format(a='o_orderdate', b=fwd))} AS center_fwd,
               {TS.format(back)} AS start_of, {TS.format(mid.format(a=back, b='o_orderdate'))} AS center_back FROM orders""")


def _window(v: Views, period: str):
    f = timebounds.time_window(start="o_orderdate", period=period)
    b = timebounds.time_window(end="o_orderdate", period=period)
    return v.orders.select(
        "o_orderkey", ts_text(f["end"]).alias("end_of"), ts_text(f["center"]).alias("center_fwd"),
        ts_text(b["start"]).alias("start_of"), ts_text(b["center"]).alias("center_back"))


for _period, _unit_name in (("AVG_DAY", "DAY"), ("AVG_WEEK", "WEEK"), ("AVG_MON", "MONTH"), ("AVG_YEAR", "YEAR")):
    query(f"time_window_{_unit_name.lower()}", _window_sql(_unit_name))(lambda v, p=_period: _window(v, p))


@query("fix_day_window", sql("", f"""
    SELECT event_id, {TS.format("date_trunc('day', ts)")} AS time_start, {TS.format("date_trunc('day', ts) + INTERVAL 1 DAY")} AS time_end FROM events"""))
def fix_day_window(v: Views):
    """Window reset to the calendar day of the center time."""
    rows = v.events.select("event_id", F.col("ts").alias("time"), F.lit(None).cast("double").alias("value"))
    out = units.apply_post(rows, ["MEaSUREs_fix_time"])
    return out.select("event_id", ts_text("time_start").alias("time_start"), ts_text("time_end").alias("time_end"))


@query("record_window", sql("", f"""
    SELECT o_orderkey, {TS.format('o_orderdate')} AS day_start, {TS.format('o_orderdate + INTERVAL 1 DAY')} AS day_end,
           {TS.format("date_trunc('month', o_orderdate)")} AS month_start,
           {TS.format("date_trunc('month', o_orderdate) + INTERVAL 1 MONTH")} AS month_end,
           {TS.format("CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 5 DAY ELSE o_orderdate + INTERVAL 1 DAY END")} AS bounds_end,
           {TS.format("CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 4 DAY ELSE o_orderdate + INTERVAL 1 DAY END")} AS legacy_end,
           {TS.format('o_orderdate + INTERVAL 36 HOUR')} AS shifted_end
    FROM orders"""))
def record_window(v: Views):
    """Windows from the record date, a bounds variable, or the center time."""
    d, ok = F.col("o_orderdate"), F.col("o_orderstatus") == "F"
    compact = lambda n: F.when(ok, F.date_format(F.date_add(d.cast("date"), n), "yyyyMMdd"))
    day = timebounds.record_window("o_orderdate", "daily")
    month = timebounds.record_window("o_orderdate", "monthly")
    bounds = timebounds.record_window("o_orderdate", "daily", compact(4), compact(5))
    legacy = timebounds.record_window("o_orderdate", "daily", compact(4), compact(5), legacy_bounds=True)
    shifted = timebounds.record_window("o_orderdate", "daily", center=d + F.make_interval(hours=F.lit(12)), next_day_end=True)
    return v.orders.select(
        "o_orderkey", ts_text(day["start"]).alias("day_start"), ts_text(day["end"]).alias("day_end"),
        ts_text(month["start"]).alias("month_start"), ts_text(month["end"]).alias("month_end"),
        ts_text(bounds["end"]).alias("bounds_end"), ts_text(legacy["end"]).alias("legacy_end"),
        ts_text(shifted["end"]).alias("shifted_end"))


@query("time_encode", sql("", """
    SELECT o_orderkey, (epoch(o_orderdate) - epoch(TIMESTAMP '1980-01-01')) / 3600.0 AS hours,
           CAST(o_totalprice AS FLOAT)::DOUBLE AS coord FROM orders"""))
def time_encode(v: Views):
    """Hours since the epoch; coordinates in single precision."""
    return v.orders.select(
        "o_orderkey", timebounds.hours_since_epoch("o_orderdate").alias("hours"),
        F.col("o_totalprice").cast("float").cast("double").alias("coord"))


@query("output_name", sql("b_granule", """
    SELECT o_orderkey, 'grid1_' || o_orderstatus || '_' || replace(filename, '.nc', '') || '.nc' AS record_name,
           ds || '_grid1_DAILY_' || o_orderstatus || '_' || year(date) AS product_name,
           ds || '_' || o_orderstatus || '_grid1_' || year(date) || '_descendants.json' AS provenance_name,
           'grid1_' || hemi || '_v1.5_factors' AS mapping_name, o_orderstatus || '_interpolated_to_grid1' AS label
    FROM b_granule"""))
def output_name(v: Views):
    """Names of records, products, provenance and mappings."""
    g, f, y = F.lit("grid1"), F.col("o_orderstatus"), F.year("date")
    return v.granule.select(
        "o_orderkey", text.transformed_name(g, f, "filename").alias("record_name"),
        text.product_name("ds", g, F.lit("daily"), f, y).alias("product_name"),
        text.provenance_name("ds", f, g, y).alias("provenance_name"),
        text.mapping_name(g, "hemi", F.lit(1.5)).alias("mapping_name"), text.record_label(f, g).alias("label"))


def _attrs(v: Views):
    fields = v.granule.select(
        "o_orderkey", "filename", F.col("o_orderstatus").alias("field"), F.concat(F.lit("long "), "ds").alias("long_name"),
        F.lit("std").alias("standard_name"), F.lit("K").alias("units"))
    return regrid.record_attributes(fields, F.lit("grid1"), text.stem("filename"))


@query("record_meta", sql("b_granule", """
    SELECT o_orderkey, CAST(7 AS INTEGER) AS n_attrs, 'long ' || ds AS long_name, replace(filename, '.nc', '') AS original_filename,
           'K' AS units FROM b_granule"""))
def record_meta(v: Views):
    """Descriptive attributes of a record."""
    a = F.col("attrs")
    return _attrs(v).select(
        "o_orderkey", F.size(a).alias("n_attrs"), a["long_name"].alias("long_name"),
        a["original_filename"].alias("original_filename"), a["units"].alias("units"))


@query("attr_filter", sql("b_granule", """
    SELECT o_orderkey, CAST(6 AS INTEGER) AS n_attrs, CAST(NULL AS VARCHAR) AS original_filename, o_orderstatus AS original_field_name FROM b_granule"""))
def attr_filter(v: Views):
    """Source-file attributes go, the original field name stays."""
    a = F.col("kept")
    return _attrs(v).withColumn("kept", regrid.product_attributes("attrs")).select(
        "o_orderkey", F.size(a).alias("n_attrs"), F.try_element_at(a, F.lit("original_filename")).alias("original_filename"),
        a["original_field_name"].alias("original_field_name"))


@query("missing_field_record", sql("b_val", """
    SELECT event_id, field, CASE WHEN field = 'value' THEN value END AS value,
           'Field ''absent'' missing from source data — empty record created' AS message
    FROM b_val, (VALUES ('value'), ('absent')) f(field)"""))
def missing_field_record(v: Views):
    """A configured field the source lacks gives an empty record and a warning."""
    wide = src_cells.with_fields(v.value_events.select("event_id", "value"), ["value", "absent"])
    return src_cells.to_long(wide, ["event_id", "message"], ["value", "absent"])


@query("nested_group", sql("b_val", """
    SELECT event_id, user_id AS grid_x, value AS h, CAST(event_id AS DOUBLE) AS raw_nt_seaice_conc FROM b_val"""))
def nested_group(v: Views):
    """Variables of nested groups next to the root's."""
    root = v.value_events.select(
        "event_id", F.col("user_id").alias("grid_x"), F.struct(F.col("value").alias("h"), F.lit(1).alias("other")).alias("monthly"),
        F.struct(F.col("event_id").cast("double").alias("raw_nt_seaice_conc")).alias("cdr_supplementary"))
    flat = src_cells.apply_pre(src_cells.apply_pre(root, "nsidc_seaice_nt_extraction", []), "ATL20_V004_monthly", ["h"])
    return flat.drop("cdr_supplementary")


@query("granule_scan", sql("b_obs", "SELECT field, count(*) AS n, count(value) AS n_valid, CAST(sum(src_id) AS BIGINT) AS src_sum FROM b_obs GROUP BY field"))
def granule_scan(v: Views):
    """Observation cells with NaN read as missing."""
    raw = v.obs.withColumn("value", F.coalesce("value", F.lit(float("nan"))))
    return units.nan_to_null(raw, ["value"]).groupBy("field").agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("n_valid"), F.sum("src_id").alias("src_sum"))
