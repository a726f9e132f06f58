"""Grids, projections, mappings and regridding."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tidegrid.functions import geo, layout
from tidegrid.operators import mapping, regrid
from tidegrid.operators.median import bounded_median
from tidegrid.session import shared_dir
from tidegrid.sinks.packing import pack_records, unpack_blocks
from tidegrid.sources import cells as src_cells
from tidegrid.sources import grids
from tidegrid.workload.registry import Views, query
from tidegrid.workload.sqltext import R, sql


@query("lon_wrap", sql("", """
    SELECT p_partkey, ((p_partkey * 0.5::DOUBLE - 700 + 180) % 360 + 360) % 360 - 180 AS lon FROM part"""))
def lon_wrap(v: Views):
    """Longitude in [-180, 180)."""
    return v.table("part").select("p_partkey", geo.wrap_lon(F.col("p_partkey") * 0.5 - 700).alias("lon"))


@query("grid_generate", sql("", """
    WITH n AS (SELECT (count(*) + 99) // 100 AS rows FROM part)
    SELECT p_partkey AS src_id, p_partkey // 100 AS "row", p_partkey % 100 AS col,
           round(-180 + (p_partkey % 100 + 0.5::DOUBLE) * 3.6, 8) AS lon,
           round(90 - (p_partkey // 100 + 0.5::DOUBLE) * (180.0::DOUBLE / rows), 8) AS lat
    FROM part, n"""))
def grid_generate(v: Views):
    """A regular grid with as many cells as there are parts."""
    rows = -(-v.table("part").count() // 100)
    ids = v.table("part").select(F.col("p_partkey").alias("src_id"))
    cells = grids.source_cells(ids, (100, rows), (-180, -90, 180, 90), geo.Projection("longlat"))
    return cells.withColumns({"lon": F.round("lon", 8), "lat": F.round("lat", 8)})


@query("grid_transpose", sql("", """
    SELECT p_partkey, (p_partkey // 100) * 100 + p_partkey % 100 AS plain,
           (p_partkey % 100) * (SELECT (count(*) + 99) // 100 FROM part) + p_partkey // 100 AS swapped FROM part"""))
def grid_transpose(v: Views):
    """Source cell number of an array position, read by rows or by columns."""
    rows = -(-v.table("part").count() // 100)
    k = F.col("p_partkey")
    r, c = F.floor(k / 100), k % 100
    return v.table("part").select(
        "p_partkey", layout.source_index(r, c, rows, 100).alias("plain"),
        layout.source_index(r, c, rows, 100, transpose=True).alias("swapped"))


_PROJECTIONS = {
    "polar_north": "EPSG:3411",
    "polar_south": "EPSG:3412",
    "equal_area_north": "+proj=laea +lat_0=90 +lon_0=0 +x_0=0 +y_0=0 +ellps=WGS84 +units=m +no_defs",
    "equal_area_south": "+proj=laea +lat_0=-90 +lon_0=0 +x_0=0 +y_0=0 +ellps=WGS84 +units=m +no_defs",
    "cylindrical": "+proj=cea +lon_0=0 +lat_ts=30 +x_0=0 +y_0=0 +ellps=WGS84 +units=m +no_defs",
    "geographic": "+proj=longlat +ellps=WGS84 +datum=WGS84 +no_defs",
}


def _forward_sql(name: str, text: str) -> str:
    """Forward projection of (lon, lat) in degrees, by Snyder's forward formulas, as SQL."""
    p = geo.Projection.parse(text)
    a, b = p.ellipsoid
    e = math.sqrt(1 - b * b / (a * a))
    south = -1 if p.lat_0 < 0 else 1
    lam = f"radians(lon - ({p.lon_0}))"
    phi = f"radians(lat * {south})"
    if p.kind == "longlat":
        return f"SELECT p_partkey, '{name}' AS proj, lon, lat, lon AS x, lat AS y FROM pts"
    q = lambda s: f"({1 - e * e!r} * ({s} / (1 - power({e!r} * {s}, 2)) - ln((1 - {e!r} * {s}) / (1 + {e!r} * {s})) / {2 * e!r}))"
    qp = q("1.0::DOUBLE")
    ts = math.radians(abs(p.lat_ts))
    m = math.cos(ts) / math.sqrt(1 - (e * math.sin(ts)) ** 2)
    if p.kind == "stere":
        t_ts = math.tan(math.pi / 4 - ts / 2) / ((1 - e * math.sin(ts)) / (1 + e * math.sin(ts))) ** (e / 2)
        t = f"(tan(pi() / 4 - {phi} / 2) / power((1 - {e!r} * sin({phi})) / (1 + {e!r} * sin({phi})), {e / 2!r}))"
        rho = f"({a * m / t_ts!r} * {t})"
        return f"SELECT p_partkey, '{name}' AS proj, lon, lat, {rho} * sin({lam}) AS x, {-south} * {rho} * cos({lam}) AS y FROM pts"
    if p.kind == "laea":
        rho = f"({a!r} * sqrt({qp} - {q(f'sin({phi})')}))"
        return f"SELECT p_partkey, '{name}' AS proj, lon, lat, {rho} * sin({lam}) AS x, {-south} * {rho} * cos({lam}) AS y FROM pts"
    return f"SELECT p_partkey, '{name}' AS proj, lon, lat, {a * m!r} * {lam} AS x, {a / (2 * m)!r} * {q(f'sin({phi})')} AS y FROM pts"


@query("grid_project", sql("", f"""
    SELECT p_partkey, proj, round(x / 1000, 3) AS x_km, round(y / 1000, 3) AS y_km, round(lon, 7) AS lon, round(lat, 7) AS lat
    FROM (WITH pts AS (
        SELECT p_partkey, (p_partkey * 7) % 340 - 170 + 0.25::DOUBLE AS lon, (p_partkey * 3) % 40 + 45 + 0.25::DOUBLE AS lat0 FROM part),
      raw AS ({" UNION ALL ".join("(" + _forward_sql(n, t).replace("FROM pts", "FROM (SELECT p_partkey, lon, " + ("-lat0" if "south" in n else "lat0") + " AS lat FROM pts)") + ")" for n, t in _PROJECTIONS.items())})
      SELECT * FROM raw)"""))
def grid_project(v: Views):
    """Inverse projections: points projected forward in closed form must come back."""
    k = F.col("p_partkey")
    pts = v.table("part").select(
        "p_partkey", ((k * 7) % 340 - 170 + F.lit(0.25)).alias("lon"), ((k * 3) % 40 + 45 + F.lit(0.25)).alias("lat0"))
    out = None
    for name, text in _PROJECTIONS.items():
        p = geo.Projection.parse(text)
        located = pts.withColumn("lat", F.col("lat0") * (-1.0 if "south" in name else 1.0))
        x, y = _forward(p, F.col("lon"), F.col("lat"))
        lon, lat = geo.inverse(p, F.col("x"), F.col("y"))
        rows = located.select("p_partkey", F.lit(name).alias("proj"), x.alias("x"), y.alias("y")).select(
            "p_partkey", "proj", F.round(F.col("x") / 1000, 3).alias("x_km"), F.round(F.col("y") / 1000, 3).alias("y_km"),
            F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _forward(p: geo.Projection, lon, lat):
    """Forward formulas, used only to make test points."""
    a, b = p.ellipsoid
    e = math.sqrt(1 - b * b / (a * a))
    south = -1.0 if p.lat_0 < 0 else 1.0
    lam, phi = F.radians(lon - p.lon_0), F.radians(lat * south)
    if p.kind == "longlat":
        return lon, lat
    s = F.sin(phi)
    ts = math.radians(abs(p.lat_ts))
    m = math.cos(ts) / math.sqrt(1 - (e * math.sin(ts)) ** 2)
    q = (s / (1 - s * s * (e * e)) - F.log((1 - s * e) / (1 + s * e)) / (2 * e)) * (1 - e * e)
    q_pole = (1 - e * e) * (1 / (1 - e * e) - math.log((1 - e) / (1 + e)) / (2 * e))
    if p.kind == "cea":
        return lam * (a * m), q * (a / (2 * m))
    if p.kind == "stere":
        t_ts = math.tan(math.pi / 4 - ts / 2) / ((1 - e * math.sin(ts)) / (1 + e * math.sin(ts))) ** (e / 2)
        rho = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - s * e) / (1 + s * e), F.lit(e / 2)) * (a * m / t_ts)
    else:
        rho = F.sqrt(F.lit(q_pole) - q) * a
    return rho * F.sin(lam), rho * F.cos(lam) * -south


@query("grid_stats", sql("b_src b_tgt", """
    SELECT round(cos(radians(m)) * 5 * 112e3, 4) AS min_spacing_m, 560000.0::DOUBLE AS max_spacing_m, r AS max_radius_m,
           CAST(greatest(1, least(100, floor(power(r * 2 / (cos(radians(m)) * 5 * 112e3), 2)))) AS INTEGER) AS neighbours
    FROM (SELECT max(abs(lat)) AS m FROM b_src), (SELECT max(radius_m) AS r FROM b_tgt)"""))
def grid_stats(v: Views):
    """Source spacing bounds, largest radius, neighbour bound."""
    return grids.grid_stats(v.src, v.tgt, 5.0, cap=100).withColumn("min_spacing_m", F.round("min_spacing_m", 4))


@query("radius_coalesce", sql("", """
    SELECT s_suppkey, coalesce(CASE WHEN s_suppkey % 4 = 0 THEN 10.0::DOUBLE END, CASE WHEN s_suppkey % 4 = 1 THEN 20.0::DOUBLE END,
        CASE WHEN s_suppkey % 4 = 2 THEN 0.5::DOUBLE * sqrt(s_suppkey) END) AS radius_m FROM supplier"""))
def radius_coalesce(v: Views):
    """Radius from whichever measure is there."""
    k = F.col("s_suppkey")
    rows = v.table("supplier").select(
        "s_suppkey", F.when(k % 4 == 0, 10.0).alias("effective_grid_radius"), F.when(k % 4 == 1, 20.0).alias("RAD"),
        F.when(k % 4 == 2, k.cast("double")).alias("rA"))
    return rows.select("s_suppkey", grids.target_radius(rows.columns).alias("radius_m"))


@query("grid_scan", sql("b_tgt", "SELECT cell_id, lon, lat, radius_m FROM b_tgt"))
def grid_scan(v: Views):
    """Target cells with the required columns."""
    return grids.require_columns(v.tgt, ["cell_id", "lon", "lat", "radius_m"])


@query("grid_merge_coords", sql("", """
    SELECT s_suppkey, s_acctbal, CAST(s_suppkey // 10 AS BIGINT) AS y, CAST(s_suppkey % 10 AS BIGINT) AS x FROM supplier"""))
def grid_merge_coords(v: Views):
    """Coordinates and variables of one grid side by side."""
    s = v.table("supplier")
    y, x = F.floor(F.col("s_suppkey") / 10).alias("y"), (F.col("s_suppkey") % 10).alias("x")
    return src_cells.merge_on_coordinates(s.select(y, x, "s_suppkey"), s.select(y, x, "s_acctbal"))


@query("map_radius", sql("m_radius", "SELECT cell_id, src_id, rank FROM m_radius WHERE rank <= 100"))
def map_radius(v: Views):
    """Sources within each target's radius, at most 100 on request, closest first."""
    return mapping.radius_pairs(v.tgt, v.src, max_neighbours=100).select("cell_id", "src_id", "rank")


@query("map_topk", sql("m_radius", "SELECT cell_id, src_id, rank FROM m_radius WHERE rank <= 3"))
def map_topk(v: Views):
    """The three closest sources within the radius."""
    return mapping.radius_pairs(v.tgt, v.src, max_neighbours=3).select("cell_id", "src_id", "rank")


@query("map_unlimited", sql("m_radius", "SELECT cell_id, src_id, rank FROM m_radius"))
def map_unlimited(v: Views):
    """Every source within the radius."""
    return mapping.radius_pairs(v.tgt, v.src, max_neighbours=None).select("cell_id", "src_id", "rank")


@query("map_dense", sql("b_src b_tgt", f"""
    WITH s AS (SELECT src_id, 10.0 + (src_id % 97) * 1e-4 AS lon, 45.0 + (src_id % 89) * 1e-4 AS lat FROM b_src),
    t AS (SELECT cell_id, 10.0 + (cell_id % 13 - 6) * 3e-3 AS lon, 45.0 + (cell_id % 7 - 3) * 3e-3 AS lat FROM b_tgt),
    d AS (SELECT cell_id, src_id, round({R} * sqrt(pow(cos(radians(s.lat)) * cos(radians(s.lon)) - cos(radians(t.lat)) * cos(radians(t.lon)), 2)
      + pow(cos(radians(s.lat)) * sin(radians(s.lon)) - cos(radians(t.lat)) * sin(radians(t.lon)), 2) + pow(sin(radians(s.lat)) - sin(radians(t.lat)), 2)), 3) AS dist_m FROM s, t)
    SELECT cell_id, CAST(row_number() OVER (PARTITION BY cell_id ORDER BY dist_m) AS INTEGER) AS rank, CAST(round(dist_m * 1000) AS BIGINT) // 100 AS dist_dm FROM d QUALIFY rank <= 10"""))
def map_dense(v: Views):
    """The ten closest distances of targets in and beside a place where all sources crowd."""
    s = v.src.select("src_id", (10.0 + (F.col("src_id") % 97) * 1e-4).alias("lon"), (45.0 + (F.col("src_id") % 89) * 1e-4).alias("lat"))
    t = v.tgt.select("cell_id", (10.0 + (F.col("cell_id") % 13 - 6) * 3e-3).alias("lon"), (45.0 + (F.col("cell_id") % 7 - 3) * 3e-3).alias("lat"))
    near = mapping.nearest_within(t, s, F.lit(100_000.0), 10)
    return near.select("cell_id", "rank", F.floor(F.round(F.col("dist_m") * 1000) / 100).alias("dist_dm"))


@query("map_nearest", sql("m_nearest", "SELECT cell_id, src_id FROM m_nearest"))
def map_nearest(v: Views):
    """The closest source within the source spacing."""
    return mapping.nearest_pairs(v.tgt, v.src, v.MAX_SPACING_M).select("cell_id", "src_id")


@query("map_count", sql("b_tgt m_radius", """
    SELECT cell_id, count(src_id) AS n_src FROM b_tgt LEFT JOIN m_radius USING (cell_id) GROUP BY cell_id"""))
def map_count(v: Views):
    """Sources per target, zeros included."""
    return mapping.source_counts(v.tgt, mapping.radius_pairs(v.tgt, v.src, None))


@query("mapping_table", sql("m_all", "SELECT cell_id, src_id, kind FROM m_all"))
def mapping_table(v: Views):
    """Radius pairs, and the nearest source of targets without any."""
    return mapping.build_mapping(v.tgt, v.src, v.MAX_SPACING_M).select("cell_id", "src_id", "kind")


@query("mapping_reuse", sql("m_all", "SELECT kind, count(*) AS n, count(DISTINCT cell_id) AS cells FROM m_all GROUP BY kind"))
def mapping_reuse(v: Views):
    """A stored mapping is built once and read back."""
    path = shared_dir(v.spark, "mapping")
    key = ("DS0", "grid1", "nh", 1.5)
    for _ in range(2):
        stored = mapping.ensure_mapping(v.spark, path, key, v.tgt, v.src, v.MAX_SPACING_M)
    return stored.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("cell_id").alias("cells"))


def _mapping_keys(v: Views):
    return v.granule.select("ds", F.lit("grid1").alias("grid"), "hemi", F.lit("1.0").alias("t_version")).distinct()


@query("mapping_requests", sql("b_granule", """
    SELECT ds, 'grid1' AS grid, hemi, '1.0' AS t_version, count(*) AS granules FROM b_granule WHERE ds <> 'DS1' OR hemi <> 'nh' GROUP BY ALL"""))
def mapping_requests(v: Views):
    """Mappings the granules need that are not stored."""
    want = _mapping_keys(v)
    stored = want.filter((F.col("ds") == "DS1") & (F.col("hemi") == "nh"))
    need = mapping.missing_mappings(want, stored)
    return v.granule.join(need, ["ds", "hemi"]).groupBy("ds", "grid", "hemi", "t_version").agg(F.count(F.lit(1)).alias("granules"))


@query("mapping_invalidate", sql("b_granule", "SELECT DISTINCT ds, hemi FROM b_granule WHERE ds <> 'DS2'"))
def mapping_invalidate(v: Views):
    """Stored mappings left after one dataset's are invalidated."""
    return mapping.without_mappings(_mapping_keys(v), ds="DS2").select("ds", "hemi")


def _regrid_sql(value: str, extra: str = "") -> str:
    return sql("b_obs m_all", f"""
        SELECT field, cell_id, round({value}, 8) AS value FROM b_obs JOIN m_all USING (src_id) {extra} GROUP BY field, cell_id""")


def _regrid(v: Views, op: str, **kw):
    out = regrid.regrid(v.obs, v.packs, ["field"], op, ties=["event_id"], **kw)
    return out.withColumn("value", F.round("value", 8))


_STRICT = "CASE WHEN count(value) = count(*) THEN {}(value) END"
for _op, _sql in (
    ("mean", _STRICT.format("avg")), ("nanmean", "avg(value)"),
    ("median", _STRICT.format("median")), ("nanmedian", "median(value)"),
):
    query(f"regrid_{_op}", _regrid_sql(_sql))(lambda v, o=_op: _regrid(v, o))


def _price_medians(v: Views, strict: bool):
    """Medians of few, very large groups: each is cut down to what a task may hold."""
    price = F.when(F.col("l_returnflag") == "A", F.floor(F.col("l_extendedprice") / 10000) * 10000.0).otherwise(F.col("l_extendedprice"))
    price = F.when((F.col("l_returnflag") != "N") | (F.col("l_linenumber") != 7), price)
    rows = v.lineitem.select("l_returnflag", "l_linestatus", price.alias("value"))
    out = bounded_median(rows, ["l_returnflag", "l_linestatus"], strict=strict, held=4096)
    return out.select("l_returnflag", "l_linestatus", F.round("value", 6).alias("value"))


def _price_sql(middle: str) -> str:
    return sql("", f"""
        SELECT l_returnflag, l_linestatus, round({middle}, 6) AS value
        FROM (SELECT l_returnflag, l_linestatus, CASE WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN NULL
              WHEN l_returnflag = 'A' THEN floor(l_extendedprice / 10000) * 10000 ELSE l_extendedprice END AS value FROM lineitem) GROUP BY ALL""")


query("median_large_groups", _price_sql("median(value)"))(lambda v: _price_medians(v, False))
query("median_large_groups_strict", _price_sql(_STRICT.format("median")))(lambda v: _price_medians(v, True))


@query("regrid_nearest", sql("b_obs m_all", """
    SELECT field, cell_id, round(value, 8) AS value FROM b_obs JOIN m_all USING (src_id)
    QUALIFY row_number() OVER (PARTITION BY field, cell_id ORDER BY dist_m, src_id, event_id) = 1"""))
def regrid_nearest(v: Views):
    """Value of the closest source."""
    return _regrid(v, "nearest")


@query("regrid_no_fallback", _regrid_sql("avg(value)", "WHERE kind = 'radius'"))
def regrid_no_fallback(v: Views):
    """Without the nearest fallback only targets with sources in radius come out."""
    return _regrid(v, "nanmean", allow_nearest=False)


@query("regrid_fallback", _regrid_sql("avg(value)", "WHERE kind = 'nearest'"))
def regrid_fallback(v: Views):
    """Values that come from the nearest fallback alone."""
    only = v.mapping.filter(F.col("kind") == "nearest")
    return regrid.regrid(v.obs, only, ["field"], "nanmean").withColumn("value", F.round("value", 8))


@query("regrid_shuffled", _regrid_sql("avg(value)"))
def regrid_shuffled(v: Views):
    """The same result by the salted shuffle join that a large mapping takes."""
    return _regrid(v, "nanmean", broadcast_limit=-1)


@query("regrid_full_grid", sql("b_obs b_tgt m_all", """
    SELECT f.field, t.cell_id, round(avg(value), 8) AS value
    FROM (SELECT DISTINCT field FROM b_obs) f CROSS JOIN b_tgt t
    LEFT JOIN (SELECT field, cell_id, value FROM b_obs JOIN m_all USING (src_id)) r USING (field, cell_id) GROUP BY f.field, t.cell_id"""))
def regrid_full_grid(v: Views):
    """Every target cell of every record."""
    grid = F.lit("suppliers").alias("grid")
    records = v.obs.select("field").distinct().select("field", grid)
    out = regrid.on_full_grid(regrid.regrid(v.obs, v.packs, ["field"], "nanmean"), v.tgt.select("cell_id", grid), records, ["field"])
    return out.select("field", "cell_id", F.round("value", 8).alias("value"))


@query("record_minmax", sql("b_obs m_all", """
    SELECT field, round(min(m), 8) AS valid_min, round(max(m), 8) AS valid_max, count(m) AS n_valid, count(m) > 0 AS has_data
    FROM (SELECT field, cell_id, avg(value) AS m FROM b_obs JOIN m_all USING (src_id) GROUP BY ALL) GROUP BY field"""))
def record_minmax(v: Views):
    """Valid range of each regridded record."""
    out = regrid.record_stats(regrid.regrid(v.obs, v.packs, ["field"], "nanmean"), ["field"])
    return out.drop("notes").withColumns({c: F.round(c, 8) for c in ("valid_min", "valid_max")})


@query("record_empty", sql("b_val", """
    SELECT user_id, count(value) > 0 AS has_data, CASE WHEN count(value) > 0 THEN '' ELSE ' -- empty record -- ' END AS notes
    FROM (SELECT user_id, CASE WHEN event_type = 'error' THEN value END AS value FROM b_val) GROUP BY user_id"""))
def record_empty(v: Views):
    """Records without any value carry a note."""
    rows = v.value_events.select("user_id", F.when(F.col("event_type") == "error", F.col("value")).alias("value"))
    return regrid.record_stats(rows, ["user_id"]).select("user_id", "has_data", "notes")


@query("llc_compact_index", sql("", """
    SELECT p_partkey, CASE WHEN tile <= 6 THEN tile * 8 + j WHEN tile <= 9 THEN 56 + 3 * j + tile - 7 ELSE 80 + 3 * j + tile - 10 END AS row_no,
        (CASE WHEN tile <= 6 THEN tile * 8 + j WHEN tile <= 9 THEN 56 + 3 * j + tile - 7 ELSE 80 + 3 * j + tile - 10 END) * 8 + i AS position
    FROM (SELECT p_partkey, (p_partkey // 64) % 13 AS tile, (p_partkey // 8) % 8 AS j, p_partkey % 8 AS i FROM part)"""))
def llc_compact_index(v: Views):
    """Row and place of tiled cells in the compact layout."""
    k = F.col("p_partkey")
    tile, j, i = F.floor(k / 64) % 13, F.floor(k / 8) % 8, k % 8
    return v.table("part").select(
        "p_partkey", layout.llc_row(tile, j, 8).alias("row_no"), layout.flat_index("llc", 8, j, i, tile).alias("position"))


@query("pack_record", sql("b_val", """
    SELECT event_type, b AS block, b * 16384 AS offset, 16384 AS n_bytes
    FROM (SELECT DISTINCT event_type, event_id // 4096 AS b FROM b_val) ORDER BY ALL"""))
def pack_record(v: Views):
    """Blocks of big-endian floats, one record per event type, with their offsets."""
    n = v.events.count()
    n_cells = -(-n // 4096) * 4096
    rows = v.value_events.select("event_type", "event_id", "value")
    blocks = pack_records(rows, ["event_type"], F.col("event_id"), n_cells, block_cells=4096)
    return blocks.select("event_type", "block", "offset", F.octet_length("data").alias("n_bytes"))


@query("pack_record_bytes", sql("b_val", """
    WITH n AS (SELECT count(*) AS cells FROM events), b AS (SELECT DISTINCT event_type, event_id // 4096 AS block FROM b_val),
    p AS (SELECT event_type, CAST(unnest(range(block * 4096, least((block + 1) * 4096, cells))) AS BIGINT) AS position FROM b, n)
    SELECT p.event_type, position, CAST(coalesce(CAST(value AS FLOAT), -9999) AS DOUBLE) AS value
    FROM p LEFT JOIN b_val v ON v.event_type = p.event_type AND v.event_id = p.position"""))
def pack_record_bytes(v: Views):
    """The values read back from the packed bytes of every block, fill values included."""
    n_cells = v.events.count()
    rows = v.value_events.select("event_type", "event_id", "value")
    blocks = pack_records(rows, ["event_type"], F.col("event_id"), n_cells, block_cells=4096)
    return unpack_blocks(blocks, ["event_type"])


