"""The derived views as SQL, and a helper that puts the ones a text needs in front of it."""

from __future__ import annotations

from tidegrid.functions.geo import SPHERE_RADIUS_M

R = repr(SPHERE_RADIUS_M)
TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "b_val": ((), """
        SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value
        FROM events"""),
    "b_obs": (("b_val",), """
        SELECT event_id, event_id % (SELECT count(*) FROM part) AS src_id, event_type AS field, value FROM b_val"""),
    "b_rec": (("b_val",), """
        SELECT event_type AS field, CAST(ts AS DATE) AS date,
               CASE WHEN event_id % 2 = 0 THEN 'nh' ELSE 'sh' END AS hemi, user_id AS cell_id, value
        FROM b_val
        QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), event_id % 2, user_id
                                   ORDER BY event_id DESC) = 1"""),
    "b_series": (("b_rec",), """
        SELECT field, date, cell_id,
               coalesce(max(value) FILTER (hemi = 'nh'), max(value) FILTER (hemi = 'sh')) AS value
        FROM b_rec GROUP BY field, date, cell_id"""),
    "b_src": ((), """
        SELECT p_partkey AS src_id, CAST((p_partkey * 37) % 360 - 180 AS DOUBLE) + 0.5 AS lon,
               CAST((p_partkey * 17) % 160 - 80 AS DOUBLE) + 0.5 AS lat FROM part"""),
    "b_tgt": ((), """
        SELECT s_suppkey AS cell_id, CAST((s_suppkey * 29) % 360 - 180 AS DOUBLE) AS lon,
               CAST((s_suppkey * 13) % 160 - 80 AS DOUBLE) AS lat,
               CAST(200000 + (s_suppkey % 5) * 100000 AS DOUBLE) AS radius_m FROM supplier"""),
    "b_dist": (("b_src", "b_tgt"), f"""
        SELECT cell_id, src_id, radius_m, round(sqrt((sx-tx)*(sx-tx) + (sy-ty)*(sy-ty) + (sz-tz)*(sz-tz)), 3) AS dist_m
        FROM (SELECT src_id, cos(radians(lat)) * cos(radians(lon)) * {R} AS sx,
                     cos(radians(lat)) * sin(radians(lon)) * {R} AS sy, sin(radians(lat)) * {R} AS sz FROM b_src) s,
             (SELECT cell_id, radius_m, cos(radians(lat)) * cos(radians(lon)) * {R} AS tx,
                     cos(radians(lat)) * sin(radians(lon)) * {R} AS ty, sin(radians(lat)) * {R} AS tz FROM b_tgt) t"""),
    "m_radius": (("b_dist",), """
        SELECT cell_id, src_id, dist_m, CAST(row_number() OVER (PARTITION BY cell_id ORDER BY dist_m, src_id) AS INTEGER) AS rank
        FROM b_dist WHERE dist_m <= radius_m"""),
    "m_nearest": (("b_dist",), """
        SELECT cell_id, src_id, dist_m FROM b_dist WHERE dist_m <= 560000
        QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY dist_m, src_id) = 1"""),
    "m_all": (("m_radius", "m_nearest"), """
        SELECT cell_id, src_id, dist_m, 'radius' AS kind FROM m_radius
        UNION ALL
        SELECT cell_id, src_id, dist_m, 'nearest' FROM m_nearest
        WHERE cell_id NOT IN (SELECT cell_id FROM m_radius)"""),
    "b_granule": ((), """
        SELECT 'I' || o_orderkey AS id, 'DS' || (o_orderkey % 5) AS ds,
               'G' || o_orderkey || '_' || CASE WHEN o_orderkey % 2 = 0 THEN 'nh' ELSE 'sh' END || '_'
                   || strftime(o_orderdate, '%Y%m%d') || '.nc' AS filename,
               'G' || o_orderkey || '.nc' AS short,
               CASE WHEN o_orderkey % 2 = 0 THEN 'nh' ELSE 'sh' END AS hemi, o_orderdate AS date,
               o_orderdate + to_days(CAST(o_orderkey % 40 AS INTEGER)) AS mod_time,
               o_orderdate + to_days(CAST(o_orderkey % 35 AS INTEGER)) AS download_time,
               CASE WHEN o_orderpriority <> '5-LOW' OR o_orderstatus <> 'F' THEN
                   '/data/DS' || (o_orderkey % 5) || '/G' || o_orderkey || '_'
                   || CASE WHEN o_orderkey % 2 = 0 THEN 'nh' ELSE 'sh' END || '_' || strftime(o_orderdate, '%Y%m%d') || '.nc'
                   ELSE '' END AS path,
               CAST(o_custkey % 3 AS VARCHAR) AS checksum, CAST(floor(o_totalprice / 1000) AS BIGINT) AS size,
               o_orderstatus <> 'P' AS success,
               CASE WHEN o_orderstatus <> 'P' THEN '' ELSE 'download failed: ' || o_orderpriority END AS message,
               o_orderkey, o_orderstatus
        FROM orders"""),
    "b_tx": ((), """
        SELECT 'DS' || (l_orderkey % 5) AS ds, 'G' || l_orderkey || '.nc' AS filename, l_returnflag AS grid,
               l_linestatus AS field, l_shipdate AS date, l_shipdate AS started,
               l_shipdate + to_days(l_linenumber) AS completed, l_discount < 0.09 AS success,
               CAST(1 + l_linenumber % 2 AS DOUBLE) AS version, CAST(l_partkey % 3 AS VARCHAR) AS origin_checksum,
               CASE WHEN l_discount >= 0.09 THEN 'failed at ' || (l_suppkey % 7)
                    WHEN l_tax > 0.07 THEN 'field missing' ELSE '' END AS message,
               'TG' || l_orderkey || '.nc' || l_returnflag || l_linestatus AS id
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag, l_linestatus
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC) = 1"""),
    "b_agg": (("b_tx",), """
        SELECT ds || '-' || grid || '-' || field || '-' || year AS id, ds, grid, field, year, success,
               last + to_days(3) AS agg_time, CASE WHEN year <= 1997 THEN '1.0' ELSE '2.0' END AS version,
               CASE WHEN success THEN '' ELSE 'too many failures' END AS message
        FROM (SELECT ds, grid, field, CAST(year(date) AS INTEGER) AS year, max(date) AS last,
                     count(*) FILTER (success) * 100 >= count(*) * 82 AS success
              FROM b_tx GROUP BY ALL)
        WHERE grid <> 'N' OR year % 3 <> 0"""),
    "b_cfg": ((), """
        SELECT 'DS' || n_nationkey AS ds,
               CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE 'V' || n_regionkey END AS variable,
               n_nationkey <> 4 AS active, CAST(1 + n_nationkey % 2 AS DOUBLE) AS t_version, '2.0' AS a_version
        FROM nation"""),
}


def sql(needs: str, body: str) -> str:
    """``body`` with the views named in ``needs`` (and theirs) as common table expressions."""
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in VIEWS[name][0]:
            visit(dep)
        if name not in order:
            order.append(name)

    for name in needs.split():
        visit(name)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1].strip()})" for n in order)
    body = body.strip()
    if not order:
        return body
    return f"WITH {ctes}" + (f",\n{body[5:]}" if body.startswith("WITH ") else f"\n{body}")
