"""Listing pages, file names, selection strategies."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegrid.functions import text
from tidegrid.operators import harvest
from tidegrid.schemas import DatasetConfig, FieldConfig
from tidegrid.sources import listings
from tidegrid.workload.registry import Views, query, ts_text
from tidegrid.workload.sqltext import TS, sql

def _key():
    return F.col("o_orderkey").cast("string")


def _orders(v: Views):
    """Orders spread over tasks: parsing is CPU work and the table is a single row group."""
    return v.spread(v.orders, "o_orderkey")


@query("listing_links", sql("", r"""
    SELECT page_id, CAST(i - 1 AS INTEGER) AS position, hrefs[i] AS href
    FROM (SELECT page_id, hrefs, unnest(range(2, len(hrefs) + 1)) AS i
          FROM (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>[^<]*</a>([^<]*)', 1) AS hrefs FROM pages))"""))
def listing_links(v: Views):
    """Anchors of whole pages after the first (these pages have plain anchors only; see listing_links_large)."""
    pages = v.table("pages").select("page_id", "url", F.col("html").alias("body"))
    return listings.entries_links(pages).select("page_id", "position", "href")


def _dir_pages(v: Views):
    day = F.date_format("o_orderdate", "dd-MMM-yyyy")
    link = lambda h: F.concat(F.lit('<a href="G'), _key(), F.lit(f'_{h}.nc">G</a>  '), day, F.lit(" 03:0"), (F.col("o_orderkey") % 10).cast("string"), F.lit("  12K\n"))
    return _orders(v).select(
        "o_orderkey", F.concat(F.lit("https://host/list/"), _key(), F.lit("/")).alias("url"),
        F.concat(F.lit('<pre><a href="../">Parent</a> -\n'), link("nh"), link("sh"), F.lit("</pre>")).alias("body"))


@query("listing_links_dated", sql("", """
    SELECT o_orderkey, CAST(p AS INTEGER) AS position,
           'https://host/list/' || o_orderkey || '/G' || o_orderkey || CASE WHEN p = 1 THEN '_nh.nc' ELSE '_sh.nc' END AS url,
           strftime(o_orderdate, '%Y-%m-%d') || ' 03:0' || (o_orderkey % 10) || ':00' AS mod_time
    FROM orders, (VALUES (1), (2)) x(p)"""))
def listing_links_dated(v: Views):
    """Directory pages with modification times."""
    rows = listings.entries_links(_dir_pages(v))
    return rows.select("o_orderkey", "position", "url", ts_text("mod_time").alias("mod_time"))


# Order keys of a page of the long listings; a page has one entry per order at most.
PAGE_KEYS = 1500


def _pages_by(v: Views, begin: str, entry, end: str):
    """Pages of some hundred entries: the orders of one customer segment and ``PAGE_KEYS`` order keys, in order of their keys."""
    rows = _by_segment(v).withColumn("e", entry)
    entries = F.sort_array(F.collect_list(F.struct("o_orderkey", "e")))
    return rows.groupBy("c_mktsegment", "page").agg(entries.alias("entries")).select(
        "c_mktsegment", "page", F.lit("https://host/list/").alias("url"),
        F.concat(F.lit(begin), F.array_join(F.transform("entries", lambda x: x["e"]), ""), F.lit(end)).alias("body"))


def _by_segment(v: Views):
    segments = v.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return v.orders.join(segments, "o_custkey").withColumn("page", F.floor(F.col("o_orderkey") / PAGE_KEYS))


def _entries_before(v: Views):
    """(c_mktsegment, page, before): entries on the earlier pages of a segment; a row per page, so the window is small."""
    earlier = Window.partitionBy("c_mktsegment").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    counts = _by_segment(v).groupBy("c_mktsegment", "page").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("c_mktsegment", "page", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


_BY_SEGMENT = "orders JOIN customer ON c_custkey = o_custkey"


@query("listing_links_large", sql("", f"""
    SELECT c_mktsegment, CAST(row_number() OVER (PARTITION BY c_mktsegment ORDER BY o_orderkey) AS INTEGER) AS position,
           'https://host/list/a&b/G' || o_orderkey || '.nc' AS url, strftime(o_orderdate, '%Y-%m-%d') || ' 03:04:00' AS mod_time
    FROM {_BY_SEGMENT}"""))
def listing_links_large(v: Views):
    """Long pages with nested markup, capitals and every kind of quotes."""
    day, k = F.date_format("o_orderdate", "dd-MMM-yyyy"), F.col("o_orderkey") % 4
    name = F.concat(F.lit("a&amp;b/G"), _key(), F.lit(".nc"))
    tag = F.when(k == 0, F.concat(F.lit('<A title="x > y" HREF="'), name, F.lit('"><B>file</B> <i>x</i></A>')))
    tag = tag.when(k == 1, F.concat(F.lit("<a\nhref = '"), name, F.lit("' class=c>file</a >")))
    tag = tag.when(k == 2, F.concat(F.lit("<a href="), name, F.lit(">file <img src='p.gif'></a>")))
    tag = tag.otherwise(F.concat(F.lit('<a data-href="no" href="'), name, F.lit('">file</a>')))
    pages = _pages_by(v, '<abbr>no</abbr><!-- <a href="no">no</a> --><a href="../">Up</a>', F.concat(tag, F.lit("  "), day, F.lit(" 03:04  1K\n")), "")
    rows = listings.entries_links(pages).join(_entries_before(v), ["c_mktsegment", "page"])
    position = (F.col("before") + F.col("position")).cast("int")
    return rows.select("c_mktsegment", position.alias("position"), "url", ts_text("mod_time").alias("mod_time"))


@query("listing_xml_large", sql("", f"""
    SELECT c_mktsegment, 'https://s/d&e/G' || o_orderkey || '.nc' AS url,
           CASE WHEN o_orderkey % 5 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 07:08:09' END AS mod_time FROM {_BY_SEGMENT}"""))
def listing_xml_large(v: Views):
    """Long catalogues, entries one to four levels below the outermost one, some without a date."""
    k, depth = F.col("o_orderkey") % 5, (F.col("o_orderkey") % 4).cast("int")
    date = F.when(k != 0, F.concat(F.lit("<date type='modified'> "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T07:08:09Z </date>"))).otherwise("")
    item = F.concat(F.lit("<t:dataset name='a>b' urlPath=\""), F.lit("d&amp;e/G"), _key(), F.lit('.nc">'), date, F.lit("</t:dataset>"))
    nest = F.concat(F.repeat(F.lit("<dataset name='n'><date>2001-01-01T00:00:00Z</date>"), depth), item, F.repeat(F.lit("</dataset>"), depth))
    pages = _pages_by(v, "<catalog xmlns:t='u'><dataset urlPath='outermost'><date>2001-01-01T00:00:00Z</date><dataset name='empty'/>", nest, "</dataset></catalog>")
    return listings.entries_xml(pages, "https://s/").select("c_mktsegment", "url", ts_text("mod_time").alias("mod_time"))


@query("listing_json_large", sql("", f"""
    SELECT c_mktsegment, 'G' || o_orderkey AS id,
           strftime(o_orderdate, '%Y-%m-%d') || ' 04:05:06.' || rpad(substr('123456', 1, CAST(1 + o_orderkey % 6 AS INTEGER)), 6, '0') AS mod_time FROM {_BY_SEGMENT}"""))
def listing_json_large(v: Views):
    """Long result pages; update times with one to six digits of a second's fraction."""
    digits = F.substring(F.lit("123456"), F.lit(1), (F.col("o_orderkey") % 6 + 1).cast("int"))
    entry = F.to_json(F.struct(
        F.concat(F.lit("G"), _key()).alias("id"), F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T04:05:06."), digits, F.lit("Z")).alias("updated"),
        F.array(F.struct(F.lit(listings.DATA_RELATION).alias("rel"), F.lit("https://provA/x").alias("href"))).alias("links")))
    pages = _pages_by(v, "[", F.concat(entry, F.lit(",")), '{"id": "last"}]')
    rows = listings.entries_json(pages, "provA").filter("reject_reason IS NULL")
    return rows.select("c_mktsegment", "id", F.date_format("mod_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("mod_time"))


@query("listing_year_folders", sql("", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
    WHERE year(o_orderdate) BETWEEN 1996 AND 1999"""))
def listing_year_folders(v: Views):
    """Year folders inside the configured range."""
    pages = v.orders.select(
        "o_orderkey", F.lit("https://host/list").alias("url"),
        F.concat(F.lit('<a href="../">Up</a><a href="'), F.year("o_orderdate").cast("string"), F.lit('/">y</a>')).alias("body"))
    rows = listings.year_folders(pages, "19960101T00:00:00Z", "19991231T00:00:00Z")
    return rows.select("o_orderkey", "year")


@query("listing_json", sql("", """
    SELECT o_orderkey, 'E' || o_orderkey AS id, 'https://provA/d/G' || o_orderkey || '.nc' AS url,
           strftime(o_orderdate, '%Y-%m-%d') || ' 04:05:06' AS mod_time, CAST(NULL AS VARCHAR) AS reject_reason FROM orders
    UNION ALL
    SELECT o_orderkey, 'X' || o_orderkey, NULL, strftime(o_orderdate, '%Y-%m-%d') || ' 04:05:06',
           'no data link for provider' FROM orders"""))
def listing_json(v: Views):
    """Search results with a data link of the provider, and rejected ones without."""
    entry = lambda i, link: F.struct(
        F.concat(F.lit(i), _key()).alias("id"), F.lit("C1").alias("collection_concept_id"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T04:05:06.000Z")).alias("updated"),
        F.array(
            F.struct(F.lit("http://other/rel#").alias("rel"), F.concat(F.lit("https://provA/x/"), _key()).alias("href")),
            F.struct(F.lit(listings.DATA_RELATION).alias("rel"), F.concat(F.lit("https://provB/d/G"), _key()).alias("href")),
            F.struct(F.lit(link).alias("rel"), F.concat(F.lit("https://provA/d/G"), _key(), F.lit(".nc")).alias("href")),
        ).alias("links"))
    body = F.to_json(F.array(entry("E", listings.DATA_RELATION), entry("X", "http://other/rel#")))
    pages = _orders(v).select("o_orderkey", F.lit("https://api/search").alias("url"), body.alias("body"))
    rows = listings.entries_json(pages, "provA")
    return rows.select("o_orderkey", "id", "url", ts_text("mod_time").alias("mod_time"), "reject_reason")


@query("listing_rejected", sql("", """
    SELECT count(*) AS n_orders, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders"""))
def listing_rejected(v: Views):
    """Rows split off because they have no address."""
    entry = F.struct(
        F.concat(F.lit("X"), _key()).alias("id"), F.lit("2020-01-01T00:00:00.000Z").alias("updated"),
        F.array(F.struct(F.lit("none").alias("rel"), F.lit("https://provA/").alias("href"))).alias("links"))
    pages = v.orders.select("o_orderkey", F.to_json(F.array(entry)).alias("body"))
    _, bad = listings.split_rejected(listings.entries_json(pages, "provA"))
    return bad.agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_orderkey").alias("key_sum"))


@query("listing_xml", sql("", """
    SELECT o_orderkey, 'https://files/server/d/G' || o_orderkey || '_' || p || '.nc' AS url,
           strftime(o_orderdate, '%Y-%m-%d') || ' 07:08:0' || p AS mod_time
    FROM orders, (VALUES (1), (2)) x(p)"""))
def listing_xml(v: Views):
    """Nested catalogue entries, default namespace included."""
    item = lambda p: F.concat(
        F.lit('<dataset name="a" urlPath="d/G'), _key(), F.lit(f'_{p}.nc"><dataSize units="Mbytes">1</dataSize><date type="modified">'),
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(f"T07:08:0{p}Z</date></dataset>"))
    body = F.concat(
        F.lit('<catalog xmlns="http://www.unidata.ucar.edu/namespaces/thredds/InvCatalog/v1.0" xmlns:xlink="http://www.w3.org/1999/xlink">'
              '<dataset name="top">'), item(1), item(2), F.lit("</dataset></catalog>"))
    pages = _orders(v).select("o_orderkey", F.lit("https://files/catalog.xml").alias("url"), body.alias("body"))
    rows = listings.entries_xml(pages, "https://files/server/")
    return rows.select("o_orderkey", "url", ts_text("mod_time").alias("mod_time"))


@query("listing_xml_refs", sql("", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS title FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999
    UNION ALL SELECT o_orderkey, 'reprocessed' FROM orders"""))
def listing_xml_refs(v: Views):
    """Catalogue folders by year; text titles stay, monthly ones go."""
    ref = lambda t: F.concat(F.lit('<catalogRef xlink:title="'), t, F.lit('" xlink:href="x"/>'))
    body = F.concat(
        F.lit('<catalog xmlns="http://c" xmlns:xlink="http://www.w3.org/1999/xlink">'),
        ref(F.year("o_orderdate").cast("string")), ref(F.lit("monthly")), ref(F.lit("reprocessed")), F.lit("</catalog>"))
    pages = _orders(v).select("o_orderkey", body.alias("body"))
    return listings.catalog_refs(pages, "19960101T00:00:00Z", "19991231T00:00:00Z")


@query("listing_month_folders", sql("", """
    SELECT o_orderkey FROM orders
    WHERE CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) BETWEEN 199603 AND 199910"""))
def listing_month_folders(v: Views):
    """Month folders inside the configured range."""
    refs = v.orders.select(
        "o_orderkey", F.year("o_orderdate").cast("string").alias("year"), F.date_format("o_orderdate", "MM").alias("title"))
    start, end = "19960301T00:00:00Z", "19991031T00:00:00Z"
    return listings.months_in_range(refs, start, end).select("o_orderkey")


@query("listing_table_rows", sql("", """
    SELECT o_orderkey, CAST(p - 1 AS INTEGER) AS position, 'https://host/t/F' || o_orderkey || '_' || p || '.tgz' AS url,
           strftime(o_orderdate, '%Y-%m-%d') || ' 11:2' || p || ':00' AS mod_time
    FROM orders, (VALUES (1), (2)) x(p)"""))
def listing_table_rows(v: Views):
    """Table rows between the headers and the footer."""
    row = lambda p: F.concat(
        F.lit('<tr><td><img></td><td><a href="F'), _key(), F.lit(f'_{p}.tgz">F</a></td><td align="right">'),
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(f" 11:2{p}  </td><td>5M</td></tr>\n"))
    head = "<table><tr><th>Name</th></tr><tr><th><hr></th></tr><tr><td></td><td><a href=\"/\">Parent</a></td></tr>"
    body = F.concat(F.lit(head), row(1), row(2), F.lit("<tr><th><hr></th></tr></table>"))
    pages = _orders(v).select("o_orderkey", F.lit("https://host/t").alias("url"), body.alias("body"))
    return listings.entries_table(pages).select("o_orderkey", "position", "url", ts_text("mod_time").alias("mod_time"))


@query("filename_parts", sql("b_granule", """
    SELECT o_orderkey, filename AS base, replace(filename, '.nc', '') AS stem, CAST(year(date) AS INTEGER) AS year
    FROM b_granule"""))
def filename_parts(v: Views):
    """File name, stem and year folder."""
    g = v.granule.withColumn("url", F.concat(F.lit("https://h/"), "ds", F.lit("/"), "filename"))
    return g.select("o_orderkey", text.basename("url").alias("base"), text.stem("url").alias("stem"), F.year("date").alias("year"))


@query("filename_date", sql("b_granule", f"""
    SELECT o_orderkey, {TS.format('date')} AS ymd, {TS.format('date')} AS doy, {TS.format("date_trunc('month', date)")} AS ym,
           {TS.format('date')} AS full, CAST(NULL AS VARCHAR) AS absent FROM b_granule"""))
def filename_date(v: Views):
    """Dates in names, in the formats the configurations use."""
    d = lambda p: F.concat(F.lit("f_"), F.date_format("date", p), F.lit(".nc"))
    out = lambda p, rx, fmt: ts_text(text.filename_date(d(p), rx, fmt))
    return v.granule.select(
        "o_orderkey", out("yyyyMMdd", r"\d{8}", "%Y%m%d").alias("ymd"), out("yyyyDDD", r"\d{7}", "%Y%j").alias("doy"),
        out("yyyy_MM", r"\d{4}_\d{2}", "%Y_%m").alias("ym"), out("yyyyMMddHHmmss", r"\d{14}", "%Y%m%d%H%M%S").alias("full"),
        ts_text(text.filename_date(F.lit("no date"), r"\d{8}", "%Y%m%d")).alias("absent"))


@query("date_range_filter", sql("b_granule", f"""
    SELECT filename, {TS.format('date')} AS date FROM b_granule
    WHERE date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-06-30'"""))
def date_range_filter(v: Views):
    """Inclusive date range."""
    return v.granule.filter(text.in_range("date", "19960101T00:00:00Z", "19980630T00:00:00Z")).select("filename", ts_text("date").alias("date"))


@query("hemi_tag", sql("b_granule", "SELECT filename, hemi FROM b_granule"))
def hemi_tag(v: Views):
    """Hemisphere by file name pattern."""
    return v.granule.select("filename", text.hemi_tag("filename", "_nh_", "_sh_").alias("hemi"))


@query("exclude_tags", sql("", """
    SELECT o_orderkey FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')"""))
def exclude_tags(v: Views):
    """Near-real-time and fast-track files go."""
    p = F.col("o_orderpriority")
    tag = F.when(p == "1-URGENT", "NRT").when(p == "2-HIGH", "icdrft").otherwise("cdr")
    named = v.orders.withColumn("filename", F.concat(F.lit("ice_"), tag, F.lit("_"), _key()))
    return named.filter(text.without_tags("filename", (text.NEAR_REAL_TIME_TAG, text.FAST_TRACK_TAG))).select("o_orderkey")


@query("resolution_parse", sql("", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN (o_orderkey % 20 + 1) / 111.0
        WHEN o_orderstatus = 'O' THEN (o_orderkey % 8) / 8.0 ELSE NULL END AS res FROM orders"""))
def resolution_parse(v: Views):
    """Resolution text to number; unreadable text becomes missing."""
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    raw = (
        F.when(s == "F", F.concat((k % 20 + 1).cast("string"), F.lit(" / 111")))
        .when(s == "O", ((k % 8) / F.lit(8.0)).cast("string")).otherwise("coarse"))
    return v.orders.select("o_orderkey", text.resolution(raw).alias("res"))


CONFIG = DatasetConfig(
    ds="DSX", start="19950601T00:00:00Z", end="20001231T00:00:00Z", fields=(FieldConfig("value"),),
    date_regex=r"\d{8}", hemi_north="_nh_", hemi_south="_sh_")


@query("harvest_candidates", sql("b_granule", f"""
    SELECT filename, {TS.format('date')} AS date, hemi, CAST(year(date) AS INTEGER) AS year FROM b_granule
    WHERE date BETWEEN TIMESTAMP '1995-06-01' AND TIMESTAMP '2000-12-31'"""))
def harvest_candidates(v: Views):
    """Listing to candidate granules: name, date, hemisphere, range."""
    listing = v.granule.select(F.concat(F.lit("https://h/"), "filename").alias("url"), "mod_time")
    return harvest.candidates(listing, CONFIG).select("filename", ts_text("date").alias("date"), "hemi", "year")


_MONTHS = """
    WITH one AS (SELECT ds, CAST(date AS DATE) AS day, max(filename) AS url FROM b_granule GROUP BY ALL),
         span AS (SELECT ds, date_trunc('month', min(day)) AS m0, date_trunc('month', max(day)) AS m1 FROM one GROUP BY ds),
         spine AS (SELECT ds, CAST(unnest(generate_series(CAST(m0 AS TIMESTAMP), CAST(m1 AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month FROM span)
    SELECT spine.ds, CAST(month AS VARCHAR) AS month, url, CAST(day AS VARCHAR) AS date
    FROM spine JOIN one ON one.ds = spine.ds AND abs(date_diff('day', day, month)) <= 7
    QUALIFY row_number() OVER (PARTITION BY spine.ds, month ORDER BY abs(date_diff('day', day, month)), day) = 1"""


@query("month_nearest", sql("b_granule", "SELECT * FROM (" + _MONTHS + ")"))
def month_nearest(v: Views):
    """Per month, the granule closest to the first."""
    rows = v.granule.select("ds", F.col("filename").alias("url"), "date")
    return harvest.month_nearest(rows).select("ds", F.col("month").cast("string").alias("month"), "url", F.col("date").cast("string").alias("date"))


@query("month_nearest_legacy", sql("b_granule", """
    SELECT ds, month, url FROM (""" + _MONTHS + """)
    WHERE (ds, month) NOT IN (SELECT (ds, CAST(CAST(date_trunc('month', max(date)) AS DATE) AS VARCHAR)) FROM b_granule GROUP BY ds)"""))
def month_nearest_legacy(v: Views):
    """The same without the last month."""
    rows = v.granule.select("ds", F.col("filename").alias("url"), "date")
    return harvest.month_nearest(rows, legacy_exclude_last=True).select("ds", F.col("month").cast("string").alias("month"), "url")


@query("series_slice", sql("b_granule", f"""
    SELECT ds, CAST(CAST(month AS DATE) AS VARCHAR) AS month, {TS.format('date')} AS step_time,
           ds || '_' || strftime(month, '%Y%m%d') || '.nc' AS filename
    FROM (SELECT DISTINCT ds, date, date_trunc('month', date) AS month,
                 abs(epoch_us(date) - (epoch_us(date_trunc('month', date)) + epoch_us(date_trunc('month', date) + INTERVAL 1 MONTH)) // 2) AS off
          FROM b_granule)
    WHERE off <= 604800000000
    QUALIFY row_number() OVER (PARTITION BY ds, month ORDER BY off, date) = 1"""))
def series_slice(v: Views):
    """Per month, the time step closest to the month's center."""
    steps = v.granule.select("ds", F.col("date").alias("time"))
    return harvest.series_slice(steps, keys=["ds"]).select(
        "ds", F.col("month").cast("string").alias("month"), ts_text("step_time").alias("step_time"), "filename")


@query("month_end_pick", sql("b_granule", """
    SELECT ds, CAST(CAST(date_trunc('month', date) AS DATE) AS VARCHAR) AS date, filename AS url, CAST(CAST(date AS DATE) AS VARCHAR) AS picked_day
    FROM b_granule WHERE date_diff('day', CAST(date AS DATE), last_day(date)) <= 2
    QUALIFY row_number() OVER (PARTITION BY ds, date_trunc('month', date) ORDER BY date DESC, filename DESC) = 1"""))
def month_end_pick(v: Views):
    """Per month, the granule of the last days."""
    rows = v.granule.select("ds", F.col("filename").alias("url"), "date")
    return harvest.select(rows, "month_end").select("ds", F.col("date").cast("string").alias("date"), "url", F.col("picked_day").cast("string").alias("picked_day"))


@query("month_to_days", sql("", """
    SELECT ym, CAST(CAST(d AS DATE) AS VARCHAR) AS day, 'ATL-DAY-1' || strftime(d, '%Y%m%d') || '_004_01' || '.nc' AS daily_filename, n
    FROM (SELECT strftime(m, '%Y%m') AS ym, n,
                 unnest(generate_series(m, m + INTERVAL 1 MONTH - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d
          FROM (SELECT date_trunc('month', CAST(o_orderdate AS TIMESTAMP)) AS m, count(*) AS n FROM orders GROUP BY ALL))"""))
def month_to_days(v: Views):
    """Monthly containers to calendar days with daily names."""
    months = v.orders.groupBy(F.trunc("o_orderdate", "MM").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    rows = months.withColumns({
        "ym": F.date_format("date", "yyyyMM"), "filename": F.concat(F.lit("ATL-DAY-1"), F.date_format("date", "yyyyMM"), F.lit("_004_01.h5"))})
    return harvest.select(rows, "month_to_days").select("ym", F.col("day").cast("string").alias("day"), "daily_filename", "n")


@query("slice_midpoint_day", sql("", """
    SELECT event_id, CAST(CAST(make_timestamp((epoch_us(ts) + epoch_us(ts + INTERVAL 30 HOUR)) // 2) AS DATE) AS VARCHAR) AS day FROM events"""))
def slice_midpoint_day(v: Views):
    """Date of a slice by the middle of its span."""
    end = F.col("ts") + F.make_interval(hours=F.lit(30))
    return v.events.select("event_id", harvest.day_of_slice("ts", end).cast("string").alias("day"))
