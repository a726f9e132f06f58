"""Fetched listing pages to granule rows.

Each parser takes one row per fetched page (``url``, ``body`` and whatever tags the caller adds)
and returns one row per listed file, so all hemispheres, years and months are one scan. Rows that
do not parse keep a NULL ``url`` or ``mod_time`` and can be split off with ``split_rejected``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.text import bound_year

# Link relation that marks a data link, and the layout of a catalogue entry.
DATA_RELATION = "http://esipfed.org/ns/fedsearch/1.1/data#"
JSON_ENTRY = (
    "STRUCT<id: STRING, collection_concept_id: STRING, updated: STRING,"
    " links: ARRAY<STRUCT<rel: STRING, href: STRING>>>"
)
# Time text in the listings; updates have one to six digits of a second's fraction.
JSON_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{1,6}Z$"
LINK_TIME = "dd-MMM-yyyy HH:mm"
XML_TIME = "yyyy-MM-dd'T'HH:mm:ss'Z'"
TABLE_TIME = "yyyy-MM-dd HH:mm"


def _join_url(base: Column, leaf: Column) -> Column:
    """Append a relative reference to a folder address; an absolute one stands alone."""
    return (
        F.when(leaf.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), leaf)
        .otherwise(F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), F.regexp_replace(leaf, "^/+", "")))
    )


def _entities(text: Column) -> Column:
    """The characters behind the entities that addresses hold."""
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(sign))
    return text


def entries_json(pages: DataFrame, provider: str, body: str = "body") -> DataFrame:
    """Catalogue search results: the first data link that names the provider, per entry."""
    entry = F.explode(F.from_json(F.col(body), f"ARRAY<{JSON_ENTRY}>")).alias("entry")
    rows = pages.select(*[c for c in pages.columns if c not in (body, "url")], entry)
    links = F.filter(
        F.col("entry.links"),
        lambda link: (link["rel"] == DATA_RELATION) & link["href"].contains(provider),
    )
    url = F.get(links, F.lit(0))["href"]
    updated = F.col("entry.updated")
    time = F.when(updated.rlike(JSON_TIME), F.try_to_timestamp(updated))
    return rows.select(
        *[c for c in rows.columns if c != "entry"],
        F.col("entry.id").alias("id"),
        F.col("entry.collection_concept_id").alias("collection_id"),
        url.alias("url"),
        time.alias("mod_time"),
        F.when(url.isNull(), F.lit("no data link for provider"))
        .when(time.isNull(), F.lit("unreadable update time")).alias("reject_reason"),
    )


def entries_links(
    pages: DataFrame, body: str = "body", url: str = "url", skip_first: int = 1,
) -> DataFrame:
    """Directory page: every anchor after the first, with the time text that follows it.

    The page is cut where anchors begin, so markup inside an anchor, capitals, any quotes (or none) and
    anchors without an end do not matter. Anchors without an address count for ``skip_first`` and go.
    """
    seen = F.regexp_replace(F.col(body), r"(?s)<!--.*?-->", "")
    parts = F.filter(F.split(seen, r"(?i)<a(?=[\s>])"), lambda part, i: i > 0)
    address = r"""(?is)^(?:[^>"']|"[^"]*"|'[^']*')*?\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""

    def link(part: Column) -> Column:
        found = F.concat(*[F.regexp_extract(part, address, i) for i in (1, 2, 3)])
        return F.struct(
            F.when(part.rlike(address), _entities(F.trim(found))).alias("href"),
            F.regexp_extract(part, r"(?is)</a\s*>([^<]*)", 1).alias("tail"))

    rows = pages.select(
        *[c for c in pages.columns if c != body],
        F.posexplode(F.transform(parts, link)).alias("position", "link"),
    ).filter((F.col("position") >= skip_first) & F.col("link.href").isNotNull())
    stamp = F.regexp_extract(F.col("link.tail"), r"(\d{1,2}-[A-Za-z]{3}-\d{4} +\d{2}:\d{2})", 1)
    return rows.select(
        *[c for c in pages.columns if c not in (body, url)],
        "position",
        F.col("link.href").alias("href"),
        _join_url(F.col(url), F.col("link.href")).alias("url"),
        F.try_to_timestamp(F.nullif(F.regexp_replace(stamp, " +", " "), F.lit("")), F.lit(LINK_TIME)).alias("mod_time"),
    )


def year_folders(pages: DataFrame, start: str, end: str, body: str = "body", url: str = "url") -> DataFrame:
    """Folder page: year folders inside the configured range, before their pages are fetched."""
    name = F.regexp_replace("href", "/", "")
    return (
        entries_links(pages, body, url)
        .withColumn("year", name.try_cast("int"))
        .filter(F.col("year").between(bound_year(start), bound_year(end)))
    )


def catalog_refs(pages: DataFrame, start: str, end: str, body: str = "body") -> DataFrame:
    """Catalogue folders: titles within the range of years; non-numeric ones stay, monthly ones go."""
    titles = F.xpath(F.col(body), F.lit('//*[local-name()="catalogRef"]/@*[local-name()="title"]'))
    keep_cols = [c for c in pages.columns if c != body]
    year = F.col("title").try_cast("int")
    return (
        pages.select(*keep_cols, F.explode(titles).alias("title"))
        .filter(~F.col("title").contains("monthly"))
        .filter(year.isNull() | year.between(bound_year(start), bound_year(end)))
    )


def months_in_range(refs: DataFrame, start: str, end: str, year: str = "year", title: str = "title") -> DataFrame:
    """Month folders inside the range of years and months; folders of a non-numeric year or title are kept whole."""
    y, m = F.col(year).try_cast("int"), F.col(title).try_cast("int")
    first = F.when(y == bound_year(start), F.lit(_month(start))).otherwise(F.lit(1))
    last = F.when(y == bound_year(end), F.lit(_month(end, 12))).otherwise(F.lit(12))
    in_years = y.isNull() | y.between(bound_year(start), bound_year(end))
    return refs.filter(in_years & (y.isNull() | m.isNull() | m.between(first, last)))


def _month(text: str, now: int = 12) -> int:
    if text == "NOW":
        return now
    digits = text.replace("-", "")
    return int(digits[4:6])


def entries_xml(pages: DataFrame, file_server: str, body: str = "body") -> DataFrame:
    """Catalogue page: ``dataset`` elements with an address, at any depth below another one.

    The page is cut at the tags of datasets. An element's own content ends where the next dataset begins
    or ends, so address and date come from the same element and one without a date keeps its own
    missing time. The depth is the number of datasets begun and not ended before.
    """
    seen = F.regexp_replace(F.col(body), r"(?s)<!--.*?-->", "")
    cut = F.regexp_replace(seen, r"<(/?)(?:[\w.-]+:)?dataset(?=[\s/>])", "\u0001$1")
    parts = F.filter(F.split(cut, "\u0001"), lambda part, i: i > 0)
    tag = r"""(?s)^(?:[^>"']|"[^"]*"|'[^']*')*"""
    closes = lambda part: part.startswith("/")
    alone = lambda part: part.rlike(tag + "/>") & ~closes(part)
    step = lambda part: F.when(closes(part), -1).when(alone(part), 0).otherwise(1)
    address = r"""(?s)^(?:[^>"']|"[^"]*"|'[^']*')*?\surlPath\s*=\s*(?:"([^"]*)"|'([^']*)')"""
    keep = [c for c in pages.columns if c not in (body, "url")]
    begun = F.aggregate(
        parts, F.struct(F.lit(0).alias("depth"), F.array().cast("array<struct<depth:int,part:string>>").alias("found")),
        lambda acc, part: F.struct(
            (acc["depth"] + step(part)).alias("depth"),
            F.when(closes(part) | ~part.rlike(address), acc["found"]).otherwise(
                F.concat(acc["found"], F.array(F.struct(acc["depth"].alias("depth"), part.alias("part"))))).alias("found")),
        lambda acc: acc["found"])
    path = F.concat(*[F.regexp_extract("d.part", address, i) for i in (1, 2)])
    date = F.regexp_extract("d.part", r"(?s)<(?:[\w.-]+:)?date(?:\s[^>]*)?>([^<]*)<", 1)
    return pages.select(*keep, F.explode(begun).alias("d")).filter("d.depth > 0").select(
        *keep, _join_url(F.lit(file_server), _entities(path)).alias("url"), F.try_to_timestamp(F.trim(date), F.lit(XML_TIME)).alias("mod_time"))


def entries_table(pages: DataFrame, body: str = "body", url: str = "url") -> DataFrame:
    """Table page: rows between the three header rows and the last; link in cell 1, time in cell 2."""
    rows = F.regexp_extract_all(F.col(body), F.lit(r"<tr[^>]*>((?s).*?)</tr>"), 1)
    inner = F.slice(rows, F.lit(4), F.greatest(F.size(rows) - 4, F.lit(0)))
    cells = F.regexp_extract_all(F.col("row"), F.lit(r"<td[^>]*>((?s).*?)</td>"), 1)
    keep = [c for c in pages.columns if c not in (body, url)]
    return (
        pages.select(*keep, url, F.posexplode(inner).alias("position", "row"))
        .withColumn("cells", cells)
        .select(
            *keep,
            "position",
            _join_url(F.col(url), F.regexp_extract(F.get("cells", F.lit(1)), r'href="([^"]*)"', 1)).alias("url"),
            F.try_to_timestamp(F.trim(F.get("cells", F.lit(2))), F.lit(TABLE_TIME)).alias("mod_time"),
        )
    )


def split_rejected(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable rows and rows without an address or a time."""
    bad = F.col("url").isNull() | F.col("mod_time").isNull()
    return rows.filter(~bad), rows.filter(bad)
