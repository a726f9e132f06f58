"""Secret scans that link the parts of a credential, with built-in column functions only.

Base kinds (assigned values, access identifiers, hex strings) are reported wherever they stand. Weak
candidates (names of accounts, short or vaguely named values, addresses of services) say little alone;
one is reported only where the parts that complement it stand near, in the same paragraph: a name needs
a secret, a secret needs a name, an address needs both. That is a join of intervals: each candidate,
widened by ``reach``, against the parts of the other roles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.scratch import stored


def either(words: str) -> str:
    """A pattern that reads the ASCII letters of ``words`` in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isascii() and c.islower() else c for c in words)


ASSIGN = r"""["']?\x20*[:=]\x20*["']?"""
# The base patterns. Runs shorter than asked for cannot hold a match that begins later, so
# access and hex ask for their length at once; an assignment's length is looked at after matching.
BASE = {
    "assign": f"({either('password|passwd|secret|token|api_?key')}){ASSIGN}([A-Za-z0-9+/_.=-]+)",
    "access": "AKIA[A-Z0-9]{12,}",
    "hex": "[0-9a-f]{32,}",
}
# Weak kinds; the values have the lengths that the patterns ask for.
WEAK = {
    "login": f"({either('user_?name|user|login|account|client_?id|key_?id')}){ASSIGN}([A-Za-z0-9@_.+-]{{3,128}})",
    "phrase": f"({either('pass_?phrase|pwd|pass|credential|private_?key|secret_?key|access_?key')}){ASSIGN}([^\\x00-\\x20\"'<>,;\\x7F]{{4,256}})",
    "endpoint": r"(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|(?:https?|ftp|mysql|postgres(?:ql)?|mongodb(?:\+srv)?|redis|amqps?|s3)://[^\x00-\x20\"'<>,;\x7F]{1,1000})(?::[0-9]{1,5})?",
}
BREAK = r"\n[\x20\x09\x0D]*\n"
KINDS = (*BASE, *WEAK)
ROLES = {"access": "name", "login": "name", "assign": "secret", "hex": "secret", "phrase": "secret", "endpoint": "address"}
NEEDS = {"login": ("secret",), "phrase": ("name",), "endpoint": ("name", "secret")}
MIN_VALUE, MIN_PHRASE = 8, 4
REACH = 400
CELL = 200  # width of the buckets of the interval join, at most the reach


def matches(text: Column, pattern: str, value: int | None = None) -> Column:
    """Array of (gap, size, value): what lies between the last match and this one, its length and its value's.

    Lengths are in code points. Splitting gives the gaps, extracting the matches, each once per text.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value)) if value else found
    each = F.transform(
        F.arrays_zip(F.split(text, pattern, -1), found, values),
        lambda z: F.struct(F.length(z["0"]).alias("gap"), F.length(z["1"]).alias("size"), F.length(z["2"]).alias("value")))
    return F.when(text.rlike(pattern), F.filter(each, lambda z: z["size"].isNotNull()))


def scan(docs: DataFrame, id_col: str | Column = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, one array of matches per kind, breaks): a stored table without the texts, so that row stays the same."""
    ids = F.col(id_col) if isinstance(id_col, str) else id_col
    t = F.col("text")
    found = {k: matches(t, p, 2 if k == "assign" else None) for k, p in (BASE | WEAK).items()}
    linked = t.rlike("|".join([WEAK["login"], BASE["access"]]))  # names; without one nothing is added
    return stored(
        docs.select(ids.alias("doc_id"), F.col(text).alias("text")).select(
            F.monotonically_increasing_id().alias("row"), "doc_id", *[c.alias(k) for k, c in found.items()],
            F.when(linked, matches(t, BREAK)).alias("break")), "secret-scan")


def parts(scanned: DataFrame) -> DataFrame:
    """(row, kind, start, stop) of every match that can count, and of paragraph breaks.

    Positions are running sums of gaps and sizes within a document. Assigned values below ``MIN_VALUE``
    are weak secrets (kind ``phrase``) from ``MIN_PHRASE`` on and dropped below.
    """
    kinds = [*KINDS, "break"]
    each = scanned.select("row", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("found")) for k in kinds])).alias("k"))
    each = each.filter("k.found IS NOT NULL").select("row", "k.kind", F.posexplode("k.found").alias("at", "m"))
    after = F.sum(F.col("m.gap") + F.col("m.size")).over(Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    kind = F.when(F.col("kind") != "assign", F.col("kind")).when(F.col("m.value") >= MIN_VALUE, "assign").when(F.col("m.value") >= MIN_PHRASE, "phrase")
    placed = each.select("row", kind.alias("kind"), (after - F.col("m.size")).alias("start"), after.alias("stop"))
    return placed.filter("kind IS NOT NULL").distinct()


def _summaries(found: DataFrame, edge: str) -> DataFrame:
    """Least and greatest ``edge`` of the parts of one role in each cell of a paragraph: one row per cell and role."""
    return found.groupBy("row", "scope", "role", F.floor(F.col(edge) / CELL).alias("cell")).agg(F.min(edge).alias("lo"), F.max(edge).alias("hi"))


def linked(found: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak candidates of ``parts`` that the parts they need complement.

    A part complements another one if both stand in one paragraph, do not overlap, and at most
    ``reach`` code points lie between them. A candidate meets a summary of each cell within reach, not
    every part in it, so the join grows with the candidates whatever crowds there are.
    """
    if reach < CELL:
        raise ValueError(f"reach must be at least {CELL}")
    roles = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    worth = found.groupBy("row").agg(
        F.bool_or(F.col("kind").isin(*WEAK)).alias("weak"), F.count_distinct(roles[F.col("kind")]).alias("roles")).filter("weak AND roles > 1")
    order = Window.partitionBy("row").orderBy("start", "stop", "kind").rowsBetween(Window.unboundedPreceding, 0)
    scoped = found.join(worth.select("row"), "row", "left_semi").withColumn("scope", F.count_if(F.col("kind") == "break").over(order))
    scoped = stored(scoped.filter("kind != 'break'").withColumn("role", roles[F.col("kind")]), "secret-parts")
    weak = scoped.filter(F.col("kind").isin(*WEAK))
    cells = lambda a, b: F.explode(F.sequence(F.floor(a / CELL), F.floor(b / CELL))).alias("cell")
    own = ["row", "scope", "kind", "role", "start", "stop"]
    at, end = F.col("start"), F.col("stop")
    behind = weak.select(*own, cells(end, end + reach)).join(_summaries(scoped, "start").withColumnRenamed("role", "other"), ["row", "scope", "cell"])
    before = weak.select(*own, cells(at - reach, at)).join(_summaries(scoped, "stop").withColumnRenamed("role", "other"), ["row", "scope", "cell"])
    near = behind.filter(f"other != role AND hi >= stop AND lo <= stop + {reach}").unionByName(
        before.filter(f"other != role AND hi >= start - {reach} AND lo <= start"))
    have = near.groupBy("row", "kind", "start", "stop").agg(F.collect_set("other").alias("have"))
    needs = F.create_map(*[x for k, v in NEEDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return have.filter(F.size(F.array_except(needs[F.col("kind")], "have")) == 0).select("row", "kind", "start", "stop")


def find_secrets(docs: DataFrame, id_col: str | Column = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """(doc_id, spans) of every row of ``docs``: spans is an array of (kind, start, stop, base) by start, then kind in the order of ``KINDS``.

    Positions are code points, the end exclusive. Base matches are the leftmost ones that do not overlap
    others of their kind, in the whole text; spans of different kinds may overlap. Weak candidates come
    with ``base`` false and only where complemented. A null or empty text and one without a match have
    an empty array; ids may be null or repeat, every row gives one row; an empty table gives none. A
    document's spans stand in one row and are placed by one task, so a very long document takes memory
    by its spans. Other columns are not read.
    """
    scanned = scan(docs, id_col, text)
    found = stored(parts(scanned), "secret-all")
    spans = found.filter(F.col("kind").isin(*BASE)).withColumn("base", F.lit(True)).unionByName(linked(found, reach).withColumn("base", F.lit(False)))
    place = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    each = F.struct("start", place[F.col("kind")].alias("place"), "kind", "stop", "base")
    by_row = spans.groupBy("row").agg(F.sort_array(F.collect_list(each)).alias("spans"))
    empty = F.expr("CAST(array() AS array<struct<kind: string, start: bigint, stop: bigint, base: boolean>>)")
    tidy = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["base"].alias("base")))
    return scanned.select("row", "doc_id").join(by_row, "row", "left").select("doc_id", F.coalesce(tidy, empty).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as text, ``kind:start:stop`` by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
