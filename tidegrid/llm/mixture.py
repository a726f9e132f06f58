"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Targets per source come from weights with a cap on repetition (water-filling over the sources). The
mix is cut into blocks of equally many words. Blocks go to sources by highest quotients
target / (2 j + 1), and a source's blocks to its shards by highest quotients of the shard's words. In a
shard the documents stand in a seeded order and are cut into blocks; every block is taken as often as
fits evenly, and the rest is a seeded systematic selection, so that what a document gives follows from
its position alone and no block becomes a row. Everything is built-in column functions.

``whole_documents`` is the mix in whole documents. What rounding a document gives too much or too little
is carried on to the next one of its shard, longest first, so it cancels out within a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.scratch import checked, stored

DOCS_PER_SHARD = 8192
MAX_SHARDS = 1 << 16
# The mix has at least this many blocks, and the smallest source with a target at least this many.
MIN_BLOCKS, MIN_SOURCE_BLOCKS = 20_000, 64
# Rows of a shard of whole documents; a shard is one array.
WHOLE_PER_SHARD = 1024
SEED = "mix-1"
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """Add ``target`` (words) to a table of (source, size): weights by source order, null last.

    The wanted total is ``share`` of all sizes. A target is min(cap * size, level * weight), with the
    level at which the targets add up to the total: sources by the ratio of cap to weight, the first
    ones are full as long as the level of the rest exceeds their ratio. One row per source, so the
    windows without a partition hold as many rows as there are sources.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sources.withColumn("weight", weight.cast("double")).withColumn("limit", F.lit(cap) * F.col("size"))
    everyone = Window.partitionBy()
    fill = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.lit(share) * F.sum("size").over(everyone) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(after)).withColumn("open", F.col("level") * F.col("weight") <= F.col("limit"))
    level = F.max(F.when(F.col("open"), F.col("level"))).over(everyone)  # from the first open source on, levels only fall
    return rows.withColumn("target", F.least("limit", F.coalesce(level * F.col("weight"), "limit"))).drop("level", "open", "limit")


def apportion(rows: DataFrame, group: list[str], votes: str, seats: str, ties: list) -> DataFrame:
    """Sainte-Lague within each group: add ``quota``, the seats of a row by highest quotients.

    ``seats`` is the group's number of seats. Webster's divisor lies between total / (seats + n / 2) and
    total / (seats - n / 2) for n rows; the seats that even the larger divisor gives are certain, and only
    the few quotients between both are ranked. Ties go by ``ties``.
    """
    part = Window.partitionBy(*group)
    total, n = F.sum(F.col(votes).cast("double")).over(part), F.count_if(F.col(votes) > 0).over(part)
    sure = F.greatest(F.floor(F.col(votes) * (F.col(seats) - n / 2) / total + 0.5) - 1, F.lit(0)).cast("long")
    most = (F.ceil(F.col(votes) * (F.col(seats) + n / 2) / total + 0.5) + 1).cast("long")
    rows = rows.withColumns({"__sure": F.when(F.col(votes) > 0, sure).otherwise(0), "__most": F.when(F.col(votes) > 0, most).otherwise(0)})
    rows = rows.withColumn("__left", F.col(seats) - F.sum("__sure").over(part))
    j = F.explode_outer(F.when(F.col("__most") > F.col("__sure"), F.sequence("__sure", F.col("__most") - 1)))
    quotients = rows.withColumn("__j", j).withColumn("__q", F.col(votes) / (2 * F.col("__j") + 1))
    best = Window.partitionBy(*group).orderBy(F.desc_nulls_last("__q"), *ties, "__j")
    won = (F.row_number().over(best) <= F.col("__left")) & F.col("__j").isNotNull()
    keys = [c for c in rows.columns if not c.startswith("__")]
    return quotients.withColumn("__won", won.cast("long")).groupBy(*keys, "__sure").agg(F.sum("__won").alias("__won")).select(
        *keys, (F.col("__sure") + F.col("__won")).alias("quota"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row of ``docs``.

    ``taken`` counts the words the mix takes of a document, repeats included, and is at most ``cap``
    times its size. Sources are weighed in code point order, a null source last; a null text has no
    words and gives none. Rows with one id and size share their place in the seeded order and are
    interchangeable. An empty table gives no rows. Reruns with one seed agree.
    """
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    sizes = stored(docs.select("doc_id", "source", key.alias("skey"), word_count(F.col("text")).alias("size")), "mix-sizes")
    place = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    shard = lambda n: F.conv(F.substring(place, 1, 8), 16, 10).cast("long") % n

    sources = sizes.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs"))
    targets = source_targets(sources, weights, share, cap)
    everyone = Window.partitionBy()
    total = F.sum("target").over(everyone)
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(everyone)
    targets = targets.withColumn("block", F.greatest(F.lit(1), F.floor(F.least(total / MIN_BLOCKS, least / MIN_SOURCE_BLOCKS))).cast("long"))
    targets = targets.withColumn("blocks", F.round(F.coalesce(total, F.lit(0.0)) / F.col("block")).cast("long"))
    targets = targets.withColumn("shards", F.least(F.lit(MAX_SHARDS), F.ceil(F.col("docs") / DOCS_PER_SHARD)).cast("long"))
    quotas = apportion(targets.withColumn("__all", F.lit(0)), ["__all"], "target", "blocks", [F.col("source").isNull(), "source"])
    quotas = stored(quotas.select("skey", "size", "target", "block", "shards", F.col("quota").alias("source_quota")), "mix-sources")

    plan = quotas.withColumnRenamed("size", "source_size")
    rows = sizes.join(checked(plan), "skey").withColumn("shard", shard(F.col("shards")))
    parts = rows.groupBy("skey", "shard").agg(
        F.sum("size").alias("words"), F.first("source_quota").alias("source_quota"), F.first("block").alias("block"))
    parts = apportion(parts, ["skey"], "words", "source_quota", ["shard"]).select("skey", "shard", "words", "quota")
    parts = stored(parts, "mix-shards")

    taken = rows.join(checked(parts), ["skey", "shard"])
    order = Window.partitionBy("skey", "shard").orderBy(place, "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum("size").over(order)
    n = F.ceil(F.col("words") / F.col("block"))
    start = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "skey", F.col("shard").cast("string"))), 1, 8), 16, 10).cast("long") % n
    taken = taken.withColumns({"__end": end, "__n": n}).withColumn("__start", F.when(F.col("words") > 0, start))
    rest, every = F.col("quota") % F.col("__n"), F.least(F.floor(F.col("quota") / F.col("__n")), F.lit(cap))
    rest = F.when(every == cap, 0).otherwise(rest)

    def chosen(blocks: Column) -> Column:
        """Blocks selected of the first ``blocks``: one wherever the running share reaches a whole number."""
        return F.floor((blocks + F.col("__start")) * rest / F.col("__n")) - F.floor(F.col("__start") * rest / F.col("__n"))

    def before(words: Column) -> Column:
        """Selected words among the first ``words`` of the shard."""
        whole = F.floor(words / F.col("block"))
        return F.col("block") * chosen(whole) + (words - whole * F.col("block")) * (chosen(whole + 1) - chosen(whole))

    extra = before(F.col("__end")) - before(F.col("__end") - F.col("size"))
    return taken.select(
        "doc_id", "source", "size", "source_size", "target",
        F.when(F.col("words") > 0, every * F.col("size") + extra).otherwise(0).cast("long").alias("taken"))


def whole_documents(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2, seed: str = SEED) -> DataFrame:
    """(row, rows, times): how often the mix takes the ``rows`` equal rows named ``row`` of ``docs`` (row, source, text) together.

    Targets are those of ``mix``. Every row is taken floor(target / source size) times and some once
    more: within a shard, by falling powers of two of the size and then in a seeded order, a row is given
    the words due so far as whole documents, rounded up with the chance of the remainder (seeded), and
    what is then still due goes on to the next one. A shard so ends within about one of its short
    documents of its share. Rows without words are taken once each. Reruns with one seed agree.
    """
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    sized = docs.select("row", "source", key.alias("skey"), word_count(F.col("text")).alias("size"))
    sizes = stored(sized.groupBy("row", "source", "skey", "size").agg(F.count(F.lit(1)).alias("rows")), "whole-sizes")
    sources = sizes.groupBy("skey").agg(
        F.first("source").alias("source"), F.sum(F.col("size") * F.col("rows")).alias("size"), F.count(F.lit(1)).alias("docs"))
    ratio = F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0.0)
    shards = F.ceil(F.col("docs") / WHOLE_PER_SHARD).cast("long")
    plan = source_targets(sources, weights, share, cap).select("skey", ratio.alias("ratio"), shards.alias("shards"))
    plan = stored(plan, "whole-sources")

    draw = lambda salt: F.xxhash64(F.lit(f"{seed}:{salt}"), "row")
    item = F.struct(
        (-F.floor(F.log2("size"))).alias("order"), draw("place").alias("place"), "row", "rows", "size",
        (F.pmod(draw("chance"), F.lit(1 << 32)) / float(1 << 32)).alias("chance"))
    parts = sizes.filter("size > 0").join(checked(plan), "skey").withColumn("shard", F.pmod(draw("shard"), F.col("shards")))
    parts = parts.groupBy("skey", "shard", "ratio").agg(F.sort_array(F.collect_list(item)).alias("items"))

    def give(done: Column, x: Column) -> Column:
        due = done["due"] + (F.col("ratio") - F.floor("ratio")) * x["size"] * x["rows"]
        more = F.least(F.greatest(F.floor(due / x["size"] + x["chance"]), F.lit(0)), x["rows"]).cast("long")
        return F.struct((due - more * x["size"]).alias("due"), F.concat(done["more"], F.array(more)).alias("more"))

    nothing = F.struct(F.lit(0.0).alias("due"), F.array().cast("array<bigint>").alias("more"))
    given = parts.withColumn("more", F.aggregate("items", nothing, give, lambda done: done["more"]))
    given = given.select("ratio", F.explode(F.arrays_zip("items", "more")).alias("x"))
    times = F.col("x.items.rows") * F.floor("ratio") + F.col("x.more")
    given = given.select("x.items.row", "x.items.rows", times.cast("long").alias("times"))
    return given.union(sizes.filter("size = 0").select("row", "rows", "rows"))
