"""Exact medians of groups of any size, in bounded memory.

A built-in median keeps a group's values in one task. Here a group of more than ``HELD`` values is
narrowed down first: a quantile sketch (folded per task, of fixed size) names two values around the
wanted rank, one pass counts what lies below, at, between and above them, and the part that holds the
rank is searched again. What is left is at most ``HELD`` values, or one value however often it occurs,
so the result is exact and no hot group meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.session import shared_dir
from tidegrid.sizing import materialize, spread_join

# Values of one group that a task may hold.
HELD = 1 << 16
# The sketch cuts a part into this many shares of equal rank and is off by at most a sixteenth of a share.
SHARES = 256
ACCURACY = 16 * SHARES


def group_sizes(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Values (``n``) and rows (``total``) of each group with its smallest (``lo``) and largest value (``hi``)."""
    return rows.groupBy(*keys).agg(
        F.count(value).alias("n"), F.count(F.lit(1)).alias("total"), F.min(value).alias("lo"), F.max(value).alias("hi"))


def bounded_median(rows: DataFrame, keys: Sequence[str], value: str = "value", strict: bool = False, held: int = HELD) -> DataFrame:
    """Median of ``value`` per group of ``rows``: (keys, value).

    Missing values are left out; with ``strict`` one of them makes the group's median missing. A group
    without values has a missing median. Keys may be null. Equal values count as often as they occur.
    ``rows`` is read several times, so it should be a table. Each search step reads only large groups.
    """
    if held < 2:
        raise ValueError("a median needs two values at hand")
    keys, spark = list(keys), rows.sparkSession
    # large groups are joined by a 64-bit hash of their keys, since a key may be null
    group = F.xxhash64(*keys, *[F.col(k).isNull() for k in keys]) if keys else F.lit(0).cast("long")
    packed = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    named = rows.select(packed.alias("__keys"), F.col(value).cast("double").alias("v"), group.alias("__group"))
    sizes = group_sizes(named, ["__group", "__keys"], "v").filter(F.col("n") > held)
    large = materialize(sizes, shared_dir(spark, "median-sizes"))
    if large.isEmpty():
        return _unpacked(_whole(named, strict), keys, value)
    found = _whole(spread_join(named, large.select("__group"), ["__group"], salt_from=["v"], how="left_anti"), strict)
    if strict:  # a group with a missing value is settled by its counts
        found = found.unionByName(large.filter(F.col("n") < F.col("total")).select("__keys", F.lit(None).cast("double").alias("v")))
        large = large.filter(F.col("n") == F.col("total"))
    values = named.filter(F.col("v").isNotNull()).select("__group", "v")
    ranks = F.explode(F.array_distinct(F.array(F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1)))
    middle = select_ranks(values, large.select("__group", ranks.alias("rank"), "n", "lo", "hi"), held)
    halves = middle.groupBy("__group").agg(F.min("v").alias("a"), F.max("v").alias("b"))
    exact = large.join(halves, "__group").select("__keys", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") * 0.5 + F.col("b") * 0.5).alias("v"))
    return _unpacked(found.unionByName(exact), keys, value)


def _whole(rows: DataFrame, strict: bool) -> DataFrame:
    """Medians of groups that fit a task."""
    middle = F.median("v")
    return rows.groupBy("__keys").agg((F.when(F.count("v") == F.count(F.lit(1)), middle) if strict else middle).alias("v"))


def _unpacked(medians: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return medians.select(*[F.col(f"__keys.{k}") for k in keys], F.col("v").alias(value))


def select_ranks(values: DataFrame, wanted: DataFrame, held: int = HELD) -> DataFrame:
    """(__group, rank, v): the values of the wanted ranks (from 1, among equal values in any order).

    ``values`` has (__group, v) without missing ones; ``wanted`` (__group, rank, n, lo, hi) with the number
    of values and the range of each group. Every round reads the values in the open ranges twice, and
    leaves about 4 of ``SHARES`` of them; the number of rounds follows the size's logarithm.
    """
    spark = values.sparkSession
    kind = "__group long, rank long, v double"
    done = spark.createDataFrame([], kind)
    open_ = materialize(wanted.select("__group", "rank", F.col("rank").alias("place"), "n", "lo", "hi"), shared_dir(spark, "median-ranks"))
    while True:
        done = done.unionByName(open_.filter("lo = hi").select("__group", "rank", F.col("lo").alias("v")))
        fits = open_.filter((F.col("lo") != F.col("hi")) & (F.col("n") <= held))
        sorted_ = F.array_sort(F.collect_list("v"))
        near = _inside(values, fits).groupBy("__group", "rank", "place").agg(sorted_.alias("vs"))
        done = done.unionByName(near.select("__group", "rank", F.element_at("vs", F.col("place").cast("int")).alias("v")))
        open_ = open_.filter((F.col("lo") != F.col("hi")) & (F.col("n") > held))
        if open_.isEmpty():
            return done
        open_ = materialize(narrowed(values, open_), shared_dir(spark, "median-ranks"))


def _inside(values: DataFrame, ranges: DataFrame) -> DataFrame:
    """Values within the range of each wanted rank; a group's values are spread over tasks."""
    met = spread_join(values, ranges, ["__group"], salt_from=["v"])
    return met.filter((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))


def narrowed(values: DataFrame, open_: DataFrame) -> DataFrame:
    """The ranges of the wanted ranks, cut down by two values around each."""
    key = ["__group", "rank"]
    shares = [i / SHARES for i in range(1, SHARES)]
    cuts = _inside(values, open_).groupBy(*key).agg(F.percentile_approx("v", shares, ACCURACY).alias("cuts"))
    cuts = open_.join(cuts, key)
    at = F.col("place") / F.col("n") * SHARES
    first = F.greatest(F.floor(at).cast("int") - 1, F.lit(1))
    last = F.least(F.ceil(at).cast("int") + 1, F.lit(SHARES - 1))
    cuts = materialize(cuts.withColumns({"a": F.element_at("cuts", first), "b": F.element_at("cuts", last)}).drop("cuts"), shared_dir(cuts.sparkSession, "median-cuts"))

    v, a, b = F.col("v"), F.col("a"), F.col("b")
    # in ascending order; where both cuts are one value the parts from it on are empty
    parts: list[Column] = [v < a, v == a, (v > a) & (v < b), (v == b) & (a != b), v > b]
    counted = _inside(values, cuts).groupBy(*key, "place").agg(F.array(*[
        F.struct(F.count_if(p).alias("n"), F.min(F.when(p, v)).alias("lo"), F.max(F.when(p, v)).alias("hi")) for p in parts]).alias("parts"))
    before = F.lit(0).cast("long")
    steps = []
    for i in range(len(parts)):
        part = F.col("parts")[i]
        steps.append(F.struct(part["n"].alias("n"), part["lo"].alias("lo"), part["hi"].alias("hi"), (F.col("place") - before).alias("place")))
        before = before + part["n"]
    holds = F.filter(F.array(*steps), lambda s: (s["place"] >= 1) & (s["place"] <= s["n"]))[0]
    return counted.select(*key, holds.alias("s")).select(*key, "s.place", "s.n", "s.lo", "s.hi")
