"""Medians of groups larger than a task may hold, against sorted lists."""

import random
from statistics import median

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_mapping import small  # noqa: F401

from tidegrid.operators import regrid
from tidegrid.operators.median import SHARES, bounded_median, narrowed, select_ranks

KIND = "a string, b int, value double"


def plain(rows, strict):
    groups = {}
    for a, b, v in rows:
        groups.setdefault((a, b), []).append(v)
    out = {}
    for key, values in groups.items():
        there = [v for v in values if v is not None]
        out[key] = median(there) if there and not (strict and len(there) < len(values)) else None
    return out


def found(frame, strict, held):
    return {(r.a, r.b): r.value for r in bounded_median(frame, ["a", "b"], strict=strict, held=held).collect()}


@pytest.mark.parametrize("strict", [False, True])
def test_groups_of_all_kinds(spark, strict):
    """Hot and small groups, ties, null keys, missing values, even and odd sizes; extra columns are not read."""
    r = random.Random(5)
    rows = [("hot", 1, r.lognormvariate(0, 8)) for _ in range(9000)] + [("hot", 2, float(r.randint(0, 3))) for _ in range(6001)]
    rows += [(None, 1, r.gauss(0, 1)) for _ in range(3000)] + [(None, None, 4.0)] * 5000 + [("gap", 1, None if i % 50 == 0 else float(i)) for i in range(4000)]
    rows += [("few", i % 7, r.random()) for i in range(50)] + [("none", 1, None)] * 3 + [("two", 1, -1.0), ("two", 1, 2.0)]
    rows += [("split", 1, 0.0)] * 2500 + [("split", 1, 1e300)] * 2500 + [("far", 1, r.choice([-1, 1]) * 10.0 ** r.randint(-300, 300)) for _ in range(4000)]
    r.shuffle(rows)
    frame = spark.createDataFrame(rows, KIND).withColumn("n", F.lit("clash")).withColumn("rank", F.lit(0))
    assert found(frame, strict, 100) == plain(rows, strict)
    assert found(spark.createDataFrame([], KIND), strict, 100) == {}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.just(1), st.one_of(st.none(), st.floats(-1e6, 1e6), st.sampled_from([0.0, 1.0]))), max_size=400), st.booleans())
def test_any_values(spark, rows, strict):
    assert found(spark.createDataFrame(rows, KIND), strict, 4) == plain(rows, strict)


def test_rounds_cut_a_group_down(spark):
    """One round leaves some of the shares' ranks only, whatever the distribution; nothing is lost around the rank."""
    n = 200_000
    values = spark.range(n).select(F.lit(0).cast("long").alias("__group"), F.exp(F.rand(3) * 50).alias("v"))
    values.write.mode("overwrite").parquet(path := spark.conf.get("spark.checkpoint.dir") + "/median-values")
    values = spark.read.parquet(path)
    wanted = values.groupBy("__group").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    wanted = wanted.withColumn("rank", F.explode(F.array(*[F.lit(k).cast("long") for k in (1, 500, n // 2, n - 3, n)]))).withColumn("place", F.col("rank"))
    cut = narrowed(values, wanted).collect()
    assert len(cut) == 5 and all(1 <= r.place <= r.n <= 6 * n / SHARES for r in cut)
    ordered = [r.v for r in values.orderBy("v").collect()]
    assert {r.rank: r.v for r in select_ranks(values, wanted, 64).collect()} == {k: ordered[k - 1] for k in (1, 500, n // 2, n - 3, n)}


def test_ten_million_values_in_one_group(spark):
    """No task gathers more than it may hold of the hot group."""
    n, held = 10_000_001, 10_000
    frame = spark.range(n).select(F.lit("hot").alias("a"), ((F.col("id") * 7_368_787) % n).cast("double").alias("value"))
    assert [tuple(r) for r in bounded_median(frame, ["a"], held=held).collect()] == [("hot", float(n // 2))]


@pytest.mark.parametrize("op,missing,want", [
    ("median", None, {0: 2.0, 1: 5.0, 2: 9.0, 3: 13.0}), ("median", 1, {0: None, 1: 5.0, 2: 9.0, 3: 13.0}), ("nanmedian", 1, {0: 1.0, 1: 5.0, 2: 9.0, 3: 13.0})])
def test_regrid_by_search(spark, small, op, missing, want):  # noqa: F811
    obs = spark.createDataFrame([("r", i, None if i == missing else float(2 * i + 1)) for i in range(7)], "rec string, src_id bigint, value double")
    assert {r.cell_id: r.value for r in regrid.regrid(obs, small, ["rec"], op, bounded=True).collect()} == want
    assert regrid.crowded(small, 2) and not regrid.crowded(small, 3)
