"""Medians over a mapping in packs, against its pairs and sorted lists."""

import math
import random
from statistics import median

import numpy as np
import pyarrow as pa
import pytest

from tidegrid.operators import mapping, packmedian, regrid

TARGET, SOURCE = "cell_id bigint, lon double, lat double, radius_m double", "src_id bigint, lon double, lat double"


@pytest.mark.parametrize("op", ["median", "nanmedian"])
def test_pairs_are_not_asked_for(spark, tmp_path, monkeypatch, op):
    """all sources are within reach of all targets; neither their pairs are made nor more rows moved than there are packs."""
    s = spark.range(3000).selectExpr("id AS src_id", "10 + id * 1e-4 AS lon", "45 + (id % 7) * 1e-4 AS lat")
    t = spark.range(400).selectExpr("id AS cell_id", "10 + id * 1e-3 AS lon", "45.0 AS lat", "1e6 AS radius_m")
    packs = mapping.ensure_packs(spark, str(tmp_path / "m"), ("D", "g", "", 1.0), t, s, 1000.0)

    def pairs(self):
        raise AssertionError("1.2 million pairs")

    monkeypatch.setattr(mapping.Packs, "pairs", pairs)
    obs = s.selectExpr("'f' AS field", "src_id", "double(src_id) AS value")
    out = {r.cell_id: r.value for r in regrid.regrid(obs, packs, ["field"], op).collect()}
    assert len(out) == 400 and set(out.values()) == {1499.5}


@pytest.mark.parametrize("op,limit", [("median", 1 << 25), ("nanmedian", -1)])
def test_packs_give_what_pairs_give(spark, tmp_path, monkeypatch, op, limit):
    """many packs, areas and runs; repeated ids and places, null keys, missing and infinite values, targets without sources or id."""
    monkeypatch.setattr(mapping, "PACK", 16)
    monkeypatch.setattr(mapping, "COPIES", 100)
    for name, size in (("HELD_AT_ONCE", 300), ("COMPARED_AT_ONCE", 200), ("ROWS_AT_ONCE", 10), ("PAIRS_AT_ONCE", 20), ("LAYERS", 1)):
        monkeypatch.setattr(packmedian, name, size)
    rnd = random.Random(8)
    sources = [(i % 150, rnd.uniform(-180, 180), rnd.uniform(-90, 90)) for i in range(160)] + [(200, 10.0, 10.0)] * 2 + [(201, 11.0, 10.0)]
    targets = [(i % 60, rnd.uniform(-180, 180), rnd.uniform(-90, 90), rnd.choice([1e5, 1e6, 4e6])) for i in range(64)]
    targets += [(90, 10.0, 10.0, 2e5), (91, 12.0, 10.0, 9e6), (91, 12.0, 10.0, 9e6), (None, 10.0, 10.0, 9e5), (None, 50.0, 10.0, 5e6)]
    t, s = spark.createDataFrame(targets, TARGET), spark.createDataFrame(sources, SOURCE)
    keys = [("r", 1.0), ("r", None), (None, 2.0), ("q", math.nan), ("q", 4.0)]
    odd = {3: None, 7: math.inf, 11: -math.inf, 13: math.nan}
    obs = [(*k, i, odd.get(rnd.randrange(60), float(rnd.randrange(100)))) for k in keys for i in range(202) for _ in range(rnd.randrange(4))]
    obs += [(*keys[0], None, 5.0), ("void", 5.0, 201, None)]
    obs = spark.createDataFrame(obs, "a string, b double, src_id bigint, value double")
    packs = mapping.ensure_packs(spark, str(tmp_path / "m"), ("D", "g", "", 1.0), t, s, 1e6)
    tiles, near, n = packs.areas(packs.cells())
    assert n > 2 and near.count() > near.select("pack").distinct().count() > 2
    text = lambda r: (r.a, str(r.b), r.cell_id, str(r.value))
    pairs = packs.pairs().localCheckpoint()
    for fallback in (True, False):
        got, want = (sorted((text(r) for r in regrid.regrid(obs, m, ["a", "b"], op, fallback, broadcast_limit=limit).collect()), key=repr) for m in (packs, pairs))
        assert got == want and len(got) > 100


def test_median_of_an_empty_grid(spark, tmp_path):
    """Without sources or targets there are no medians; without keys there is one for each cell."""
    t, s = spark.createDataFrame([(0, 0.0, 0.0, 1000.0)], TARGET), spark.createDataFrame([(0, 0.0, 0.0), (1, 0.0, 0.001)], SOURCE)
    obs = spark.createDataFrame([(0, 1.0), (1, 4.0)], "src_id bigint, value double")
    for n, (a, b, want) in enumerate([(t.filter("false"), s, []), (t, s.filter("false"), []), (t, s, [(0, 2.5)])]):
        packs = mapping.ensure_packs(spark, str(tmp_path / "m"), ("D", "g", "", float(n)), a, b, 1000.0)
        assert [tuple(r) for r in regrid.regrid(obs, packs, [], "median").collect()] == want


@pytest.mark.parametrize("strict", [False, True])
def test_middles(monkeypatch, strict):
    """Sources with no, one or many values; more values than are taken at once."""
    rnd = random.Random(3)
    for layers, at_once in ((8, 1 << 20), (1, 1 << 20), (2, 10)):
        monkeypatch.setattr(packmedian, "LAYERS", layers)
        monkeypatch.setattr(packmedian, "PAIRS_AT_ONCE", at_once)
        n, m = 9, 30
        values = [[rnd.choice([0.0, -0.5, 1e9, rnd.random()]) for _ in range(rnd.choice([0, 1, 2, 40]))] for _ in range(m)]
        gone = [i for i in range(m) if rnd.random() < 0.05]
        source = np.repeat(np.arange(m), [len(v) for v in values])
        order = np.random.default_rng(1).permutation(len(source))
        record = packmedian._Record(pa.array([{"k": 1}]), source[order], np.array([x for v in values for x in v])[order], np.array(gone, np.int64), m)
        pairs = [(a, b) for a in range(n - 1) for b in range(m) if rnd.random() < 0.3]
        rnd.shuffle(pairs)
        got = {}
        for found, middle, there in record.middles(*map(np.array, zip(*pairs, strict=True)), n, strict):
            got |= {int(a): float(v) if ok else None for a, v, ok in zip(found, middle, there, strict=True)}
        want = {}
        for a in {a for a, b in pairs if values[b] or b in gone}:
            held = [x for c, b in pairs if c == a for x in values[b]]
            want[a] = None if not held or (strict and any(c == a and b in gone for c, b in pairs)) else median(held)
        assert got == want
