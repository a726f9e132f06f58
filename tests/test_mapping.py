import math
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidegrid import sizing
from tidegrid.functions.geo import SPHERE_RADIUS_M as R
from tidegrid.functions.masks import UnknownFunction
from tidegrid.operators import mapping, regrid


def xyz(lon, lat):
    lam, phi = math.radians(lon), math.radians(lat)
    return R * math.cos(phi) * math.cos(lam), R * math.cos(phi) * math.sin(lam), R * math.sin(phi)


def brute(targets, sources, max_l, k):
    """All distances, one by one."""
    out = set()
    for cell, lon, lat, radius in targets:
        near = sorted((round(math.dist(xyz(lon, lat), xyz(a, b)), 3), s) for s, a, b in sources)
        hits = [(d, s) for d, s in near if d <= radius][:k]
        if hits:
            out |= {(cell, s, "radius") for _, s in hits}
        elif near and near[0][0] <= int(max_l):
            out.add((cell, near[0][1], "nearest"))
    return out


def frames(spark, targets, sources):
    return (spark.createDataFrame(targets, "cell_id bigint, lon double, lat double, radius_m double"),
            spark.createDataFrame(sources, "src_id bigint, lon double, lat double"))


def check(spark, targets, sources, max_l, k):
    t, s = frames(spark, targets, sources)
    got = mapping.build_mapping(t, s, max_l, k).select("cell_id", "src_id", "kind").collect()
    assert {tuple(r) for r in got} == brute(targets, sources, max_l, k)
    assert len(got) == len({tuple(r) for r in got})


coordinate = st.tuples(st.floats(-180, 180).map(lambda x: round(x, 3)), st.floats(-90, 90).map(lambda x: round(x, 3)))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(coordinate, min_size=1, max_size=30), st.lists(coordinate, min_size=1, max_size=60), st.sampled_from([1, 3, 100]))
def test_equals_brute_force(spark, where, points, k):
    targets = [(i, lo, la, 1e5 * (1 + i % 40)) for i, (lo, la) in enumerate(where)]
    sources = [(i, lo, la) for i, (lo, la) in enumerate(points)]
    check(spark, targets, sources, 900_000.0, k)


@pytest.mark.parametrize("k", [1, 5, 50, None])
def test_crowded_sources(spark, k):
    """A third of the sources in one spot, a third within metres of it, the rest spread out."""
    rnd = random.Random(7)
    sources = [(i, 10.0, 80.0) for i in range(300)]
    sources += [(300 + i, 10.0 + rnd.uniform(-1e-3, 1e-3), 80.0 + rnd.uniform(-1e-4, 1e-4)) for i in range(300)]
    sources += [(600 + i, rnd.uniform(-180, 180), rnd.uniform(-90, 90)) for i in range(300)]
    targets = [(0, 10.0, 80.0, 500_000.0), (1, 10.0005, 80.00005, 5.0), (2, 11.0, 80.5, 300_000.0), (3, -170.0, 0.0, 2_000_000.0)]
    check(spark, targets, sources, 800_000.0, k)


def test_poles_and_date_line(spark):
    sources = [(0, 179.9, 0.0), (1, -179.9, 0.0), (2, 0.0, 89.9), (3, 180.0, 89.9), (4, 90.0, -89.95)]
    targets = [(0, -180.0, 0.0, 30_000.0), (1, 45.0, 90.0, 30_000.0), (2, -90.0, -90.0, 30_000.0)]
    check(spark, targets, sources, 1.0, 10)


def test_invalid_positions_are_left_out(spark):
    sources = [(0, 0.0, 0.0), (1, None, 0.0), (2, 0.0, float("nan")), (3, 0.0, 95.0)]
    t, s = frames(spark, [(0, 0.0, 0.0, 1000.0), (1, None, None, 1000.0)], sources)
    assert [(r.cell_id, r.src_id) for r in mapping.build_mapping(t, s, 1000.0).collect()] == [(0, 0)]


def test_whole_metre_search_bounds(spark):
    """The largest radius and the source spacing are cut to whole metres."""
    sources = [(0, 0.0, 1000.7 / R * 180 / math.pi)]
    t, s = frames(spark, [(0, 0.0, 0.0, 1000.9)], sources)
    assert mapping.radius_pairs(t, s, 10, search_radius_m=1000.9).count() == 0
    assert mapping.radius_pairs(t, s, 10).count() == 1
    assert mapping.nearest_pairs(t, s, 1000.9).count() == 0
    assert mapping.nearest_pairs(t, s, 1001.0).count() == 1


def test_neighbour_limit_must_be_positive(spark):
    t, s = frames(spark, [(0, 0.0, 0.0, 1.0)], [(0, 0.0, 0.0)])
    with pytest.raises(ValueError):
        mapping.radius_pairs(t, s, 0)


@pytest.fixture
def small(spark):
    pairs = [(0, 0, 1.0, 1), (0, 1, 2.0, 2), (1, 2, 1.0, 1), (2, 3, 1.0, 1), (2, 4, 2.0, 2), (2, 5, 3.0, 3)]
    table = [(c, s, d, r, "radius") for c, s, d, r in pairs] + [(3, 6, 9.0, 1, "nearest")]
    return spark.createDataFrame(table, "cell_id bigint, src_id bigint, dist_m double, rank int, kind string")


@pytest.mark.parametrize("limit", [1 << 25, -1])
@pytest.mark.parametrize("op,missing,fallback,want", [
    ("mean", None, True, {0: 2.0, 1: 5.0, 2: 9.0, 3: 13.0}), ("mean", None, False, {0: 2.0, 1: 5.0, 2: 9.0}),
    ("nanmean", 1, True, {0: 1.0, 1: 5.0, 2: 9.0, 3: 13.0}), ("mean", 1, True, {0: None, 1: 5.0, 2: 9.0, 3: 13.0}),
    ("median", None, True, {0: 2.0, 1: 5.0, 2: 9.0, 3: 13.0}), ("median", 1, True, {0: None, 1: 5.0, 2: 9.0, 3: 13.0}),
    ("nanmedian", 1, True, {0: 1.0, 1: 5.0, 2: 9.0, 3: 13.0}), ("nearest", None, True, {0: 1.0, 1: 5.0, 2: 7.0, 3: 13.0}),
    ("nearest", 3, True, {0: 1.0, 1: 5.0, 2: None, 3: 13.0}),
])
def test_reduction(spark, small, op, missing, fallback, want, limit):
    obs = spark.createDataFrame(
        [("r", i, None if i == missing else float(2 * i + 1)) for i in range(7)], "rec string, src_id bigint, value double")
    out = regrid.regrid(obs, small, ["rec"], op, allow_nearest=fallback, broadcast_limit=limit)
    assert {r.cell_id: r.value for r in out.collect()} == want


def test_all_missing_does_not_fall_back(spark, small):
    obs = spark.createDataFrame([("r", i, None if i < 2 else 1.0) for i in range(7)], "rec string, src_id bigint, value double")
    got = {r.cell_id: r.value for r in regrid.regrid(obs, small, ["rec"], "nanmean").collect()}
    assert got[0] is None and got[3] == 1.0


def test_unknown_operation(spark, small):
    with pytest.raises(UnknownFunction):
        regrid.regrid(spark.createDataFrame([("r", 0, 1.0)], "rec string, src_id bigint, value double"), small, ["rec"], "mode")


def test_full_grid_and_stats(spark, small, rows):
    obs = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 3.0), ("b", 2, None)], "rec string, src_id bigint, value double")
    cells = spark.createDataFrame([(i,) for i in range(5)], "cell_id bigint")
    out = regrid.on_full_grid(regrid.regrid(obs, small, ["rec"]), cells.withColumn("grid", F.lit("g")), obs.select("rec", F.lit("g").alias("grid")).distinct(), ["rec"])
    with pytest.raises(ValueError):
        regrid.on_full_grid(out, cells, obs, ["rec"], cell_on=())
    assert out.count() == 10 and out.filter("value is not null").count() == 1
    assert rows(regrid.record_stats(out, ["rec"]), "rec", "n_valid", "has_data", "notes") == [
        ("a", 1, True, ""), ("b", 0, False, " -- empty record -- ")]


def test_mapping_store(spark, tmp_path):
    """Reuse needs the same grids and parameters; other keys stay, also without this package's settings."""
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        t, s = frames(spark, [(0, 0.0, 0.0, 1000.0)], [(0, 0.0, 0.0), (1, 0.0, 0.001)])
        key, path = ("D", "g", "nh", 1.0), str(tmp_path / "m")
        ids = lambda key, t, s, *a, **k: sorted(r.src_id for r in mapping.ensure_mapping(spark, path, key, t, s, *a, **k).collect())
        assert ids(key, t, s, 1000.0) == [0, 1]
        files = sorted((tmp_path / "m").rglob("*.parquet"))
        assert ids(key, t, s, 1000.0) == [0, 1] and sorted((tmp_path / "m").rglob("*.parquet")) == files
        other = s.withColumn("src_id", F.col("src_id") + 99)
        assert ids(("D", "g", "nh", 2.0), t, other, 1000.0) == [99, 100]
        assert sorted((tmp_path / "m/ds=D/grid=g/hemi=nh/t_version=1.0").rglob("*.parquet")) == files
        assert ids(key, t, s, 1000.0, max_neighbours=1) == [0]
        assert ids(key, t, other, 1000.0) == [99, 100]
        assert ids(("E", "g", "", 1.0), t.filter("cell_id > 0"), s, 1000.0) == []
        marks = {tuple(p.parent.name for p in (tmp_path / "m").rglob("_SUCCESS"))}
        assert ids(("E", "g", "", 1.0), t.filter("cell_id > 0"), s, 1000.0) == [] and marks == {tuple(p.parent.name for p in (tmp_path / "m").rglob("_SUCCESS"))}
        assert mapping.invalidate_mappings(spark, path, ds="D") == 1
        assert sorted(p.name for p in (tmp_path / "m").glob("ds=*/*")) == ["grid=g"]
        assert ids(key, t, s, 1000.0) == [0, 1]
        assert mapping.invalidate_mappings(spark, path) == 2
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


@pytest.mark.parametrize("where", ["beside", "around", "far"])
def test_candidates_beside_a_dense_place(spark, where):
    """The join makes a small multiple of k rows per target, wherever the crowd is."""
    rnd = random.Random(3)
    sources = [(i, 10.0 + rnd.uniform(0, 2e-3), 45.0 + rnd.uniform(0, 2e-3)) for i in range(6000)]
    lon = {"beside": 9.999, "around": 10.001, "far": 10.7}[where]
    targets = [(i, lon + rnd.uniform(-5e-4, 5e-4), 45.001 + rnd.uniform(-5e-4, 5e-4), 200_000.0) for i in range(40)]
    t, s = frames(spark, targets, sources)
    assert mapping.candidate_pairs(t, s, F.col("radius_m"), 10).count() <= 40 * 10 * 25
    check(spark, targets, sources, 1.0, 10)


def test_full_grid_block_by_block(spark):
    """Large and sparse cell numbers, records without values, values on cells that the grid lacks."""
    ids = [*range(0, 3000, 3), 10**12, 10**12 + 5000]
    cells = spark.createDataFrame([(g, c) for g in "gh" for c in ids] + [("g", 1)], "grid string, cell_id bigint")
    records = spark.createDataFrame([(f"r{i}", "gh"[i % 2]) for i in range(7)] + [("lost", "x")], "rec string, grid string")
    values = [(f"r{i}", c, float(c + i)) for i in range(6) for c in (0, 3 * i, 2997, 10**12, 7)]
    out = regrid.on_full_grid(spark.createDataFrame(sorted(set(values)), "rec string, cell_id bigint, value double"), cells, records, ["rec"])
    have = {(r, c): v for r, c, v in values}
    want = {(f"r{i}", "gh"[i % 2], c, have.get((f"r{i}", c))) for i in range(7) for c in ids + ([1] if i % 2 == 0 else [])}
    got = [tuple(r) for r in out.select("rec", "grid", "cell_id", "value").collect()]
    assert len(got) == len(want) and set(got) == want


def test_crowd_of_many_packs(spark, monkeypatch):
    """With a neighbour limit a target goes on to the few packs that can hold its neighbours, not to all of a crowd's."""
    monkeypatch.setattr(mapping, "PACK", 64)
    rnd = random.Random(5)
    sources = [(i, 10.0 + rnd.uniform(0, 2e-3), 45.0 + rnd.uniform(0, 2e-3)) for i in range(4000)] + [(4000 + i, 10.001, 45.001) for i in range(100)]
    targets = [(i, 9.99 + rnd.uniform(0, 0.02), 45.001, 200_000.0) for i in range(70)]
    t, s = frames(spark, targets, sources)
    pairs = mapping.candidate_pairs(t, s, F.col("radius_m"), 10)
    assert pairs.count() <= 70 * 10 * 20
    assert "BroadcastHashJoin" not in pairs._jdf.queryExecution().executedPlan().toString()
    check(spark, targets, sources, 1.0, 10)


def test_salts_do_not_multiply_a_large_mapping(spark, tmp_path):
    """A mapping that is larger than the observations is joined once, not once for each sub-key."""
    spark.range(200_000).selectExpr("id AS cell_id", "id % 10 AS src_id", "rand(1) AS dist_m", "'radius' AS kind").write.parquet(str(tmp_path / "m"))
    spark.range(10).selectExpr("id AS src_id", "'f' AS field", "double(id) AS value").write.parquet(str(tmp_path / "o"))
    m, obs = spark.read.parquet(str(tmp_path / "m")), spark.read.parquet(str(tmp_path / "o"))
    assert sizing.affordable_salts(obs, m) == 1
    assert sizing.affordable_salts(m, obs) == sizing.salts_for(m)
    out = regrid.regrid(obs, m, ["field"], "mean", broadcast_limit=-1)
    assert out.filter("value = cell_id % 10").count() == 200_000


def test_every_pair_is_moved_once(spark, tmp_path, monkeypatch):
    """A mapping without a limit is ranked and written: pairs are not stored in between or sorted again for the file."""
    stored = []
    keep = mapping.materialize
    monkeypatch.setattr(mapping, "materialize", lambda df, path: stored.append(df.columns) or keep(df, path))
    t, s = frames(spark, [(0, 0.0, 0.0, 1000.0), (1, 9.0, 9.0, 1.0)], [(0, 0.0, 0.0), (1, 0.0, 0.001), (2, 9.0, 9.001)])
    got = mapping.ensure_mapping(spark, str(tmp_path / "m"), ("D", "g", "", 1.0), t, s, 1000.0)
    assert sorted((r.cell_id, r.src_id, r.kind) for r in got.collect()) == [(0, 0, "radius"), (0, 1, "radius"), (1, 2, "nearest")]
    assert not any({"src_id", "dist_m"} <= set(columns) for columns in stored)


def regridded(df):
    text = lambda v: v if v is None or math.isfinite(v) else str(v)
    return {(r.a, r.b, r.cell_id): text(r.value if r.value is None or not math.isfinite(r.value) else round(r.value, 6)) for r in df.collect()}


@pytest.mark.parametrize("op,limit", [("mean", 1 << 25), ("nanmean", -1), ("nearest", -1)])
def test_packs_give_what_pairs_give(spark, tmp_path, monkeypatch, op, limit):
    """many packs and sheets; repeated ids and places, null keys, missing and infinite values, targets without sources."""
    monkeypatch.setattr(mapping, "PACK", 16)
    monkeypatch.setattr(regrid, "SHEET", 40)
    monkeypatch.setattr(regrid, "RECORDS_AT_ONCE", 2)
    rnd = random.Random(8)
    sources = [(i % 150, rnd.uniform(-180, 180), rnd.uniform(-90, 90)) for i in range(160)] + [(200, 10.0, 10.0)] * 2 + [(201, 11.0, 10.0)]
    targets = [(i % 60, rnd.uniform(-180, 180), rnd.uniform(-90, 90), rnd.choice([1e5, 1e6, 4e6])) for i in range(64)] + [(90, 10.0, 10.0, 2e5)]
    t, s = frames(spark, targets, sources)
    keys = [("r", 1), ("r", None), (None, 2), ("q", 3), ("q", 4)]
    odd = {3: None, 7: math.inf, 11: -math.inf, 13: math.nan}
    obs = [(*k, i, odd.get(rnd.randrange(60), float(rnd.randrange(100))), n) for n, (k, i) in enumerate((k, i) for k in keys for i in range(202) if rnd.random() < 0.8)]
    obs += [(*keys[0], 201, 5.0, 10**6), (*keys[0], None, 5.0, 10**6)]
    obs = spark.createDataFrame(obs, "a string, b int, src_id bigint, value double, n long")
    pairs = mapping.build_mapping(t, s, 1e6).localCheckpoint()
    packs = mapping.ensure_packs(spark, str(tmp_path / "m"), ("D", "g", "", 1.0), t, s, 1e6)
    assert packs.sources.count() > 8 and packs.nearest.count() > 0
    same = lambda df: sorted(tuple(r) for r in df.select("cell_id", "src_id", "dist_m", "kind").collect())
    assert same(packs.pairs()) == same(pairs)
    for fallback in (True, False):
        got, want = (regridded(regrid.regrid(obs, m, ["a", "b"], op, allow_nearest=fallback, ties=["n"], broadcast_limit=limit)) for m in (packs, pairs))
        assert got == want and len(got) > 100


def test_pairs_are_neither_stored_nor_moved(spark, tmp_path):
    """all sources are within reach of all targets; the stored mapping and what a mean shuffles follow the cells."""
    s = spark.range(3000).selectExpr("id AS src_id", "10 + id * 1e-4 AS lon", "45 + (id % 7) * 1e-4 AS lat")
    t = spark.range(400).selectExpr("id AS cell_id", "10 + id * 1e-3 AS lon", "45.0 AS lat", "1e6 AS radius_m")
    packs = mapping.ensure_packs(spark, str(tmp_path / "m"), ("D", "g", "", 1.0), t, s, 1000.0)
    assert sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < 400_000  # 1.2 million pairs
    obs = s.selectExpr("'f' AS field", "src_id", "double(src_id) AS value")
    out = regrid.regrid(obs, packs, ["field"], "mean")
    assert out.filter("abs(value - 1499.5) < 1e-6").count() == out.count() == 400
    whole = {"cell_id", "src_id"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(whole <= {w.split("#")[0].strip(" []") for w in line.split(",")} for line in plan.splitlines() if "Exchange" in line)


def test_full_grid_over_packs(spark, tmp_path):
    """F8: every cell of every record comes out, from packs as from pairs."""
    t, s = frames(spark, [(0, 0.0, 0.0, 1000.0), (1, 5.0, 5.0, 1.0), (2, 50.0, 50.0, 1.0)], [(0, 0.0, 0.0), (1, 0.0, 0.001), (2, 5.0, 5.005)])
    packs = mapping.ensure_packs(spark, str(tmp_path / "m"), ("D", "g", "", 1.0), t, s, 1000.0)
    obs = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 4.0), ("a", 2, 7.0), ("b", 2, None)], "rec string, src_id bigint, value double")
    g = F.lit("g").alias("grid")
    out = regrid.on_full_grid(regrid.regrid(obs, packs, ["rec"], "nanmean"), t.select("cell_id", g), obs.select("rec", g).distinct(), ["rec"])
    assert {(r.rec, r.cell_id): r.value for r in out.collect()} == {("a", 0): 2.5, ("a", 1): 7.0, ("a", 2): None, ("b", 0): None, ("b", 1): None, ("b", 2): None}


def test_mapping_of_an_empty_grid(spark, tmp_path):
    """Without sources or targets a mapping is stored, is empty and gives no values."""
    t, s = frames(spark, [(0, 0.0, 0.0, 1000.0)], [(0, 0.0, 0.0)])
    obs = spark.createDataFrame([("f", 0, 1.0)], "field string, src_id bigint, value double")
    for n, (a, b) in enumerate([(t.filter("false"), s), (t, s.filter("false"))]):
        packs = mapping.ensure_packs(spark, str(tmp_path / "m"), ("D", "g", "", float(n)), a, b, 1000.0)
        assert packs.pairs().count() == 0 and regrid.regrid(obs, packs, ["field"]).count() == 0
