from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.functions import layout
from tidegrid.operators import mapping, state
from tidegrid.plans import aggregate, harvest, transform
from tidegrid.schemas import DatasetConfig, GRANULE
from tidegrid.sinks.packing import numbered_cells, pack_records, pack_whole
from tidegrid.sinks.provenance import members, provenance_lines, read_lineage, write_lineage, write_provenance
from tidegrid.sinks.store import CommitConflict, StateStore
from tidegrid.sizing import bounded_broadcast, plan_bytes, spread_join
from tidegrid.sources import listings
from tidegrid.sources.grids import generate
from tidegrid.functions.geo import Projection
from tidegrid.streaming import jobs

D = datetime
NOW = "2021-01-01"


def now():
    return F.lit(NOW).cast("timestamp")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, how, rows):
    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(60)], "id int, k string")
    small = spark.createDataFrame([("hot", 1), ("k3", 2), ("k6", 3)], "k string, v int")
    cols = ["id", "k"] + (["v"] if how in ("inner", "left") else [])
    want = rows(big.join(small, ["k"], how), *cols)
    assert rows(spread_join(big, small, ["k"], ["id"], how, limit=-1), *cols) == want
    assert rows(spread_join(big, small, ["k"], ["id"], how), *cols) == want
    with pytest.raises(ValueError):
        spread_join(big, small, ["k"], ["id"], "full_outer")


def test_broadcast_needs_a_small_side(spark):
    df = spark.range(10)
    assert plan_bytes(df) == 80
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(bounded_broadcast(df)) and not hinted(bounded_broadcast(df, limit=10))


def test_packing_fills_and_orders(spark):
    rows = [(t, p, None if p == 3 else float(p + t)) for t in (0, 1) for p in range(200)]
    df = spark.createDataFrame(rows, "t int, pos int, value double")
    blocks = pack_records(df, ["t"], F.col("pos"), 200, block_cells=64)
    assert sorted((r.block, r.offset, len(r.data)) for r in blocks.filter("t = 0").collect()) == [(0, 0, 256), (1, 256, 256), (2, 512, 256), (3, 768, 32)]
    whole = {t: np.concatenate([np.frombuffer(r.data, ">f4") for r in blocks.filter(F.col("t") == t).orderBy("offset").collect()]) for t in (0, 1)}
    for t in (0, 1):
        want = np.arange(200, dtype="f4") + t
        want[3] = -9999
        assert np.array_equal(whole[t], want)


def test_packing_whole_records(spark):
    """Records with many, few and no values; the last block is shorter; positions and fill values are right."""
    values = spark.createDataFrame([("a", p, None if p % 5 == 0 else float(p)) for p in range(150)] + [("b", 149, 7.0)], "rec string, position long, value double")
    records = spark.createDataFrame([("a", 150), ("b", 150), ("gap", 130), ("none", 0)], "rec string, n_cells long")
    got = pack_whole(values, records, ["rec"], block_cells=64).collect()
    assert sorted((r.rec, r.block, r.offset, len(r.data)) for r in got) == [
        (n, b, 256 * b, size * 4) for n, last in (("a", 22), ("b", 22), ("gap", 2)) for b, size in ((0, 64), (1, 64), (2, last))]
    whole = {n: np.concatenate([np.frombuffer(r.data, ">f4") for r in sorted(got, key=lambda r: r.block) if r.rec == n]).tolist() for n in ("a", "b", "gap")}
    assert whole["a"] == [-9999.0 if p % 5 == 0 else float(p) for p in range(150)]
    assert whole["b"] == [-9999.0] * 149 + [7.0] and whole["gap"] == [-9999.0] * 130


def test_cells_are_numbered_in_order(spark, tmp_path):
    ids = [*range(0, 5000, 7), 10**13, -4]
    got = {r.cell_id: r.position for r in numbered_cells(spark.createDataFrame([(i,) for i in ids], "cell_id long").repartition(5), str(tmp_path / "n")).collect()}
    assert got == {c: n for n, c in enumerate(sorted(ids))}


def test_packing_llc_order(spark):
    cells = [(t, j, i, float(n)) for n, (t, j, i) in enumerate((t, j, i) for t in range(13) for j in range(3) for i in range(3))]
    df = spark.createDataFrame([(0, *c) for c in cells], "rec int, tile int, j int, i int, value double")
    data = pack_records(df, ["rec"], layout.flat_index("llc", 3, "j", "i", "tile"), 117).first().data
    tiles = np.arange(117).reshape(13, 3, 3)
    faces = [tiles[0:6].reshape(-1), tiles[6].reshape(-1), np.concatenate(tiles[7:10], 1).reshape(-1), np.concatenate(tiles[10:13], 1).reshape(-1)]
    assert np.array_equal(np.frombuffer(data, ">f4"), np.concatenate(faces).astype("f4"))


def granule(name, **kw):
    base = {f.name: None for f in GRANULE.fields}
    return tuple({**base, "ds": "D", "filename": name, **kw}[f.name] for f in GRANULE.fields)


def test_store_snapshots(spark, tmp_path, rows):
    store = StateStore(spark, str(tmp_path / "state"))
    assert store.read("granule").count() == 0
    store.upsert("granule", spark.createDataFrame([granule("a", size=1, message="m"), granule("b", size=2)], GRANULE))
    news = spark.createDataFrame([("D", "a", 9), ("D", "c", 3)], "ds string, filename string, size bigint")
    store.upsert("granule", news, set_columns=["size"])
    assert rows(store.read("granule"), "filename", "size", "message") == [("a", 9, "m"), ("b", 2, None), ("c", 3, None)]
    assert store.versions("granule") == [1, 2]
    (tmp_path / "state" / "granule" / "cdead" / "_part=D.none").mkdir(parents=True)  # a commit that never finished
    assert store.versions("granule") == [1, 2] and store.read("granule").count() == 3
    store.expire("granule", keep=1)
    assert store.versions("granule") == [2]


def test_record_results_keeps_files_on_failure(spark, rows):
    tx = spark.createDataFrame([("1", True, False, "old.nc"), ("2", True, False, "old.nc"), ("3", True, False, "x")], "id string, in_progress boolean, success boolean, output_name string")
    res = spark.createDataFrame([("1", True, "new.nc", "p", "c", ""), ("2", False, "bad.nc", "p", "c", "boom"), (None, True, "n", "p", "c", "")], "id string, success boolean, output_name string, output_path string, checksum string, message string")
    updates, skipped = state.result_updates(res, now(), F.lit(2.0))
    assert skipped.count() == 1
    assert rows(state.record_results(tx, updates), "id", "in_progress", "success", "output_name") == [
        ("1", False, True, "new.nc"), ("2", False, False, "old.nc"), ("3", True, False, "x")]


def test_table_page_layout(spark, rows):
    tr = lambda n: f'<tr><td></td><td><a href="{n}">x</a></td><td> 2020-01-0{n[-1]} 10:00 </td></tr>'
    page = "<tr>h</tr><tr>h</tr><tr>h</tr>" + tr("f1") + tr("f2") + "<tr>foot</tr>"
    df = spark.createDataFrame([("https://h/d/", page), ("https://h/e", "<p>none</p>")], "url string, body string")
    assert rows(listings.entries_table(df), "url", "mod_time") == [("https://h/d/f1", D(2020, 1, 1, 10)), ("https://h/d/f2", D(2020, 1, 2, 10))]


def test_xml_entry_without_date_keeps_alignment(spark, rows):
    doc = ('<catalog xmlns="http://c"><dataset><dataset urlPath="a.nc"/><dataset urlPath="b.nc"><date type="modified">2020-01-02T00:00:00Z</date></dataset>'
           '<dataset name="sub"><dataset urlPath="c.nc"><date>2020-01-03T00:00:00Z</date></dataset></dataset></dataset></catalog>')
    df = spark.createDataFrame([("u", doc), ("u", "<catalog/>")], "url string, body string")
    assert rows(listings.entries_xml(df, "https://s"), "url", "mod_time") == [
        ("https://s/a.nc", None), ("https://s/b.nc", D(2020, 1, 2)), ("https://s/c.nc", D(2020, 1, 3))]


def test_source_grid_corner_cells(spark):
    cells = {r.src_id: r for r in generate(spark, (4, 2), (0.0, -90.0, 360.0, 90.0), Projection("longlat")).collect()}
    assert (cells[0].lon, cells[0].lat) == (45.0, 45.0) and (cells[7].lon, cells[7].lat) == (-45.0, -45.0)
    assert (cells[5].row, cells[5].col) == (1, 1)


CONFIG = DatasetConfig.of({
    "ds_name": "D", "start": "20200101T00:00:00Z", "end": "20201231T00:00:00Z", "t_version": 1.0, "a_version": "1.0",
    "hemi_pattern": {"north": "_nh", "south": "_sh"}, "do_monthly_aggregation": True, "skipna_in_mean": True,
    "fields": [{"name": "sst", "units": "K", "pre_transformations": ["negatives"], "post_transformations": ["kelvin_to_celsius"]}, {"name": "h", "units": "m"}]})


def test_harvest_to_products(spark, tmp_path, rows):
    """Listing to plan to state to regridded records to annual products, on one small grid."""
    store = StateStore(spark, str(tmp_path / "state"))
    urls = [f"https://x/a_{h}_202001{d:02d}.nc" for d in (1, 2) for h in ("nh", "sh")] + ["https://x/a_nh_20190101.nc"]
    listing = spark.createDataFrame([(u, D(2020, 2, 1)) for u in urls], "url string, mod_time timestamp")
    plan = harvest.plan(listing, CONFIG, store.read("granule"))
    assert plan.count() == 4
    files = plan.select("filename", F.concat(F.lit("/d/"), "filename").alias("path"), F.lit(500).cast("bigint").alias("size"),
                        F.lit("2020-03-01").cast("timestamp").alias("mtime"), F.md5("filename").alias("checksum"))
    tries = plan.select("ds", "filename", "date", "url", "mod_time", F.lit(True).alias("success"), F.lit("").alias("message"), F.lit(1).alias("duration"))
    harvest.record(store, tries, files, now())
    assert harvest.plan(listing, CONFIG, store.read("granule")).count() == 0
    assert rows(store.read("dataset"), "n_granules", "harvest_status") == [(4, "All granules successfully harvested")]

    targets = spark.createDataFrame([("D", "g", "sst"), ("D", "g", "h")], "ds string, grid string, field string")
    outputs = spark.createDataFrame([("D", "a_nh_20200101.nc", "g", "h", D(2020, 4, 1), 1.0)], "ds string, filename string, grid string, field string, output_mtime timestamp, output_version double")
    source_files = files.select("path", "mtime")
    planned = transform.plan(store, CONFIG, targets, source_files, outputs)
    ready = transform.begin(store, planned, now(), str(tmp_path / "work"))
    assert ready.count() == 7
    tx = store.read("transformation")
    assert tx.count() == 8 and tx.filter("in_progress").count() == 7 and tx.filter("success").count() == 1

    src = spark.createDataFrame([(0, 0.0, 0.0), (1, 0.1, 0.0), (2, 10.0, 0.0)], "src_id bigint, lon double, lat double")
    cells = spark.createDataFrame([("g", 0, 0.05, 0.0, 20_000.0), ("g", 1, 10.2, 0.0, 1000.0)], "grid string, cell_id bigint, lon double, lat double, radius_m double")
    m = mapping.build_mapping(cells, src, 50_000.0)
    obs = store.read("granule").select("ds", "filename", "date").withColumn("hemi", F.regexp_extract("filename", "_(nh|sh)_", 1))
    obs = obs.withColumn("src_id", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(3)]))).withColumn("sst", F.when(F.col("hemi") == "sh", 300.15).when(F.col("src_id") == 0, 273.15).when(F.col("src_id") == 1, 283.15).otherwise(-5.0))
    out = transform.regrid_dataset(obs, m, CONFIG, "g")
    got = {(r.filename, r.field, r.cell_id): (r.value, r.units) for r in out.collect()}
    assert got["a_nh_20200101.nc", "sst", 0] == (pytest.approx(5.0), "Celsius")
    assert got["a_nh_20200101.nc", "sst", 1] == (None, "Celsius")
    assert got["a_sh_20200101.nc", "sst", 1] == (pytest.approx(27.0), "Celsius")
    assert got["a_sh_20200101.nc", "h", 0] == (None, "m")

    results = store.read("transformation").filter("in_progress").select(
        "id", F.lit(True).alias("success"), F.lit("o").alias("output_name"), F.lit("/o").alias("output_path"), F.lit("c").alias("checksum"), F.lit("").alias("message"))
    transform.finish(store, results, now(), F.lit(1.0))
    assert rows(store.read("dataset"), "transformation_status", "n_granules") == [("All transformations successful", 4)]
    again = transform.plan(store, CONFIG, targets, source_files, outputs)
    assert again.filter("reason is not null").count() == 0

    a_versions = spark.createDataFrame([("D", "1.0")], "ds string, a_version string")
    todo = aggregate.plan(store, targets, a_versions)
    assert rows(todo, "grid", "field", "year") == [("g", "h", 2020), ("g", "sst", 2020)]
    daily, monthly = str(tmp_path / "daily"), str(tmp_path / "monthly")
    more = {f"{n}_path": str(tmp_path / n) for n in ("facts", "packed", "lineage")}
    before = store.latest()
    aggregate.run(store, out, cells, todo, CONFIG, daily, monthly, str(tmp_path / "staging"), F.lit("2022-01-01").cast("timestamp"), **more)
    assert store.latest() == before + 1  # state and status in one commit
    facts = {r.scale: r for r in spark.read.parquet(more["facts_path"]).collect()}
    assert set(facts) == {"daily", "monthly"} and facts["daily"].field == "sst" and facts["daily"].valid_max == pytest.approx(27.0)
    assert (facts["daily"].coverage_start, facts["daily"].coverage_end, facts["daily"].resolution) == (D(2020, 1, 1), D(2021, 1, 1), "P1D")
    assert facts["monthly"].resolution == "P1M" and facts["daily"].attrs["interpolated_grid"] == "g" and "original_filename" not in facts["daily"].attrs
    blocks = spark.read.parquet(more["packed_path"] + "/blocks")
    first = np.frombuffer(blocks.filter("date = DATE'2020-01-01'").first().data, ">f4")
    assert blocks.count() == 366 and first.tolist() == [pytest.approx(5.0), pytest.approx(27.0)]
    assert np.frombuffer(blocks.filter("date = DATE'2020-06-01'").first().data, ">f4").tolist() == [-9999.0] * 2
    lineage = read_lineage(spark, more["lineage_path"])
    assert rows(lineage.groupBy("field", "kind").count(), "field", "kind", "count") == [("h", "product", 1), ("h", "transformation", 4), ("sst", "product", 1), ("sst", "transformation", 4)]
    found = store.read("aggregation")
    write_lineage(provenance_lines(members(store.read("transformation"), store.read("granule")), found, store.read("dataset")), found, more["lineage_path"])
    assert read_lineage(spark, more["lineage_path"]).count() == 10  # known versions are not written again
    assert [r.daily_path.startswith(daily) for r in found.orderBy("field").collect()] == [False, True]
    d = spark.read.parquet(daily)
    assert d.count() == 366 * 2 and rows(d.filter("value is not null"), "date", "cell_id", "value") == [
        (date(2020, 1, 1), 0, pytest.approx(5.0)), (date(2020, 1, 1), 1, pytest.approx(27.0)),
        (date(2020, 1, 2), 0, pytest.approx(5.0)), (date(2020, 1, 2), 1, pytest.approx(27.0))]
    mm = spark.read.parquet(monthly)
    assert mm.count() == 24 and rows(mm.filter("month = 1"), "cell_id", "value") == [(0, pytest.approx(5.0)), (1, pytest.approx(27.0))]
    assert rows(store.read("aggregation"), "field", "success", "notes") == [
        ("h", True, "Empty year (no data present in grid), not saving to disk."), ("sst", True, "")]
    assert aggregate.plan(store, targets, a_versions).count() == 0

    lines = provenance_lines(members(store.read("transformation"), store.read("granule")), store.read("aggregation"), store.read("dataset"))
    write_provenance(lines, str(tmp_path / "prov"))
    assert spark.read.text(str(tmp_path / "prov")).count() == 2 + 8


def test_jobs_leave_other_datasets_alone(spark, tmp_path, rows):
    """Two datasets in one store; each job touches the rows and stamps of its own."""
    store = StateStore(spark, str(tmp_path / "state"))
    listing = lambda ds: spark.createDataFrame([(f"https://x/{ds}_nh_20200101.nc", D(2020, 2, 1)), (f"https://y/{ds}_nh_20200101.nc", D(2020, 2, 2))], "url string, mod_time timestamp")
    own = {ds: DatasetConfig.of({
        "ds_name": ds, "start": "20200101T00:00:00Z", "end": "20201231T00:00:00Z", "t_version": 1.0, "a_version": v,
        "hemi_pattern": {"north": "_nh", "south": "_sh"}, "skipna_in_mean": True, "fields": [{"name": "h", "units": "m"}]}) for ds, v in (("A", "1.0"), ("B", "9.9"))}
    later = F.lit("2023-05-05").cast("timestamp")
    for ds, when in (("A", now()), ("B", later)):
        plan = harvest.plan(listing(ds), own[ds], store.read("granule"))
        assert rows(plan, "url") == [(f"https://y/{ds}_nh_20200101.nc",)]  # the latest of two listings
        files = plan.select("filename", F.lit("/d").alias("path"), F.lit(500).cast("bigint").alias("size"), F.lit("2020-03-01").cast("timestamp").alias("mtime"), F.md5("filename").alias("checksum"))
        tries = plan.select("ds", "filename", "date", "url", "mod_time", F.lit(True).alias("success"), F.lit("").alias("message"), F.lit(1).alias("duration"))
        harvest.record(store, tries, files, when)
    stamps = {r.ds: r.last_checked for r in store.read("dataset").collect()}
    assert stamps["A"] != stamps["B"]

    targets = spark.createDataFrame([("A", "g", "h"), ("B", "g", "h")], "ds string, grid string, field string")
    none = spark.createDataFrame([], "ds string, filename string, grid string, field string, output_mtime timestamp, output_version double")
    sources = spark.createDataFrame([("/d", D(2020, 3, 1))], "path string, mtime timestamp")
    for ds, when in (("A", now()), ("B", later)):
        transform.begin(store, transform.plan(store, own[ds], targets, sources, none), when, str(tmp_path / f"work-{ds}"))
        results = store.read("transformation").filter("in_progress").select(
            "id", F.lit(True).alias("success"), F.lit("o").alias("output_name"), F.lit("/o").alias("output_path"), F.lit("c").alias("checksum"), F.lit("").alias("message"))
        transform.finish(store, results, when, F.lit(1.0))
    stamps = {r.ds: r.last_transformation for r in store.read("dataset").collect()}
    assert stamps["A"] != stamps["B"] and None not in stamps.values()

    cells = spark.createDataFrame([("g", 0)], "grid string, cell_id bigint")
    record = lambda ds: spark.createDataFrame([(ds, "g", "h", f"{ds}_nh_20200101.nc", date(2020, 1, 1), "nh", 0, 1.5)], "ds string, grid string, field string, filename string, date date, hemi string, cell_id bigint, value double")
    versions = spark.createDataFrame([("A", "1.0"), ("B", "9.9")], "ds string, a_version string")
    for ds, when in (("B", later), ("A", F.lit("2024-01-01").cast("timestamp"))):
        aggregate.run(store, record(ds), cells, aggregate.plan(store, targets, versions), own[ds], str(tmp_path / ds), str(tmp_path / f"{ds}m"), str(tmp_path / f"staging-{ds}"), when)
        assert rows(store.read("aggregation").filter(F.col("ds") == ds), "notes") == [("",)]
        if ds == "B":
            assert store.read("aggregation").filter("ds = 'A'").count() == 0
    assert rows(store.read("dataset"), "ds", "aggregation_version") == [("A", "1.0"), ("B", "9.9")]


def test_transform_job(spark, tmp_path, rows):
    """One call takes a plan to written records and recorded results; other files' records stay."""
    config = DatasetConfig.of({
        "ds_name": "D", "start": "20200101T00:00:00Z", "end": "20201231T00:00:00Z", "t_version": 1.0, "a_version": "1.0", "data_res": 0.5,
        "transpose": True, "preprocessing": "ATL20_V004_monthly", "hemi_pattern": {"north": "_nh", "south": "_sh"},
        "fields": [{"name": "h", "units": "m", "pre_transformations": ["negatives"]}, {"name": "gone", "units": "1"}]})
    store = StateStore(spark, str(tmp_path / "state"))
    names = ["a_nh_20200101.nc", "b_nh_20200102.nc", "c_sh_20200103.nc"]
    store.upsert("granule", spark.createDataFrame(
        [granule(n, id=n, path="/d", size=500, success=True, checksum=n, date=D(2020, 1, i + 1)) for i, n in enumerate(names)], GRANULE))
    targets = spark.createDataFrame([("D", "g", "h"), ("D", "g", "gone")], "ds string, grid string, field string")
    grids = spark.createDataFrame([("g", i, lon, 0.0, 20_000.0) for i, lon in enumerate((0.05, 10.0, 90.0))], "grid string, cell_id bigint, lon double, lat double, radius_m double")
    sources = spark.createDataFrame([(h, i, lon, 0.0) for h in ("nh", "sh") for i, lon in enumerate((0.0, 0.1, 10.0, 10.1))], "hemi string, src_id bigint, lon double, lat double")
    # array positions by columns of a 2 x 2 grid: (row, col) is number col * 2 + row
    values = {(0, 0): 1.0, (1, 0): 3.0, (0, 1): -5.0, (1, 1): None}
    cells = lambda files: spark.createDataFrame([(n, r, c, (v,)) for n in files for (r, c), v in values.items()], "filename string, row bigint, col bigint, monthly struct<h: double>")
    sources_files = spark.createDataFrame([("/d", D(2020, 3, 1))], "path string, mtime timestamp")
    none = spark.createDataFrame([], "ds string, filename string, grid string, field string, output_mtime timestamp, output_version double")
    records = str(tmp_path / "records")
    for step, files in enumerate((names[:1], names[:2])):
        (path := tmp_path / f"cells{step}").mkdir()
        cells(files).write.mode("overwrite").parquet(str(path))
        ready = transform.begin(store, transform.plan(store, config, targets, sources_files, none), now(), str(tmp_path / f"plan{step}"))
        transform.run(store, config, ready, str(path), sources, grids, str(tmp_path / "maps"), records, str(tmp_path / f"work{step}"), now(), shape=(2, 2))
        tx = store.read("transformation")
        assert rows(tx, "filename", "field", "success", "message") == sorted(
            (n, f, n in files, ("" if f == "h" else "Field 'gone' missing from source data") if n in files else "no cells of this granule in the input")
            for n in names for f in ("h", "gone"))
        assert tx.filter("in_progress").count() == 0
        got = spark.read.parquet(records)
        assert rows(got.filter("field = 'h'"), "filename", "cell_id", "value") == [
            (n, i, v) for n in files for i, v in ((0, 2.0), (1, None), (2, None))]
        assert got.filter("field = 'gone'").count() == 3 * len(files) and got.filter("field = 'gone' AND value IS NOT NULL").count() == 0
    assert rows(store.read("dataset"), "transformation_status") == [("2 transformations failed",)]


@pytest.mark.parametrize("all_fail", [False, True])
def test_a_failing_grid_fails_alone(spark, tmp_path, rows, monkeypatch, all_fail):
    """The mapping of one grid cannot be made: its combinations fail with the reason, the other grid is written."""
    config = DatasetConfig.of({"ds_name": "D", "start": "20200101T00:00:00Z", "end": "20201231T00:00:00Z", "t_version": 1.0, "a_version": "1.0",
                               "data_res": 0.5, "fields": [{"name": "h", "units": "m"}]})
    store = StateStore(spark, str(tmp_path / "state"))
    store.upsert("granule", spark.createDataFrame([granule("a_20200101.nc", id="a", path="/d", size=500, success=True, checksum="a", date=D(2020, 1, 1))], GRANULE))
    targets = spark.createDataFrame([("D", "bad", "h"), ("D", "good", "h")], "ds string, grid string, field string")
    grids = spark.createDataFrame([(g, i, 0.05 + i, 0.0, 20_000.0) for g in ("bad", "good") for i in range(2)], "grid string, cell_id bigint, lon double, lat double, radius_m double")
    sources = spark.createDataFrame([(0, 0.0, 0.0)], "src_id bigint, lon double, lat double")
    spark.createDataFrame([("a_20200101.nc", 0, 2.5)], "filename string, src_id bigint, h double").write.parquet(str(tmp_path / "cells"))
    files = spark.createDataFrame([("/d", D(2020, 3, 1))], "path string, mtime timestamp")
    none = spark.createDataFrame([], "ds string, filename string, grid string, field string, output_mtime timestamp, output_version double")
    plain = transform.ensure_mapping

    def mapped(spark, path, key, *more):
        if all_fail or key[1] == "bad":
            return spark.range(1).select(F.raise_error(F.lit("no such projection"))).collect()
        return plain(spark, path, key, *more)

    monkeypatch.setattr(transform, "ensure_mapping", mapped)
    ready = transform.begin(store, transform.plan(store, config, targets, files, none), now(), str(tmp_path / "plan"))
    results = transform.run(store, config, ready, str(tmp_path / "cells"), sources, grids, str(tmp_path / "maps"), str(tmp_path / "records"), str(tmp_path / "work"), now())
    tx = {r.grid: r for r in store.read("transformation").collect()}
    assert {g: r.success for g, r in tx.items()} == {"bad": False, "good": not all_fail} == {r.grid: r.success for r in results.collect()}
    assert "no such projection" in tx["bad"].message and "mapping" in tx["bad"].message and not any(r.in_progress for r in tx.values())
    if not all_fail:
        assert rows(spark.read.parquet(str(tmp_path / "records")), "grid", "cell_id", "value") == [("good", 0, 2.5), ("good", 1, None)]
    assert rows(store.read("dataset"), "transformation_status") == [("No successful transformations" if all_fail else "1 transformations failed",)]


def test_commits_do_not_replace_each_other(spark, tmp_path, rows):
    store = StateStore(spark, str(tmp_path / "state"))
    store.upsert("granule", spark.createDataFrame([granule("a", size=1), granule("a", size=2)], GRANULE))
    assert rows(store.read("granule"), "filename", "size") == [("a", 2)]
    base = store.latest("granule")
    store.upsert("granule", spark.createDataFrame([granule("b", size=1)], GRANULE))
    with pytest.raises(CommitConflict):
        store.commit("granule", store.read("granule"), base)
    (tmp_path / "state/_log/claim-00000003").touch()  # another committer at work
    with pytest.raises(CommitConflict):
        store.upsert("granule", spark.createDataFrame([granule("c", size=1)], GRANULE))
    store.release("granule")
    assert store.upsert("granule", spark.createDataFrame([granule("c", size=1)], GRANULE)) == 3


def test_queued_files_are_no_successes(spark):
    counts = {"a": [True, None], "b": [None], "c": [True, False, None], "d": [True], "e": [False]}
    df = spark.createDataFrame([(ds, s) for ds, v in counts.items() for s in v], "ds string, success boolean")
    got = {r.ds: (r.n_granules, r.status) for r in state.harvest_status(df).collect()}
    assert got["a"] == (2, "1 granules queued") and got["b"] == (1, "1 granules queued") and got["c"] == (3, "1 harvested granules failed, 1 granules queued")
    assert got["d"] == (1, "All granules successfully harvested") and "queued" not in got["e"][1]


def test_stream_replay_is_idempotent(spark, tmp_path, rows):
    path, store = str(tmp_path / "in"), StateStore(spark, str(tmp_path / "state"))
    first = spark.createDataFrame([("D", "u/a", "a", D(2020, 1, 1), D(2019, 1, 1), ""), ("D", "u/b", "b", D(2020, 1, 1), D(2019, 1, 2), "")], "ds string, url string, filename string, mod_time timestamp, date timestamp, hemi string")
    first.write.mode("append").parquet(path)

    def drain(checkpoint):
        jobs.follow_listing(jobs.read_listing(spark, path, first.schema), store, str(tmp_path / checkpoint)).awaitTermination()

    drain("c1")
    late = first.filter("filename = 'a'").withColumn("mod_time", F.lit("2020-06-01").cast("timestamp"))
    late.write.mode("append").parquet(path)
    drain("c1")
    want = [("a", D(2020, 6, 1)), ("b", D(2020, 1, 1))]
    assert rows(store.read("granule"), "filename", "mod_time") == want
    drain("c2")  # everything again from the start
    assert rows(store.read("granule"), "filename", "mod_time") == want


def test_stream_months_close_after_lateness(spark, tmp_path, rows):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "cell bigint, ts timestamp, value double"
    batch = lambda data: spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)
    read = lambda: jobs.monthly_means(jobs.read_listing(spark, path, spark.createDataFrame([], schema).schema, files_per_trigger=1), ["cell"])
    for data in ([(1, D(2024, 1, 5), 2.0), (1, D(2024, 2, 1), 9.0)], [(1, D(2024, 1, 31), 4.0)], [(1, D(2024, 4, 20), 1.0)], [(1, D(2024, 4, 21), 1.0)]):
        batch(data)
        jobs.run_to_table(read(), out, str(tmp_path / "c"))
    assert (D(2024, 2, 1), 3.0, 2) in rows(spark.read.parquet(out), "month_end", "mean_value", "n_valid")
