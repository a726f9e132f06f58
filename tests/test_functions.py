import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidegrid.functions import geo, layout, masks, text, timebounds, units
from tidegrid.sources.grids import neighbour_bound, target_radius


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_names_and_dates(spark):
    r = one(
        spark, base=text.basename(F.lit("https://h/a/b_20200115.nc")), stem=text.stem(F.lit("a/b.c.nc")),
        day=text.filename_date(F.lit("x_20200115.nc"), r"\d{8}", "%Y%m%d"),
        doy=text.filename_date(F.lit("x_2020015.nc"), r"\d{7}", "%Y%j"),
        none=text.filename_date(F.lit("x.nc"), r"\d{8}", "%Y%m%d"),
        bad=text.filename_date(F.lit("x_20201399.nc"), r"\d{8}", "%Y%m%d"),
        both=text.hemi_tag(F.lit("a_nh_sh_"), "_nh_", "_sh_"), no=text.hemi_tag(F.lit("a"), "_nh_", "_sh_"),
        res=text.resolution(F.lit("10/111")), num=text.resolution(F.lit("0.25")))
    assert r.base == "b_20200115.nc" and r.stem == "b.c"
    assert r.day == datetime(2020, 1, 15) and r.doy == datetime(2020, 1, 15)
    assert r.none is None and r.bad is None
    assert r.both == "nh" and r.no == ""
    assert r.res == pytest.approx(10 / 111) and r.num == 0.25


def test_range_bounds():
    assert text.bound_year("19960101T00:00:00Z") == 1996
    with pytest.raises(ValueError):
        text.bound("yesterday")
    with pytest.raises(ValueError):
        text.spark_pattern("%Q")


def test_sst_mask(spark, rows):
    cold = spark.createDataFrame([(280.0,), (272.0,), (272.65,), (290.0,)], "analysed_sst double")
    assert [r[0] for r in masks.sst_ice(cold).collect()] == [280.0, None, None, 290.0]
    ice = spark.createDataFrame([(280.0, 0.0), (285.0, 0.5), (290.0, None)], "analysed_sst double, sea_ice_fraction double")
    assert [r[0] for r in masks.sst_ice(ice).collect()] == [280.0, None, 290.0]


def test_negative_mask(spark):
    df = spark.createDataFrame([(1.5, 1.0, -3.0), (-0.5, 1.0, -3.0)], "h double, lat double, lon double")
    assert [tuple(r) for r in masks.negatives(df).collect()] == [(1.5, 1.0, -3.0), (None, 1.0, -3.0)]


@pytest.mark.parametrize("qa,kept", [(0, True), (8, False), (32, False), (64, False), (1, True), (2, True), (4, True), (16, True), (128, True), (40, False), (None, True)])
def test_qa_bits(spark, qa, kept):
    df = spark.createDataFrame([(0.5, 0.1, qa)], "cdr_seaice_conc double, cdr_seaice_conc_stdev double, cdr_seaice_conc_qa_flag bigint")
    for name in ("mask_nsidc_seaice", "G02202v5_mask_flagged_conc"):
        r = masks.apply_masks(df, [name]).first()
        assert (r[0] is not None) == kept and (r[1] is not None) == kept


def test_range_variants_differ(spark):
    df = spark.createDataFrame([(1.5, 0.1, 0)], "cdr_seaice_conc double, cdr_seaice_conc_stdev double, cdr_seaice_conc_qa_flag bigint")
    assert masks.qa_range(df).first()[:2] == (None, None)
    assert masks.qa_bits(df).first()[:2] == (1.5, 0.1)


def test_land_mask(spark):
    df = spark.createDataFrame([(10.0, 1.0, 0.0), (20.0, 2.0, 1.0), (30.0, 3.0, None)], "lwe_thickness double, uncertainty double, land_mask double")
    assert [r[0] for r in masks.land(df).collect()] == [10.0, None, None]


def test_unknown_functions_raise(spark):
    df = spark.createDataFrame([(1.0,)], "value double")
    for call in (lambda: masks.apply_masks(df, ["nope"]), lambda: units.apply_post(df, ["nope"])):
        with pytest.raises(masks.UnknownFunction):
            call()


@pytest.mark.parametrize("name,values,want,label", [
    ("meters_to_cm", [1.0, 2.5, 0.01], [100, 250, 1], "cm"),
    ("kelvin_to_celsius", [273.15, 283.15, 373.15], [0, 10, 100], "Celsius"),
    ("seaice_concentration_to_fraction", [0.0, 50.0, 100.0], [0, 0.5, 1], "1"),
])
def test_units(spark, name, values, want, label):
    out = units.apply_post(spark.createDataFrame([(v,) for v in values], "value double"), [name]).collect()
    assert [r.value for r in out] == pytest.approx(want, abs=1e-9) and {r.units for r in out} == {label}


def test_day_window_of_center_time(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 15, 12, 30, 45, 123000), 1.0)], "time timestamp, value double")
    r = units.apply_post(df, ["MEaSUREs_fix_time"]).first()
    assert (r.time_start, r.time_end) == (datetime(2020, 1, 15), datetime(2020, 1, 16))


@pytest.mark.parametrize("given,at,period,other", [
    ("start", "2020-01-15", "AVG_DAY", "2020-01-16"), ("end", "2020-01-16", "AVG_DAY", "2020-01-15"),
    ("start", "2020-01-01", "AVG_MON", "2020-02-01"), ("end", "2020-02-01", "AVG_MON", "2020-01-01"),
    ("start", "2020-01-01", "AVG_WEEK", "2020-01-08"), ("start", "2020-01-01", "AVG_YEAR", "2021-01-01"),
    ("end", "2024-03-31", "AVG_MON", "2024-02-29"),
])
def test_time_windows(spark, given, at, period, other):
    w = one(spark, w=timebounds.time_window(**{given: F.lit(at)}, period=period)).w
    assert w["end" if given == "start" else "start"] == datetime.fromisoformat(other)
    assert w.center == w.start + (w.end - w.start) / 2


def test_time_window_arguments():
    for kw in ({}, {"start": "a", "end": "b"}, {"start": "a", "period": "AVG_HOUR"}):
        with pytest.raises(ValueError):
            timebounds.time_window(**kw)


def test_noon_center_and_hours(spark):
    r = one(spark, c=timebounds.time_window(start=F.lit("2020-01-15"))["center"], h=timebounds.hours_since_epoch(F.lit("1980-01-02 12:00:00")))
    assert r.c == datetime(2020, 1, 15, 12) and r.h == 36.0


def test_lon_wrap(spark):
    r = one(spark, a=geo.wrap_lon(F.lit(190.0)), b=geo.wrap_lon(F.lit(180.0)), c=geo.wrap_lon(F.lit(-180.0)))
    assert (r.a, r.b, r.c) == (-170.0, -180.0, -180.0)


# published corner coordinates of the two polar stereographic grids: x, y in km, lat, lon east
@pytest.mark.parametrize("code,x,y,lat,lon", [
    ("EPSG:3411", -3850, 5850, 30.98, 168.35), ("EPSG:3411", 3750, 5850, 31.37, 102.34),
    ("EPSG:3411", 3750, -5350, 34.35, 350.03), ("EPSG:3411", -3850, -5350, 33.92, 279.26),
    ("EPSG:3412", -3950, 4350, -39.23, 317.76), ("EPSG:3412", 3950, -3950, -41.45, 135.0),
])
def test_polar_corners(spark, code, x, y, lat, lon):
    lo, la = geo.inverse(geo.Projection.parse(code), F.lit(x * 1000.0), F.lit(y * 1000.0))
    r = one(spark, lo=lo, la=la)
    assert r.la == pytest.approx(lat, abs=0.01)
    assert (r.lo - lon + 180) % 360 - 180 == pytest.approx(0, abs=0.01)


def test_cylindrical_extent(spark):
    p = geo.Projection.parse("+proj=cea +lon_0=0 +lat_ts=30 +x_0=0 +y_0=0 +ellps=WGS84")
    lo, la = geo.inverse(p, F.lit(17367530.44), F.lit(7314540.83))
    r = one(spark, lo=lo, la=la)
    assert abs(r.lo) == pytest.approx(180, abs=1e-4) and r.la == pytest.approx(85.0445664, abs=1e-3)


def test_projection_errors():
    for bad in ("+proj=merc", "+proj=laea +lat_0=45"):
        with pytest.raises(ValueError):
            geo.Projection.parse(bad)


def test_llc_layout_against_faces(spark):
    """Independently lay 13 tiles out as five faces and flatten them."""
    import numpy as np

    size = 4
    cells = [(t, j, i) for t in range(13) for j in range(size) for i in range(size)]
    tiles = np.arange(13 * size * size).reshape(13, size, size)
    faces = [
        np.concatenate(tiles[0:3], 0), np.concatenate(tiles[3:6], 0), tiles[6],
        np.concatenate(tiles[7:10], 1), np.concatenate(tiles[10:13], 1)]
    compact = np.concatenate([f.reshape(-1) for f in faces])
    df = spark.createDataFrame([(int(tiles[c]), *c) for c in cells], "n int, tile int, j int, i int")
    got = df.select("n", layout.flat_index("llc", size, "j", "i", "tile").alias("p")).collect()
    assert all(compact[r.p] == r.n for r in got) and len({r.p for r in got}) == len(cells)


def test_layout_errors():
    with pytest.raises(ValueError):
        layout.flat_index("hex", 4, "j", "i")
    with pytest.raises(ValueError):
        layout.flat_index("llc", 4, "j", "i")


def test_neighbour_bound():
    assert neighbour_bound(1000, 100, 10000) == 400
    assert neighbour_bound(1000, 100) == 400
    assert neighbour_bound(1000, 100, 100) == 100
    assert neighbour_bound(10, 1000) == 1


def test_radius_preference(spark):
    df = spark.createDataFrame([(None, 20.0, 16.0), (10.0, 20.0, 16.0), (None, None, 16.0)], "effective_grid_radius double, RAD double, rA double")
    assert [r[0] for r in df.select(target_radius(df.columns)).collect()] == [20.0, 10.0, 2.0]
    assert spark.range(1).select(target_radius(["name"])).first()[0] is None
    assert math.isclose(0.5 * math.sqrt(16.0), 2.0)


@pytest.mark.parametrize("text", ["+init=EPSG:3411", "+init=epsg:3411", "EPSG:3411"])
def test_projection_codes(text):
    assert geo.Projection.parse(text) == geo.Projection("stere", geo.HUGHES_1980, -45.0, 90.0, 70.0)


def test_projection_settings(spark):
    p = geo.Projection.parse("+proj=stere +a=6378273 +b=6356889.44891 +lat_0=90 +lat_ts=70 +lon_0=-45 +x_0=1000 +y_0=-500 +units=m +no_defs")
    assert p.ellipsoid == (6378273.0, 6356889.44891) and (p.x_0, p.y_0) == (1000.0, -500.0)
    plain = geo.Projection("stere", geo.HUGHES_1980, -45.0, 90.0, 70.0)
    x, y = F.lit(800_000.0), F.lit(-300_000.0)
    shifted, own = geo.inverse(p, x + 1000, y - 500), geo.inverse(plain, x, y)
    row = spark.range(1).select(*[c.alias(n) for n, c in zip("abcd", (*shifted, *own))]).first()
    assert row.a == pytest.approx(row.c, abs=1e-7) and row.b == pytest.approx(row.d, abs=1e-7)
    assert geo.Projection.parse("+proj=cea +ellps=GRS80 +lat_ts=30").ellipsoid == geo.ELLIPSOIDS["GRS80"]
    for bad in ("+proj=cea +towgs84=1,2,3", "+proj=cea +ellps=moon", "+proj=cea +units=km", "+proj=utm +zone=3", "+proj=stere +k_0=0.9 +lat_0=90"):
        with pytest.raises(ValueError):
            geo.Projection.parse(bad)


def test_checksum_in_chunks(spark, tmp_path, monkeypatch):
    import hashlib

    from tidegrid.sources import files

    monkeypatch.setattr(files, "CHUNK_BYTES", 7)
    for i, n in enumerate((1, 5, 100, 1000)):
        (tmp_path / f"f{i}.bin").write_bytes(bytes(range(256)) * 4 if n == 1000 else b"x" * n)
    got = {r.filename: (r.size, r.checksum) for r in files.checksums(spark, str(tmp_path), "*.bin", whole_bytes=50).collect()}
    assert got == {p.name: (p.stat().st_size, hashlib.md5(p.read_bytes()).hexdigest()) for p in tmp_path.glob("*.bin")}
