import datetime as dt
import struct

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclim.functions import grid
from gridclim.operators import daily, fieldqa, gridbuild, repair, runs, series, spatial, station, storage
from gridclim.sources import bronze, dbf, raster

D = dt.date(2020, 1, 1)


def long_rows(spark, skip=()):
    native = {"tmax": 303.15, "tmin": 288.15, "tdew": 291.15, "precip": 0.005, "srad": 22e6, "wind_u": 3.0, "wind_v": 4.0}
    return spark.createDataFrame([("0XKE", "EU9K", D, v, x) for v, x in native.items() if v not in skip], "parent_id string, child_id string, date date, variable string, value double")


def meta(spark):
    return spark.createDataFrame([("EU9K", -34.9, 50.0)], "child_id string, lat double, elevation double")


def test_build_wide(spark):
    r = daily.build_wide(long_rows(spark), meta(spark)).first()
    assert (round(r.tmax, 6), round(r.tmin, 6), round(r.tdew, 6), round(r.precip, 6), round(r.srad, 6), r.wind) == (30, 15, 18, 5, 22, 5)
    assert r.rh is not None and 2 < r.et0 < 12
    r = daily.build_wide(long_rows(spark, ["srad"]), meta(spark)).first()
    assert r.srad is None and r.et0 is None and r.rh is not None
    r = daily.build_wide(long_rows(spark), meta(spark).where("false")).first()
    assert r.et0 is None and r.rh is not None


BASE = {"parent_id": "P", "child_id": "C", "date": D, "tmax": 30.0, "tmin": 18.0, "precip": 5.0, "srad": 22.0, "wind": 5.0, "tdew": 18.0, "rh": 55.0, "et0": 4.5}


def test_split_valid(spark):
    broken = [{}, {"tmax": 10.0, "tmin": 20.0}, {"precip": -0.1}, {"srad": -1.0}, {"rh": 140.0}, {"et0": -0.5}, {"tmax": 10.0, "tmin": 20.0, "et0": -0.5}, {"rh": None}]
    rows = spark.createDataFrame([Row(**(BASE | b)) for b in broken])
    good, bad = daily.split_valid(rows)
    assert good.count() == 2
    assert sorted(r.reason for r in bad.collect()) == sorted(["tmax<tmin", "precip<0", "srad<0", "rh_out_of_range", "et0<0", "tmax<tmin;et0<0"])


def test_calendar(spark):
    rows = spark.createDataFrame([("P", "C", D), ("P", "C", dt.date(2020, 1, 4))], "parent_id string, child_id string, date date")
    assert daily.calendar_report(rows, 2020).first().asDict() == {"parent_id": "P", "child_id": "C", "n_dates": 2, "expected": 366, "missing": 364}
    assert [r.missing_date.day for r in daily.missing_days(rows, ["child_id"]).orderBy("missing_date").collect()] == [2, 3]


KEYS = ["parent_id", "child_id", "date"]
STORED = T.StructType([T.StructField(c, T.StringType()) for c in ("bucket", "parent_id", "child_id")] + [T.StructField("date", T.DateType()), T.StructField("tmax", T.DoubleType()), T.StructField("precip", T.DoubleType()), T.StructField("is_preliminary", T.BooleanType()), T.StructField("imputed", T.ShortType())])


def stored(spark, rows):
    return spark.createDataFrame([("012", "0123", c, D, t, p, False, m) for c, t, p, m in rows], STORED)


def test_upsert_table_keeps_repairs_and_codes(spark, tmp_path):
    path = f"{tmp_path}/t"
    storage.upsert_table(spark, path, stored(spark, [("1E10", 1.0, 2.0, 1), ("0001", 3.0, 4.0, 0)]), STORED, KEYS, "bucket")
    storage.upsert_table(spark, path, stored(spark, [("1E10", 9.0, None, 0), ("0002", 5.0, 6.0, 0)]), STORED, KEYS, "bucket")
    storage.upsert_table(spark, path, stored(spark, [("1E10", 9.0, None, 0), ("0002", 5.0, 6.0, 0)]), STORED, KEYS, "bucket")
    rows = {r.child_id: (r.parent_id, r.tmax, r.precip, r.imputed) for r in storage.read_stored(spark, path, STORED).collect()}
    assert rows == {"1E10": ("0123", 1.0, None, 1), "0001": ("0123", 3.0, 4.0, 0), "0002": ("0123", 5.0, 6.0, 0)}


def test_update_and_clear(spark):
    rows = stored(spark, [("a", 1.0, 2.0, 0), ("b", 3.0, 4.0, 0)])
    new = spark.createDataFrame([("0123", "a", D, 7.0), ("0123", "z", D, 8.0)], "parent_id string, child_id string, date date, value double")
    done = storage.update_column(rows, new, "tmax", KEYS)
    assert {r.child_id: (r.tmax, r.imputed) for r in done.collect()} == {"a": (7.0, 1), "b": (3.0, 0)}
    log = new.select(*KEYS, F.lit("tmax").alias("variable"))
    cleared, kept = storage.clear_imputed(done, log, new.where("child_id = 'a'"), "tmax", KEYS)
    assert cleared.where("imputed <> 0").count() == 0 and [r.child_id for r in kept.collect()] == ["z"]
    with pytest.raises(ValueError):
        storage.update_column(rows, new, "child_id", KEYS)


ISSUES = "issue_id long, variable string, date date, detector string, cells long, detail string, status string, resolution string, detected_at timestamp, resolved_at timestamp"


def test_registry(spark):
    now = dt.datetime(2024, 1, 1)
    old = spark.createDataFrame([(4, "tmin", D, "constant_field", 10, "{}", "accepted_source_defect", "kept", now, now)], ISSUES)
    found = spark.createDataFrame([("tmin", D, "constant_field", 20, "{1}"), ("tmax", D, "constant_field", 5, "{2}")], "variable string, date date, detector string, cells long, detail string")
    rows = {r.variable: r for r in storage.record_findings(old, found).collect()}
    assert (rows["tmin"].issue_id, rows["tmin"].cells, rows["tmin"].status, rows["tmin"].detected_at) == (4, 20, "accepted_source_defect", now)
    assert (rows["tmax"].issue_id, rows["tmax"].status) == (5, "detected")
    open_ = storage.set_status(storage.record_findings(old, found), [5], "refetch_pending")
    assert [r.resolved_at for r in open_.where("issue_id = 5").collect()] == [None] and storage.open_issues(open_).count() == 1


def field(spark, value_of, n=64):
    days = [dt.date(1987, 1, 25 + k) for k in range(3)]
    rng = np.random.default_rng(0)
    rows = [("tmin", "f", "c", d, float(value_of(d, k, rng))) for d in days for k in range(n)]
    return spark.createDataFrame(rows, "variable string, file string, chunk string, date date, value double")


def test_field_checks(spark):
    bad = dt.date(1987, 1, 26)
    constant = field(spark, lambda d, k, g: 267.660614 if d == bad else g.normal(295, 1.5))
    r = fieldqa.scan(constant).collect()
    assert [(x.date, x.detector, x.cells, round(x.low, 6)) for x in r] == [(bad, "constant_field", 64, -5.489386)]
    assert fieldqa.scan(field(spark, lambda d, k, g: 267.0 if d == bad else g.normal(295, 1.5), 20)).count() == 0
    near = field(spark, lambda d, k, g: 295 + k * 1e-5 if d == bad else g.normal(295, 1.5))
    assert [x.detector for x in fieldqa.scan(near).collect()] == ["low_spread"]
    dry = field(spark, lambda d, k, g: 1e-6).withColumn("variable", F.lit("precip"))
    assert fieldqa.scan(dry).count() == 0


def test_consolidate(spark):
    rows = [("tmin", D, "constant_field", f"f{k}", f"c{k}", n, 1, -5.0, -5.0, 0.0, 0.0) for k, n in enumerate((412, 3902, 5528))]
    found = spark.createDataFrame(rows, "variable string, date date, detector string, file string, chunk string, cells long, n_distinct long, low double, high double, stddev double, raw_stddev double")
    r = fieldqa.consolidate(found).collect()
    assert len(r) == 1 and r[0].cells == 9842 and r[0].min == r[0].max == -5.0


def test_repair(spark):
    rng, start = np.random.default_rng(0), dt.date(1987, 1, 20)
    truth = {c: 21 + np.cumsum(rng.normal(0, 0.4, 14)) for c in ("EU9K", "EU9L", "EU9M")}
    held = start + dt.timedelta(7)
    rows = [(c, start + dt.timedelta(k), float(v)) for c, x in truth.items() for k, v in enumerate(x) if k != 7]
    history = spark.createDataFrame(rows, "child_id string, date date, value double")
    found, how = repair.repair_field(history, held, "tmin")
    assert how == "interpolated 1987-01-26..1987-01-28"
    assert all(abs(r.value - truth[r.child_id][7]) < 1.0 for r in found.collect())
    other = [(c, dt.date(y, 1, 26), float(10 + y % 5)) for c in truth for y in range(1980, 1987)]
    rain = spark.createDataFrame(other, "child_id string, date date, value double")
    a, b = repair.repair_field(rain, held, "precip", seed=3), repair.repair_field(rain, held, "precip", seed=3)
    assert a[1] == b[1] and a[1].startswith("analog") and a[0].count() == 3
    mean, how = repair.repair_field(rain, held, "tmin")
    assert how == "climatology n=7" and mean.count() == 3
    with pytest.raises(ValueError):
        repair.repair_field(rain.where("false"), held, "tmin")


def test_bronze_files(spark, tmp_path):
    for name, n in (("tmax_1987__c1", 2), ("tmax_1987", 3), ("tmax_19870", 5)):
        rows = [("0123", "1E10", dt.date(1987, 1, 1 + k), float(k)) for k in range(n)]
        import pyarrow as pa
        import pyarrow.parquet as pq

        (tmp_path / "tmax").mkdir(exist_ok=True)
        pq.write_table(pa.table({"child_id": [r[0] for r in rows], "parent_id": [r[1] for r in rows], "date": [r[2] for r in rows], "value": [r[3] for r in rows]}), tmp_path / "tmax" / f"{name}.parquet")
    found = bronze.load(spark, str(tmp_path), ["tmax", "tmin"], [1987])
    assert sorted((r.variable, r.year, r.chunk) for r in found.collect()) == [("tmax", 1987, "")] * 3 + [("tmax", 1987, "c1")] * 2
    assert bronze.load(spark, str(tmp_path), ["tmin"], [1987]).count() == 0
    assert bronze.load(spark, str(tmp_path), ["tmax"], [1987], ["other"]).count() == 0


def test_rasters(spark):
    tile = spark.createDataFrame([(D, [90.0, 89.75], [0.0, 0.25], [0.0, 1.0, None, 3.0])], "date date, lats array<double>, lons array<double>, values array<double>")
    rows = {r.child_id: r.value for r in raster.encode_grid(tile).collect()}
    assert rows == {"0000": 0.0, "0001": 1.0, grid.place(89.75, 0.25).child_id: 3.0}
    with pytest.raises(PySparkException):
        raster.encode_grid(tile.unionAll(tile)).collect()
    fine = spark.createDataFrame([(D, [-10.225], [-48.375], [7.0])], "date date, lats array<double>, lons array<double>, values array<double>")
    assert raster.encode_fine_grid(fine).first().fine_id == grid.place(-10.225, -48.375).fine_id
    with pytest.raises(PySparkException):
        raster.encode_fine_grid(fine.withColumn("lats", F.array(F.lit(-10.22)))).collect()


def test_dbf(spark, tmp_path):
    fields = [("CELL", "N", 9, 0), ("NAME", "C", 12, 0), ("X", "F", 12, 6)]
    rows = [(" ", 1, "UY0001", -56.2), ("*", 2, "gone", 0.0), (" ", None, "", None)]
    width = 1 + sum(f[2] for f in fields)
    data = struct.pack("<BBBBIHH20x", 3, 124, 1, 1, len(rows), 32 + 32 * len(fields) + 1, width)
    data += b"".join(struct.pack("<11sc4xBB14x", n.encode(), t.encode(), w, p) for n, t, w, p in fields) + b"\r"
    for mark, a, b, c in rows:
        data += (mark + ("" if a is None else str(a)).rjust(9) + b.ljust(12) + ("" if c is None else f"{c:.6f}").rjust(12)).encode()
    (tmp_path / "t.dbf").write_bytes(data)
    spark.dataSource.register(dbf.DbfSource)
    found = spark.read.format("dbf").option("path", f"{tmp_path}/t.dbf").load()
    assert [tuple(r) for r in found.collect()] == [(1, "UY0001", -56.2), (None, "", None)]
    assert spark.read.format("dbf").option("path", f"{tmp_path}/t.dbf").option("columns", "X").load().columns == ["X"]


def test_series_and_station(spark):
    at = grid.place(-34.9, -56.2)
    days = [dt.date(2020, 1, 1) + dt.timedelta(k) for k in range(366)]
    rows = spark.createDataFrame([(at.parent_id, at.child_id, d, 25.0 + d.month, 15.0 + d.month, 1.0, 20.0, 3.0, 14.0, 60.0, 4.0, False, 0) for d in days if d.day != 5], "parent_id string, child_id string, date date, tmax double, tmin double, precip double, srad double, wind double, tdew double, rh double, et0 double, is_preliminary boolean, imputed int")
    assert series.climate_series(rows, -34.9, -56.2, "2020-02-01", "2020-02-10").count() == 9
    with pytest.raises(ValueError):
        series.climate_series(rows, 0, 0, rain="no")
    alt = spark.createDataFrame([(at.fparent_id, at.fine_id, days[0], 2, 9.0)], "fparent_id string, fine_id string, date date, source int, precip double")
    rain = series.climate_series(rows, -34.9, -56.2, "2020-01-01", "2020-01-02", "chirps_v2", alt=alt)
    assert [r.precip for r in rain.collect()] == [9.0, None]
    cells = spark.createDataFrame([(at.child_id, at.cell_lat, at.cell_lon, 50.0)], "child_id string, lat double, lon double, elevation double")
    files = station.station_files(station.station_lines(rows, cells, 2020, first_year=2020, last_year=2020), 2020).collect()
    lines = files[0].content.split("\n")
    assert files[0].filename == "FGHR2020.WTH" and lines[0] == "*WEATHER DATA : FGHR ERA5 0.25deg local-day 2020" and lines[1] == ""
    assert lines[3] == "  FGHR  -35.000  -56.250    50  26.5   5.5   2.0   2.0"
    assert lines[5] == "20001  20.0  26.0  16.0   1.0  14.0 193.9   -99  60.0" and len(lines) == 5 + 354 + 1


def test_weights(spark):
    cells = gridbuild.fine_grid(spark, -6.0, -51.0, -5.0, -50.0)
    weights = spatial.area_weights(cells)
    inner = spatial.coverage_report(weights).where("covered > 0.999999").collect()
    assert len(inner) == 9 and all(r.n_fine == 36 and abs(r.covered - 1) < 1e-9 for r in inner)


def test_grids_and_chunks(spark):
    assert gridbuild.fine_grid(spark, -13.50, -50.75, -5.15, -45.70).count() == 16867
    assert gridbuild.fine_grid(spark, -13.50, -50.75, -5.15, -45.70).select("fparent_id").distinct().count() == 54
    box = gridbuild.fine_grid(spark, -6.0, -51.0, -5.0, -50.0)
    assert box.count() == 400 and box.select("fparent_id").distinct().count() == 1
    for k in (1, 5, 10):
        chunks = gridbuild.tile_extent(spark, -34, -74, 5.5, -34.75, k)
        ids = [p for r in chunks.collect() for p in r.parent_ids]
        assert len(ids) == len(set(ids)) and grid.place(-10.0, -50.0).parent_id in ids
    assert gridbuild.side_of(400) == 20
    with pytest.raises(ValueError):
        gridbuild.side_of(5)
    land = spark.createDataFrame([(grid.place(-10.0, -50.0).parent_id, 16, [0, 60])], "parent_id string, land_cells long, zones array<int>")
    plan = gridbuild.plan_chunks(gridbuild.tile_extent(spark, -34, -74, 5.5, -34.75, 10), land).collect()
    assert len(plan) == 1 and plan[0].cell_zones == 32
    with pytest.raises(PySparkException):
        gridbuild.plan_chunks(gridbuild.tile_extent(spark, -34, -74, 5.5, -34.75, 10), land, 31).collect()


def test_polygon(spark):
    cells = spark.createDataFrame([(c, y, x) for c, y, x in (("a", 0.0, 0.0), ("b", 0.0, 0.25), ("c", 5.0, 5.0))], "child_id string, lat double, lon double")
    square = "POLYGON((-0.125 -0.125, 0.25 -0.125, 0.25 0.125, -0.125 0.125, -0.125 -0.125))"
    assert {r.child_id: round(r.weight, 9) for r in spatial.polygon_weights(cells, square).collect()} == {"a": 1.0, "b": 0.5}
    hole = "POLYGON((-1 -1, 1 -1, 1 1, -1 1, -1 -1), (-0.125 -0.125, 0.125 -0.125, 0.125 0.125, -0.125 0.125, -0.125 -0.125))"
    assert {r.child_id for r in spatial.polygon_weights(cells, hole).collect()} == {"b"}


def test_timezone_fill(spark):
    cells = spark.createDataFrame([(0, 0, 0.0, True, 60), (0, 2, 0.5, True, None), (50, 50, 12.0, True, None), (1, 1, 0.25, False, None)], "row long, col long, lon double, is_land boolean, t_zone int")
    assert {(r.row, r.col): r.t_zone for r in spatial.fill_timezone(cells).collect()} == {(0, 0): 60, (0, 2): 60, (50, 50): 60, (1, 1): None}


def test_soil_ring_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    places = [(float(a), float(b)) for a, b in zip(rng.uniform(-60, 70, 40), rng.uniform(-180, 180, 40), strict=True)]
    points = [(a + float(rng.normal(0, 0.4)), b + float(rng.normal(0, 0.4))) for a, b in places for _ in range(4)]
    soil = spark.createDataFrame(points, "lat double, lon double").withColumn("lon", F.pmod(F.col("lon") + 180, F.lit(360.0)) - 180).withColumn("cell5m", grid.soil_cell("lat", "lon")).dropDuplicates(["cell5m"])
    c = grid.soil_cell_center("cell5m")
    soil = soil.select("cell5m", c["lat"].alias("lat"), c["lon"].alias("lon"), F.lit("s").alias("soil_id"))
    sites = spark.createDataFrame([(k, *p) for k, p in enumerate(places)], "key long, lat double, lon double")
    got = {r.key: (r.cell5m, round(r.dist_km, 6)) for r in spatial.soil_nearest(sites, soil, 30.0).collect()}
    all_ = sites.crossJoin(soil.select("cell5m", F.col("lat").alias("y"), F.col("lon").alias("x"))).withColumn("km", spatial.haversine_km(F.col("lat"), F.col("lon"), F.col("y"), F.col("x"))).where("km <= 30").collect()
    want = {}
    for r in all_:
        want[r.key] = min(want.get(r.key, (9e9, 0)), (r.km, r.cell5m))
    assert got == {k: (c, round(km, 6)) for k, (km, c) in want.items()} and len(got) > 20


def test_soil_ring_reaches_over_the_poles(spark):
    places = [(y, x) for y in (89.0, 89.5, 89.7, 89.97, 90.0, -89.5, -90.0) for x in (-180.0, 3.0, 179.0)]
    sites = spark.createDataFrame([(k, *p) for k, p in enumerate(places)], "key long, lat double, lon double")
    points = spark.createDataFrame([(s * (89.6 - k % 3 * 0.1), -170.0 + 36.0 * k) for s in (1, -1) for k in range(10)], "lat double, lon double").withColumn("cell5m", grid.soil_cell("lat", "lon"))
    c = grid.soil_cell_center("cell5m")
    soil = points.select("cell5m", c["lat"].alias("lat"), c["lon"].alias("lon"), F.lit("s").alias("soil_id"))
    got = {r.key: (r.dist_km, r.cell5m) for r in spatial.soil_nearest(sites, soil, 60.0).collect()}
    want = {}
    for r in sites.crossJoin(soil.select("cell5m", F.col("lat").alias("y"), F.col("lon").alias("x"))).withColumn("km", spatial.haversine_km(F.col("lat"), F.col("lon"), F.col("y"), F.col("x"))).where("km <= 60").collect():
        want[r.key] = min(want.get(r.key, (9e9, 0)), (r.km, r.cell5m))
    assert got == want and len(want) > 12


def test_bridge_measures_on_the_ground(spark):
    soil = spark.createDataFrame([("c", 1, "far", 60.0 + 3 / 24, 10.0 + 1 / 24), ("c", 2, "near", 60.0 + 1 / 24, 10.0 + 3 / 24)], "child_id string, cell5m long, soil_id string, lat double, lon double")
    cells = spark.createDataFrame([("c", 60.0, 10.0)], "child_id string, lat double, lon double")
    got = {r.soil_id: r for r in spatial.soil_bridge(soil, cells).collect()}
    assert got["near"].is_nearest and not got["far"].is_nearest
    assert got["near"].dist_deg == pytest.approx(np.hypot(1 / 24, 3 / 24 * np.cos(np.radians(60 + 1 / 24))), abs=1e-12)


def test_batches_equal_a_plain_loop(spark):
    rng = np.random.default_rng(2)
    start = np.sort(rng.uniform(0, 20000, 200))
    rows = [(k, float(a), float(a + rng.uniform(1, 300)), int(rng.integers(1, 3)) if k % 20 == 0 else 1) for k, a in enumerate(start)]
    batch, last, level, want = 0, None, None, {}
    for k, a, b, p in rows:
        if last is None or p != level or a > last + 180:
            batch, last = batch + 1, 0.0
        last, level = max(last, b), p
        want[k] = batch
    got = runs.batches(spark.createDataFrame(rows, "k long, started double, finished double, parallel int"))
    assert {r.k: r.batch for r in got.collect()} == want


def test_fit(spark):
    rows = spark.createDataFrame([(x, 2.0 + 0.5 * x, None) for x in (10, 20, 30, 40)] + [(50, 1.0, "failed")], "cells long, cost double, error string")
    r = runs.fit_per_task(rows, "cost").first()
    assert (round(r.fixed, 9), round(r.per_cell, 9), round(r.r2, 9), r.n) == (2.0, 0.5, 1.0, 4)
    assert runs.fit_per_task(rows.where("cells < 30"), "cost").count() == 0
