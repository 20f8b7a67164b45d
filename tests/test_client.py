import datetime as dt
from zoneinfo import ZoneInfo, available_timezones

import pytest
from pyspark.sql import functions as F

from gridclim.functions import grid
from gridclim.plans import control
from gridclim.plans.client import Climate


@pytest.fixture(scope="module")
def climate(spark):
    places = [grid.place(-34.9, -56.2), grid.place(-34.9, -55.95)]
    days = [dt.date(2020, 1, 1) + dt.timedelta(k) for k in range(366)]
    rows = [(p.parent_id, p.child_id, d, 25.0 + d.month + k, 15.0 + d.month, 1.0, 20.0, 3.0, 14.0, 60.0, 4.0, d.month == 12, 0) for k, p in enumerate(places) for d in days if d.day != 5]
    stored = spark.createDataFrame(rows, "parent_id string, child_id string, date date, tmax double, tmin double, precip double, srad double, wind double, tdew double, rh double, et0 double, is_preliminary boolean, imputed int")
    cells = spark.createDataFrame([(p.child_id, p.parent_id, p.cell_lat, p.cell_lon, 50.0, -180, True) for p in places], "child_id string, parent_id string, lat double, lon double, elevation double, t_zone int, is_land boolean")
    at = places[0]
    alt = spark.createDataFrame([(at.fparent_id, at.fine_id, d, 2, 2.0) for d in days[:40]], "fparent_id string, fine_id string, date date, source int, precip double")
    weights = spark.createDataFrame([(at.fine_id, at.child_id, 0.5)], "fine_id string, child_id string, weight double")
    return Climate(stored, cells, alt=alt, weights=weights)


def test_reads(climate):
    r = climate.info(-34.9, -56.2).first()
    assert (r.n_days, r.n_expected, r.n_missing, r.n_prelim) == (354, 366, 12, 30)
    assert climate.info(10.0, 10.0).count() == 0
    assert climate.missing_days(-34.9, -56.2).count() == 12 and climate.missing_days(10.0, 10.0).count() == 0
    assert climate.monthly(-34.9, -56.2).count() == 12
    assert climate.series_long(-34.9, -56.2, "2020-02-01", "2020-02-02", ["tmax", "rh"]).count() == 4
    assert climate.quality(-34.9, -56.2, 2020).first().days_expected == 366
    both = climate.compare_rain(-34.9, -56.2, ["era5", "chirps_v2"]).collect()
    assert (both[0].era5, both[0].chirps_v2, both[-1].chirps_v2) == (30.0, 60.0, None)
    weighted = climate.series(-34.9, -56.2, "2020-01-01", "2020-01-01", "chirps_v2", "weighted")
    assert weighted.first().precip == 2.0


def test_station_text(climate):
    lines = climate.station_text(-34.9, -56.2, 2020, rain="chirps_v2", first_year=2020).split("\n")
    assert lines[0].endswith("+ chirps_v2 RAIN (product day) 2020") and lines[5].startswith("20001") and lines[5].split()[4] == "2.0" and "-99.0" in lines[-2]
    with pytest.raises(ValueError):
        climate.station_text(10.0, 10.0, 2020)


def test_regions(climate):
    box = "POLYGON((-56.5 -35.2, -55.8 -35.2, -55.8 -34.8, -56.5 -34.8, -56.5 -35.2))"
    mean = climate.region(box, ["tmax"], "2020-01-01", "2020-01-01").first()
    assert 26 < mean.tmax < 27 and mean.n_cells == 2
    assert sorted(r.filename for r in climate.export_region(box, 2020, first_year=2020, last_year=2020).collect()) == sorted([f"{grid.place(-34.9, -56.2).child_id}2020.WTH", f"{grid.place(-34.9, -55.95).child_id}2020.WTH"])
    assert F is not None


def test_manifest_and_records(tmp_path):
    a, b = (control.Manifest(f"{tmp_path}/m.json", r) for r in ("north", "south"))
    a.mark("tmax", 2020, "c1")
    a.mark("tmax", 2020, "c1")
    b.mark("tmax", 2021)
    assert a.done("tmax", 2020, "c1") and not a.done("tmax", 2020, "c2") and not b.done("tmax", 2020, "c1") and b.done("tmax", 2021, "x")
    assert not a.complete("tmax", 2020, ["c1", "c2"])
    for k in range(3):
        control.append_record(f"{tmp_path}/r.jsonl", {"k": k})
    assert open(f"{tmp_path}/r.jsonl").read().count("\n") == 3


def test_standard_offsets_of_all_zones(spark):
    found = {r.zone: r.minutes for r in control.with_standard_offset(spark.createDataFrame([(z,) for z in [*available_timezones(), "No/Zone", None]], "zone string")).collect()}
    at = lambda z, month: dt.datetime(2023, month, 1, tzinfo=ZoneInfo(z))
    for zone in available_timezones() - {"localtime"}:
        plain = [at(zone, m).utcoffset() for m in (1, 7) if at(zone, m).dst() == dt.timedelta(0)]
        assert plain and found[zone] == plain[0].total_seconds() / 60
    # fixed values: zones where the smaller of two offsets, or those of another year, would be wrong
    known = {"Europe/Dublin": 60, "Asia/Amman": 180, "Asia/Damascus": 180, "America/Chihuahua": -360, "Africa/Juba": 120, "America/Montevideo": -180, "Europe/Berlin": 60, "Australia/Sydney": 600}
    assert {z: found[z] for z in known} == known and found["No/Zone"] is None and found[None] is None


def test_folders_stay_below_the_root():
    with pytest.raises(ValueError):
        control.resolve_folder("/data", "../etc")
