import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from gridclim.operators import storage
from gridclim.plans import jobs

NATIVE = {"tmax": 303.15, "tmin": 288.15, "tdew": 291.15, "precip": 0.005, "srad": 22e6, "wind_u": 3.0, "wind_v": 4.0}
CELLS = [f"C{k:03d}" for k in range(80)]
DAYS = [dt.date(2020, 1, d) for d in range(1, 11)]
BAD = dt.date(2020, 1, 6)


@pytest.fixture
def archive(tmp_path):
    for v, x in NATIVE.items():
        rows = [(c, "0123", d, 999.0 if v == "tmax" and d == BAD else x + (0.01 * k + 0.1 * d.day) * (v[0] == "t")) for k, c in enumerate(CELLS) for d in DAYS]
        (tmp_path / v).mkdir()
        names = ("child_id", "parent_id", "date", "value")
        half = len(rows) // 2
        for part, some in (("__s01r001c+001", rows[:half]), ("__s01r001c+002", rows[half:])):
            pq.write_table(pa.table(dict(zip(names, zip(*some, strict=True), strict=True))), tmp_path / v / f"{v}_2020{part}.parquet")
    # a row that fails the checks
    pq.write_table(pa.table({"child_id": ["C999"], "parent_id": ["0123"], "date": [DAYS[0]], "value": [-0.5]}), tmp_path / "precip" / "precip_2020__x.parquet")
    return str(tmp_path)


def test_transform_scan_and_repair(spark, archive, tmp_path):
    tables = jobs.Tables(f"{tmp_path}/tables")
    meta = spark.createDataFrame([(c, -34.9, 50.0) for c in CELLS], "child_id string, lat double, elevation double")
    run = dt.date(2020, 4, 5)
    counts = jobs.transform(spark, archive, tables, meta, [2020], run)
    assert counts == {"stored": 800, "quarantined": 1}
    assert jobs.transform(spark, archive, tables, meta, [2020], run) == counts
    record = tables.read(spark, "record", jobs.STORED)
    assert record.where("is_preliminary").count() == 80 * 6 and record.where("et0 is null").count() == 0
    assert tables.read(spark, "quarantine", jobs.QUARANTINE).first().reason == "precip<0"

    found = jobs.scan(spark, archive, ["tmax"], [2020]).collect()
    assert [(r.variable, r.date, r.detector, r.cells) for r in found] == [("tmax", BAD, "constant_field", 80)] and round(found[0].min, 2) == 725.85
    log, how = jobs.repair_issue(spark, tables, meta, "tmax", BAD, found[0].min, 7, dry_run=True)
    assert how == "interpolated 2020-01-05..2020-01-07" and log.count() == 80
    jobs.repair_issue(spark, tables, meta, "tmax", BAD, found[0].min, 7)
    day = {r.child_id: r for r in tables.read(spark, "record", jobs.STORED).where(f"date = DATE'{BAD}'").collect()}
    assert len(day) == 80 and all(r.imputed == 1 and abs(r.tmax - (30 + 0.01 * k + 0.6)) < 1e-3 for k, r in ((k, day[c]) for k, c in enumerate(CELLS)))
    assert tables.read(spark, "log", jobs.LOG).count() == 80
    jobs.transform(spark, archive, tables, meta, [2020], run)
    again = tables.read(spark, "record", jobs.STORED).where(f"date = DATE'{BAD}' and imputed = 1 and tmax < 40").count()
    assert again == 80
    with pytest.raises(ValueError):
        jobs.transform(spark, archive, tables, meta, [1999], run)
    assert storage.read_stored(spark, f"{tmp_path}/nothing", jobs.LOG).count() == 0
