"""Tables of snapshots: whole or not at all, also when runs die or meet."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclim.operators import snapshots, storage
from gridclim.plans import jobs

FORECAST = T.StructType([T.StructField("system", T.StringType()), T.StructField("target_start", T.DateType()), T.StructField("cell_id", T.StringType()), T.StructField("value", T.DoubleType())])
ROWS = T.StructType([T.StructField("bucket", T.StringType()), T.StructField("key", T.LongType()), T.StructField("value", T.LongType())])


def forecast(spark, system, days, value):
    return spark.createDataFrame([(system, dt.date(2024, 1, 1) + dt.timedelta(k), c, value) for k in range(days) for c in ("1E10", "0001")], FORECAST)


def rows(spark, *found):
    return spark.createDataFrame(list(found), ROWS)


def plain(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_shorter_horizon_leaves_nothing_of_a_longer(spark, tmp_path):
    path = f"{tmp_path}/forecast"
    put = lambda system, days, value: snapshots.replace_horizon(spark, path, forecast(spark, system, days, value), FORECAST, system)
    put("seas5", 30, 1.0)
    put("gfs", 16, 2.0)
    before = snapshots.Table(spark, path).read(FORECAST)
    after = put("seas5", 7, 3.0)
    assert {(r.system, r.n, r.v) for r in after.groupBy("system").agg(F.count("*").alias("n"), F.max("value").alias("v")).collect()} == {("seas5", 14, 3.0), ("gfs", 32, 2.0)}
    assert before.where("system = 'seas5'").count() == 60, "a reader keeps the version it has"
    assert snapshots.Table(spark, path).read(FORECAST, 1).count() == 60 and {r.cell_id for r in after.collect()} == {"1E10", "0001"}
    assert put("gfs", 0, 0.0).where("system = 'gfs'").count() == 0
    with pytest.raises(Exception, match="another system"):
        snapshots.replace_horizon(spark, path, forecast(spark, "gfs", 1, 0.0), FORECAST, "seas5")
    assert snapshots.Table(spark, path).read(FORECAST).count() == 14


def test_a_run_that_dies_leaves_the_table(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    snapshots.replace_all(spark, path, rows(spark, ("a", 1, 1), ("b", 2, 1)), "bucket")
    broken = rows(spark, ("a", 1, 2), ("b", 2, 2), ("c", 3, 2)).repartition(3).withColumn("value", F.when(F.col("key") == 3, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        snapshots.replace_all(spark, path, broken, "bucket")
    table = snapshots.Table(spark, path)
    table.write(rows(spark, ("a", 1, 5), ("d", 4, 5)), "bucket")  # dies before it publishes
    assert plain(table.read(ROWS)) == [("a", 1, 1), ("b", 2, 1)] and table.numbers() == [1]
    table.expire()
    assert plain(table.read(ROWS)) == [("a", 1, 1), ("b", 2, 1)]
    table.expire(grace=-60)
    assert plain(table.read(ROWS)) == [("a", 1, 1), ("b", 2, 1)] and sorted(p.name for p in (tmp_path / "t").iterdir() if "=" in p.name) == ["bucket=a", "bucket=b"]
    monkeypatch.setattr(snapshots.Table, "_put", lambda self, v: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        storage.upsert_table(spark, path, rows(spark, ("b", 2, 9)), ROWS, ["key"], "bucket", storage.upsert)
    monkeypatch.undo()
    assert plain(storage.read_stored(spark, path, ROWS)) == [("a", 1, 1), ("b", 2, 1)]


def test_commits_that_meet(spark, tmp_path):
    path = f"{tmp_path}/t"
    table = snapshots.Table(spark, path)
    base = snapshots.replace_all(spark, path, rows(spark, ("a", 1, 1), ("b", 2, 1)), "bucket")
    snapshots.replace_partitions(spark, path, rows(spark, ("a", 1, 2)), "bucket", base=base)
    snapshots.replace_partitions(spark, path, rows(spark, ("b", 2, 3), ("c", 3, 3)), "bucket", base=base)  # other partitions: both count
    assert plain(table.read(ROWS)) == [("a", 1, 2), ("b", 2, 3), ("c", 3, 3)]
    with pytest.raises(snapshots.Conflict):
        snapshots.replace_partitions(spark, path, rows(spark, ("a", 1, 4)), "bucket", base=base)
    snapshots.replace_all(spark, path, rows(spark, ("z", 9, 9)), "bucket")
    with pytest.raises(snapshots.Conflict):
        snapshots.replace_partitions(spark, path, rows(spark, ("q", 1, 4)), "bucket", base=base)
    assert plain(table.read(ROWS)) == [("z", 9, 9)]


def test_an_upsert_is_made_anew_where_another_came_first(spark, tmp_path):
    path, met = f"{tmp_path}/t", []
    storage.upsert_table(spark, path, rows(spark, ("a", 1, 1), ("a", 2, 1)), ROWS, ["key"], "bucket", storage.upsert)

    def slow(old, new, keys):
        if not met:
            met.append(1)
            storage.upsert_table(spark, path, rows(spark, ("a", 2, 7)), ROWS, ["key"], "bucket", storage.upsert)
        return storage.upsert(old, new, keys)

    storage.upsert_table(spark, path, rows(spark, ("a", 1, 5)), ROWS, ["key"], "bucket", slow)
    assert plain(storage.read_stored(spark, path, ROWS)) == [("a", 1, 5), ("a", 2, 7)]


def test_a_number_is_taken_once(spark, tmp_path):
    path = f"{tmp_path}/t"
    snapshots.replace_all(spark, path, rows(spark, ("a", 1, 1)), "bucket")
    table = snapshots.Table(spark, path)
    assert not table._put(snapshots.Version(1, {"bucket=a": "other"}, [])) and plain(table.read(ROWS)) == [("a", 1, 1)]
    assert [p.name for p in (tmp_path / "t" / "_versions").iterdir() if p.suffix == ".json"] == ["v00000000000000000001.json"]


def test_versions_and_expiry(spark, tmp_path):
    path = f"{tmp_path}/t"
    table = snapshots.Table(spark, path)
    assert table.version() == snapshots.Version() and table.read(ROWS).count() == 0
    for k in range(4):
        snapshots.replace_partitions(spark, path, rows(spark, ("a", 1, k), *([("b", 2, 0)] if k == 0 else [])), "bucket", keep=10)
    assert table.numbers() == [1, 2, 3, 4] and [plain(table.read(ROWS, n))[0][2] for n in table.numbers()] == [0, 1, 2, 3]
    table.expire(keep=2)
    assert table.numbers() == [3, 4] and plain(table.read(ROWS)) == [("a", 1, 3), ("b", 2, 0)] and plain(table.read(ROWS, 3)) == [("a", 1, 2), ("b", 2, 0)]
    with pytest.raises(ValueError, match="no version 1"):
        table.read(ROWS, 1)
    assert len(list((tmp_path / "t" / "bucket=a").iterdir())) == 2 and len(list((tmp_path / "t" / "bucket=b").iterdir())) == 1


def test_partitions_of_any_name(spark, tmp_path):
    path = f"{tmp_path}/t"
    names = ["a b", "x/y", "k=v", "100%", "é", "1E10", None]
    snapshots.replace_all(spark, path, rows(spark, *[(n, k, 0) for k, n in enumerate(names)]), "bucket")
    assert set(snapshots.Table(spark, path).version().runs) == {snapshots.folder_of("bucket", n) for n in names}
    storage.upsert_table(spark, path, rows(spark, *[(n, k, 1) for k, n in enumerate(names)], ("new", 99, 1)), ROWS, ["key"], "bucket", storage.upsert)
    got = {r.key: (r.bucket, r.value) for r in storage.read_stored(spark, path, ROWS).collect()}
    assert got == {k: (n, 1) for k, n in enumerate(names)} | {99: ("new", 1)}


def test_a_plain_table_becomes_one_of_snapshots(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows(spark, ("a", 1, 1), ("b", 2, 1)).write.partitionBy("bucket").parquet(path)
    assert plain(storage.read_stored(spark, path, ROWS)) == [("a", 1, 1), ("b", 2, 1)]
    storage.upsert_table(spark, path, rows(spark, ("b", 2, 5)), ROWS, ["key"], "bucket", storage.upsert)
    assert plain(storage.read_stored(spark, path, ROWS)) == [("a", 1, 1), ("b", 2, 5)]


def test_pruning_and_unpartitioned_tables(spark, tmp_path):
    path = f"{tmp_path}/t"
    snapshots.replace_all(spark, path, rows(spark, ("a", 1, 1), ("b", 2, 1)), "bucket")
    plan = snapshots.Table(spark, path).read(ROWS).where("bucket = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    whole = f"{tmp_path}/u"
    for n in (5, 3):
        snapshots.replace_all(spark, whole, spark.range(n), keep=1)
    assert snapshots.Table(spark, whole).read(spark.range(1).schema).count() == 3 and len([p for p in (tmp_path / "u").iterdir() if p.name.startswith("run=")]) == 1


def test_two_repairs_leave_two_complete_logs(spark, tmp_path):
    """Of two variables on one day, the second started while the first has staged its log."""
    tables = jobs.Tables(str(tmp_path))
    days = [dt.date(2020, 1, 1) + dt.timedelta(k) for k in range(9)]
    stored = [("000", "0001", c, d, 40.0 if d.day == 5 else 20.0 + d.day, 2.0 if d.day == 5 else 8.0 + d.day, 1.0, 10.0, 2.0, 5.0, 50.0, 3.0, False, None, 0) for c in ("0AAA", "0AAB") for d in days]
    storage.write_table(spark.createDataFrame(stored, jobs.STORED), tables.path("record"), "bucket", jobs.KEYS)
    meta = spark.createDataFrame([(c, -10.0, 100.0) for c in ("0AAA", "0AAB")], "child_id string, lat double, elevation double")
    real, inner = storage.upsert_table, []

    def meeting(session, path, *args, **kwargs):
        if path.endswith("/log") and not inner:
            inner.append(1)
            jobs.repair_issue(spark, tables, meta, "tmin", dt.date(2020, 1, 5), 2.0, 2)
        return real(session, path, *args, **kwargs)

    storage.upsert_table = meeting
    try:
        jobs.repair_issue(spark, tables, meta, "tmax", dt.date(2020, 1, 5), 40.0, 1)
    finally:
        storage.upsert_table = real
    log = tables.read(spark, "log", jobs.LOG)
    assert sorted((r.child_id, r.variable, r.issue_id) for r in log.collect()) == [("0AAA", "tmax", 1), ("0AAA", "tmin", 2), ("0AAB", "tmax", 1), ("0AAB", "tmin", 2)]
    fixed = tables.read(spark, "record", jobs.STORED).where("date = DATE'2020-01-05'").collect()
    assert len(fixed) == 2 and all(r.tmax != 40.0 and r.tmin != 2.0 for r in fixed)
