import datetime
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclim.functions import grid, sql
from gridclim.operators import runs, series, spatial, snapshots, storage
from gridclim.plans import jobs
from gridclim.sources import bronze, raster

SCHEMA = T.StructType([T.StructField("bucket", T.StringType()), T.StructField("key", T.LongType()), T.StructField("reason", T.StringType())])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_emptied_partitions_are_cleared(spark, tmp_path):
    path = f"{tmp_path}/quarantine"
    put = lambda rows, **more: storage.upsert_table(spark, path, spark.createDataFrame(rows, SCHEMA), SCHEMA, ["key"], "bucket", **more)
    put([("a", 1, "x"), ("b", 2, "x"), ("c", 3, "x")], how=storage.upsert)
    inside = F.col("key") < 3
    replaced = lambda old, new, keys: storage.replace_window(old, new, inside)
    put([("b", 4, "y")], how=replaced, window=inside)
    snapshots.Table(spark, path).expire(keep=1, grace=-60)
    rows = {tuple(r) for r in storage.read_stored(spark, path, SCHEMA).select("bucket", "key", "reason").collect()}
    assert rows == {("b", 4, "y"), ("c", 3, "x")} and sorted(p.name for p in (tmp_path / "quarantine").iterdir() if p.name.startswith("bucket")) == ["bucket=b", "bucket=c"]
    put([], how=replaced, window=inside)
    assert storage.read_stored(spark, path, SCHEMA).count() == 2 and [p.name for p in tmp_path.iterdir()] == ["quarantine"]


def test_a_whole_table_is_replaced(spark, tmp_path):
    path = f"{tmp_path}/t"
    storage.replace_table(spark, spark.range(5), path)
    assert storage.replace_table(spark, spark.range(3), path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["t"]
    assert sorted(r.id for r in storage.accumulate_table(spark, spark.range(2, 6), path, ["id"]).collect()) == [0, 1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        storage.write_result(spark.range(1), f"{tmp_path}/r", "xml")
    with pytest.raises(ValueError):
        storage.register_sources(spark.createDataFrame([], "source int, code string, note string"), ["nothing"])


def test_a_polygon_that_only_touches_counts(spark):
    cells = spark.createDataFrame([("in", 0.0, 0.0), ("side", 0.0, 1.125), ("corner", 1.125, 1.125), ("out", 0.0, 1.126), ("hole", 0.5, 0.5)], "child_id string, lat double, lon double")
    square = "POLYGON((-1 -1, 1 -1, 1 1, -1 1, -1 -1))"
    assert {r.child_id for r in spatial.polygon_cells(cells, square).collect()} == {"in", "side", "corner", "hole"}
    assert {r.child_id for r in spatial.polygon_weights(cells, square).collect()} == {"in", "hole"}
    holed = square[:-1] + ", (0.2 0.2, 0.8 0.2, 0.8 0.8, 0.2 0.8, 0.2 0.2))"
    assert {r.child_id for r in spatial.polygon_cells(cells, holed).collect()} == {"in", "side", "corner"}


def test_weighted_rain_of_a_cell_reads_its_parents(spark, tmp_path):
    at = grid.place(-5.175, -50.725)
    cells = series.fine_cells_of(at)
    assert len(cells) in (25, 36) and at.fine_id in cells
    known = {r.fine_id for r in spatial.area_weights(spark.createDataFrame([(c,) for c in cells], "fine_id string")).where(F.col("child_id") == at.child_id).collect()}
    assert known == set(cells)
    spark.createDataFrame([(c, series._fine_parent(c), datetime.date(2020, 1, 1), 2, 3.0) for c in cells], "fine_id string, fparent_id string, date date, source int, precip double").write.parquet(f"{tmp_path}/alt")
    alt = spark.read.parquet(f"{tmp_path}/alt")
    stored = spark.createDataFrame([(at.parent_id, at.child_id, datetime.date(2020, 1, 1), *[1.0] * 8, False, 0)], "parent_id string, child_id string, date date, tmax double, tmin double, precip double, srad double, wind double, tdew double, rh double, et0 double, is_preliminary boolean, imputed int")
    weights = spatial.area_weights(alt.select("fine_id").distinct())
    found = series.climate_series(stored, -5.175, -50.725, rain="chirps_v2", mode="weighted", alt=alt, weights=weights)
    assert [round(r.precip, 9) for r in found.collect()] == [3.0] and "In(fparent_id" in plan(found).replace("EqualTo(fparent_id", "In(fparent_id")


def test_dates_reach_the_scan(spark, tmp_path):
    rows = spark.range(800).select(F.lit("012").alias("bucket"), F.lit("0123").alias("parent_id"), F.lit("0001").alias("child_id"), F.date_add(F.lit("2019-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.lit(1.0).alias("tmax"))
    rows.write.partitionBy("bucket").parquet(f"{tmp_path}/record")
    record = spark.read.parquet(f"{tmp_path}/record")
    near, wide = jobs.histories(record.where(F.col("bucket").isin(["012"])), "tmax", datetime.date(2020, 1, 3))
    assert "GreaterThanOrEqual(date,2019-12-29)" in plan(near) and "PartitionFilters: [" in plan(near) and "PushedFilters: [" in plan(wide) and "Or(" in plan(wide).split("PushedFilters")[1]
    assert near.count() == 10 and wide.count() == sum(1 for r in record.collect() if r.date != datetime.date(2020, 1, 3) and min(abs(r.date.timetuple().tm_yday - 3), 365 - abs(r.date.timetuple().tm_yday - 3)) <= 7)
    assert "GreaterThanOrEqual(date,2020-01-01)" in plan(record.where(jobs.in_years([2020])))
    sites = spark.createDataFrame([(1, 89.0, 0.1)], "key long, lat double, lon double")
    text = plan(series.series_for_sites(record.withColumn("bucket", F.col("bucket").cast("string")), sites))
    assert "bucket" in text.split("PartitionFilters")[1][:200]


def test_sql_tables_read_one_partition(spark, tmp_path):
    at = grid.place(-34.9, -56.2)
    names = "tmax tmin precip srad wind tdew rh et0".split()
    rows = spark.range(5).select(F.lit(at.parent_id[:3]).alias("bucket"), F.lit(at.parent_id).alias("parent_id"), F.lit(at.child_id).alias("child_id"), F.expr("date_add(date'2020-01-01', cast(id as int))").alias("date"), *[F.col("id").cast("double").alias(c) for c in names], F.lit(False).alias("is_preliminary"))
    rows.unionByName(rows.withColumn("bucket", F.lit("zzz"))).write.partitionBy("bucket").parquet(f"{tmp_path}/record")
    spark.read.schema(rows.schema).parquet(f"{tmp_path}/record").createOrReplaceTempView("_parts")
    sql.register_tables(spark, "_parts")
    found = spark.sql("select * from climate_series(-34.9D, -56.2D)")
    assert found.count() == 5 and "(bucket" in plan(found).split("PartitionFilters")[1] and at.parent_id[:3] in plan(found).split("PartitionFilters")[1][:200]
    rows.drop("bucket").createOrReplaceTempView("_parts")
    sql.register_tables(spark, "_parts")
    assert spark.sql("select * from climate_missing(-34.9D, -56.2D)").count() == 0 and spark.sql("select * from climate_info(-34.9D, -56.2D)").first().n_days == 5


def test_samples_and_axes(spark):
    rows = spark.range(100)
    assert [r.id for r in runs.spaced_sample(rows, ["id"], 4).orderBy("id").collect()] == [0, 33, 66, 99]
    assert [r.id for r in runs.spaced_sample(rows, ["id"], 1).collect()] == [0] and runs.spaced_sample(rows, ["id"], 500).count() == 100
    assert runs.spaced_sample(rows.where("false"), ["id"], 3).count() == 0
    many = spark.range(20_000, numPartitions=5).selectExpr("if(id % 3 = 0, 7, if(id % 5 = 0, null, id * 37 % 9973)) as a", "cast(id % 11 as string) as b", "id")
    ordered = sorted(((r.a is not None, r.a or 0, r.b), r.id) for r in many.collect())
    for n in (2, 9, 250):
        got = runs.spaced_sample(many, ["a", "b"], n)
        assert "SinglePartition" not in plan(got) and "Window [row_number()" in plan(got)
        assert sorted((r.a is not None, r.a or 0, r.b) for r in got.collect()) == [ordered[round(k * 19_999 / (n - 1))][0] for k in range(n)]
    same = spark.range(5000).selectExpr("1 as a", "id")
    assert runs.spaced_sample(same, ["a"], 50).count() == 50 and runs.spaced_sample(same.select("a"), ["a"], 50).count() == 50
    assert bronze.sample(rows, ["id"], 1.0).count() == 100 and sorted(bronze.sample(rows, ["id"], 0.3).collect()) == sorted(bronze.sample(rows.repartition(7), ["id"], 0.3).collect())
    field = spark.createDataFrame([(datetime.date(2020, 1, 1), ["x"], [2], [1.0], [1.0, 2.0], [5.0, 6.0])], "date date, dims array<string>, sizes array<int>, lats array<double>, lons array<double>, values array<double>")
    with pytest.raises(Exception, match="latitude"):
        raster.to_latlon(field).collect()


def test_loads_of_nothing_fail(spark, tmp_path):
    meta = spark.createDataFrame([("0001", 1.0, 2.0)], "child_id string, lat double, elevation double")
    with pytest.raises(RuntimeError):
        jobs.transform_years(spark, f"{tmp_path}/none", jobs.Tables(f"{tmp_path}/t"), meta, [2020, 2021], datetime.date(2022, 1, 1))


def test_new_findings_are_numbered_without_one_window(spark):
    issues = spark.createDataFrame([(7, "tmax", datetime.date(2020, 1, 1), "d", 3, "{}", "imputed", None, None, None)], "issue_id long, variable string, date date, detector string, cells long, detail string, status string, resolution string, detected_at timestamp, resolved_at timestamp")
    found = [(v, datetime.date(2020, 1, 1) + datetime.timedelta(k), x, 9, "{}") for v in ("tmin", "precip", "tmax") for k in (2, 0, 1) for x in ("e", "d")]
    out = storage.record_findings(issues, spark.createDataFrame(found, "variable string, date date, detector string, cells long, detail string"))
    fresh = sorted(f[:3] for f in found if f[:3] != ("tmax", datetime.date(2020, 1, 1), "d"))
    want = {k: 8 + n for n, k in enumerate(fresh)} | {("tmax", datetime.date(2020, 1, 1), "d"): 7}
    assert {(r.variable, r.date, r.detector): r.issue_id for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(" in plan and not re.search(r"windowspecdefinition\(\w+#\d+L? (ASC|DESC)", plan)


def test_wide_station_numbers_are_an_error(spark):
    sql.register(spark)
    assert spark.sql("SELECT station_number(9999.94D), station_number(NULL), station_number(-0.25D)").first()[:2] == ("9999.9", " -99.0")
    with pytest.raises(Exception, match="does not fit"):
        spark.sql("SELECT station_number(x) FROM VALUES (12345.6D) AS t(x)").collect()
