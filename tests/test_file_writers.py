"""Folders of files in formats that Spark does not know, written by tasks and read back by others."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from gridclim.sources import dbf, files, geotiff, netcdf

DAY = dt.date(2020, 1, 1)
SCHEMA = "KEY long, NAME string, X double, PRICE decimal(9,2), DAY date, FLAG boolean, SMALL int"
ROWS = [
    (1, "Å b", 0.1 + 0.2, None, DAY, True, 7),
    (-(2**63), "", -2.2250738585072014e-308, "-1234567.89", dt.date(1900, 2, 28), False, -(2**31)),
    (None, None, None, None, None, None, None),
    (2**63 - 1, "x" * 25, 1e300, "0.01", None, None, 0),
]


@pytest.fixture(autouse=True)
def sources(spark):
    for source in (dbf.DbfSource, geotiff.GeoTiffSource, netcdf.NetcdfSource):
        spark.dataSource.register(source)


def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA.replace("decimal(9,2)", "string")).withColumn("PRICE", F.col("PRICE").cast("decimal(9,2)"))


def test_dbf_round_trip(spark, tmp_path):
    path = f"file:{tmp_path}/t"
    table(spark).coalesce(1).write.format("dbf").mode("append").option("width", "NAME=25").option("records", 3).save(path)
    assert [os.path.splitext(n)[1] for n in os.listdir(tmp_path / "t")] == [".dbf"] * 2
    found = spark.read.format("dbf").option("path", path).option("records", 2).load()
    assert found.rdd.getNumPartitions() == 3
    want = [(k, s or "", x, None if p is None else float(p), d, f, n) for k, s, x, p, d, f, n in ROWS]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_append_overwrite_and_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    put = lambda df, mode: df.write.format("dbf").mode(mode).save(path)
    numbers = spark.range(10, numPartitions=4).toDF("N")
    put(numbers, "append")
    put(numbers, "append")
    read = lambda: sorted(r.N for r in spark.read.format("dbf").schema("N long").option("path", path).load().collect())
    assert read() == sorted([*range(10)] * 2)
    put(numbers.where("N > 7"), "overwrite")
    assert read() == [8, 9]
    put(numbers.where("false"), "overwrite")
    assert read() == [] and os.listdir(path) == []


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    broken = spark.range(100, numPartitions=4).select(F.when(F.col("id") == 77, "too wide").otherwise("x").alias("NAME"))
    with pytest.raises(Exception, match="wider"):
        broken.write.format("dbf").mode("append").option("width", 3).save(path)
    assert [n for n in (os.listdir(path) if os.path.isdir(path) else []) if n[0] != "."] == []
    assert spark.read.format("dbf").schema("NAME string").option("path", path).load().count() == 0 if os.path.isdir(path) else True


def test_attempts_that_do_not_count_are_not_read(tmp_path):
    class Numbers(files.FolderWriter):
        ending = ".txt"

        def put(self, rows, path):
            name = path()
            with open(name, "w") as f:
                f.write(" ".join(map(str, rows)))
            yield name

    job = Numbers({"path": str(tmp_path)}, None, False)
    lost, counted = job.write(iter([1, 2])), job.write(iter([1, 2]))
    assert files.listed({"path": str(tmp_path)}, ".txt") == [] and len(os.listdir(tmp_path)) == 2
    job.commit([counted, None])
    (only,) = files.listed({"path": str(tmp_path)}, ".txt")
    assert open(only).read() == "1 2" and len(os.listdir(tmp_path)) == 1 and lost.names != counted.names
    again = Numbers({"path": str(tmp_path)}, None, True)
    again.write(iter([3]))
    again.abort([])
    assert files.listed({"path": str(tmp_path)}, ".txt") == [only] and len(os.listdir(tmp_path)) == 1


@pytest.mark.parametrize(("columns", "message"), [("a_name_of_twelve long", "ten ASCII"), ("A array<long>", "no place"), ("A binary", "no place")])
def test_columns_without_a_place(spark, tmp_path, columns, message):
    with pytest.raises(Exception, match=message):
        spark.createDataFrame([], columns).write.format("dbf").mode("append").save(str(tmp_path / "t"))


def test_files_of_one_read_agree(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).toDF("A").write.format("dbf").mode("append").save(path)
    spark.range(3).selectExpr("cast(id as double) as A").write.format("dbf").mode("append").save(path)
    with pytest.raises(Exception, match="other columns"):
        spark.read.format("dbf").option("path", path).load().collect()
    with pytest.raises(Exception, match="path"):
        spark.read.format("dbf").load()
    with pytest.raises(Exception, match="mounted"):
        spark.read.format("dbf").option("path", "s3://bucket/t.dbf").load()


def tiles(spark, n=70, partitions=2):
    """A tile of 2 x 3 pixels for each of n days, newest first; every seventh of the numbers is masked, by null or NaN. Odd partitions hold a
    second set of axes."""
    rows = []
    for k in reversed(range(n)):
        values = [None if (6 * k + j) % 7 == 0 else float("nan") if (6 * k + j) % 7 == 1 else k + j / 4 for j in range(6)]
        rows.append((DAY + dt.timedelta(k), [10.0, 9.75], [20.0 + 10 * (k % 2), 20.25 + 10 * (k % 2), 20.5 + 10 * (k % 2)], values))
    return spark.createDataFrame(rows, "date date, lats array<double>, lons array<double>, values array<double>").repartitionByRange(partitions, "lons", "date").sortWithinPartitions("lons", F.desc("date"))


@pytest.mark.parametrize(("form", "size"), [("geotiff", "window"), ("netcdf", "steps")])
def test_raster_round_trip(spark, tmp_path, form, size):
    path = str(tmp_path / "t")
    tiles(spark).write.format(form).mode("append").option("bands", 20).save(path)
    assert len(os.listdir(path)) == 4
    found = spark.read.format(form).option("path", path).option(size, 8).load()
    assert found.rdd.getNumPartitions() == 10
    plain = lambda rows: sorted((r.date, r.lats, r.lons, [None if v is None or v != v else v for v in r["values"]]) for r in rows)
    assert plain(found.collect()) == plain(tiles(spark).collect())


@pytest.mark.parametrize("form", ["geotiff", "netcdf"])
def test_empty_rasters_and_tiles_that_do_not_fit(spark, tmp_path, form):
    put = lambda df, name, **options: df.write.format(form).mode("append").options(**options).save(str(tmp_path / name))
    put(tiles(spark).where("false"), "none")
    assert spark.read.format(form).option("path", str(tmp_path / "none")).load().count() == 0
    few = tiles(spark, 1, 1)
    for bad in (few.withColumn("date", F.lit(None).cast("date")), few.withColumn("values", F.slice("values", 1, 5)), few.withColumn("lats", F.lit(None).cast("array<double>"))):
        with pytest.raises(Exception, match="do not fill"):
            put(bad, "bad")
    with pytest.raises(Exception, match="need the columns"):
        put(few.drop("lats"), "bad")
    assert [n for n in (os.listdir(tmp_path / "bad") if (tmp_path / "bad").is_dir() else []) if n[0] != "."] == []


def test_geotiff_axes(spark, tmp_path):
    put = lambda df, name, **options: df.write.format("geotiff").mode("append").options(**options).save(str(tmp_path / name))
    few = tiles(spark, 1, 1)
    with pytest.raises(Exception, match="equal steps"):
        put(few.withColumn("lats", F.reverse("lats")), "turned")
    with pytest.raises(Exception, match="stands for missing"):
        put(few.withColumn("values", F.transform("values", lambda v: F.lit(-9999.0))), "missing")
    pixel = few.select("date", F.array(F.lit(1.0)).alias("lats"), F.array(F.lit(2.0)).alias("lons"), F.array(F.lit(5.0)).alias("values"))
    with pytest.raises(Exception, match="equal steps"):
        put(pixel, "one")
    put(pixel, "pixel", step=0.25)
    (row,) = spark.read.format("geotiff").option("path", str(tmp_path / "pixel")).load().collect()
    assert (row.lats, row.lons, row["values"]) == ([1.0], [2.0], [5.0])
