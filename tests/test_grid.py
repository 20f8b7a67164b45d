import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridclim.functions import grid


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize(
    "lat, lon, code",
    [(90.0, 0.0, "0000"), (0.0, 0.0, "B400"), (-5.175, -50.725, "BSAD"), (-34.9, -56.2, "FGHR"), (0.0, -0.1, "B540")],
)
def test_coarse_codes(spark, lat, lon, code):
    assert one(spark, grid.cell_code(F.lit(lat), F.lit(lon)))[0] == code
    assert grid.place(lat, lon).child_id == code


def test_place_pins(spark):
    p = grid.place(-5.175, -50.725)
    assert (p.parent_id, p.fine_id, p.fparent_id) == ("0QML", "5L7NT", "00IAL")
    assert (p.cell_lat, p.cell_lon) == (-5.25, -50.75)
    assert (grid.place(-10.24, -48.36).fine_id, grid.place(-10.24, -48.36).fparent_id) == ("60ST4", "00JON")
    assert grid.place(-34.9, -56.2).cell5m == 6472845 and grid.place(42.625, 1.542).cell5m == 2455938


def test_columns_equal_scalars(spark):
    pairs = [(a / 8, b / 8) for a in range(-719, 720, 97) for b in range(-1439, 1440, 131)] + [(0.0, 180.0), (0.0, -180.0), (-90.0, 179.9), (59.95, 0.05), (60.0, -0.05), (-60.0, 12.0)]
    rows = spark.createDataFrame(pairs, "lat double, lon double").select("*", grid.locate("lat", "lon").alias("p")).collect()
    for r in rows:
        p = grid.place(r.lat, r.lon)
        assert (r.p.child_id, r.p.parent_id, r.p.fine_id, r.p.fparent_id, r.p.cell5m) == (p.child_id, p.parent_id, p.fine_id, p.fparent_id, p.cell5m), (r.lat, r.lon)


def test_round_trips(spark):
    rows = spark.range(0, 1038240, 997).select(grid.base36("id", 4).alias("c"), "id")
    back = rows.select("id", grid.base36_decode("c").alias("n"), grid.code_center("c").alias("p"), "c")
    again = back.where("p.lon >= 0 or p.lon <= -0.25").select("c", grid.cell_code("p.lat", "p.lon").alias("d"), (F.col("n") == F.col("id")).alias("same"))
    assert again.where("c <> d or not same").count() == 0
    fine = spark.range(0, 17280000, 100003).select(grid.base36("id", 5).alias("c")).select("c", grid.fine_code_center("c").alias("p"))
    assert fine.where(F.col("c") != grid.fine_code("p.lat", "p.lon")).count() == 0


def test_boxes(spark):
    r = one(spark, grid.parent_code_bbox(F.lit(grid.place(-5.175, -50.725).parent_id)).alias("b")).b
    assert (r.south, r.north) == (-5.875, -4.875) and r.west <= -50.75 <= r.east
    assert one(spark, grid.fine_parent_code_bbox(F.lit("00JON")).alias("b")).b.asDict() == {"south": -11.0, "west": -49.0, "north": -10.0, "east": -48.0}
    with pytest.raises(PySparkException):
        one(spark, grid.parent_bbox(F.lit(0), F.lit(180)))


@pytest.mark.parametrize("bad", [lambda: grid.base36(F.lit(36**4), 4), lambda: grid.base36_decode(F.lit("a!")), lambda: grid.fine_number(F.lit("B400"))])
def test_bad_codes(spark, bad):
    with pytest.raises(PySparkException):
        one(spark, bad())


def test_nulls(spark):
    none = F.lit(None).cast("double")
    assert list(one(spark, grid.cell_code(none, none), grid.fine_code(none, none), grid.soil_cell(none, none))) == [None, None, None]


def test_half_even(spark):
    assert list(one(spark, grid.lat_index(F.lit(89.875)), grid.lat_index(F.lit(89.625)))) == [0, 2]
