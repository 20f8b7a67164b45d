import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridclim.functions import physics as p
from gridclim.functions import text


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "column, expected, by",
    [
        (lambda: p.saturation_pressure(F.lit(20.0)), 2.338, 0.002),
        (lambda: p.saturation_pressure(F.lit(30.0)), 4.243, 0.002),
        (lambda: p.pressure(F.lit(1800.0)), 81.8, 0.05),
        (lambda: p.gamma(p.pressure(F.lit(1800.0))), 0.054, 0.0005),
        (lambda: p.slope(F.lit(25.0)), 0.189, 0.0005),
        (lambda: p.extraterrestrial_radiation(F.lit(-20.0), F.lit(246)), 32.2, 0.05),
        (lambda: p.extraterrestrial_radiation(F.lit(85.0), F.lit(355)), 0.0, 1e-9),
        (lambda: p.et0(*map(F.lit, (30.0, 18.0, 22.0, 3.0, 15.0, 50.0, -34.9, 15))), 5.55227464231591, 1e-9),
    ],
)
def test_anchors(spark, column, expected, by):
    assert value(spark, column()) == pytest.approx(expected, abs=by)


def test_snaps(spark):
    x = spark.createDataFrame([(2.5,), (-0.023,), (-0.064,), (-1.5,), (0.0,), (None,)], "x double")
    assert [r[0] for r in x.select(p.snap_negative_et0("x")).collect()] == [2.5, 0.0, 0.0, -1.5, 0.0, None]
    edge = spark.createDataFrame([(-0.01,), (-0.005,)], "x double")
    assert [tuple(r) for r in edge.select(p.snap_noise("x"), p.snap_noise("x", closed=False)).collect()] == [(0.0, -0.01), (0.0, 0.0)]


def test_nulls_and_nan(spark):
    none = F.lit(None).cast("double")
    assert value(spark, p.relative_humidity(none, F.lit(1.0), F.lit(1.0))) is None
    assert value(spark, p.known(F.lit(float("nan")))) is None
    assert value(spark, p.et0(F.lit(30.0), F.lit(18.0), none, F.lit(3.0), F.lit(15.0), F.lit(50.0), F.lit(0.0), F.lit(15))) is None
    assert [value(spark, p.sky_ratio(F.lit(a), F.lit(0.0))) for a in (1.0, -1.0, 0.0)] == [1.0, 0.0, None]
    assert value(spark, p.relative_humidity(F.lit(10.0), F.lit(10.0), F.lit(12.0))) == 100.0


def test_units(spark):
    native = {"tmax": (303.15, 30.0), "precip": (0.005, 5.0), "srad": (22e6, 22.0), "wind_u": (3.0, 3.0)}
    for name, (a, b) in native.items():
        assert value(spark, p.convert(name, F.lit(a))) == pytest.approx(b)
        assert value(spark, p.convert_by(F.lit(name), F.lit(a))) == pytest.approx(b)


def test_text(spark):
    rows = spark.createDataFrame([(0.25,), (-0.05,), (None,), (12.349,)], "x double")
    assert [r[0] for r in rows.select(text.f6("x")).collect()] == ["   0.3", "  -0.1", " -99.0", "  12.3"]
    with pytest.raises(PySparkException):
        value(spark, text.f6(F.lit(123456.0)))
    assert value(spark, text.station_date(F.lit("2020-12-31").cast("date"))) == "20366"
    assert value(spark, text.offset_hours(F.lit("UTC-03:30"))) == -3.5
    with pytest.raises(PySparkException):
        value(spark, text.offset_hours(F.lit("GMT")))
    assert text.rain_source("CHIRPS_V2") == 2 and text.rain_source(None) is None
    with pytest.raises(ValueError):
        text.rain_source("x")
    assert value(spark, text.constant_value(F.lit('{"min": 1.5, "max": 1.5}'))) == 1.5


def test_sql_functions(spark):
    from gridclim.functions import sql

    sql.register(spark)
    r = spark.sql("select cell_code(-5.175, -50.725), parent_code(-5.175, -50.725), fine_code(-5.175, -50.725), soil_cell(-34.9, -56.2), base36(518400, 4), station_number(null)").first()
    assert list(r) == ["BSAD", "0QML", "5L7NT", 6472845, "B400", " -99.0"]
