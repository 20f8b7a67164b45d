"""Every query with SQL gives the rows and types of its SQL, at the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}
NAMES = sorted(k for k in entry.oracle_sql() if not k.startswith("op"))
#: Polygons, and sources of formats that Spark does not read.
PYTHON = {"st_upsert", "j_polygon_slanted", "a_region_slanted", "a_region_weighted", "j_polygon_cells", "j_polygon_weights", "t_fine_region", "t_export_region", "r_dbf", "r_geotiff", "r_netcdf"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows):
    return sorted((tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, db, name):
    found = entry.queries()[name](spark, SF)
    columns = sorted(found.columns)
    want = db.sql(entry.oracle_sql()[name])
    assert columns == sorted(want.columns)
    types = dict(zip(want.columns, map(str, want.types), strict=True))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in found.schema} == types
    quoted = ", ".join(f'"{c}"' for c in columns)
    assert plain(tuple(r) for r in found.select(*columns).collect()) == plain(db.sql(f"SELECT {quoted} FROM ({entry.oracle_sql()[name]})").fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_hot_queries_stay_in_the_jvm(spark):
    for name in NAMES:
        if name in PYTHON or name.startswith("w_"):
            continue
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Cartesian" not in plan, name


def test_literal_place_reaches_the_scan(spark, tmp_path):
    from gridclim.operators import series

    rows = spark.range(10).selectExpr("'0QM' bucket", "'0QML' parent_id", "'BSAD' child_id", "DATE'2020-01-01' date", *[f"1D {v}" for v in ("tmax", "tmin", "precip", "srad", "wind", "tdew", "rh", "et0")], "false is_preliminary", "0 imputed")
    rows.write.partitionBy("bucket").parquet(f"{tmp_path}/t")
    plan = series.climate_series(spark.read.parquet(f"{tmp_path}/t"), -5.175, -50.725, columns=["date", "tmax"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(child_id,BSAD)" in plan and "rh" not in plan.split("ReadSchema")[1]


def test_spilled_codes_are_decoded(spark, tmp_path):
    con = duckdb.connect()
    con.sql(f"COPY (SELECT range AS c_custkey FROM range(1, 3601)) TO '{tmp_path}/customer.parquet' (FORMAT parquet)")
    con.sql(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet'")
    for name in ("g_decode_spilled", "g_parent_of"):
        rows = plain(tuple(r) for r in entry.queries()[name](spark, str(tmp_path)).collect())
        assert rows == plain(con.sql(entry.oracle_sql()[name]).fetchall()) and len(rows) == 3600
