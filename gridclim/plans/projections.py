"""The driver's tables as relations of the weather domain, by exact arithmetic on their columns.

CTES holds the same relations as SQL text; the two stand side by side so that a change shows in both.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclim.functions import grid
from gridclim.operators import daily
from gridclim.operators.dealing import dealt

#: Lines of a task.
LINES = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Columns of order lines dealt by supplier, LINES to a task: sums by supplier and date, which are nearly as many as the lines, take as
    much of a task's memory whatever the table's size, and those by supplier and month follow without another shuffle."""
    return dealt(table(spark, sf_dir, "lineitem").select("l_suppkey", *columns), LINES, "l_suppkey")


def folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the warehouse, for queries that write and read back."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_gridclim/{name}-{uuid.uuid4().hex}"


def local(path: str) -> str:
    """A folder's path for plain file access, made if need be."""
    path = re.sub("^file:/*(?=/)", "", path)
    os.makedirs(path, exist_ok=True)
    return path


def place_of(key: str) -> list:
    k = F.col(key)
    return [((k * 37) % 1200 / F.lit(10.0) - 60.0).alias("lat"), ((k * 91) % 3600 / F.lit(10.0) - 180.0).alias("lon")]


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, lat, lon of customers."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), *place_of("c_custkey"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells that the events' users stand for, once each: codes, centre, elevation, offset."""
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("u")).distinct()
    rows = users.select("u", *place_of("u"), ((F.col("u") * 13) % 3000).cast("double").alias("elevation"), ((F.col("u") % 5 - 2) * 60).cast("int").alias("t_zone"))
    return rows.select("u", grid.cell_code("lat", "lon").alias("child_id"), grid.parent_code("lat", "lon").alias("parent_id"), "lat", "lon", "elevation", "t_zone", (F.col("u") % 3 != 0).alias("is_land"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """u, ts, t_zone, variable, value in native units: an event type gives one or two variables."""
    v = F.col("value")
    pairs = {
        "view": [("tmax", 290.0 + v / 10.0), ("wind_u", v / 50.0)],
        "click": [("tmin", 275.0 + v / 10.0), ("wind_v", v / 70.0)],
        "purchase": [("precip", v / 10000.0)],
        "signup": [("tdew", 270.0 + v / 20.0)],
        "error": [("srad", v * 100000.0)],
    }
    both = F.array().cast("array<struct<variable:string,value:double>>")
    for kind, found in pairs.items():
        both = F.when(F.col("event_type") == kind, F.array(*[F.struct(F.lit(n).alias("variable"), x.alias("value")) for n, x in found])).otherwise(both)
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("u"), "ts", ((F.col("user_id") % 5 - 2) * 60).cast("int").alias("t_zone"), F.explode(both).alias("o"))
    return rows.select("u", "ts", "t_zone", "o.variable", "o.value")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """u, date, variable, value: local days."""
    return daily.local_day_reduce(hourly(spark, sf_dir), ["u"])


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide record with derived variables, before checks; every seventh user's rows are repaired, the last days preliminary."""
    meta = cells(spark, sf_dir)
    wide = daily.with_wind(daily.to_wide(bronze(spark, sf_dir), ["u", "date"])).withColumn("child_id", F.col("u").cast("string"))
    derived = daily.add_derived(wide, meta.select(F.col("u").cast("string").alias("child_id"), "lat", "elevation")).drop("child_id")
    rows = derived.join(meta.select("u", "child_id", "parent_id"), "u")
    flags = {"is_preliminary": F.col("date") >= F.lit("2024-01-25").cast("date"), "imputed": F.when(F.col("u") % 7 == 0, 4).otherwise(0).cast("int")}
    return rows.withColumns(flags)


def alt_rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fine_id, fparent_id, date, source, precip: order lines as product rain of suppliers' fine cells."""
    sold = lines(spark, sf_dir, "l_shipdate", "l_linenumber", "l_quantity").select(F.col("l_suppkey").alias("u"), F.to_date("l_shipdate").alias("date"), (F.col("l_linenumber") % 3 + 2).alias("source"), F.col("l_quantity").alias("q"))
    rows = sold.groupBy("u", "date", "source").agg(F.sum("q").alias("precip")).select("*", *place_of("u"))
    return rows.select("u", grid.fine_code("lat", "lon").alias("fine_id"), grid.fine_parent_code("lat", "lon").alias("fparent_id"), "date", "source", "precip")


def rain_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """alt_rain with its days moved into January 2024, where the record lies."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.datediff("date", F.lit("1992-01-01").cast("date")) % 31).cast("int"))
    return alt_rain(spark, sf_dir).groupBy("u", "fine_id", "fparent_id", day.alias("date"), "source").agg(F.sum("precip").alias("precip"))


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as findings in a registry: issue_id, variable, date, detector, cells, detail, status, resolution, times."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    status = F.element_at(F.array(*map(F.lit, ("detected", "imputed", "in_review", "false_positive"))), (k % 4 + 1).cast("int"))
    variable = F.element_at(F.array(*map(F.lit, ("tmax", "tmin", "precip"))), (k % 3 + 1).cast("int"))
    rows = o.select(k.alias("issue_id"), variable.alias("variable"), F.to_date("o_orderdate").alias("date"), F.lit("constant_field").alias("detector"), (k % 90).alias("cells"), F.lit("{}").alias("detail"), status.alias("status"), F.col("o_orderdate").cast("timestamp").alias("detected_at"))
    rows = rows.select("*", F.lit(None).cast("string").alias("resolution"), F.when(F.col("status").isin("imputed", "false_positive"), F.col("detected_at")).alias("resolved_at"))
    return rows.groupBy("variable", "date", "detector").agg(*[F.min_by(c, "issue_id").alias(c) for c in ("issue_id", "cells", "detail", "status", "resolution", "detected_at", "resolved_at")]).select("issue_id", "variable", "date", "detector", "cells", "detail", "status", "resolution", "detected_at", "resolved_at")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as run records: starts and ends in seconds, level, cells, cost, an error for some."""
    o = table(spark, sf_dir, "orders")
    start = F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("double")
    seconds = F.floor("o_totalprice") % 3600 + F.lit(0.0)
    key = F.col("o_orderkey")
    return o.select(key.alias("run"), (F.col("o_custkey") % 50).alias("group"), (key % 3 + 1).alias("parallel"), start.alias("started"), (start + seconds * 400).alias("finished"), seconds.alias("seconds"), (key % 1000 + 1).alias("cells"), ((key * 7) % 500 / F.lit(100.0)).alias("cost"), (key % 4).alias("attempts"), F.when(key % 11 == 0, F.lit("failed")).alias("error"))


def soil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Soil points where suppliers are, once for each soil cell: at the cell's centre. Most customers have none of their own."""
    rows = table(spark, sf_dir, "supplier").select(*place_of("s_suppkey")).select(grid.soil_cell("lat", "lon").alias("cell5m")).distinct()
    center = grid.soil_cell_center("cell5m")
    rows = rows.select("cell5m", F.concat(F.lit("XX"), F.lpad(F.col("cell5m").cast("string"), 8, "0")).alias("soil_id"), center["lat"].alias("lat"), center["lon"].alias("lon"))
    return rows.withColumn("child_id", grid.cell_code("lat", "lon"))


def wrap_sql(lon: str) -> str:
    return f"(CASE WHEN ({lon}) % 360.0::DOUBLE < 0 THEN (({lon}) % 360.0::DOUBLE + 360.0::DOUBLE) % 360.0::DOUBLE ELSE ({lon}) % 360.0::DOUBLE END)"


def lat_sql(lat: str) -> str:
    return f"round_even((90.0::DOUBLE - ({lat})) / 0.25::DOUBLE, 0)::BIGINT"


def lon_sql(lon: str) -> str:
    return f"round_even({wrap_sql(lon)} / 0.25::DOUBLE, 0)::BIGINT"


def child_sql(lat: str, lon: str) -> str:
    return f"to_base({lat_sql(lat)} * 1440 + {lon_sql(lon)}, 36, 4)"


def parent_sql(lat: str, lon: str) -> str:
    return f"to_base(({lat_sql(lat)} // 4) * 360 + {lon_sql(lon)} // 4, 36, 4)"


def fine_row_sql(lat: str) -> str:
    return f"greatest(0, least(2399, floor((60.0::DOUBLE - ({lat})) * 20 + 1e-9::DOUBLE)))::BIGINT"


def fine_col_sql(lon: str) -> str:
    return f"greatest(0, least(7199, floor({wrap_sql(lon)} * 20 + 1e-9::DOUBLE)))::BIGINT"


def fine_sql(lat: str, lon: str) -> str:
    return f"to_base({fine_row_sql(lat)} * 7200 + {fine_col_sql(lon)}, 36, 5)"


def fparent_sql(lat: str, lon: str) -> str:
    return f"to_base(({fine_row_sql(lat)} // 20) * 360 + {fine_col_sql(lon)} // 20, 36, 5)"


def soil_sql(lat: str, lon: str) -> str:
    turned = wrap_sql(f"({lon}) + 180.0::DOUBLE")
    return f"(greatest(0, least(2159, floor((90.0::DOUBLE - ({lat})) * 12)))::BIGINT * 4320 + floor({turned} * 12)::BIGINT % 4320)"


def place_sql(key: str) -> str:
    return f"(({key} * 37) % 1200)::DOUBLE / 10.0::DOUBLE - 60.0::DOUBLE AS lat, (({key} * 91) % 3600)::DOUBLE / 10.0::DOUBLE - 180.0::DOUBLE AS lon"


def es_sql(t: str) -> str:
    return f"(0.6108::DOUBLE * exp(17.27::DOUBLE * ({t}) / (({t}) + 237.3::DOUBLE)))"


_MEAN = "((tmax + tmin) / 2.0::DOUBLE)"
_PHI, _YEAR = "radians(lat)", "(2.0::DOUBLE * pi() * dayofyear(date) / 365.0::DOUBLE)"
_DECL = f"(0.409::DOUBLE * sin({_YEAR} - 1.39::DOUBLE))"
_SUNSET = f"acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, -tan({_PHI}) * tan({_DECL}))))"
RA_SQL = f"(24.0::DOUBLE * 60.0::DOUBLE / pi() * 0.0820::DOUBLE * (1.0::DOUBLE + 0.033::DOUBLE * cos({_YEAR})) * ({_SUNSET} * sin({_PHI}) * sin({_DECL}) + cos({_PHI}) * cos({_DECL}) * sin({_SUNSET})))"
_RSO = f"((0.75::DOUBLE + 2e-5::DOUBLE * elevation) * {RA_SQL})"
_RATIO = f"(CASE WHEN {_RSO} = 0 THEN CASE WHEN srad > 0 THEN 1.0::DOUBLE WHEN srad < 0 THEN 0.0::DOUBLE END WHEN srad IS NOT NULL THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, srad / {_RSO})) END)"
_RNL = f"(4.903e-9::DOUBLE * ((pow(tmax + 273.16::DOUBLE, 4.0::DOUBLE) + pow(tmin + 273.16::DOUBLE, 4.0::DOUBLE)) / 2.0::DOUBLE) * (0.34::DOUBLE - 0.14::DOUBLE * sqrt({es_sql('tdew')})) * (1.35::DOUBLE * {_RATIO} - 0.35::DOUBLE))"
_DELTA = f"(4098.0::DOUBLE * {es_sql(_MEAN)} / pow({_MEAN} + 237.3::DOUBLE, 2.0::DOUBLE))"
_GAMMA = "(0.000665::DOUBLE * 101.3::DOUBLE * pow((293.0::DOUBLE - 0.0065::DOUBLE * elevation) / 293.0::DOUBLE, 5.26::DOUBLE))"
_U2 = "(wind * 0.748::DOUBLE)"
_RAW_ET0 = f"((0.408::DOUBLE * {_DELTA} * (0.77::DOUBLE * srad - {_RNL}) + {_GAMMA} * (900.0::DOUBLE / ({_MEAN} + 273.0::DOUBLE)) * {_U2} * (({es_sql('tmax')} + {es_sql('tmin')}) / 2.0::DOUBLE - {es_sql('tdew')})) / ({_DELTA} + {_GAMMA} * (1.0::DOUBLE + 0.34::DOUBLE * {_U2})))"
ET0_SQL = f"(CASE WHEN {_RAW_ET0} < 0 AND {_RAW_ET0} >= -0.1::DOUBLE THEN 0.0::DOUBLE ELSE {_RAW_ET0} END)"
RH_SQL = f"(CASE WHEN tmax IS NOT NULL AND tmin IS NOT NULL AND tdew IS NOT NULL THEN greatest(0.0::DOUBLE, least(100.0::DOUBLE, 100.0::DOUBLE * {es_sql('tdew')} / {es_sql(_MEAN)})) END)"

CTES = {
    "sites": f"SELECT c_custkey AS key, {place_sql('c_custkey')} FROM customer",
    "users": f"SELECT DISTINCT user_id AS u, {place_sql('user_id')}, ((user_id * 13) % 3000)::DOUBLE AS elevation, ((user_id % 5 - 2) * 60)::INTEGER AS t_zone FROM events",
    "cells": f"SELECT u, {child_sql('lat', 'lon')} AS child_id, {parent_sql('lat', 'lon')} AS parent_id, lat, lon, elevation, t_zone, u % 3 <> 0 AS is_land FROM users",
    "hourly": """SELECT user_id AS u, ts, ((user_id % 5 - 2) * 60)::INTEGER AS t_zone, o.variable AS variable, o.value AS value FROM (
  SELECT user_id, ts, unnest(CASE event_type
    WHEN 'view' THEN [{variable: 'tmax', value: 290.0::DOUBLE + value / 10.0::DOUBLE}, {variable: 'wind_u', value: value / 50.0::DOUBLE}]
    WHEN 'click' THEN [{variable: 'tmin', value: 275.0::DOUBLE + value / 10.0::DOUBLE}, {variable: 'wind_v', value: value / 70.0::DOUBLE}]
    WHEN 'purchase' THEN [{variable: 'precip', value: value / 10000.0::DOUBLE}]
    WHEN 'signup' THEN [{variable: 'tdew', value: 270.0::DOUBLE + value / 20.0::DOUBLE}]
    WHEN 'error' THEN [{variable: 'srad', value: value * 100000.0::DOUBLE}] END) AS o FROM events)""",
    "bronze": """SELECT u, (ts + t_zone * INTERVAL 1 MINUTE)::DATE AS date, variable,
  CASE variable WHEN 'tmax' THEN max(value) WHEN 'tmin' THEN min(value) WHEN 'precip' THEN sum(value) WHEN 'srad' THEN sum(value) ELSE avg(value) END AS value
  FROM hourly GROUP BY u, (ts + t_zone * INTERVAL 1 MINUTE)::DATE, variable""",
    "native": "SELECT u, date, " + ", ".join(f"max(CASE WHEN variable = '{v}' THEN value END) AS n_{v}" for v in daily.NATIVE) + " FROM bronze GROUP BY u, date",
    "wide": """SELECT u, date, n_tmax - 273.15::DOUBLE AS tmax, n_tmin - 273.15::DOUBLE AS tmin, n_precip * 1000.0::DOUBLE AS precip, n_srad / 1e6::DOUBLE AS srad,
  n_tdew - 273.15::DOUBLE AS tdew, sqrt(n_wind_u * n_wind_u + n_wind_v * n_wind_v) AS wind FROM native""",
    "stored": f"""SELECT w.*, c.child_id, c.parent_id, {RH_SQL} AS rh, {ET0_SQL} AS et0, date >= DATE '2024-01-25' AS is_preliminary, (CASE WHEN u % 7 = 0 THEN 4 ELSE 0 END)::INTEGER AS imputed
  FROM wide w JOIN cells c USING (u)""",
    "alt_rain": f"""SELECT u, {fine_sql('lat', 'lon')} AS fine_id, {fparent_sql('lat', 'lon')} AS fparent_id, date, source, precip FROM (
  SELECT l_suppkey AS u, {place_sql('l_suppkey')}, l_shipdate::DATE AS date, l_linenumber % 3 + 2 AS source, sum(l_quantity) AS precip FROM lineitem GROUP BY ALL)""",
    "rain_now": "SELECT u, fine_id, fparent_id, (DATE '2024-01-01' + ((date - DATE '1992-01-01') % 31)::INTEGER)::DATE AS date, source, sum(precip) AS precip FROM alt_rain GROUP BY ALL",
    "all_issues": "SELECT o_orderkey AS issue_id, ['tmax', 'tmin', 'precip'][o_orderkey % 3 + 1] AS variable, o_orderdate::DATE AS date, 'constant_field' AS detector, o_orderkey % 90 AS cells, ['detected', 'imputed', 'in_review', 'false_positive'][o_orderkey % 4 + 1] AS status FROM orders",
    "issues": "SELECT variable, date, detector, min(issue_id) AS issue_id, arg_min(cells, issue_id) AS cells, arg_min(status, issue_id) AS status FROM all_issues GROUP BY ALL",
    "runs": """SELECT o_orderkey AS run, o_custkey % 50 AS "group", o_orderkey % 3 + 1 AS parallel, epoch(o_orderdate)::BIGINT::DOUBLE AS started, floor(o_totalprice)::BIGINT % 3600 + 0.0::DOUBLE AS seconds,
  epoch(o_orderdate)::BIGINT::DOUBLE + (floor(o_totalprice)::BIGINT % 3600)::DOUBLE * 400 AS finished, o_orderkey % 1000 + 1 AS cells, ((o_orderkey * 7) % 500)::DOUBLE / 100.0::DOUBLE AS cost, o_orderkey % 4 AS attempts, CASE WHEN o_orderkey % 11 = 0 THEN 'failed' END AS error FROM orders""",
    "soil_cells": f"SELECT DISTINCT {soil_sql('lat', 'lon')} AS cell5m FROM (SELECT {place_sql('s_suppkey')} FROM supplier)",
    "soil_points": "SELECT cell5m, 'XX' || lpad(cell5m::VARCHAR, 8, '0') AS soil_id, 90.0::DOUBLE - (cell5m // 4320 + 0.5::DOUBLE) / 12 AS lat, (cell5m % 4320 + 0.5::DOUBLE) / 12 - 180.0::DOUBLE AS lon FROM soil_cells",
    "soil": f"SELECT *, {child_sql('lat', 'lon')} AS child_id FROM soil_points",
    "weights": """SELECT fine_id, to_base(i * 1440 + j % 1440, 36, 4) AS child_id,
    (least(n, 90.125::DOUBLE - i * 0.25::DOUBLE) - greatest(s, 90.125::DOUBLE - (i + 1) * 0.25::DOUBLE)) * (least(e, (j + 1) * 0.25::DOUBLE - 0.125::DOUBLE) - greatest(w, j * 0.25::DOUBLE - 0.125::DOUBLE)) / 0.0625::DOUBLE AS weight
  FROM (SELECT *, unnest(range(floor((w + 0.125::DOUBLE) / 0.25::DOUBLE + 1e-9::DOUBLE)::BIGINT, floor((e + 0.125::DOUBLE) / 0.25::DOUBLE - 1e-9::DOUBLE)::BIGINT + 1)) AS j FROM (
    SELECT *, unnest(range(floor((90.125::DOUBLE - n) / 0.25::DOUBLE + 1e-9::DOUBLE)::BIGINT, floor((90.125::DOUBLE - s) / 0.25::DOUBLE - 1e-9::DOUBLE)::BIGINT + 1)) AS i FROM (
      SELECT fine_id, 60.0::DOUBLE - (k // 7200) * 0.05::DOUBLE AS n, 60.0::DOUBLE - (k // 7200) * 0.05::DOUBLE - 0.05::DOUBLE AS s, (k % 7200) * 0.05::DOUBLE AS w, (k % 7200) * 0.05::DOUBLE + 0.05::DOUBLE AS e
      FROM (SELECT DISTINCT fine_id, fk AS k FROM fine_cells))))""",
    "fine_cells": f"SELECT DISTINCT {fine_sql('lat', 'lon')} AS fine_id, {fine_row_sql('lat')} * 7200 + {fine_col_sql('lon')} AS fk FROM (SELECT {place_sql('s_suppkey')} FROM supplier)",
}
_NEEDS = {"rain_now": ["alt_rain"], "issues": ["all_issues"], "cells": ["users"], "bronze": ["hourly"], "native": ["bronze"], "wide": ["native"], "stored": ["wide", "cells"], "soil_points": ["soil_cells"], "soil": ["soil_points"], "weights": ["fine_cells"]}


def with_ctes(names: list[str], query: str) -> str:
    """The query after the relations it names, and those that these need."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + query if order else query
