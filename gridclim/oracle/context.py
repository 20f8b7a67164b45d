"""Queries of the climate context: normals, percentiles, drought, phases and cyclones, with SQL that goes about it another way."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclim.functions import grid
from gridclim.operators import admin, climate, cyclones, snapshots, spatial
from gridclim.oracle.registry import query, r6, r6_sql
from gridclim.plans import projections as P

# divisors that leave no short decimals keep means from lying halfway between two rounded values
P.CTES |= {
    "days": "SELECT l_suppkey AS u, l_shipdate::DATE AS date, sum(l_quantity) AS precip, avg(l_discount) / 0.0033::DOUBLE AS tmax FROM lineitem GROUP BY ALL",
    "rain_months": "SELECT u, (year(date) * 12 + month(date) - 1)::INTEGER AS month, sum(precip) AS precip FROM days GROUP BY ALL",
    "rolled": """SELECT u, month, scale, total FROM (
  SELECT u, month, scale, sum(precip) OVER w AS total, count(*) OVER w AS k FROM (SELECT u, month, precip, unnest([1, 3, 6, 12]) AS scale FROM rain_months)
  WINDOW w AS (PARTITION BY u, scale ORDER BY month RANGE BETWEEN scale - 1 PRECEDING AND CURRENT ROW)) WHERE k = scale""",
    "fitted": """SELECT *, m / alpha AS beta FROM (SELECT *, CASE WHEN lo < hi THEN (1 + sqrt(1 + 4 * (ln(m) - ml) / 3)) / (4 * (ln(m) - ml)) END AS alpha FROM (
  SELECT u, scale, month % 12 AS c, count(*) FILTER (total = 0) / count(*) AS dry, avg(total) FILTER (total > 0) AS m, avg(ln(total)) FILTER (total > 0) AS ml, min(total) FILTER (total > 0) AS lo, max(total) FILTER (total > 0) AS hi
  FROM rolled GROUP BY ALL))""",
    "chances": """SELECT u, month, scale, total, dry + (1 - dry) * list_sum(list_transform(range(0, 500), lambda n: exp((alpha + n) * ln(total / beta) - total / beta - lgamma(alpha + n + 1)))) AS p
  FROM rolled JOIN fitted USING (u, scale) WHERE month % 12 = c AND alpha IS NOT NULL AND total > 0""",
}
P._NEEDS |= {"rain_months": ["days"], "rolled": ["rain_months"], "fitted": ["rolled"], "chances": ["rolled", "fitted"]}

# the quantile by Newton's method from a rough start; the normal distribution by its series of odd powers
_ROUGH = "CASE WHEN p < 0.5 THEN -1 ELSE 1 END * (t - (2.515517 + 0.802853 * t + 0.010328 * t * t) / (1 + 1.432788 * t + 0.189269 * t * t + 0.001308 * t * t * t))"
_PHI = "(0.5 + exp(-z * z / 2) / sqrt(2 * pi()) * sign(z) * list_sum(list_transform(range(0, 120), lambda k: exp((2 * k + 1) * ln(greatest(abs(z), 1e-12)) - lgamma(2 * k + 2) + k * ln(2) + lgamma(k + 1)))))"


def _spi_sql() -> str:
    inner = f"SELECT *, {_ROUGH} AS z FROM (SELECT *, sqrt(-2 * ln(least(p, 1 - p))) AS t FROM chances)"
    for _ in range(4):
        inner = f"SELECT * REPLACE (z - ({_PHI} - p) / (exp(-z * z / 2) / sqrt(2 * pi())) AS z) FROM ({inner})"
    return f"SELECT u, month, scale, total, z AS spi FROM ({inner})"


P.CTES["spi"] = _spi_sql()
P._NEEDS["spi"] = ["chances"]


def days(spark, d):
    return P.lines(spark, d, "l_shipdate", "l_quantity", "l_discount").groupBy(F.col("l_suppkey").alias("u"), F.to_date("l_shipdate").alias("date")).agg(F.sum("l_quantity").alias("precip"), (F.avg("l_discount") / 0.0033).alias("tmax"))


def rain_months(spark, d):
    return days(spark, d).groupBy("u", climate.month_number("date").alias("month")).agg(F.sum("precip").alias("precip"))


@query("c_rolling_rain", ["rolled"], "SELECT u, month, scale::INTEGER AS scale, total FROM rolled")
def _(spark, d):
    return climate.rolling_sums(rain_months(spark, d), ["u"])


@query("c_drought_index", ["spi", "rolled"], "SELECT u, month, r.scale::INTEGER AS scale, r.total, round(spi, 6) AS spi FROM rolled r LEFT JOIN spi s USING (u, month, scale)")
def _(spark, d):
    """Suppliers as cells, their order lines as rain, over seven years."""
    return climate.drought_index(rain_months(spark, d), ["u"]).select("u", "month", "scale", "total", *r6("spi"))


@query(
    "c_drought_alerts",
    ["spi"],
    """SELECT admin_id, make_date((month // 12)::BIGINT, (month % 12 + 1)::BIGINT, 1) AS as_of, scale::INTEGER AS scale, round(v, 6) AS spi, n_cells, CASE WHEN v <= -1.5 THEN 'red' WHEN v <= -1 THEN 'yellow' WHEN v <= -0.5 THEN 'watch' ELSE 'green' END AS status
  FROM (SELECT s_nationkey::BIGINT AS admin_id, month, scale, sum(spi * (1 + u % 3)) / sum(1 + u % 3) AS v, count(*) AS n_cells FROM spi JOIN supplier ON u = s_suppkey GROUP BY ALL)""",
)
def _(spark, d):
    """Nations as units, with shares of one to three."""
    shares = P.table(spark, d, "supplier").select(F.col("s_suppkey").alias("u"), F.col("s_nationkey").cast("long").alias("admin_id"), (F.col("s_suppkey") % 3 + 1).alias("share"))
    found = climate.drought_alerts(climate.drought_index(rain_months(spark, d), ["u"]), shares, ["u"])
    return found.select("admin_id", "as_of", "scale", *r6("spi"), "n_cells", "status")


def _normals_sql(key: str, bin_sql: str, scale: str) -> str:
    return f"""SELECT zone, '1993-1997' AS period, '{scale}' AS scale, bin::INTEGER AS bin, count(*) AS n_years, {r6_sql('avg(tmax)').replace('AS avg(tmax)', 'AS tmax_mean')}, round(avg(precip), 6) AS precip_mean, round(stddev_samp(precip), 6) AS precip_sd,
  round(quantile_cont(precip, 1.0::DOUBLE / 3), 6) AS precip_p33, round(quantile_cont(precip, 2.0::DOUBLE / 3), 6) AS precip_p67
  FROM (SELECT {key} AS zone, {bin_sql} AS bin, year(date) AS year, avg(tmax) AS tmax, sum(precip) AS precip FROM days WHERE year(date) BETWEEN 1993 AND 1997 GROUP BY ALL) GROUP BY ALL"""


def _normals(spark, d, key, scale):
    rows = climate.normals(days(spark, d).withColumn("zone", key), ["zone"], 1993, 1997, scale, ("tmax",), ("precip",))
    return rows.select("zone", "period", "scale", "bin", "n_years", *r6("tmax_mean", "precip_mean", "precip_sd", "precip_p33", "precip_p67"))


@query("c_normals_month", ["days"], _normals_sql("u", "month(date)", "month"))
def _(spark, d):
    return _normals(spark, d, F.col("u"), "month")


@query("c_normals_pentad", ["days"], _normals_sql("u % 7", "(SELECT (datediff('day', DATE '2001-01-01', make_date(2001, month(date)::BIGINT, CASE WHEN month(date) = 2 THEN least(day(date), 28) ELSE day(date) END::BIGINT)) + CASE WHEN month(date) = 2 AND day(date) = 29 THEN 1 ELSE 0 END) // 5 + 1)", "pentad"))
def _(spark, d):
    return _normals(spark, d, F.col("u") % 7, "pentad")


_PARTS = (0.0, 0.1, 1 / 3, 0.5, 2 / 3, 0.99, 1.0)


@query(
    "c_percentiles",
    [],
    f"SELECT flag, unnest(ps) AS probability, n, round(unnest(vs), 6) AS percentile FROM (SELECT l_returnflag AS flag, {list(_PARTS)!r}::DOUBLE[] AS ps, count(*) AS n, quantile_cont(l_extendedprice, {list(_PARTS)!r}::DOUBLE[]) AS vs FROM lineitem GROUP BY l_returnflag)",
)
def _(spark, d):
    """Prices by return flag: three groups of very many values."""
    rows = climate.grouped_percentiles(P.table(spark, d, "lineitem").withColumnRenamed("l_returnflag", "flag"), ["flag"], "l_extendedprice", list(_PARTS))
    return rows.select("flag", "probability", "n", *r6("percentile"))


def _phases_sql(limit: float) -> str:
    return f"""SELECT name, step, round(value, 4) AS value, CASE WHEN s <> 0 AND n >= 5 THEN s ELSE 0 END::INTEGER AS phase, CASE WHEN s <> 0 AND n >= 5 THEN n ELSE 0 END::BIGINT AS length FROM (
  SELECT *, count(*) OVER (PARTITION BY name, s, step - r) AS n FROM (SELECT *, row_number() OVER (PARTITION BY name, s ORDER BY step) AS r FROM (
    SELECT name, step, value, CASE WHEN value >= {limit} THEN 1 WHEN value <= -{limit} THEN -1 ELSE 0 END AS s FROM series)))"""


P.CTES |= {
    "order_months": "SELECT o_orderpriority AS name, (year(o_orderdate) * 12 + month(o_orderdate) - 1)::INTEGER AS month, avg(o_totalprice / 997) AS value FROM orders GROUP BY ALL",
    "off": "SELECT name, month, value - avg(value) OVER (PARTITION BY name, month % 12) AS off FROM order_months",
    "month_series": "SELECT a.name, a.month AS step, avg(b.off) AS value FROM off a JOIN off b ON a.name = b.name AND b.month BETWEEN a.month - 1 AND a.month + 1 GROUP BY ALL HAVING count(*) = 3",
}
P._NEEDS |= {"off": ["order_months"], "month_series": ["off"]}


@query("c_sustained_phases", ["month_series"], _phases_sql(2.0).replace("FROM series", "FROM month_series"))
def _(spark, d):
    """Monthly mean prices of orders by priority as indices: three-month means of their anomalies."""
    orders = P.table(spark, d, "orders").select(F.col("o_orderpriority").alias("name"), climate.month_number("o_orderdate").alias("month"), (F.col("o_totalprice") / 997).alias("v"))
    months = orders.groupBy("name", "month").agg(F.avg("v").alias("value"))
    index = climate.seasonal_anomaly(months, ["name"]).withColumnRenamed("month", "step")
    return climate.sustained_phases(index, ["name"], step="step", threshold=2.0).select("name", "step", F.round("value", 4).alias("value"), "phase", "length")


@query("c_sustained_days", [], _phases_sql(0.5).replace("FROM series", "FROM (SELECT l_returnflag AS name, (l_shipdate::DATE - DATE '1970-01-01')::INTEGER AS step, (sum(CASE WHEN l_linenumber <= 3 THEN 1 ELSE -1 END))::DOUBLE AS value FROM lineitem GROUP BY ALL)"))
def _(spark, d):
    """Days of shipping by return flag: series of thousands of steps, in blocks of 64."""
    lines = P.table(spark, d, "lineitem").select(F.col("l_returnflag").alias("name"), F.unix_date(F.to_date("l_shipdate")).alias("step"), F.when(F.col("l_linenumber") <= 3, 1).otherwise(-1).alias("v"))
    index = lines.groupBy("name", "step").agg(F.sum("v").cast("double").alias("value"))
    return climate.sustained_phases(index, ["name"], step="step", block=64).select("name", "step", F.round("value", 4).alias("value"), "phase", "length")


_LAT, _LON = "((user_id * 37) % 1200)::DOUBLE / 10.0::DOUBLE - 60.0::DOUBLE", "((user_id * 91) % 3600)::DOUBLE / 10.0::DOUBLE - 180.0::DOUBLE"
P.CTES |= {
    "tracks": f"""SELECT user_id AS storm_id, ts AS obs_time, ({_LAT}) + ((event_id * 7) % 40)::DOUBLE / 10.0::DOUBLE - 2.0::DOUBLE AS lat,
  (({_LON}) + ((event_id * 11) % 40)::DOUBLE / 10.0::DOUBLE - 2.0::DOUBLE + 540.0::DOUBLE) % 360.0::DOUBLE - 180.0::DOUBLE AS lon, value AS wind_kt, event_type = 'error' AS is_forecast FROM events""",
    "legs": """SELECT * FROM (SELECT storm_id, obs_time AS t0, lat AS lat0, lon AS lon0, wind_kt AS w0, lead(obs_time) OVER w AS t1, lead(lat) OVER w AS lat1, lead(lon) OVER w AS lon1, lead(wind_kt) OVER w AS w1 FROM tracks WHERE NOT is_forecast WINDOW w AS (PARTITION BY storm_id ORDER BY obs_time, lat, lon, wind_kt)) WHERE t1 IS NOT NULL
  UNION ALL SELECT storm_id, min(obs_time), min(lat), min(lon), min(wind_kt), min(obs_time), min(lat), min(lon), min(wind_kt) FROM tracks WHERE NOT is_forecast GROUP BY storm_id HAVING count(*) = 1""",
}
P._NEEDS["legs"] = ["tracks"]
_ARC = lambda a, b: f"2 * asin(sqrt(pow(sin(radians({b[0]} - {a[0]}) / 2), 2) + cos(radians({a[0]})) * cos(radians({b[0]})) * pow(sin(radians({b[1]} - {a[1]}) / 2), 2)))"
_TO = lambda a, b: f"atan2(sin(radians({b[1]} - {a[1]})) * cos(radians({b[0]})), cos(radians({a[0]})) * sin(radians({b[0]})) - sin(radians({a[0]})) * cos(radians({b[0]})) * cos(radians({b[1]} - {a[1]})))"
_A, _B, _C = ("lat0", "lon0"), ("lat1", "lon1"), ("lat", "lon")


@query(
    "c_cyclone_exposure",
    ["legs", "sites"],
    f"""SELECT storm_id, key, round(min(km), 3) AS closest_approach_km, max(greatest(w0, w1)) AS max_wind_kt, min(t0)::DATE AS exposure_start, max(t1)::DATE AS exposure_end FROM (
  SELECT *, 6371.0088 * CASE WHEN d12 = 0 THEN d13 WHEN cos(turn) < 0 THEN d13 WHEN acos(least(1, cos(d13) / cos(asin(sin(d13) * sin(turn))))) > d12 THEN d23 ELSE abs(asin(sin(d13) * sin(turn))) END AS km FROM (
    SELECT l.*, key, {_ARC(_A, _C)} AS d13, {_ARC(_B, _C)} AS d23, {_ARC(_A, _B)} AS d12, {_TO(_A, _C)} - {_TO(_A, _B)} AS turn FROM legs l, sites)) WHERE km <= 250 GROUP BY ALL""",
)
def _(spark, d):
    """Users' events as storms that wander around their places, customers' places as cells, 250 km."""
    place = P.place_of("user_id")
    shift = lambda k: (F.col("event_id") * k) % 40 / F.lit(10.0) - 2.0
    rows = P.table(spark, d, "events").withColumns({"_lat": place[0], "_lon": place[1]})
    tracks = rows.select(F.col("user_id").alias("storm_id"), F.col("ts").alias("obs_time"), (F.col("_lat") + shift(7)).alias("lat"), ((F.col("_lon") + shift(11) + 540.0) % 360.0 - 180.0).alias("lon"), F.col("value").alias("wind_kt"), (F.col("event_type") == "error").alias("is_forecast"))
    return cyclones.exposure(tracks, P.sites(spark, d), 250.0, ["key"]).select("storm_id", "key", F.round("closest_approach_km", 3).alias("closest_approach_km"), "max_wind_kt", "exposure_start", "exposure_end")


# Forecasts in snapshots


_FORECAST = T.StructType([T.StructField("system", T.StringType()), T.StructField("target_start", T.DateType()), T.StructField("cell", T.LongType()), T.StructField("value", T.DoubleType())])
P.CTES["forecast"] = "SELECT event_type AS system, ts::DATE AS target_start, user_id AS cell, max(value) AS value FROM events GROUP BY ALL"


def forecast(spark, d):
    """The largest value of each user, day and event type, as a forecast of the type's system."""
    return P.table(spark, d, "events").groupBy(F.col("event_type").alias("system"), F.to_date("ts").alias("target_start"), F.col("user_id").alias("cell")).agg(F.max("value").alias("value"))


def _issued(spark, d) -> str:
    """Three issues: all systems' at first, then a shorter horizon of one, then of another."""
    path, rows = P.folder(spark, "forecast"), forecast(spark, d)
    snapshots.replace_all(spark, path, rows, "system")
    late = rows.where(F.col("target_start") >= F.lit("2024-01-10").cast("date")).withColumn("value", F.col("value") + 1000)
    for system in ("view", "click"):
        snapshots.replace_horizon(spark, path, late.where(F.col("system") == system), _FORECAST, system)
    return path


@query("w_forecast_horizon", ["forecast"], "SELECT system, target_start, cell, value + CASE WHEN system IN ('view', 'click') THEN 1000 ELSE 0 END AS value FROM forecast WHERE system NOT IN ('view', 'click') OR target_start >= DATE '2024-01-10'")
def _(spark, d):
    return snapshots.Table(spark, _issued(spark, d)).read(_FORECAST)


@query(
    "w_forecast_versions",
    ["forecast"],
    "SELECT v AS version, system, count(*) AS n, max(value + CASE WHEN done THEN 1000 ELSE 0 END) AS most FROM (SELECT v, f.*, (system = 'view' AND v > 1) OR (system = 'click' AND v > 2) AS done FROM forecast f, (SELECT unnest([1, 2, 3])::INTEGER AS v)) WHERE NOT done OR target_start >= DATE '2024-01-10' GROUP BY ALL",
)
def _(spark, d):
    """Each version as a reader finds it that names it."""
    table, out = snapshots.Table(spark, _issued(spark, d)), None
    for n in table.numbers():
        rows = table.read(_FORECAST, n).groupBy("system").agg(F.count("*").alias("n"), F.max("value").alias("most")).select(F.lit(n).alias("version"), "system", "n", "most")
        out = rows if out is None else out.unionByName(rows)
    return out


# Skill, analogue years, vegetation

P.CTES |= {
    "shipped": "SELECT l_suppkey % 20 AS zone, (year(l_shipdate) * 12 + month(l_shipdate) - 1)::INTEGER AS month, avg(l_quantity) / 0.7::DOUBLE AS value, avg(l_discount) AS disc FROM lineitem GROUP BY ALL",
    "hindcasts": "SELECT l_suppkey % 20 AS zone, (year(l_shipdate) * 12 + month(l_shipdate) - 1 - l_linenumber % 3)::INTEGER AS init, (l_linenumber % 3)::INTEGER AS lead, l_extendedprice / 997 AS value FROM lineitem",
    "verified": "SELECT zone, h.month, lead, x, value AS y FROM (SELECT zone, init + lead AS month, lead, avg(value) AS x FROM hindcasts GROUP BY ALL) h JOIN shipped USING (zone, month)",
}
P._NEEDS |= {"verified": ["shipped", "hindcasts"]}


def shipped(spark, d):
    rows = P.table(spark, d, "lineitem").select((F.col("l_suppkey") % 20).alias("zone"), climate.month_number("l_shipdate").alias("month"), "l_quantity", "l_discount")
    return rows.groupBy("zone", "month").agg((F.avg("l_quantity") / 0.7).alias("value"), F.avg("l_discount").alias("disc"))


def hindcasts(spark, d):
    lead = (F.col("l_linenumber") % 3).cast("int")
    return P.table(spark, d, "lineitem").select((F.col("l_suppkey") % 20).alias("zone"), (climate.month_number("l_shipdate") - lead).alias("init"), lead.alias("lead"), (F.col("l_extendedprice") / 997).alias("value"))


@query(
    "c_hindcast_skill",
    ["verified"],
    """SELECT zone, (month % 12 + 1)::INTEGER AS calendar, lead, count(*) AS n_years, round(avg(x), 6) AS hindcast_mean, round(stddev_samp(x), 6) AS hindcast_sd, round(avg(y), 6) AS obs_mean, round(stddev_samp(y), 6) AS obs_sd, round(avg(x) - avg(y), 6) AS bias,
  CASE WHEN count(*) >= 3 THEN round(sum(ax * ay) / sqrt(sum(ax * ax) * sum(ay * ay)), 6) END AS skill_acc FROM (
    SELECT v.*, x - (SELECT avg(o.x) FROM verified o WHERE o.zone = v.zone AND o.lead = v.lead AND o.month % 12 = v.month % 12 AND o.month <> v.month) AS ax,
      y - (SELECT avg(o.y) FROM verified o WHERE o.zone = v.zone AND o.lead = v.lead AND o.month % 12 = v.month % 12 AND o.month <> v.month) AS ay FROM verified v) GROUP BY ALL""",
)
def _(spark, d):
    """Prices as hindcasts of quantities, at leads of none to two months, with anomalies from each other year by itself in the SQL."""
    found = climate.hindcast_skill(hindcasts(spark, d), shipped(spark, d), ["zone"])
    return found.select("zone", "calendar", "lead", "n_years", *r6("hindcast_mean", "hindcast_sd", "obs_mean", "obs_sd", "bias", "skill_acc"))


P.CTES |= {
    "parts_of_years": "SELECT zone, month // 12 AS year, month % 12 + 1 AS c, unnest(['value', 'disc']) AS variable, unnest([value, disc]) AS x FROM shipped WHERE month % 12 < 6",
    "zs": "SELECT zone, year, c, variable, (x - avg(x) OVER w) / stddev_samp(x) OVER w AS z FROM parts_of_years WINDOW w AS (PARTITION BY zone, c, variable) QUALIFY stddev_samp(x) OVER w > 0",
    "scenes": "SELECT l_suppkey % 50 AS cell, l_shipdate::DATE AS date, l_discount * 5 + l_tax + 0.05 AS ndvi, (l_linenumber % 4)::INTEGER AS quality FROM lineitem",
    "composites": "SELECT cell, year, dekad, ndvi FROM (SELECT cell, year, dekad, quality, max(ndvi) AS ndvi FROM (SELECT cell, ndvi, quality, year(date) AS year, (month(date) - 1) * 3 + CASE WHEN day(date) <= 10 THEN 1 WHEN day(date) <= 20 THEN 2 ELSE 3 END AS dekad FROM scenes WHERE ndvi BETWEEN -1 AND 1 AND quality <= 1 AND year(date) BETWEEN 1993 AND 1997) GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY cell, year, dekad ORDER BY quality) = 1",
}
P._NEEDS |= {"parts_of_years": ["shipped"], "zs": ["parts_of_years"], "composites": ["scenes"]}

@query(
    "c_analogue_years",
    ["zs"],
    """SELECT zone, target::INTEGER AS target, rank, year::INTEGER AS year, round(distance, 6) AS distance, n_parts FROM (SELECT *, row_number() OVER (PARTITION BY zone, target ORDER BY distance, year)::INTEGER AS rank FROM (
  SELECT a.zone, a.year AS target, b.year AS year, round(sqrt(sum(pow(a.z - b.z, 2)) / count(*)), 9) AS distance, count(*) AS n_parts FROM zs a JOIN zs b ON a.zone = b.zone AND a.c = b.c AND a.variable = b.variable
  JOIN (SELECT zone, year, count(*) AS n FROM zs GROUP BY ALL) t ON t.zone = a.zone AND t.year = a.year WHERE a.year IN (1995, 1997) AND a.year <> b.year GROUP BY a.zone, a.year, b.year HAVING 2 * count(*) >= any_value(t.n))) WHERE rank <= 3""",
)
def _(spark, d):
    """The three years most like 1995 and 1997 by their first six months' quantities and discounts."""
    found = climate.analogue_years(shipped(spark, d), ["zone"], ["value", "disc"], [1995, 1997], [1, 2, 3, 4, 5, 6])
    return found.select("zone", "target", "rank", "year", *r6("distance"), "n_parts")


@query(
    "c_vegetation_anomaly",
    ["composites"],
    """SELECT cell, make_date(year::BIGINT, ((dekad - 1) // 3 + 1)::BIGINT, ((dekad - 1) % 3 * 10 + 1)::BIGINT) AS dekad_start, round(ndvi, 6) AS ndvi, round(lta, 6) AS ndvi_lta, round((ndvi - lta) / abs(lta) * 100, 5) + 0 AS anomaly_pct, CASE WHEN sd > 1e-9 THEN round((ndvi - lta) / sd, 5) + 0 END AS z FROM (
  SELECT e.cell, e.year, e.dekad, any_value(c.ndvi) AS ndvi, CASE WHEN count(o.ndvi) >= 2 THEN avg(o.ndvi) END AS lta, CASE WHEN count(o.ndvi) >= 2 THEN stddev_samp(o.ndvi) END AS sd
  FROM (SELECT * FROM (SELECT DISTINCT cell FROM scenes WHERE year(date) BETWEEN 1993 AND 1997), range(1993, 1998) y(year), range(1, 37) k(dekad)) e
  LEFT JOIN composites c USING (cell, year, dekad) LEFT JOIN composites o ON o.cell = e.cell AND o.dekad = e.dekad AND o.year <> e.year GROUP BY ALL)""",
)
def _(spark, d):
    """Discounts as scenes of suppliers' cells, line numbers as quality."""
    lines = P.table(spark, d, "lineitem")
    scenes = lines.select((F.col("l_suppkey") % 50).alias("cell"), F.to_date("l_shipdate").alias("date"), (F.col("l_discount") * 5 + F.col("l_tax") + 0.05).alias("ndvi"), (F.col("l_linenumber") % 4).alias("quality"))
    found = climate.vegetation_anomaly(scenes, ["cell"], 1993, 1997)
    return found.select("cell", "dekad_start", *r6("ndvi", "ndvi_lta"), (F.round("anomaly_pct", 5) + 0).alias("anomaly_pct"), (F.round("z", 5) + 0).alias("z"))


# Administrative units

# offsets in degrees: a slanted outer ring, its hole, which turns the same way, and a triangle elsewhere
_SHAPES = [[[(0.0, 0.0), (1.31, 0.22), (1.02, 1.4), (-0.33, 0.91)], [(0.3, 0.3), (0.8, 0.42), (0.55, 0.87)]], [[(2.0, -1.0), (2.1, 0.35), (3.17, -0.41)]]]
_POINTS = [(part, ring, k, *p, *points[(k + 1) % len(points)]) for part, shape in enumerate(_SHAPES) for ring, points in enumerate(shape) for k, p in enumerate(points)]
P.CTES |= {
    "sides": f"SELECT key, CASE WHEN ring = 0 THEN 1 ELSE -1 END AS hole, round(lon + a, 3) AS x0, round(lat + b, 3) AS y0, round(lon + c, 3) AS x1, round(lat + d, 3) AS y1 FROM sites, (VALUES {', '.join(map(str, _POINTS))}) AS t(part, ring, k, a, b, c, d)",
    # all cells of each unit's box, by all of its edges: the area west of an edge within a cell is an integral of the clamped line
    "boxes": "SELECT key, i, j, 90.125 - (i + 1) * 0.25 AS s, 90.125 - i * 0.25 AS n, j * 0.25 - 0.125 AS w, j * 0.25 + 0.125 AS e FROM (SELECT key, unnest(range(floor((90.125 - y) / 0.25)::BIGINT, floor((90.125 - v) / 0.25)::BIGINT + 1)) AS i, u, x FROM (SELECT key, max(y0) AS y, min(y0) AS v, min(x0) AS u, max(x0) AS x FROM sides GROUP BY key)), LATERAL (SELECT unnest(range(floor((u + 0.125) / 0.25)::BIGINT, floor((x + 0.125) / 0.25)::BIGINT + 1)) AS j)",
    "cuts": """SELECT key, i, j, sum(hole * CASE WHEN hi > lo THEN sgn * (hi - lo) * (CASE WHEN abs(xb - xa) < 1e-12 THEN greatest(w, least(e, xa)) - w ELSE (CASE WHEN xb >= e THEN (e - w) * (xb - e) + (e - w) ** 2 / 2 WHEN xb <= w THEN 0 ELSE (xb - w) ** 2 / 2 END - CASE WHEN xa >= e THEN (e - w) * (xa - e) + (e - w) ** 2 / 2 WHEN xa <= w THEN 0 ELSE (xa - w) ** 2 / 2 END) / (xb - xa) END) ELSE 0 END) / 0.0625 AS share FROM (
  SELECT *, x0 + (x1 - x0) * (lo - y0) / (y1 - y0) AS xa, x0 + (x1 - x0) * (hi - y0) / (y1 - y0) AS xb FROM (SELECT *, greatest(s, least(y0, y1)) AS lo, least(n, greatest(y0, y1)) AS hi, CASE WHEN y1 > y0 THEN 1 ELSE -1 END AS sgn FROM boxes JOIN sides USING (key) WHERE y0 <> y1)) GROUP BY ALL""",
    "unit_shares": "SELECT key, i, j % 1440 + CASE WHEN j % 1440 < 0 THEN 1440 ELSE 0 END AS j, sum(abs(share)) AS share FROM cuts GROUP BY ALL HAVING sum(abs(share)) > 1e-9",
}
P._NEEDS |= {"sides": ["sites"], "boxes": ["sides"], "cuts": ["boxes"], "unit_shares": ["cuts"]}


def units(spark, d):
    """A multipolygon with a hole at each customer's place, as text."""
    def text(points):
        at = lambda p: F.format_string("%.3f %.3f", F.round(F.col("lon") + p[0], 3), F.round(F.col("lat") + p[1], 3))
        return F.concat(F.lit("("), F.concat_ws(", ", *[at(p) for p in (*points, points[0])]), F.lit(")"))

    parts = [F.concat(F.lit("("), F.concat_ws(", ", *[text(r) for r in shape]), F.lit(")")) for shape in _SHAPES]
    return P.sites(spark, d).select("key", F.concat(F.lit("MULTIPOLYGON ("), F.concat_ws(", ", *parts), F.lit(")")).alias("wkt"))


@query("c_admin_cells", ["unit_shares"], "SELECT key, to_base(i // 4 * 360 + j // 4, 36, 4) AS parent_id, to_base(i * 1440 + j, 36, 4) AS child_id, round(share, 6) AS area_fraction FROM unit_shares WHERE share > 1e-6")
def _(spark, d):
    return admin.admin_cells(units(spark, d), "key").where("area_fraction > 1e-6").select("key", "parent_id", "child_id", *r6("area_fraction"))


@query("c_admin_area", ["sites"], f"SELECT key, round(sum(hole * abs(turn)) / 2, 6) AS area FROM (SELECT key, CASE WHEN ring = 0 THEN 1 ELSE -1 END AS hole, sum(a * d - c * b) AS turn FROM sites, (VALUES {', '.join(map(str, _POINTS))}) AS t(part, ring, k, a, b, c, d) GROUP BY key, part, ring) GROUP BY key")
def _(spark, d):
    """The cells' shares add up to each unit's area."""
    return admin.admin_cells(units(spark, d), "key").groupBy("key").agg(F.round(F.sum("area_fraction") * 0.0625, 6).alias("area"))

# a slanted polygon with a hole, and another polygon: lon and lat of the rings
_REGION = [[[(-150.3, -48.7), (20.4, -55.1), (95.2, 31.9), (-40.6, 52.3)], [(-60.2, -20.1), (10.7, -24.9), (-5.3, 12.6)]], [[(120.1, -50.2), (171.3, -11.4), (133.8, 40.9)]]]
_REGION_WKT = "MULTIPOLYGON (" + ", ".join("(" + ", ".join("(" + ", ".join(f"{x} {y}" for x, y in [*ring, ring[0]]) + ")" for ring in shape) + ")" for shape in _REGION) + ")"
_REGION_SIDES = [(1 if ring == 0 else -1, part, ring, *p, *points[(k + 1) % len(points)]) for part, shape in enumerate(_REGION) for ring, points in enumerate(shape) for k, p in enumerate(points)]
_CLAMPED = "(CASE WHEN {0} >= e THEN (e - w) * ({0} - e) + (e - w) ** 2 / 2 WHEN {0} <= w THEN 0 ELSE ({0} - w) ** 2 / 2 END)"
P.CTES |= {
    "centres": f"SELECT DISTINCT u, child_id, 90.0 - {P.lat_sql('lat')} * 0.25 AS lat, CASE WHEN {P.lon_sql('lon')} * 0.25 > 180 THEN {P.lon_sql('lon')} * 0.25 - 360 ELSE {P.lon_sql('lon')} * 0.25 END AS lon FROM cells",
    "region": f"""SELECT u, child_id, sum(share) AS weight FROM (SELECT u, child_id, part, ring, any_value(hole) * abs(sum(CASE WHEN hi > lo THEN sgn * (hi - lo) * (CASE WHEN abs(xb - xa) < 1e-12 THEN greatest(w, least(e, xa)) - w ELSE ({_CLAMPED.format('xb')} - {_CLAMPED.format('xa')}) / (xb - xa) END) ELSE 0 END)) / 0.0625 AS share FROM (
  SELECT *, x0 + (x1 - x0) * (lo - y0) / (y1 - y0) AS xa, x0 + (x1 - x0) * (hi - y0) / (y1 - y0) AS xb FROM (SELECT *, lat - 0.125 AS s, lat + 0.125 AS n, lon - 0.125 AS w, lon + 0.125 AS e, greatest(lat - 0.125, least(y0, y1)) AS lo, least(lat + 0.125, greatest(y0, y1)) AS hi, CASE WHEN y1 > y0 THEN 1 ELSE -1 END AS sgn
    FROM centres, (VALUES {', '.join(map(str, _REGION_SIDES))}) AS t(hole, part, ring, x0, y0, x1, y1))) GROUP BY ALL) GROUP BY ALL HAVING sum(share) > 1e-9""",
}
P._NEEDS |= {"centres": ["cells"], "region": ["centres"]}


def _region(spark, d):
    at = grid.cell_center("lat", "lon")
    cells = P.cells(spark, d).select("u", "child_id", at["lat"].alias("lat"), at["lon"].alias("lon"))
    return spatial.polygon_weights(cells, _REGION_WKT).where("weight > 1e-9").select("u", "child_id", "weight")


@query("j_polygon_slanted", ["region"], "SELECT u, child_id, round(weight, 6) AS weight FROM region")
def _(spark, d):
    return _region(spark, d).select("u", "child_id", *r6("weight"))


@query("a_region_slanted", ["region", "stored"], "SELECT date, round(sum(tmax * weight) / sum(weight) FILTER (tmax IS NOT NULL), 6) AS tmax, count(*) AS n_cells FROM stored JOIN region USING (child_id) GROUP BY date")
def _(spark, d):
    return spatial.region_mean(P.stored(spark, d), _region(spark, d), ["tmax"]).select("date", *r6("tmax"), "n_cells")
