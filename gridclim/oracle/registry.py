"""All queries and their SQL by key. Each query applies an operator to a projection of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclim.functions import grid, physics, text
from gridclim.operators import daily, fieldqa, gridbuild, runs, series, spatial, station, storage
from gridclim.plans import projections as P
from gridclim.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
KEYS = ["u"]
V8 = text.VARIABLES


def query(key: str, ctes: list[str], sql: str):
    """Registers a query with SQL over the named relations."""

    def put(f: Query) -> Query:
        QUERIES[key] = lambda spark, sf_dir: f(configure(spark), sf_dir)
        ORACLES[key] = P.with_ctes(ctes, sql)
        return f

    return put


def r6(*names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


def r6_sql(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


# codes


@query("g_child_code", ["sites"], f"SELECT key, {P.child_sql('lat', 'lon')} AS child_id FROM sites")
def _(spark, d):
    return P.sites(spark, d).select("key", grid.cell_code("lat", "lon").alias("child_id"))


@query("g_parent_code", ["sites"], f"SELECT key, {P.parent_sql('lat', 'lon')} AS parent_id FROM sites")
def _(spark, d):
    return P.sites(spark, d).select("key", grid.parent_code("lat", "lon").alias("parent_id"))


@query("g_parent_of", ["sites"], f"SELECT key, to_base((k // 1440 // 4) * 360 + k % 1440 // 4, 36, 4) AS parent_id FROM (SELECT key, {P.lat_sql('lat')} * 1440 + {P.lon_sql('lon')} AS k FROM sites)")
def _(spark, d):
    return P.sites(spark, d).select("key", grid.parent_of(grid.cell_code("lat", "lon")).alias("parent_id"))


@query("g_seam_modes", ["sites"], f"SELECT key, to_base({P.lat_sql('lat')} * 1440 + {P.lon_sql('lon')} % 1440, 36, 4) AS wrapped, to_base({P.lat_sql('lat')} * 1440 + least({P.lon_sql('lon')}, 1439), 36, 4) AS clipped FROM sites")
def _(spark, d):
    return P.sites(spark, d).select("key", grid.cell_code("lat", "lon", "wrap").alias("wrapped"), grid.cell_code("lat", "lon", "clip").alias("clipped"))


@query("g_fine_code", ["sites"], f"SELECT key, {P.fine_sql('lat', 'lon')} AS fine_id, {P.fparent_sql('lat', 'lon')} AS fparent_id FROM sites")
def _(spark, d):
    return P.sites(spark, d).select("key", grid.fine_code("lat", "lon").alias("fine_id"), grid.fine_parent_of(grid.fine_code("lat", "lon")).alias("fparent_id"))


@query("g_cell5m", ["sites"], f"SELECT key, {P.soil_sql('lat', 'lon')} AS cell5m FROM sites")
def _(spark, d):
    return P.sites(spark, d).select("key", grid.soil_cell("lat", "lon").alias("cell5m"))


@query(
    "g_decode_center",
    ["sites"],
    f"""SELECT key, 90.0::DOUBLE - k // 1440 * 0.25::DOUBLE AS c_lat, CASE WHEN k % 1440 * 0.25::DOUBLE > 180 THEN k % 1440 * 0.25::DOUBLE - 360 ELSE k % 1440 * 0.25::DOUBLE END AS c_lon,
  round(60.0::DOUBLE - ({P.fine_row_sql('lat')} + 0.5::DOUBLE) * 0.05::DOUBLE, 6) AS f_lat,
  round(CASE WHEN ({P.fine_col_sql('lon')} + 0.5::DOUBLE) * 0.05::DOUBLE > 180 THEN ({P.fine_col_sql('lon')} + 0.5::DOUBLE) * 0.05::DOUBLE - 360 ELSE ({P.fine_col_sql('lon')} + 0.5::DOUBLE) * 0.05::DOUBLE END, 6) AS f_lon
  FROM (SELECT *, {P.lat_sql('lat')} * 1440 + {P.lon_sql('lon')} AS k FROM sites)""",
)
def _(spark, d):
    rows = P.sites(spark, d)
    c, f = grid.code_center(grid.cell_code("lat", "lon")), grid.fine_cell_center("lat", "lon")
    return rows.select("key", c["lat"].alias("c_lat"), c["lon"].alias("c_lon"), F.round(f["lat"], 6).alias("f_lat"), F.round(f["lon"], 6).alias("f_lon"))


@query(
    "g_decode_spilled",
    ["sites"],
    f"""SELECT key, to_base((k // 1440 // 4) * 360 + k % 1440 // 4, 36, 4) AS parent_id, 90.0::DOUBLE - k // 1440 * 0.25::DOUBLE AS c_lat,
  CASE WHEN k % 1440 * 0.25::DOUBLE > 180 THEN k % 1440 * 0.25::DOUBLE - 360 ELSE k % 1440 * 0.25::DOUBLE END AS c_lon
  FROM (SELECT key, {P.lat_sql('lat')} * 1440 + {P.lon_sql('lon')} AS k FROM sites)""",
)
def _(spark, d):
    code = grid.cell_code("lat", "lon")
    c = grid.code_center(code)
    return P.sites(spark, d).select("key", grid.parent_of(code).alias("parent_id"), c["lat"].alias("c_lat"), c["lon"].alias("c_lon"))


@query(
    "g_parent_bbox",
    ["sites"],
    f"""SELECT key, 90.0::DOUBLE - (least((r + 1) * 4, 721) - 1) * 0.25::DOUBLE - 0.125::DOUBLE AS south, c * 1.0::DOUBLE - 0.125::DOUBLE - shift AS west, 90.0::DOUBLE - r * 1.0::DOUBLE + 0.125::DOUBLE AS north, c * 1.0::DOUBLE + 0.875::DOUBLE - shift AS east
  FROM (SELECT *, CASE WHEN c * 1.0::DOUBLE - 0.125::DOUBLE >= 180 THEN 360.0::DOUBLE ELSE 0.0::DOUBLE END AS shift FROM (SELECT key, {P.lat_sql('lat')} // 4 AS r, ({P.lon_sql('lon')} % 1440) // 4 AS c FROM sites)) WHERE c <> 180""",
)
def _(spark, d):
    row, col = F.floor(grid.lat_index("lat") / 4), F.floor(grid.lon_index("lon", "wrap") / 4)
    box = grid.parent_bbox(F.col("r"), F.col("c"))
    return P.sites(spark, d).select("key", row.alias("r"), col.alias("c")).where("c <> 180").select("key", box.alias("b")).select("key", "b.*")


@query("g_locate", ["sites"], f"SELECT key, {P.child_sql('lat', 'lon')} AS child_id, {P.parent_sql('lat', 'lon')} AS parent_id, {P.fine_sql('lat', 'lon')} AS fine_id, {P.fparent_sql('lat', 'lon')} AS fparent_id, {P.soil_sql('lat', 'lon')} AS cell5m FROM sites")
def _(spark, d):
    return P.sites(spark, d).select("key", grid.locate("lat", "lon").alias("p")).select("key", "p.child_id", "p.parent_id", "p.fine_id", "p.fparent_id", "p.cell5m")


# physics, text


@query("s_rh", ["stored"], "SELECT u, date, round(rh, 6) AS rh FROM stored")
def _(spark, d):
    return P.stored(spark, d).select("u", "date", *r6("rh"))


@query("s_et0", ["stored"], "SELECT u, date, round(et0, 6) AS et0 FROM stored")
def _(spark, d):
    return P.stored(spark, d).select("u", "date", *r6("et0"))


@query("s_radiation", [], f"SELECT c_custkey AS key, round({P.RA_SQL.replace('lat', '((c_custkey % 180) - 90.0::DOUBLE)').replace('dayofyear(date)', '(c_custkey % 365 + 1)')}, 6) AS ra FROM customer")
def _(spark, d):
    k = F.col("c_custkey")
    return P.table(spark, d, "customer").select(k.alias("key"), F.round(physics.extraterrestrial_radiation(k % 180 - 90.0, k % 365 + 1), 6).alias("ra"))


@query("s_noise_snap", [], "SELECT c_custkey AS key, CASE WHEN x < 0 AND x >= -0.01::DOUBLE THEN 0.0::DOUBLE ELSE x END AS coarse, CASE WHEN x < 0 AND x > -0.01::DOUBLE THEN 0.0::DOUBLE ELSE x END AS fine FROM (SELECT c_custkey, (c_custkey % 5 - 2)::DOUBLE / 100.0::DOUBLE AS x FROM customer)")
def _(spark, d):
    x = (F.col("c_custkey") % 5 - 2) / 100.0
    return P.table(spark, d, "customer").select(F.col("c_custkey").alias("key"), physics.snap_noise(x).alias("coarse"), physics.snap_noise(x, closed=False).alias("fine"))


_F6 = lambda x: f"lpad(round(coalesce({x}, -99.0)::DECIMAL(20,12), 1)::DECIMAL(20,1)::VARCHAR, 6, ' ')"


@query("s_fixed_width", [], f"SELECT c_custkey AS key, {_F6('c_acctbal / 10.0::DOUBLE')} AS line FROM customer")
def _(spark, d):
    return P.table(spark, d, "customer").select(F.col("c_custkey").alias("key"), text.f6(F.col("c_acctbal") / 10.0).alias("line"))


@query("s_station_date", [], "SELECT o_orderkey AS key, strftime(o_orderdate, '%y%j') AS day, (o_orderdate::DATE - INTERVAL 3 MONTH)::DATE AS cutoff, least(abs(dayofyear(o_orderdate) - 10), 365 - abs(dayofyear(o_orderdate) - 10))::INTEGER AS doy_distance FROM orders")
def _(spark, d):
    day = F.to_date("o_orderdate")
    return P.table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), text.station_date(day).alias("day"), text.preliminary_cutoff(day).alias("cutoff"), text.doy_distance(F.dayofyear(day), F.lit(10)).alias("doy_distance"))


@query("s_bits", ["stored"], "SELECT u, date, (imputed & 4) > 0 AS has, (imputed | 8)::INTEGER AS added, (imputed & 251)::INTEGER AS cleared FROM stored")
def _(spark, d):
    return P.stored(spark, d).select("u", "date", text.imputed("imputed", "precip").alias("has"), text.with_bit("imputed", "srad").alias("added"), text.without_bit("imputed", "precip").alias("cleared"))


@query("s_tz_offset", ["sites"], "SELECT key, (round_even(lon / 15.0::DOUBLE, 0) * 60)::INTEGER AS minutes FROM sites")
def _(spark, d):
    return P.sites(spark, d).select("key", text.offset_minutes_by_longitude("lon").alias("minutes"))


@query("s_json", [], "SELECT event_id, (props->>'k')::INTEGER AS k FROM events")
def _(spark, d):
    return P.table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


# daily


@query("a_local_day_reduce", ["bronze"], "SELECT u, date, variable, round(value, 6) AS value FROM bronze")
def _(spark, d):
    return P.bronze(spark, d).select("u", "date", "variable", *r6("value"))


@query("x_wide_pivot", ["wide"], f"SELECT u, date, {r6_sql('tmax', 'tmin', 'precip', 'srad', 'tdew', 'wind')} FROM wide")
def _(spark, d):
    return daily.with_wind(daily.to_wide(P.bronze(spark, d), ["u", "date"])).select("u", "date", *r6("tmax", "tmin", "precip", "srad", "tdew", "wind"))


@query("t_build_wide", ["stored"], f"SELECT u, child_id, parent_id, date, {r6_sql(*V8)}, is_preliminary, imputed FROM stored")
def _(spark, d):
    return P.stored(spark, d).select("u", "child_id", "parent_id", "date", *r6(*V8), "is_preliminary", "imputed")


@query("x_long_unpivot", ["stored"], "\nUNION ALL ".join(f"SELECT u, date, '{v}' AS variable, round({v}, 6) AS value FROM stored" for v in V8))
def _(spark, d):
    return daily.to_long(P.stored(spark, d), ["u", "date"]).select("u", "date", "variable", *r6("value"))


_REASON = "concat_ws(';', CASE WHEN tmax < tmin THEN 'tmax<tmin' END, CASE WHEN precip < 0 THEN 'precip<0' END, CASE WHEN srad < 0 THEN 'srad<0' END, CASE WHEN rh < 0 OR rh > 100 THEN 'rh_out_of_range' END, CASE WHEN et0 < 0 THEN 'et0<0' END)"
_SHIFTED = "shifted AS (SELECT * REPLACE (tmin + (u % 4) * 10.0::DOUBLE AS tmin, precip - (u % 3)::DOUBLE AS precip) FROM stored)"


def _shifted(spark, d):
    return P.stored(spark, d).withColumns({"tmin": F.col("tmin") + F.col("u") % 4 * 10.0, "precip": F.col("precip") - (F.col("u") % 3).cast("double")})


def _over_shifted(sql: str) -> str:
    return P.with_ctes(["stored"], "").rstrip() + ",\n" + _SHIFTED + "\n" + sql


def shifted_query(key: str, sql: str):
    def put(f):
        query(key, [], "")(f)
        ORACLES[key] = _over_shifted(sql)
        return f

    return put


@shifted_query("p_qa_split_good", f"SELECT u, date, {r6_sql('tmax', 'tmin', 'precip')} FROM shifted WHERE {_REASON} = ''")
def _(spark, d):
    return daily.split_valid(_shifted(spark, d))[0].select("u", "date", *r6("tmax", "tmin", "precip"))


@shifted_query("p_qa_failures", f"SELECT u, date, {_REASON} AS reason FROM shifted WHERE {_REASON} <> ''")
def _(spark, d):
    return daily.split_valid(_shifted(spark, d))[1].select("u", "date", "reason")


@shifted_query(
    "a_quality_summary",
    f"""SELECT s.u, count(*) AS days_present, count(*) FILTER (tmax IS NULL OR tmin IS NULL) AS null_temp, count(*) FILTER (srad IS NULL) AS null_srad, count(*) FILTER (precip IS NULL) AS null_rain,
  count(*) FILTER (is_preliminary) AS preliminary, count(*) FILTER (imputed <> 0) AS repaired, count(*) FILTER (tmax < tmin OR precip < 0 OR rh < 0 OR rh > 100 OR srad < 0) AS impossible, count(*) FILTER ({_REASON} <> '') AS quarantined FROM shifted s GROUP BY s.u""",
)
def _(spark, d):
    rows = _shifted(spark, d)
    return daily.quality_summary(rows, daily.split_valid(rows)[1], KEYS)


@query("a_calendar_report", ["stored"], "SELECT u, count(DISTINCT date) AS n_dates, 366::BIGINT AS expected, 366 - count(DISTINCT date) AS missing FROM stored GROUP BY u")
def _(spark, d):
    return daily.calendar_report(P.stored(spark, d), 2024, KEYS)


@query("j_missing_days", ["stored"], "SELECT u, day::DATE AS missing_date FROM (SELECT u, unnest(range(min(date)::TIMESTAMP, max(date)::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day FROM stored GROUP BY u) x WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.u = x.u AND s.date = x.day::DATE)")
def _(spark, d):
    return daily.missing_days(P.stored(spark, d), KEYS)


@query("a_restamp", ["stored"], "SELECT u, day::DATE AS date, round(tmax, 6) AS tmax FROM (SELECT DISTINCT u, unnest(range(TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-16', INTERVAL 1 DAY)) AS day FROM (SELECT DISTINCT u FROM stored)) x LEFT JOIN stored s ON s.u = x.u AND s.date = x.day::DATE".replace("SELECT u, day", "SELECT x.u AS u, day"))
def _(spark, d):
    return daily.restamp(P.stored(spark, d).select("u", "date", "tmax"), KEYS, "2024-01-05", "2024-01-15").select("u", "date", *r6("tmax"))


@query("a_monthly", ["stored"], "SELECT u, date_trunc('month', date)::DATE AS month, count(*) AS n_days, " + ", ".join(f"round(avg({c}), 6) AS {c}_mean" for c in ("tmax", "tmin", "srad", "wind", "rh")) + ", " + ", ".join(f"round(sum({c}), 6) AS {c}_sum" for c in ("precip", "et0")) + " FROM stored GROUP BY ALL")
def monthly(spark, d):
    rows = daily.monthly(P.stored(spark, d), KEYS)
    return rows.select("u", "month", "n_days", *r6(*[c for c in rows.columns if c.endswith(("_mean", "_sum"))]))


# series


@query("a_series_info", ["stored"], "SELECT u, min(date) AS first_date, max(date) AS last_date, count(*) AS n_days, count(*) FILTER (is_preliminary) AS n_prelim, count(*) FILTER (imputed <> 0) AS n_imputed, (max(date) - min(date) + 1)::BIGINT AS n_expected, (max(date) - min(date) + 1)::BIGINT - count(*) AS n_missing FROM stored GROUP BY u")
def _(spark, d):
    rows = P.stored(spark, d)
    return series.series_info(rows, rows.select("u").distinct(), KEYS)


#: A literal coordinate: the place of user 7.
LAT, LON = (7 * 37) % 1200 / 10.0 - 60.0, (7 * 91) % 3600 / 10.0 - 180.0


@query("t_point_series", ["stored"], f"SELECT date, {r6_sql(*V8)}, is_preliminary FROM stored WHERE child_id = '{grid.place(LAT, LON).child_id}' AND date BETWEEN DATE '2024-01-03' AND DATE '2024-01-25'")
def _(spark, d):
    return series.climate_series(P.stored(spark, d), LAT, LON, "2024-01-03", "2024-01-25").select("date", *r6(*V8), "is_preliminary")


@query("t_series_for_sites", ["stored", "sites"], f"SELECT s.key, t.date, round(t.tmax, 6) AS tmax FROM sites s LEFT JOIN stored t ON {P.child_sql('s.lat', 's.lon')} = t.child_id AND {P.parent_sql('s.lat', 's.lon')} = t.parent_id")
def _(spark, d):
    rows = P.stored(spark, d).select("parent_id", "child_id", "date", "tmax")
    return series.series_for_sites(rows, P.sites(spark, d)).select("key", "date", *r6("tmax"))


@query("t_fine_series", ["alt_rain"], "SELECT fine_id, date, source, precip FROM alt_rain WHERE source IN (2, 4) AND date >= DATE '1996-01-01'")
def _(spark, d):
    return series.fine_series(P.alt_rain(spark, d), None, ["chirps_v2", "chirps_v3_sat"], "1996-01-01").select("fine_id", "date", "source", "precip")


@query(
    "j_rain_weighted",
    ["alt_rain", "weights"],
    "SELECT child_id, date, source, round(sum(precip * weight) / sum(weight), 6) AS rain, round(sum(weight), 6) AS coverage, count(*) AS n_fine FROM alt_rain JOIN weights USING (fine_id) GROUP BY child_id, date, source",
)
def _(spark, d):
    alt = P.alt_rain(spark, d)
    weights = spatial.area_weights(alt.select("fine_id").distinct())
    return series.weighted_rain(alt, weights).select("child_id", "date", "source", *r6("rain", "coverage"), "n_fine")


@query("j_compare_sources", ["alt_rain"], "SELECT u, date_trunc('month', date)::DATE AS month, sum(precip) FILTER (source = 2) AS chirps_v2, sum(precip) FILTER (source = 3) AS chirps_v3_rnl, sum(precip) FILTER (source = 4) AS chirps_v3_sat FROM alt_rain GROUP BY ALL")
def _(spark, d):
    name = F.when(F.col("source") == 2, "chirps_v2").when(F.col("source") == 3, "chirps_v3_rnl").otherwise("chirps_v3_sat")
    return series.compare_rain(P.alt_rain(spark, d).withColumn("rain_source", name), KEYS, "month").select("u", "month", "chirps_v2", "chirps_v3_rnl", "chirps_v3_sat")


@query(
    "j_precip_compare",
    ["alt_rain", "weights", "cells"],
    "SELECT o.child_id, o.date, o.source, (c.u % 9)::DOUBLE AS own_precip, round(o.rain, 6) AS alt_precip, round(o.coverage, 6) AS coverage FROM (SELECT child_id, date, source, sum(precip * weight) / sum(weight) AS rain, sum(weight) AS coverage FROM alt_rain JOIN weights USING (fine_id) GROUP BY ALL) o JOIN (SELECT child_id, min(u) AS u FROM cells GROUP BY child_id) c USING (child_id)",
)
def _(spark, d):
    alt = P.alt_rain(spark, d)
    days = alt.select("date").distinct()
    own = P.cells(spark, d).groupBy("child_id").agg(F.min("u").alias("u"))
    weights = spatial.area_weights(alt.select("fine_id").distinct())
    near = weights.join(own, "child_id").join(alt.select("fine_id", "date").distinct(), "fine_id").select("child_id", "u", "date").distinct()
    stored = near.join(days, "date").select("child_id", "date", (F.col("u") % 9).cast("double").alias("precip"))
    return series.precip_compare(stored, alt, weights).select("child_id", "date", "source", "own_precip", *r6("alt_precip", "coverage"))


# station files

_LINES = P.with_ctes(["stored", "cells"], "").rstrip()
_TMEAN = "SELECT u, month(date) AS mon, avg((tmax + tmin) / 2.0::DOUBLE) AS tmean FROM stored WHERE date BETWEEN DATE '1991-01-01' AND DATE '2024-12-31' GROUP BY ALL"


@query("t_station_climatology", ["stored"], f"SELECT u, round(avg(tmean), 6) AS tav, round((max(tmean) - min(tmean)) / 2.0::DOUBLE, 6) AS amp, count(*)::INTEGER AS n_months FROM ({_TMEAN}) GROUP BY u")
def _(spark, d):
    return station.climatology(P.stored(spark, d), KEYS, 1991, 2024).select("u", *r6("tav", "amp"), "n_months")


def _by_user(spark, d):
    """The record with the user as cell, so that no two share one."""
    return P.stored(spark, d).withColumn("child_id", F.col("u").cast("string"))


@query(
    "t_station_body",
    ["stored"],
    "SELECT u::VARCHAR AS child_id, dayofyear(date)::INTEGER + 10 AS ord, strftime(date, '%y%j') || " + " || ".join(_F6(f"round({x}, 9)") for x in ("srad", "tmax", "tmin", "precip", "tdew")) + f" || {_F6('round(wind * 0.748::DOUBLE * 86.4::DOUBLE, 9)')} || '   -99' || {_F6('round(rh, 9)')} AS line FROM stored",
)
def _(spark, d):
    rows = _by_user(spark, d)
    return station.body_lines(station.body(rows.withColumns({c: F.round(c, 9) for c in ("srad", "tmax", "tmin", "precip", "tdew", "rh")})).withColumn("wind", F.round("wind", 9)))


@query(
    "t_station_header",
    ["stored", "cells"],
    f"""SELECT c.u::VARCHAR AS child_id, '  ' || c.u::VARCHAR || lpad(round(c.lat::DECIMAL(20,12), 3)::DECIMAL(20,3)::VARCHAR, 9, ' ') || lpad(round(c.lon::DECIMAL(20,12), 3)::DECIMAL(20,3)::VARCHAR, 9, ' ') || lpad(round(c.elevation::DECIMAL(20,12), 0)::DECIMAL(20,0)::VARCHAR, 6, ' ') || {_F6('round(k.tav, 9)')} || {_F6('round(k.amp, 9)')} || '   2.0   2.0' AS line
  FROM cells c LEFT JOIN (SELECT u, avg(tmean) AS tav, (max(tmean) - min(tmean)) / 2.0::DOUBLE AS amp FROM ({_TMEAN}) GROUP BY u) k USING (u)""",
)
def _(spark, d):
    cells = P.cells(spark, d).withColumn("child_id", F.col("u").cast("string"))
    climate = station.climatology(_by_user(spark, d), ["child_id"], 1991, 2024).withColumns({c: F.round(c, 9) for c in ("tav", "amp")})
    return station.header_lines(station.header(cells, climate), 2024).where("ord = 3").select("child_id", "line")


# storage

_OLD = "SELECT u, date, tmax, precip, imputed FROM stored WHERE date < DATE '2024-01-20'"
_NEW = "SELECT u, date, tmax + 1.0::DOUBLE AS tmax, CASE WHEN u % 5 <> 0 THEN precip + 1.0::DOUBLE END AS precip, 8 AS imputed FROM stored WHERE date >= DATE '2024-01-10'"


@query(
    "w_upsert_guarded",
    ["stored"],
    f"SELECT coalesce(o.u, n.u) AS u, coalesce(o.date, n.date) AS date, round(CASE WHEN n.u IS NULL OR (coalesce(o.imputed, 0) & 1) > 0 THEN o.tmax ELSE n.tmax END, 6) AS tmax, round(CASE WHEN n.u IS NULL OR (coalesce(o.imputed, 0) & 4) > 0 THEN o.precip ELSE n.precip END, 6) AS precip, (coalesce(o.imputed, 0) | coalesce(n.imputed, 0))::INTEGER AS imputed FROM ({_OLD}) o FULL JOIN ({_NEW}) n ON o.u = n.u AND o.date = n.date",
)
def _(spark, d):
    rows = P.stored(spark, d).select("u", "date", "tmax", "precip", "imputed")
    new = rows.where("date >= DATE'2024-01-10'").select("u", "date", (F.col("tmax") + 1.0).alias("tmax"), F.when(F.col("u") % 5 != 0, F.col("precip") + 1.0).alias("precip"), F.lit(8).alias("imputed"))
    return storage.upsert_guarded(rows.where("date < DATE'2024-01-20'"), new, ["u", "date"]).select("u", "date", *r6("tmax", "precip"), "imputed")


@query("w_upsert_plain", ["alt_rain"], "SELECT coalesce(o.u, n.u) AS u, coalesce(o.date, n.date) AS date, coalesce(o.source, n.source) AS source, CASE WHEN n.u IS NULL THEN o.precip ELSE n.precip END AS precip FROM (SELECT * FROM alt_rain WHERE date < DATE '1999-01-01') o FULL JOIN (SELECT u, date, source, precip * 2 AS precip FROM alt_rain WHERE date >= DATE '1997-01-01') n ON o.u = n.u AND o.date = n.date AND o.source = n.source")
def _(spark, d):
    rows = P.alt_rain(spark, d).select("u", "date", "source", "precip")
    return storage.upsert(rows.where("date < DATE'1999-01-01'"), rows.where("date >= DATE'1997-01-01'").withColumn("precip", F.col("precip") * 2), ["u", "date", "source"])


@query("w_update_column", ["stored"], "SELECT u, date, round(CASE WHEN u % 4 = 1 AND date >= DATE '2024-01-15' THEN 20.5::DOUBLE ELSE tmax END, 6) AS tmax, (CASE WHEN u % 4 = 1 AND date >= DATE '2024-01-15' THEN imputed | 1 ELSE imputed END)::INTEGER AS imputed FROM stored")
def _(spark, d):
    rows = P.stored(spark, d).select("u", "date", "tmax", "imputed")
    values = rows.where("u % 4 = 1 and date >= DATE'2024-01-15'").select("u", "date", F.lit(20.5).alias("value"))
    return storage.update_column(rows, values, "tmax", ["u", "date"]).select("u", "date", *r6("tmax"), "imputed")


@query("w_clear_bit", ["stored"], "SELECT u, date, (CASE WHEN date < DATE '2024-01-15' THEN imputed & 251 ELSE imputed END)::INTEGER AS imputed FROM stored")
def _(spark, d):
    rows = P.stored(spark, d).select("u", "date", "imputed")
    log = rows.where("imputed <> 0").select("u", "date", F.lit("precip").alias("variable"))
    return storage.clear_imputed(rows, log, rows.where("date < DATE'2024-01-15'"), "precip", ["u", "date"])[0]


@shifted_query("w_quarantine_window", f"SELECT u, date, 'old' AS reason FROM stored WHERE date < DATE '2024-01-10' UNION ALL SELECT u, date, {_REASON} AS reason FROM shifted WHERE {_REASON} <> '' AND date >= DATE '2024-01-10' AND u % 7 <> 0")
def _(spark, d):
    rows = _shifted(spark, d)
    old = rows.select("u", "date", F.lit("old").alias("reason"))
    new = daily.split_valid(rows)[1].where("date >= DATE'2024-01-10'").select("u", "date", "reason")
    return storage.replace_window(old, new, F.col("date") >= F.lit("2024-01-10").cast("date"), rows.where("imputed <> 0"), ["u", "date"])


@query("w_mark_valid", ["sites", "alt_rain"], f"SELECT key, {P.fine_sql('lat', 'lon')} AS fine_id, EXISTS (SELECT 1 FROM alt_rain a WHERE a.fine_id = {P.fine_sql('sites.lat', 'sites.lon')}) AS is_valid FROM sites")
def _(spark, d):
    cells = P.sites(spark, d).select("key", grid.fine_code("lat", "lon").alias("fine_id"), F.lit(None).cast("boolean").alias("is_valid"))
    return storage.mark_valid(cells, P.alt_rain(spark, d)).select("key", "fine_id", "is_valid")


# field checks

_FIELD = "field AS (SELECT 'tmax' AS variable, 'f' || (l_suppkey % 2)::VARCHAR AS file, 'c' AS chunk, date_trunc('month', l_shipdate)::DATE AS date, CASE month(l_shipdate) % 5 WHEN 0 THEN 300.0::DOUBLE WHEN 1 THEN 300.0::DOUBLE + l_quantity / 1e6::DOUBLE ELSE 273.15::DOUBLE + l_quantity END AS value FROM lineitem)"
_STATS = "stats AS (SELECT variable, file, chunk, date, count(DISTINCT value) AS n_distinct, stddev_pop(value) AS sd, count(value) AS n, min(value) AS low, max(value) AS high FROM field GROUP BY ALL)"


def _field(spark, d):
    lines = P.table(spark, d, "lineitem")
    day = F.month("l_shipdate") % 5
    value = F.when(day == 0, 300.0).when(day == 1, 300.0 + F.col("l_quantity") / 1e6).otherwise(273.15 + F.col("l_quantity"))
    return lines.select(F.lit("tmax").alias("variable"), F.concat(F.lit("f"), (F.col("l_suppkey") % 2).cast("string")).alias("file"), F.lit("c").alias("chunk"), F.trunc("l_shipdate", "month").alias("date"), value.alias("value"))


@query("a_field_by_date", [], f"WITH {_FIELD}, {_STATS} SELECT variable, file, date, n_distinct, round(sd, 4) AS stddev, n, low, high FROM stats")
def _(spark, d):
    return fieldqa.by_date(_field(spark, d)).select("variable", "file", "date", "n_distinct", F.round("stddev", 4).alias("stddev"), "n", "low", "high")


@query("a_constant_field", [], f"WITH {_FIELD}, {_STATS} SELECT file, date, n, low FROM stats WHERE n_distinct = 1 AND n >= 32")
def _(spark, d):
    return fieldqa.constant_fields(fieldqa.by_date(_field(spark, d))).select("file", "date", "n", "low")


@query("a_low_spread", [], f"WITH {_FIELD}, {_STATS}, med AS (SELECT file, quantile_cont(sd, 0.5) AS m FROM stats GROUP BY file) SELECT s.file, s.date, s.n FROM stats s JOIN med USING (file) WHERE m > 0 AND sd < 0.02::DOUBLE * m AND n_distinct > 1 AND n >= 32")
def _(spark, d):
    return fieldqa.low_spread_fields(fieldqa.by_date(_field(spark, d))).select("file", "date", "n")


@query("a_consolidate", [], f"WITH {_FIELD}, {_STATS} SELECT variable, date, 'constant_field' AS detector, sum(n)::BIGINT AS cells, round(min(low) - 273.15::DOUBLE, 6) AS min, round(max(high) - 273.15::DOUBLE, 6) AS max FROM stats WHERE n_distinct = 1 AND n >= 32 GROUP BY variable, date")
def _(spark, d):
    return fieldqa.consolidate(fieldqa.scan(_field(spark, d)).where("detector = 'constant_field'")).select("variable", "date", "detector", "cells", *r6("min", "max"))


# repair


@query("r_interpolate", ["stored"], "SELECT u::VARCHAR AS child_id, round(a + (b - a) * 0.5::DOUBLE, 6) AS value FROM (SELECT u, max(CASE WHEN date = DATE '2024-01-09' THEN tmax END) AS a, max(CASE WHEN date = DATE '2024-01-11' THEN tmax END) AS b FROM stored GROUP BY u) WHERE a IS NOT NULL AND b IS NOT NULL")
def _(spark, d):
    import datetime

    from gridclim.operators import repair

    history = _by_user(spark, d).select("child_id", "date", F.col("tmax").alias("value"))
    return repair.interpolate(history, datetime.date(2024, 1, 10))[0].select("child_id", *r6("value"))


@query("r_climatology", ["alt_rain"], "SELECT u::VARCHAR AS child_id, round(avg(precip), 6) AS value FROM alt_rain WHERE year(date) <> 1998 AND least(abs(dayofyear(date) - 2), 365 - abs(dayofyear(date) - 2)) <= 7 GROUP BY u")
def _(spark, d):
    import datetime

    from gridclim.operators import repair

    history = P.alt_rain(spark, d).select(F.col("u").cast("string").alias("child_id"), "date", F.col("precip").alias("value"))
    return repair.climatology(history, datetime.date(1998, 1, 2))[0].select("child_id", *r6("value"))


# spatial


@query("j_area_weights", ["weights"], "SELECT fine_id, child_id, round(weight, 6) AS weight FROM weights WHERE weight > 1e-9")
def _(spark, d):
    fine = P.table(spark, d, "supplier").select(*P.place_of("s_suppkey")).select(grid.fine_code("lat", "lon").alias("fine_id")).distinct()
    return spatial.area_weights(fine).select("fine_id", "child_id", *r6("weight"))


@query("a_coverage", ["weights"], "SELECT child_id, round(sum(weight), 6) AS covered, count(*) AS n_fine FROM weights WHERE weight > 1e-9 GROUP BY child_id")
def _(spark, d):
    fine = P.table(spark, d, "supplier").select(*P.place_of("s_suppkey")).select(grid.fine_code("lat", "lon").alias("fine_id")).distinct()
    return spatial.coverage_report(spatial.area_weights(fine)).select("child_id", *r6("covered"), "n_fine")


_PLANAR = "sqrt(pow(s.lat - g.c_lat, 2) + pow(least(abs(s.lon - g.c_lon), 360 - abs(s.lon - g.c_lon)), 2))"
_COARSE_OF = "SELECT DISTINCT child_id, 90.0::DOUBLE - k // 1440 * 0.25::DOUBLE AS c_lat, CASE WHEN k % 1440 * 0.25::DOUBLE > 180 THEN k % 1440 * 0.25::DOUBLE - 360 ELSE k % 1440 * 0.25::DOUBLE END AS c_lon FROM (SELECT child_id, " + f"{P.lat_sql('lat')} * 1440 + {P.lon_sql('lon')} AS k FROM soil)"


def _soil_cells(spark, d):
    soil = P.soil(spark, d)
    c = grid.code_center("child_id")
    return soil, soil.select("child_id").distinct().select("child_id", c["lat"].alias("lat"), c["lon"].alias("lon"))


@query("n_nearest_point", ["soil"], f"SELECT s.child_id, s.cell5m, round({_PLANAR}, 6) AS dist_deg, row_number() OVER (PARTITION BY s.child_id ORDER BY {_PLANAR}, cell5m) = 1 AS is_nearest FROM soil s JOIN ({_COARSE_OF}) g USING (child_id)")
def _(spark, d):
    soil, cells = _soil_cells(spark, d)
    return spatial.soil_bridge(soil, cells, "planar").select("child_id", "cell5m", *r6("dist_deg"), "is_nearest")


_SCALED = "sqrt(pow(s.lat - g.c_lat, 2) + pow(least(abs(s.lon - g.c_lon), 360 - abs(s.lon - g.c_lon)) * cos(radians(s.lat)), 2))"


@query("n_nearest_point_scaled", ["soil"], f"SELECT s.child_id, s.cell5m, round({_SCALED}, 6) AS dist_deg, row_number() OVER (PARTITION BY s.child_id ORDER BY {_SCALED}, cell5m) = 1 AS is_nearest FROM soil s JOIN ({_COARSE_OF}) g USING (child_id)")
def _(spark, d):
    soil, cells = _soil_cells(spark, d)
    return spatial.soil_bridge(soil, cells).select("child_id", "cell5m", *r6("dist_deg"), "is_nearest")


_KM = "asin(sqrt(least(1.0::DOUBLE, pow(sin(radians(p.lat - s.lat) / 2), 2) + cos(radians(s.lat)) * cos(radians(p.lat)) * pow(sin(radians(p.lon - s.lon) / 2), 2)))) * 2 * 6371.0088::DOUBLE"


@query("j_knn", ["sites", "soil"], f"SELECT key, cell5m, round(km, 6) AS dist_km FROM (SELECT s.key, p.cell5m, {_KM} AS km, row_number() OVER (PARTITION BY s.key ORDER BY {_KM}, p.cell5m) AS n FROM sites s JOIN soil p ON abs(s.lat - p.lat) < 0.5 AND {_KM} <= 40) WHERE n = 1")
def _(spark, d):
    return spatial.soil_nearest(P.sites(spark, d), P.soil(spark, d), 40.0).select("key", "cell5m", *r6("dist_km"))


@query("j_soil_exact", ["sites", "soil"], f"SELECT key, p.cell5m, p.soil_id FROM sites s LEFT JOIN soil p ON p.cell5m = {P.soil_sql('s.lat', 's.lon')}")
def _(spark, d):
    return spatial.soil_at(P.sites(spark, d), P.soil(spark, d)).select("key", "cell5m", "soil_id")


@query("j_soil_orphans", ["soil", "cells"], "SELECT cell5m FROM soil s WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE c.child_id = s.child_id AND c.is_land)")
def _(spark, d):
    return spatial.soil_orphans(P.soil(spark, d), P.cells(spark, d).where("is_land")).select("cell5m")


@query("p_bbox", ["cells"], "SELECT u FROM cells WHERE lat BETWEEN -30 AND 10 AND lon BETWEEN -80 AND 20 AND is_land")
def _(spark, d):
    return spatial.in_bbox(P.cells(spark, d), -30, -80, 10, 20, land=True).select("u")


_REGION_SHARE = "greatest(0.0::DOUBLE, least(c.lat + 0.125::DOUBLE, 40.2::DOUBLE) - greatest(c.lat - 0.125::DOUBLE, -39.9::DOUBLE)) * greatest(0.0::DOUBLE, least(c.lon + 0.125::DOUBLE, 60.1::DOUBLE) - greatest(c.lon - 0.125::DOUBLE, -70.3::DOUBLE)) / 0.0625::DOUBLE"


@query("a_region_weighted", ["stored", "cells"], f"SELECT s.date, round(sum(s.tmax * w.weight) / sum(w.weight) FILTER (s.tmax IS NOT NULL), 6) AS tmax, count(*) AS n_cells FROM stored s JOIN (SELECT u, {_REGION_SHARE} AS weight FROM cells c) w USING (u) WHERE w.weight > 1e-12 GROUP BY s.date")
def _(spark, d):
    inside = spatial.polygon_weights(P.cells(spark, d).select(F.col("u").cast("string").alias("child_id"), "lat", "lon"), "POLYGON((-70.3 -39.9, 60.1 -39.9, 60.1 40.2, -70.3 40.2, -70.3 -39.9))")
    return spatial.region_mean(_by_user(spark, d), inside, ["tmax"]).select("date", *r6("tmax"), "n_cells")


@query("a_land_fraction", ["sites"], f"SELECT to_base(floor((90.0::DOUBLE - lat) / 0.25::DOUBLE)::BIGINT * 1440 + floor({P.wrap_sql('lon')} / 0.25::DOUBLE)::BIGINT, 36, 4) AS child_id, round(avg((key % 3 = 0)::INTEGER::DOUBLE), 6) AS land_fraction, avg((key % 3 = 0)::INTEGER::DOUBLE) >= 0.5 AS is_land FROM sites GROUP BY ALL")
def _(spark, d):
    pixels = P.sites(spark, d).select("lat", "lon", (F.col("key") % 3 == 0).alias("is_land"))
    row, col = F.floor((90.0 - F.col("lat")) / 0.25).cast("long"), F.floor(grid.wrapped("lon") / 0.25).cast("long")
    cells = pixels.select(grid.coarse_code(row, col).alias("child_id")).distinct()
    return spatial.land_fraction(pixels, cells).select("child_id", *r6("land_fraction"), "is_land")


@query("t_coarse_grid", [], "SELECT k // 1440 // 103 AS band, count(*) AS n, min(to_base(k, 36, 4)) AS first, max(to_base(k, 36, 4)) AS last FROM (SELECT unnest(range(1038240)) AS k) GROUP BY ALL")
def _(spark, d):
    return gridbuild.coarse_grid(spark).groupBy(F.expr("row div 103").alias("band")).agg(F.count("*").alias("n"), F.min("child_id").alias("first"), F.max("child_id").alias("last"))


@query("a_land_parents", ["cells"], "SELECT parent_id, count(*) AS land_cells, count(DISTINCT t_zone) AS n_zones FROM cells WHERE is_land GROUP BY parent_id")
def _(spark, d):
    return gridbuild.land_parents(P.cells(spark, d)).select("parent_id", "land_cells", F.size("zones").cast("long").alias("n_zones"))


_CHUNK_ROW, _CHUNK_COL = f"({P.lat_sql('lat')} // 40)", f"(CASE WHEN {P.lon_sql('lon')} >= 720 THEN {P.lon_sql('lon')} - 1440 ELSE {P.lon_sql('lon')} END)"


@query("a_chunk_stats", ["cells"], f"SELECT printf('s10r%03dc%+04d', r, c) AS chunk_id, count(*) AS land_cells, count(DISTINCT parent_id) AS n_land_parents, count(DISTINCT t_zone) AS n_zones FROM (SELECT *, {_CHUNK_ROW} AS r, floor({_CHUNK_COL} / 40.0)::BIGINT AS c FROM cells WHERE is_land) GROUP BY r, c")
def _(spark, d):
    cells = P.cells(spark, d)
    chunks = gridbuild.tile_extent(spark, -90, -180, 90, 179.99, 10)
    return gridbuild.chunk_land_stats(chunks, gridbuild.land_parents(cells)).where("land_cells > 0").select("chunk_id", "land_cells", "n_land_parents", "n_zones")


# runs


@query(
    "n_gap_sessions",
    ["runs"],
    """SELECT "group", run, sum(brk) OVER (PARTITION BY "group" ORDER BY started, finished, parallel, run ROWS UNBOUNDED PRECEDING)::BIGINT AS batch FROM (
  SELECT *, CASE WHEN before IS NULL OR started > before + 180 THEN 1 ELSE 0 END AS brk FROM (
    SELECT *, max(finished) OVER (PARTITION BY "group", stretch ORDER BY started, finished, parallel, run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM (
      SELECT *, sum(turn) OVER (PARTITION BY "group" ORDER BY started, finished, parallel, run ROWS UNBOUNDED PRECEDING) AS stretch FROM (
        SELECT *, coalesce((lag(parallel) OVER (PARTITION BY "group" ORDER BY started, finished, parallel, run) <> parallel)::INTEGER, 0) AS turn FROM runs))))""",
)
def _(spark, d):
    return runs.batches(P.runs(spark, d), ["group"]).select("group", "run", "batch")


@query("a_run_summary", ["runs"], 'SELECT "group", count(*) AS n, count(*) FILTER (error IS NULL) AS n_ok, max(attempts) AS attempts, round(quantile_cont(seconds, 0.5) FILTER (error IS NULL), 1) AS seconds_median, round(quantile_cont(cost, 0.5) FILTER (error IS NULL), 4) AS cost_median FROM runs GROUP BY "group"')
def _(spark, d):
    return runs.summarize(P.runs(spark, d), ["group"]).select("group", "n", "n_ok", "attempts", "seconds_median", "cost_median")


@query("a_ols_fit", ["runs"], 'SELECT "group", count(*) AS n, round(regr_intercept(cost, cells::DOUBLE), 6) AS fixed, round(regr_slope(cost, cells::DOUBLE), 8) AS per_cell, round(regr_r2(cost, cells::DOUBLE), 6) AS r2 FROM runs WHERE error IS NULL AND cost <> 0 GROUP BY "group" HAVING count(*) >= 3')
def _(spark, d):
    return runs.fit_per_task(P.runs(spark, d), "cost", ["group"]).select("group", "n", *r6("fixed"), F.round("per_cell", 8).alias("per_cell"), *r6("r2"))


@query("a_run_ratios", ["runs"], "SELECT run, round(cost * 1000 / cells, 6) AS cost_per_1000_cells, round(CASE WHEN seconds <> 0 THEN cells / seconds END, 6) AS cells_per_second FROM runs")
def _(spark, d):
    return runs.ratios(P.runs(spark, d)).select("run", *r6("cost_per_1000_cells", "cells_per_second"))


@query("a_rollup_done", ["runs"], 'SELECT "group", bool_and(error IS NULL) AS complete, count(*) FILTER (error IS NOT NULL) AS open FROM runs GROUP BY "group"')
def _(spark, d):
    return runs.rollup(P.runs(spark, d).withColumn("done", F.col("error").isNull()), ["group"])


def load_more() -> None:
    """Registers the queries of the other modules."""
    from gridclim.oracle import context, more  # noqa: F401

    more.complete(ORACLES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub-daily observations to local days, wide, derived, monthly."""
    return monthly(configure(spark), sf_dir)
