"""The scalar functions as temporary SQL functions; they inline into plans, so Catalyst sees through them."""

from __future__ import annotations

from pyspark.sql import SparkSession

_WRAPPED = "pmod(lon, 360D)"
_ROW, _COL = "cast(rint((90D - lat) / 0.25D) as bigint)", f"cast(rint({_WRAPPED} / 0.25D) as bigint)"
_FINE_ROW = "greatest(0, least(2399, floor((60D - lat) * 20 + 1e-9D)))"
_FINE_COL = f"greatest(0, least(7199, floor({_WRAPPED} * 20 + 1e-9D)))"
_ONE_DIGIT = "cast(cast(round(cast(coalesce(x, -99D) as decimal(20,12)), 1) as decimal(20,1)) as string)"
FUNCTIONS = {
    "base36(n bigint, width int) returns string": "if(n >= 0 and n < pow(36, width), lpad(conv(cast(n as string), 10, 36), width, '0'), raise_error('not a base-36 number of this width'))",
    "base36_decode(code string) returns bigint": "if(code rlike '^[0-9A-Z]+$', cast(conv(code, 36, 10) as bigint), raise_error('not a base-36 code'))",
    "cell_code(lat double, lon double) returns string": f"lpad(conv(cast({_ROW} * 1440 + {_COL} as string), 10, 36), 4, '0')",
    "parent_code(lat double, lon double) returns string": f"lpad(conv(cast(({_ROW} div 4) * 360 + ({_COL} div 4) as string), 10, 36), 4, '0')",
    "fine_code(lat double, lon double) returns string": f"lpad(conv(cast({_FINE_ROW} * 7200 + {_FINE_COL} as string), 10, 36), 5, '0')",
    "parent_of(code string) returns string": "lpad(conv(cast((cast(conv(code, 36, 10) as bigint) div 1440 div 4) * 360 + (cast(conv(code, 36, 10) as bigint) % 1440 div 4) as string), 10, 36), 4, '0')",
    "fine_parent_code(lat double, lon double) returns string": f"lpad(conv(cast(({_FINE_ROW} div 20) * 360 + ({_FINE_COL} div 20) as string), 10, 36), 5, '0')",
    "soil_cell(lat double, lon double) returns bigint": "greatest(0, least(2159, floor((90D - lat) * 12))) * 4320 + floor(pmod(lon + 180D, 360D) * 12) % 4320",
    "fine_parent_of(code string) returns string": "lpad(conv(cast((cast(conv(code, 36, 10) as bigint) div 7200 div 20) * 360 + (cast(conv(code, 36, 10) as bigint) % 7200 div 20) as string), 10, 36), 5, '0')",
    "round_half_even(x double) returns double": "rint(x)",
    "lat_index(lat double) returns bigint": _ROW,
    "lon_index(lon double) returns bigint": _COL,
    "fine_lat_index(lat double) returns bigint": _FINE_ROW,
    "fine_lon_index(lon double) returns bigint": _FINE_COL,
    "cell_center_lat(lat double) returns double": f"90D - {_ROW} * 0.25D",
    "cell_center_lon(lon double) returns double": f"if({_COL} * 0.25D > 180, {_COL} * 0.25D - 360, {_COL} * 0.25D)",
    "soil_center_lat(cell bigint) returns double": "90D - (floor(cell / 4320) + 0.5D) / 12",
    "soil_center_lon(cell bigint) returns double": "(cell % 4320 + 0.5D) / 12 - 180D",
    "station_date(day date) returns string": "date_format(day, 'yyDDD')",
    "station_filename(child string, year int) returns string": "concat(child, cast(year as string), '.WTH')",
    "rain_code(name string) returns int": "case lower(coalesce(name, 'era5')) when 'era5' then null when 'chirps_v2' then 2 when 'chirps_v3_rnl' then 3 when 'chirps_v3_sat' then 4 else raise_error(concat('unknown rain source ', name)) end",
    "is_imputed(mask int, bit int) returns boolean": "(coalesce(mask, 0) & bit) > 0",
    "snap_extent(x double) returns double": "rint(x / 0.25D) * 0.25D",
    "relative_humidity(tmax double, tmin double, tdew double) returns double": "greatest(0D, least(100D, 100D * (0.6108D * exp(17.27D * tdew / (tdew + 237.3D))) / (0.6108D * exp(17.27D * ((tmax + tmin) / 2D) / ((tmax + tmin) / 2D + 237.3D)))))",
    "saturation_pressure(t double) returns double": "0.6108D * exp(17.27D * t / (t + 237.3D))",
    "wind_km_day(wind double) returns double": "wind * 0.748D * 86.4D",
    "station_number(x double) returns string": f"if(length({_ONE_DIGIT}) > 6, raise_error(concat('does not fit six characters: ', {_ONE_DIGIT})), lpad({_ONE_DIGIT}, 6, ' '))",
}


def register(spark: SparkSession) -> None:
    for signature, body in FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {signature} return {body}")


#: Table functions over a record's view: series, months, extent and gaps of the cell at a coordinate. Bounds may be left out.
_CELL = "parent_id = parent_code(climate_{0}.lat, climate_{0}.lon) and child_id = cell_code(climate_{0}.lat, climate_{0}.lon)"
_BOUNDS = "(climate_{0}.first is null or date >= climate_{0}.first) and (climate_{0}.last is null or date <= climate_{0}.last)"
_ARGUMENTS = "lat double, lon double, first date default null, last date default null"
TABLES = {
    "series": ("date date, tmax double, tmin double, precip double, srad double, wind double, tdew double, rh double, et0 double, is_preliminary boolean", "select date, tmax, tmin, precip, srad, wind, tdew, rh, et0, is_preliminary from {view} where {cell} and {bounds}"),
    "monthly": ("month date, n_days bigint, tmax_mean double, tmin_mean double, precip_sum double, et0_sum double", "select trunc(date, 'month'), count(*), avg(tmax), avg(tmin), sum(precip), sum(et0) from {view} where {cell} and {bounds} group by 1"),
    "info": ("first_date date, last_date date, n_days bigint, n_expected bigint", "select min(date), max(date), count(*), cast(datediff(max(date), min(date)) + 1 as bigint) from {view} where {cell} and {bounds} having count(*) > 0"),
    "long": ("date date, variable string, value double", "select date, v.variable, v.value from {view} lateral view stack(8, 'tmax', tmax, 'tmin', tmin, 'precip', precip, 'srad', srad, 'wind', wind, 'tdew', tdew, 'rh', rh, 'et0', et0) v as variable, value where {cell} and {bounds}"),
    "station_body": ("ord int, line string", "select dayofyear(date) + 10, concat(station_date(date), station_number(srad), station_number(tmax), station_number(tmin), station_number(precip), station_number(tdew), station_number(wind_km_day(wind)), '   -99', station_number(rh)) from {view} where {cell} and {bounds}"),
    "missing": ("missing_date date", "select explode(days) from (select array_except(sequence(min(date), max(date)), collect_set(date)) as days from {view} where {cell} and {bounds})"),
}


def register_tables(spark: SparkSession, view: str) -> None:
    """Table functions climate_series, _long, _monthly, _info, _missing and _station_body over a view of the record; where it has the partition column
    bucket, only the coordinate's partition is read."""
    register(spark)
    stored = " and bucket = substring(parent_code(climate_{0}.lat, climate_{0}.lon), 1, 3)" if "bucket" in spark.table(view).columns else ""
    for name, (columns, body) in TABLES.items():
        query = body.format(view=view, cell=(_CELL + stored).format(name), bounds=_BOUNDS.format(name))
        spark.sql(f"create or replace temporary function climate_{name}({_ARGUMENTS}) returns table ({columns}) return {query}")
