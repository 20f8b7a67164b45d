"""Fixed-width text, dates, offsets, rain-source names, provenance bits and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: provenance bits, rain-source codes and the station file's constant lines
IMPUTED_BITS = {"tmax": 1, "tmin": 2, "precip": 4, "srad": 8, "wind": 16, "tdew": 32, "rh": 64, "et0": 128}
VARIABLES = list(IMPUTED_BITS)
RAIN_SOURCES = {"chirps_v2": 2, "chirps_v3_rnl": 3, "chirps_v3_sat": 4}
STATION_LINE = "@ INSI      LAT     LONG  ELEV   TAV   AMP REFHT WNDHT"
BODY_LINE = "@DATE  SRAD  TMAX  TMIN  RAIN  DEWP  WIND   PAR  RHUM"
MISSING = -99


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def padded(text: Column, width: int) -> Column:
    """Right-aligned; an error where the text is wider."""
    return F.when(F.length(text) > width, F.raise_error(F.lit(f"wider than {width} characters")).cast("string")).otherwise(F.lpad(text, width, " "))


def decimals(x, places: int) -> Column:
    """Decimal text rounded half away from zero, as decimal and not as binary fraction."""
    return F.round(_col(x).cast("decimal(20,12)"), places).cast(f"decimal(20,{places})").cast("string")


def f6(x) -> Column:
    """A station file's number: one decimal, width 6, -99.0 where missing."""
    return padded(decimals(F.coalesce(_col(x).cast("double"), F.lit(float(MISSING))), 1), 6)


def station_date(d) -> Column:
    return F.date_format(_col(d), "yyDDD")


def station_filename(child, year) -> Column:
    return F.concat(_col(child), _col(year).cast("string"), F.lit(".WTH"))


def rain_source(name: str | None) -> int | None:
    """Code of a rain source by name, any case; none for the record's own rain."""
    if name is None or name.lower() == "era5":
        return None
    if name.lower() not in RAIN_SOURCES:
        raise ValueError(f"unknown rain source {name!r}; known: era5, {', '.join(RAIN_SOURCES)}")
    return RAIN_SOURCES[name.lower()]


def preliminary_cutoff(run, months: int = 3) -> Column:
    return F.add_months(_col(run), -months)


def is_preliminary(date, cutoff) -> Column:
    return _col(date) >= _col(cutoff)


def doy_distance(a, b) -> Column:
    d = F.abs(_col(a) - _col(b))
    return F.when(d.isNotNull(), F.least(d, 365 - d))


def offset_minutes_by_longitude(lon) -> Column:
    return (F.rint(_col(lon) / 15.0) * 60).cast("int")


def offset_hours(text) -> Column:
    """UTC+HH:MM as hours; an error for other text."""
    text, form = _col(text), r"^UTC([+-])(\d{2}):(\d{2})$"
    part = lambda k: F.regexp_extract(text, form, k)
    sign = F.when(part(1) == "-", -1.0).otherwise(1.0)
    hours = F.when(text.rlike(form), sign * (part(2).try_cast("double") + part(3).try_cast("double") / 60.0))
    return F.when(text.isNotNull() & hours.isNull(), F.raise_error(F.lit("not an offset like UTC-03:00")).cast("double")).otherwise(hours)


def local_date(ts, minutes) -> Column:
    """Date of a UTC time at an offset of so many minutes."""
    return F.to_date(_col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), _col(minutes)))


def imputed(mask, variable: str) -> Column:
    return _col(mask).cast("int").bitwiseAND(IMPUTED_BITS[variable]) > 0


def with_bit(mask, variable: str) -> Column:
    return _col(mask).cast("int").bitwiseOR(IMPUTED_BITS[variable])


def without_bit(mask, variable: str) -> Column:
    return _col(mask).cast("int").bitwiseAND(0xFF ^ IMPUTED_BITS[variable])


def chunk_of_path(path) -> Column:
    """The chunk in <variable>_<year>__<chunk>.parquet; empty where there is none."""
    return F.regexp_extract(_col(path), r"__([^/]+?)\.parquet$", 1)


def constant_value(detail) -> Column:
    """The value of a constant field from a finding's JSON: its min where that is also its max."""
    low, high = (F.get_json_object(_col(detail), f"$.{k}").try_cast("double") for k in ("min", "max"))
    return F.when(low == high, low)
