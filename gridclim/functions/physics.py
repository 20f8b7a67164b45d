"""Units, humidity and FAO-56 reference evapotranspiration. A null input gives null; NaN counts as null."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: FAO-56 constants, tolerances and unit factors
SOLAR_CONSTANT, STEFAN_BOLTZMANN, ALBEDO, WIND_TO_2M, GRAVITY = 0.0820, 4.903e-9, 0.23, 0.748, 9.80665
ET0_TOLERANCE, NOISE_TOLERANCE = 0.1, 0.01
UNITS = {"tmax": (1.0, -273.15), "tmin": (1.0, -273.15), "tdew": (1.0, -273.15), "precip": (1000.0, 0.0), "srad": (1e-6, 0.0), "wind_u": (1.0, 0.0), "wind_v": (1.0, 0.0)}


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def known(x) -> Column:
    """NaN as null: comparisons with NaN would otherwise count it as the greatest number."""
    return F.nanvl(_col(x).cast("double"), F.lit(None).cast("double"))


def clamp(x: Column, low: float, high: float) -> Column:
    """Within bounds; null stays null, which greatest and least alone would not keep."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def convert(variable: str, value) -> Column:
    """Native to stored units."""
    factor, offset = UNITS[variable]
    value = known(value)
    return value / 1e6 if variable == "srad" else value * factor if offset == 0 and factor != 1 else value + offset if offset else value


def convert_by(variable, value) -> Column:
    """convert with the variable in a column; an unknown one gives null."""
    variable, out = _col(variable), F.lit(None).cast("double")
    for name in reversed(UNITS):
        out = F.when(variable == name, convert(name, value)).otherwise(out)
    return out


def saturation_pressure(t) -> Column:
    t = _col(t)
    return 0.6108 * F.exp(17.27 * t / (t + 237.3))


def relative_humidity(tmax, tmin, tdew) -> Column:
    mean = (_col(tmax) + _col(tmin)) / 2.0
    return clamp(100.0 * saturation_pressure(tdew) / saturation_pressure(mean), 0.0, 100.0)


def pressure(elevation) -> Column:
    return 101.3 * F.pow((293.0 - 0.0065 * _col(elevation)) / 293.0, F.lit(5.26))


def gamma(p) -> Column:
    return 0.000665 * _col(p)


def slope(t) -> Column:
    t = _col(t)
    return 4098.0 * saturation_pressure(t) / F.pow(t + 237.3, F.lit(2.0))


def extraterrestrial_radiation(lat, doy) -> Column:
    phi, year = F.radians(_col(lat)), 2.0 * math.pi * _col(doy) / 365.0
    distance, decl = 1.0 + 0.033 * F.cos(year), 0.409 * F.sin(year - 1.39)
    sunset = F.acos(clamp(-F.tan(phi) * F.tan(decl), -1.0, 1.0))
    return 24.0 * 60.0 / math.pi * SOLAR_CONSTANT * distance * (sunset * F.sin(phi) * F.sin(decl) + F.cos(phi) * F.cos(decl) * F.sin(sunset))


def clear_sky_radiation(ra, elevation) -> Column:
    return (0.75 + 2e-5 * _col(elevation)) * _col(ra)


def net_shortwave(rs) -> Column:
    return (1.0 - ALBEDO) * _col(rs)


def sky_ratio(rs, rso) -> Column:
    """rs / rso within 0..1; without any clear-sky radiation 1 for positive rs, 0 for negative, null for none."""
    rs, rso = _col(rs), _col(rso)
    none = F.when(rs > 0, 1.0).when(rs < 0, 0.0)
    return F.when(rso == 0, none).otherwise(clamp(F.try_divide(rs, rso), 0.0, 1.0))


def net_longwave(tmax, tmin, ea, rs, rso) -> Column:
    fourth = lambda t: F.pow(_col(t) + 273.16, F.lit(4.0))
    ea = _col(ea)
    vapour = F.when(ea.isNotNull(), 0.34 - 0.14 * F.sqrt(F.greatest(ea, F.lit(0.0))))
    return STEFAN_BOLTZMANN * ((fourth(tmax) + fourth(tmin)) / 2.0) * vapour * (1.35 * sky_ratio(rs, rso) - 0.35)


def net_radiation(tmax, tmin, srad, ea, lat, doy, elevation) -> Column:
    rso = clear_sky_radiation(extraterrestrial_radiation(lat, doy), elevation)
    return net_shortwave(srad) - net_longwave(tmax, tmin, ea, srad, rso)


def wind_2m(wind) -> Column:
    return _col(wind) * WIND_TO_2M


def snap_negative_et0(x) -> Column:
    x = _col(x)
    return F.when((x < 0) & (x >= -ET0_TOLERANCE), 0.0).otherwise(x)


def snap_noise(x, closed: bool = True) -> Column:
    """Accumulations a hair below zero become zero; the bound itself belongs to it on the coarse grid only."""
    x = _col(x)
    return F.when((x < 0) & ((x >= -NOISE_TOLERANCE) if closed else (x > -NOISE_TOLERANCE)), 0.0).otherwise(x)


def et0(tmax, tmin, srad, wind, tdew, elevation, lat, doy) -> Column:
    tmax, tmin = _col(tmax), _col(tmin)
    mean, ea, u2, g = (tmax + tmin) / 2.0, saturation_pressure(tdew), wind_2m(wind), gamma(pressure(elevation))
    deficit = (saturation_pressure(tmax) + saturation_pressure(tmin)) / 2.0 - ea
    d = slope(mean)
    rn = net_radiation(tmax, tmin, srad, ea, lat, doy, elevation)
    return snap_negative_et0((0.408 * d * rn + g * (900.0 / (mean + 273.0)) * u2 * deficit) / (d + g * (1.0 + 0.34 * u2)))


def wind_speed(u, v) -> Column:
    u, v = _col(u), _col(v)
    return F.sqrt(u * u + v * v)


def elevation(geopotential) -> Column:
    return _col(geopotential) / GRAVITY


def wind_km_day(wind) -> Column:
    return _col(wind) * 0.748 * 86.4
