"""Column expressions of meteorology, soil, geometry and time. Nulls give null."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Physical constants and the parameters of the published formulas.
EPSILON = 2.871 / 4.61
FREEZING = 273.15
FT3_TO_M3 = 0.0283168466
DAYS_PER_YEAR = 365.25
EARTH_KM = 111.0


def cleaned(value: Column, sentinels=(-999.0, -9999.0)) -> Column:
    """NaN and sentinels to null."""
    v = F.when(F.isnan(value), None).otherwise(value)
    return F.when(v.isin(*[float(s) for s in sentinels]), None).otherwise(v)


def water_year(day: Column) -> Column:
    return F.year(day) + (F.month(day) >= 10).cast("int")


def season(month: Column) -> Column:
    return F.when(month.isin(12, 1, 2), "djf").when(month.isin(3, 4, 5), "mam").when(month.isin(6, 7, 8), "jja").otherwise("son")


def vapor_pressure(p: Column, q: Column, approximate: bool = False) -> Column:
    """From pressure and specific humidity."""
    return q * p / F.lit(EPSILON) if approximate else -q * p / (q * F.lit(EPSILON) - q - F.lit(EPSILON))


def saturation_pressure(t: Column) -> Column:
    """Over water above freezing, over ice below, in Pa for K."""
    c = t - F.lit(FREEZING)
    return F.when(t > FREEZING, 611.2 * F.exp(17.62 * c / (243.12 + c))).otherwise(611.2 * F.exp(22.46 * c / (272.62 + c)))


def relative_humidity(t: Column, e: Column) -> Column:
    return F.greatest(F.least(F.try_divide(e, saturation_pressure(t)), F.lit(1.0)), F.lit(0.0))


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def wind_direction(u: Column, v: Column) -> Column:
    """Where the wind comes from, in degrees from north."""
    return F.pmod(F.lit(180.0) + F.degrees(F.atan2(u, v)), F.lit(360.0))


def reflected_shortwave(down: Column, net: Column) -> Column:
    return down - net


def net_radiation(sw_down: Column, sw_up: Column, lw_down: Column, lw_up: Column) -> Column:
    return sw_down - sw_up + lw_down - lw_up


def penman_monteith(t: Column, p: Column, u10: Column, e: Column, sw: Column, lw: Column, lw_sign: int = 1, mass_flux: bool = False) -> Column:
    """Hourly reference evapotranspiration in mm/h (or kg m-2 s-1): albedo 0.23, emissivity 0.95, wind at 10 m brought
    to 2 m. lw_sign 1 subtracts the long-wave balance, -1 adds it."""
    c, kpa = t - F.lit(FREEZING), p / 1000.0
    u2 = u10 * F.lit(4.87 / math.log(67.8 * 10 - 5.42))
    es = 0.6108 * F.exp(17.27 * c / (c + 237.3))
    slope = 4098.0 * es / ((c + 237.3) * (c + 237.3))
    gamma = 0.000665 * kpa
    lw_up = F.lit(0.95 * 5.670374419e-8) * t * t * t * t
    rn = ((1 - 0.23) * sw - F.lit(float(lw_sign)) * (lw - lw_up)) * 0.0036
    pet = (0.408 * slope * rn + gamma * (37.0 / t) * u2 * (es - e / 1000.0)) / (slope + gamma * (1 + 0.34 * u2))
    return pet / 3600.0 if mass_flux else pet


def priestley_taylor(t: Column, srad: Column, lat: Column, doy: Column, elevation: Column, a: float = 1.26) -> Column:
    """Daily evapotranspiration in mm, never negative. The sunset angle is clamped; the ratio of solar radiation to its
    clear-sky value is 0 where the latter is not positive."""
    rad = F.radians(lat)
    dist = 1 + 0.033 * F.cos(2 * math.pi / 365 * doy)
    decl = 0.409 * F.sin(2 * math.pi / 365 * doy - 1.39)
    angle = F.acos(F.least(F.greatest(-F.tan(rad) * F.tan(decl), F.lit(-1.0)), F.lit(1.0)))
    ra = 24 * 60 / math.pi * 0.082 * dist * (angle * F.sin(rad) * F.sin(decl) + F.cos(rad) * F.cos(decl) * F.sin(angle))
    clear = (0.75 + 2e-5 * elevation) * ra
    ratio = F.when(clear > 0, F.least(srad / clear, F.lit(1.0))).otherwise(0.0)
    es = 0.6108 * F.exp(17.27 * t / (t + 237.3))
    lw = 4.903e-9 * F.pow(t + 273.16, F.lit(4.0)) * (0.34 - 0.14 * F.sqrt(es)) * (1.35 * ratio - 0.35)
    slope = 4098.0 * es / ((t + 237.3) * (t + 237.3))
    gamma = 0.000665 * 101.3 * F.pow((293 - 0.0065 * elevation) / 293, F.lit(5.26))
    return F.greatest(a * slope / (slope + gamma) * (0.77 * srad - lw) / 2.45, F.lit(0.0))


def oudin(t: Column, ra: Column, days: Column) -> Column:
    """Monthly evapotranspiration in mm from the mean temperature (C) and extraterrestrial radiation (MJ m-2 d-1)."""
    return F.when(t + 5 > 0, ra / 2.45 * (t + 5) / 100 * days).otherwise(0.0)


def porosity(sand: Column, clay: Column) -> Column:
    """From sand and clay in per mille."""
    return (50.5 - 0.142 * (sand / 10) - 0.037 * (clay / 10)) / 100


def conductivity(sand: Column, clay: Column) -> Column:
    """Saturated conductivity in cm/h from sand and clay in per mille."""
    return 2.54 * F.pow(F.lit(10.0), -0.6 + 0.0126 * (sand / 10) - 0.0064 * (clay / 10))


def km_to_degrees(km: Column, lat: Column) -> tuple[Column, Column]:
    """(degrees of latitude, degrees of longitude)."""
    return km / EARTH_KM, km / (F.lit(EARTH_KM) * F.cos(F.radians(lat)))


def cubic_metres(cubic_feet: Column) -> Column:
    """Flow in m3/s from ft3/s."""
    return cubic_feet * FT3_TO_M3


def flow_depth(flow: Column, area_km2: Column) -> Column:
    """Flow in mm/d over a basin from m3/s."""
    return flow * 86400 / (area_km2 * 1e6) * 1000


def flux_depth(flux: Column, seconds: Column) -> Column:
    """Water in mm that a mass flux (kg m-2 s-1) brings in a period."""
    return flux * seconds / 1000 * 1000


def seconds_in(period: str, day: Column) -> Column:
    """Seconds of the hour, day, month or (mean) year that a date lies in."""
    of = {"hour": F.lit(3600.0), "day": F.lit(86400.0), "month": F.dayofmonth(F.last_day(day)) * 86400.0, "year": F.lit(DAYS_PER_YEAR * 86400.0)}
    return of[period]


def circular_mean(angle: Column, high: float = 360.0, low: float = 0.0) -> Column:
    """Aggregate: mean direction in [low, high)."""
    x = (angle - low) * F.lit(2 * math.pi / (high - low))
    return F.pmod(F.atan2(F.avg(F.sin(x)), F.avg(F.cos(x))) * F.lit((high - low) / (2 * math.pi)), F.lit(high - low)) + low


def circular_std(angle: Column, high: float = 360.0, low: float = 0.0) -> Column:
    """Aggregate: circular standard deviation in the angle's unit."""
    x = (angle - low) * F.lit(2 * math.pi / (high - low))
    r = F.least(F.sqrt(F.pow(F.avg(F.sin(x)), 2.0) + F.pow(F.avg(F.cos(x)), 2.0)), F.lit(1.0))
    return F.sqrt(-2 * F.ln(r)) * F.lit((high - low) / (2 * math.pi))


def albers(lon: Column, lat: Column) -> tuple[Column, Column]:
    """x and y in metres: equal-area conic of North America (parallels 20 and 60, origin 40 N 96 W), GRS80."""
    a, e2 = 6378137.0, 0.00669438002290
    e = math.sqrt(e2)

    def q(s):
        one = math.sin if isinstance(s, float) else F.sin
        x = one(s)
        ln = math.log if isinstance(s, float) else F.ln
        return (1 - e2) * (x / (1 - e2 * x * x) - 1 / (2 * e) * ln((1 - e * x) / (1 + e * x)))

    m = lambda s: math.cos(s) / math.sqrt(1 - e2 * math.sin(s) ** 2)
    p1, p2, p0 = (math.radians(x) for x in (20.0, 60.0, 40.0))
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
    c = m(p1) ** 2 + n * q(p1)
    rho0 = a / n * math.sqrt(c - n * q(p0))
    rho = F.lit(a / n) * F.sqrt(F.lit(c) - n * q(F.radians(lat)))
    theta = n * F.radians(lon + 96.0)
    return rho * F.sin(theta), F.lit(rho0) - rho * F.cos(theta)


def mapped(value: Column, table: dict[str, str]) -> Column:
    """Look up a code in a small dictionary; null where it isn't there."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), value)


# Offsets from UTC in hours of the standard time zones.
UTC_OFFSETS = {"NST": "-3.5", "AST": "-4", "EST": "-5", "CST": "-6", "MST": "-7", "PST": "-8", "AKST": "-9", "HST": "-10"}


def from_file_name(path: Column) -> tuple[Column, Column]:
    """(basin id, period) in names such as .../CAN_01AD002_2001-03.nc: the country and station, and year or year-month."""
    return F.regexp_extract(path, r"((?:CAN|USA|MEX)_[0-9A-Z]+)", 1), F.regexp_extract(path, r"_([0-9]{4}(?:-[0-9]{2})?)\.[a-z0-9]+$", 1)
