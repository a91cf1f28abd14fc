"""Scalar functions as Column expressions: longitudes, units, vapour, melt, normal distribution, texts."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

KELVIN = 273.15
SECONDS_PER_DAY = 86400
GRAVITY = 9.80665


def d(x: float) -> Column:
    return F.lit(float(x))


def let(value: Column, use) -> Column:
    """An expression that uses a value several times and computes it once."""
    return F.transform(F.array(value), use)[0]


def lon_to_180(lon: Column) -> Column:
    """Longitudes from 0 to 360 as -180 to 180; 180 itself becomes -180."""
    return F.when(lon < 180, lon).otherwise(lon - 360)


def flux_to_mm_day(x: Column) -> Column:
    return x * d(SECONDS_PER_DAY)


def accumulated_metres_to_flux(x: Column) -> Column:
    return x / d(SECONDS_PER_DAY) * d(1000)


def kelvin_to_celsius(x: Column) -> Column:
    return x - d(KELVIN)


def geopotential_to_height(x: Column) -> Column:
    return x / d(GRAVITY)


def clip(x: Column, low: float | None = None, high: float | None = None) -> Column:
    """x within bounds; null stays null (greatest and least skip nulls)."""
    out = x
    if low is not None:
        out = F.greatest(out, d(low))
    if high is not None:
        out = F.least(out, d(high))
    return F.when(x.isNotNull(), out)


def dewpoint(e: Column) -> Column:
    """Dewpoint (C) of a vapour pressure (mb)."""
    v = F.log(e / d(6.112))
    return d(243.5) * v / (d(17.67) - v)


def saturation_vapor_pressure(t: Column) -> Column:
    """Saturation vapour pressure (mb) at a temperature (K)."""
    return d(6.112) * F.exp(d(17.67) * (t - d(273.15)) / (t - d(29.65)))


def dewpoint_from_relative_humidity(t: Column, rh: Column) -> Column:
    return dewpoint(rh * saturation_vapor_pressure(t))


def relative_humidity_from_dewpoint(t: Column, td: Column) -> Column:
    return saturation_vapor_pressure(td) / saturation_vapor_pressure(t)


#: Fit of the rain share of precipitation against temperature.
MELT = {"a": -48.2292, "b": 0.7205, "c": 1.1662, "d": 1.0223}


def melt_fraction(t: Column, t0: float = -2.0, t1: float = 6.5) -> Column:
    """Share of rain or melt at a temperature (C): 0 below t0, 1 above t1, a hyperbolic tangent between."""
    between = d(1) - d(MELT["a"]) * (F.tanh(d(MELT["b"]) * (t - d(MELT["c"]))) - d(MELT["d"])) / d(100)
    return F.when(t < t0, d(0)).when(t > t1, d(1)).when(t.isNotNull(), between)


def normal_cdf(x: Column) -> Column:
    """Standard normal distribution (West's double-precision form of Hart's approximation), in the JVM."""
    return let(F.abs(x), lambda z: _normal_cdf(x, z))


def _normal_cdf(x: Column, z: Column) -> Column:
    num = (0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
    den = (0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)
    gauss = F.exp(-z * z / d(2))

    def poly(coefficients) -> Column:
        out = d(coefficients[0])
        for c in coefficients[1:]:
            out = out * z + d(c)
        return out

    near = gauss * poly(num) / poly(den)
    tail = z + d(0.65)
    for k in (4, 3, 2, 1):
        tail = z + d(k) / tail
    far = gauss / tail / d(2.506628274631)
    upper = F.when(z > 37, d(0)).when(z < 7.07106781186547, near).otherwise(far)
    return F.when(x.isNotNull(), F.when(x > 0, d(1) - upper).otherwise(upper))


def normal_ppf(p: Column) -> Column:
    """Inverse of the standard normal distribution: Acklam's approximation and one Halley step; null outside (0, 1)."""
    a = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
    b = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01)
    c = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
    e = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00)

    def poly(coefficients, x: Column) -> Column:
        out = d(coefficients[0])
        for k in coefficients[1:]:
            out = out * x + d(k)
        return out

    def tail(q: Column) -> Column:
        return poly(c, q) / (poly(e, q) * q + d(1))

    r = (p - d(0.5)) * (p - d(0.5))
    middle = poly(a, r) * (p - d(0.5)) / (poly(b, r) * r + d(1))
    first = F.when(p < 0.02425, tail(F.sqrt(d(-2) * F.log(p)))).when(p > 1 - 0.02425, -tail(F.sqrt(d(-2) * F.log(d(1) - p)))).otherwise(middle)

    def refined(z: Column) -> Column:
        return let((normal_cdf(z) - p) * d(math.sqrt(2 * math.pi)) * F.exp(z * z / d(2)), lambda off: z - off / (d(1) + z * off / d(2)))

    return F.when((p > 0) & (p < 1), let(first, refined))


def season(time: Column) -> Column:
    """DJF, MAM, JJA or SON."""
    m = F.month(time)
    return F.when(m.isin(12, 1, 2), "DJF").when(m.isin(3, 4, 5), "MAM").when(m.isin(6, 7, 8), "JJA").otherwise("SON")


def days_in_month(time: Column) -> Column:
    return F.dayofmonth(F.last_day(time))


def resolution_text(r: Column) -> Column:
    """0.25 as 0_25: rounded to two places, the point as an underscore."""
    return F.translate(F.round(r, 2).cast("string"), ".", "_")


def timescale_name(freq: Column) -> Column:
    return F.when(freq == "1MS", "month").when(freq.isin("YS", "1AS"), "year").otherwise("day")


def aggregation_name(variable: Column) -> Column:
    return F.when(variable.startswith("tas"), "mean").when(variable == "pr", "sum")


def percent_difference(a: Column, b: Column) -> Column:
    return F.when(b != 0, (a - b) / b * d(100))


def swap_scheme(uri: Column, old: str, new: str) -> Column:
    """The URI under another scheme (gs:// to az://, az:// to https://host/)."""
    return F.when(uri.startswith(old), F.concat(F.lit(new), F.substr(uri, F.lit(len(old) + 1)))).otherwise(uri)


def name_and_folder(uri: Column) -> tuple[Column, Column]:
    """The last part of a URI without its suffix, and all before it."""
    last = F.element_at(F.split(uri, "/"), -1)
    return F.regexp_replace(last, r"\.[^.]*$", ""), F.regexp_replace(uri, r"/[^/]*$", "")


def semver(version: Column) -> Column:
    """Numbers of a version text (its local part after + left out), as an array that sorts by precedence."""
    return F.transform(F.split(F.regexp_replace(version, r"\+.*$", ""), r"\."), lambda x: F.regexp_extract(x, r"\d+", 0).cast("int"))
