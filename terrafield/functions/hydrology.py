"""Monthly reference evapotranspiration as one Column expression, and humidity by what is known of it."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scalar import clip, d, dewpoint, melt_fraction, relative_humidity_from_dewpoint, saturation_vapor_pressure

SRAD_TO_MJ = 0.0864
MONTH_DAYS = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)


def humidity(df: DataFrame) -> DataFrame:
    """Adds tmean, and vap (kPa), tdew (C), rh and vpd (kPa), from rh, vap or tdew, whichever is there (in this order)."""
    if "tmean" not in df.columns:
        df = df.withColumn("tmean", (F.col("tmax") + F.col("tmin")) / d(2))
    kelvin = F.col("tmean") + d(273.15)
    sat = saturation_vapor_pressure(kelvin) / d(10)
    if "rh" in df.columns:
        df = df.withColumn("vap", F.col("rh") * sat)
    elif "vap" not in df.columns and "tdew" in df.columns:
        df = df.withColumn("rh", relative_humidity_from_dewpoint(kelvin, F.col("tdew") + d(273.15))).withColumn("vap", F.col("rh") * sat)
    elif "vap" not in df.columns:
        raise ValueError("needs rh, vap or tdew")
    df = df.withColumn("vap", clip(F.col("vap"), 0.005))
    if "rh" not in df.columns:
        df = df.withColumn("rh", F.col("vap") / sat)
    if "tdew" not in df.columns:
        df = df.withColumn("tdew", dewpoint(F.col("vap") * d(10)))
    return df.withColumn("vpd", sat - F.col("vap"))


def penman_monteith(tmax: Column, tmin: Column, srad: Column, wind: Column, tdew: Column, tmean_before: Column, lat: Column, elevation: Column, month: Column) -> Column:
    """Monthly reference evapotranspiration (mm), Penman-Monteith with a temperature-limited surface.

    Temperatures in C, srad in MJ/m2/day, wind in m/s at 10 m, elevation in m; ``tmean_before`` is
    the month before's mean (the month's own for the first).
    """
    # Fixed values of the method: 365-day months, a 208 s/m resistance at 1 m/s, 100 s/m of stomata, albedo 0.23.
    lengths = F.array(*[d(n) for n in MONTH_DAYS])
    ends = F.array(*[d(sum(MONTH_DAYS[: k + 1])) for k in range(12)])
    n_days = F.element_at(lengths, month)
    doy = F.element_at(ends, month) - (n_days - d(1)) / d(2)
    mean = (tmax + tmin) / d(2)
    soil_heat = d(0.14) * (mean - tmean_before) * n_days
    wind2 = wind * d(4.87 / math.log(67 * 10 - 5.42))
    low, optimal, high = -10.0, 5.0, 100.0
    power = (high - optimal) / (high - low)
    limit = d(1 / ((optimal - low) * (high - optimal) ** power)) * (mean - d(low)) * F.pow(d(high) - mean, d(power))
    ks = F.when(mean >= optimal, d(1)).otherwise(F.greatest(d(0.01), F.least(limit, d(1))))
    ra = d(208) / wind2
    rs = d(100) / ks / d(0.5 * 24 * 0.12)
    pressure = d(101.3) * F.pow((d(293) - d(0.0065) * elevation) / d(293), d(5.26))
    vapour = lambda t: d(0.6108) * F.exp(t * d(17.27) / (t + d(237.3)))
    es = (vapour(tmax) + vapour(tmin)) / d(2)
    ea = vapour(tdew)
    vpd = F.greatest(es - ea, d(0))
    slope = d(4098) * es / F.pow(mean + d(237.3), d(2))
    latent = d(2.501) - d(2.361e-3) * mean
    gamma = d(1.013e-3) * pressure / (d(0.622) * latent)
    density = pressure / (d(1.01 * 0.287) * (mean + d(273.15)))
    phi = lat * d(math.pi / 180)
    angle = doy * d(2 * math.pi / 365)
    distance = d(1) + d(0.033) * F.cos(angle)
    declination = d(0.409) * F.sin(angle - d(1.39))
    sunset = F.acos(-F.tan(phi) * F.tan(declination))
    top = d(1440 / math.pi * 0.082) * distance * (sunset * F.sin(phi) * F.sin(declination) + F.cos(phi) * F.cos(declination) * F.sin(sunset))
    clear = F.greatest(d(0), top * (d(0.75) + d(2e-5) * elevation))
    # Where there is no sun above the horizon, the share is one, as of any radiation under a dark sky.
    share = F.least(d(1), F.try_divide(srad, clear))
    longwave = d(4.903e-9) * (F.pow(tmax + d(273.15), d(4)) + F.pow(tmin + d(273.15), d(4))) / d(2) * (d(0.34) - d(0.14) * F.sqrt(ea)) * (d(1.35) * share - d(0.35))
    net = (d(0.77) * srad - longwave) * n_days
    aerodynamic = density * d(1.013e-3) * vpd / ra * d(86400) * n_days
    return d(0.408) * (slope * (net - soil_heat) + aerodynamic) / (slope + gamma * (d(1) + rs / ra))


def monthly_pet(df: DataFrame, cell: tuple[str, ...] = ("lat", "lon"), time: str = "time", latitude: str = "lat") -> DataFrame:
    """Adds ``pet`` to a monthly table with tmax, tmin, tmean, srad (W/m2), ws, tdew and elevation.

    Where it freezes, the rate is scaled by the melt fraction. One window per cell gives the month before.
    """
    order = Window.partitionBy(*cell).orderBy(time)
    before = F.coalesce(F.lag("tmean").over(order), F.col("tmean"))
    pet = penman_monteith(
        F.col("tmax"), F.col("tmin"), F.col("srad") * d(SRAD_TO_MJ), F.col("ws"), F.col("tdew"), before,
        F.col(latitude).cast("double"), F.col("elevation").cast("double"), F.month(time),
    )
    return df.withColumn("pet", pet * melt_fraction(F.col("tmean")))
