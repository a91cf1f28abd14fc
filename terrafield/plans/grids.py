"""Queries of scalar functions, calendars, windows, joins, set operations and regridding."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import hydrology as H
from ..functions import scalar as S
from ..operators import aggregate as A
from ..operators import calendar as C
from ..operators import grid as G
from ..operators import select as X
from ..sources.cube import CELLS, GCM, OBS, WIDTH, cells, gcm, grid_width, obs, table, tasks
from .registry import nudged, query, r6

CELL = A.CELL
HALF = f"({WIDTH} // 2)"

# ---------------------------------------------------------------- scalar functions


@query("f01_lon_to_180", "SELECT c_custkey, CASE WHEN c_custkey % 360 < 180 THEN c_custkey % 360 ELSE c_custkey % 360 - 360 END AS lon FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", S.lon_to_180(F.col("c_custkey") % 360).alias("lon"))


@query("f04_units", f"WITH {OBS} SELECT time, lat_i, lon_i, round(pr * 86400.0::DOUBLE, 6) AS mm, round(pr / 86400.0::DOUBLE * 1000, 6) AS flux, round(pr - 273.15::DOUBLE, 6) AS celsius, round(pr / 9.80665::DOUBLE, 6) AS height FROM obs")
def _(spark, sf):
    x = F.col("pr")
    return obs(spark, sf).select("time", *CELL, r6(S.flux_to_mm_day(x), "mm"), r6(S.accumulated_metres_to_flux(x), "flux"), r6(S.kelvin_to_celsius(x), "celsius"), r6(S.geopotential_to_height(x), "height"))


_T, _E = "(260 + p_size)::DOUBLE", "(1 + p_size)::DOUBLE"
_SVP = "(6.112 * exp(17.67::DOUBLE * ({0} - 273.15::DOUBLE) / ({0} - 29.65::DOUBLE)))"
_DEW = "(243.5::DOUBLE * ln({0} / 6.112::DOUBLE) / (17.67::DOUBLE - ln({0} / 6.112::DOUBLE)))"


@query("f05_dewpoint", f"SELECT p_partkey, round({_DEW.format(_E)}, 6) AS dewpoint FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", r6(S.dewpoint((F.col("p_size") + 1).cast("double")), "dewpoint"))


@query("f06_saturation_vapor_pressure", f"SELECT p_partkey, round({_SVP.format(_T)}, 6) AS svp FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", r6(S.saturation_vapor_pressure((F.col("p_size") + 260).cast("double")), "svp"))


@query("f07_dewpoint_from_rh", f"SELECT p_partkey, round({_DEW.format('(0.6::DOUBLE * ' + _SVP.format(_T) + ')')}, 6) AS dewpoint FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", r6(S.dewpoint_from_relative_humidity((F.col("p_size") + 260).cast("double"), F.lit(0.6)), "dewpoint"))


@query("f08_rh_from_dewpoint", f"SELECT p_partkey, round({_SVP.format('(' + _T + ' - 5)')} / {_SVP.format(_T)}, 6) AS rh FROM part")
def _(spark, sf):
    t = (F.col("p_size") + 260).cast("double")
    return table(spark, sf, "part").select("p_partkey", r6(S.relative_humidity_from_dewpoint(t, t - 5.0), "rh"))


def _weather(spark, sf):
    z = F.col("p_size").cast("double")
    return table(spark, sf, "part").select("p_partkey", (z - 5).alias("tmax"), (z - 15).alias("tmin"), (z - 18).alias("tdew"), (F.lit(0.4) + z / 100).alias("rh"))


_K = "(((p_size - 5)::DOUBLE + (p_size - 15)::DOUBLE) / 2 + 273.15::DOUBLE)"


@query("f09_humidity", f"WITH x AS (SELECT p_partkey, {_SVP.format(_K)} / 10 AS sat, 0.4::DOUBLE + p_size::DOUBLE / 100 AS rh FROM part) SELECT p_partkey, round(greatest(rh * sat, 0.005), 6) AS vap, round(sat - greatest(rh * sat, 0.005), 6) AS vpd FROM x")
def _(spark, sf):
    out = H.humidity(_weather(spark, sf).drop("tdew"))
    return out.select("p_partkey", r6("vap", "vap"), r6("vpd", "vpd"))


@query("f10_melt_fraction", "WITH x AS (SELECT p_partkey, p_size::DOUBLE / 2 - 8 AS t FROM part) SELECT p_partkey, round(CASE WHEN t < -2 THEN 0 WHEN t > 6.5 THEN 1 ELSE 1 - (-48.2292::DOUBLE * (tanh(0.7205::DOUBLE * (t - 1.1662::DOUBLE)) - 1.0223::DOUBLE)) / 100 END, 6) AS melt FROM x")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", r6(S.melt_fraction(F.col("p_size").cast("double") / 2 - 8), "melt"))


_PET = """WITH m AS (SELECT p_partkey, unnest(range(1, 13)) AS month, p_size FROM part),
x AS (SELECT p_partkey, month, p_size * 0.6::DOUBLE - 2 + month AS tmax, p_size * 0.6::DOUBLE - 12 + month AS tmin, p_size * 0.6::DOUBLE - 15 + month AS tdew, 10.0::DOUBLE + month AS srad, 1.0::DOUBLE + p_size % 7 AS ws, (p_partkey % 60)::DOUBLE AS lat, (p_partkey % 900)::DOUBLE AS elev,
 [31,28,31,30,31,30,31,31,30,31,30,31][month] AS nd, [31,59,90,120,151,181,212,243,273,304,334,365][month] AS last FROM m),
a AS (SELECT *, (tmax + tmin) / 2 AS t, last - (nd - 1) / 2.0::DOUBLE AS doy, ws * (4.87::DOUBLE / ln(67 * 10 - 5.42::DOUBLE)) AS u, lat * pi() / 180 AS phi, 101.3::DOUBLE * pow((293 - 0.0065::DOUBLE * elev) / 293, 5.26::DOUBLE) AS p FROM x),
b AS (SELECT *, lag(t, 1, t) OVER (PARTITION BY p_partkey ORDER BY month) AS before, 208 / u AS ra, (0.6108::DOUBLE * exp(tmin * 17.27::DOUBLE / (tmin + 237.3::DOUBLE)) + 0.6108::DOUBLE * exp(tmax * 17.27::DOUBLE / (tmax + 237.3::DOUBLE))) / 2 AS es, 0.6108::DOUBLE * exp(tdew * 17.27::DOUBLE / (tdew + 237.3::DOUBLE)) AS ea, 2.501::DOUBLE - 0.002361::DOUBLE * t AS lhv,
 CASE WHEN t >= 5 THEN 1 ELSE greatest(0.01::DOUBLE, least((t + 10) * pow(100 - t, 95.0::DOUBLE / 110) / (15 * pow(95, 95.0::DOUBLE / 110)), 1)) END AS ks, 1 + 0.033::DOUBLE * cos(2 * pi() / 365 * doy) AS dr, 0.409::DOUBLE * sin(2 * pi() / 365 * doy - 1.39::DOUBLE) AS dl FROM a),
c AS (SELECT *, acos(-tan(phi) * tan(dl)) AS om, 4098 * es / pow(t + 237.3::DOUBLE, 2) AS delta, 0.001013::DOUBLE * p / (0.622::DOUBLE * lhv) AS gamma, p / (1.01::DOUBLE * (t + 273.15::DOUBLE) * 0.287::DOUBLE) AS pa, 100 / ks / (0.5::DOUBLE * 24 * 0.12::DOUBLE) AS rs FROM b),
e AS (SELECT *, greatest(0, 1440 / pi() * 0.082::DOUBLE * dr * (om * sin(phi) * sin(dl) + cos(phi) * cos(dl) * sin(om)) * (0.75::DOUBLE + 0.00002::DOUBLE * elev)) AS rso FROM c),
f AS (SELECT *, (srad * 0.77::DOUBLE - 4.903e-9 * (pow(tmax + 273.15::DOUBLE, 4) + pow(tmin + 273.15::DOUBLE, 4)) / 2 * (0.34::DOUBLE - 0.14::DOUBLE * sqrt(ea)) * (1.35::DOUBLE * least(1, srad / rso) - 0.35::DOUBLE)) * nd AS net FROM e)
SELECT p_partkey, month::INT AS month, round(0.408::DOUBLE * (delta * (net - 0.14::DOUBLE * (t - before) * nd) + pa * 0.001013::DOUBLE * greatest(0, es - ea) / ra * 86400 * nd) / (delta + gamma * (1 + rs / ra)), 5) AS pet FROM f"""


@query("f11_pet", _PET)
def _(spark, sf):
    z, m = F.col("p_size") * F.lit(0.6), F.col("month")
    rows = table(spark, sf, "part").select("p_partkey", "p_size", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    rows = rows.select(
        "p_partkey", "month", (z - 2 + m).alias("tmax"), (z - 12 + m).alias("tmin"), (z - 15 + m).alias("tdew"), (m + F.lit(10.0)).alias("srad"),
        (F.col("p_size") % 7 + F.lit(1.0)).alias("ws"), (F.col("p_partkey") % 60).cast("double").alias("lat"), (F.col("p_partkey") % 900).cast("double").alias("elev"),
    )
    t = (F.col("tmax") + F.col("tmin")) / 2
    before = F.coalesce(F.lag(t).over(Window.partitionBy("p_partkey").orderBy("month")), t)
    pet = H.penman_monteith(F.col("tmax"), F.col("tmin"), F.col("srad"), F.col("ws"), F.col("tdew"), before, F.col("lat"), F.col("elev"), m)
    return rows.select("p_partkey", "month", F.round(pet, 5).alias("pet"))


@query("f13_roots", "SELECT p_partkey, round(cbrt((p_size - 25)::DOUBLE), 6) AS root, pow((p_size - 25)::DOUBLE, 3) AS cube FROM part")
def _(spark, sf):
    x = (F.col("p_size") - 25).cast("double")
    return table(spark, sf, "part").select("p_partkey", r6(F.cbrt(x), "root"), F.pow(x, F.lit(3.0)).alias("cube"))


def normal_cdf_sql(x: str) -> str:
    """The normal distribution by its series, the density times the sum of x ** (2 j + 1) / (1 * 3 * ... * (2 j + 1))."""
    term = f"exp((2 * j + 1) * ln(greatest(abs({x}), 1e-300)) - (lgamma(2 * j + 3) - (j + 1) * ln(2) - lgamma(j + 2)))"
    return f"(0.5::DOUBLE + sign({x}) * exp(-({x}) * ({x}) / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 90), lambda j: {term})))"


def normal_ppf_sql(table_name: str) -> str:
    """A CTE body: u and its normal score z, by bisection, for each u within (0, 1) of a table."""
    return f"""(WITH RECURSIVE halves AS (SELECT DISTINCT u, -9.0::DOUBLE AS lo, 9.0::DOUBLE AS hi, 0 AS k FROM {table_name} WHERE u > 0 AND u < 1
    UNION ALL SELECT u, CASE WHEN below THEN mid ELSE lo END, CASE WHEN below THEN hi ELSE mid END, k + 1 FROM (SELECT *, {normal_cdf_sql('mid')} < u AS below FROM (SELECT *, (lo + hi) / 2 AS mid FROM halves WHERE k < 50)))
    SELECT u, (lo + hi) / 2 AS z FROM halves WHERE k = 50)"""


@query("f14_normal", f"WITH s AS (SELECT p_partkey, (p_size + 0.5::DOUBLE) / 60 AS u FROM part), n AS {normal_ppf_sql('s')} SELECT p_partkey, round(z, 6) AS z, round(u, 6) AS p FROM s JOIN n USING (u)")
def _(spark, sf):
    p = (F.col("p_size") + 0.5) / F.lit(60.0)
    return table(spark, sf, "part").select("p_partkey", r6(S.normal_ppf(p), "z"), r6(S.normal_cdf(S.normal_ppf(p)), "p"))


@query("f15_clip", f"WITH {OBS} SELECT time, lat_i, lon_i, CASE WHEN pr <> 7 THEN least(greatest(pr, 10), 40) END AS pr FROM obs")
def _(spark, sf):
    return obs(spark, sf).select("time", *CELL, S.clip(F.when(F.col("pr") != 7, F.col("pr")), 10, 40).alias("pr"))


@query("f16_date_parts", f"WITH {OBS} SELECT DISTINCT time, month(time)::INT AS month, year(time)::INT AS year, dayofyear(time)::INT AS doy, day(last_day(time))::INT AS n_days, strftime(time, '%Y-%m-%d') AS text, CASE WHEN month(time) IN (12, 1, 2) THEN 'DJF' WHEN month(time) IN (3, 4, 5) THEN 'MAM' WHEN month(time) IN (6, 7, 8) THEN 'JJA' ELSE 'SON' END AS season FROM obs")
def _(spark, sf):
    t = F.col("time")
    return obs(spark, sf).select("time").distinct().select("time", F.month(t).alias("month"), F.year(t).alias("year"), F.dayofyear(t).alias("doy"), S.days_in_month(t).alias("n_days"), F.date_format(t, "yyyy-MM-dd").alias("text"), S.season(t).alias("season"))


@query("f17_date_range", f"WITH {OBS} SELECT unnest(generate_series(min(time), max(time), INTERVAL 1 DAY))::DATE AS time FROM obs")
def _(spark, sf):
    return obs(spark, sf).agg(F.min("time").alias("a"), F.max("time").alias("b")).select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("time"))


@query("f18_batches", "WITH s AS (SELECT b, b * 15 AS a, least(b * 15 + 15, 366) AS e FROM (SELECT unnest(range(0, 25)) AS b)), r AS (SELECT b, a, e, unnest(range(a - 15, e + 15)) AS i FROM s) SELECT b::INT AS batch, ((i + 366) % 366 + 1)::INT AS item, i >= a AND i < e AS is_core FROM r")
def _(spark, sf):
    return C.generate_batches(366, 15, 15, spark, one_indexed=True)


@query("f22_resolution_text", "SELECT p_partkey, replace(printf('%.1f', p_size / 2.0), '.', '_') AS res FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", S.resolution_text(F.col("p_size") / F.lit(2.0)).alias("res"))


@query("f23_uris", "SELECT page_id, CASE WHEN url LIKE 'http://%' THEN 'https://' || substr(url, 8) ELSE url END AS uri, regexp_replace(string_split(url, '/')[-1], '\\.[^.]*$', '') AS name, regexp_replace(url, '/[^/]*$', '') AS folder FROM pages")
def _(spark, sf):
    name, folder = S.name_and_folder(F.col("url"))
    return table(spark, sf, "pages").select("page_id", S.swap_scheme(F.col("url"), "http://", "https://").alias("uri"), name.alias("name"), folder.alias("folder"))


@query("f25_names", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'month' WHEN 1 THEN 'year' ELSE 'day' END AS timescale, CASE p_size % 3 WHEN 0 THEN 'mean' WHEN 1 THEN 'sum' END AS aggregation FROM part")
def _(spark, sf):
    freq = F.element_at(F.array(F.lit("1MS"), F.lit("YS"), F.lit("1D")), (F.col("p_partkey") % 3 + 1).cast("int"))
    variable = F.element_at(F.array(F.lit("tasmax"), F.lit("pr"), F.lit("huss")), (F.col("p_size") % 3 + 1).cast("int"))
    return table(spark, sf, "part").select("p_partkey", S.timescale_name(freq).alias("timescale"), S.aggregation_name(variable).alias("aggregation"))


@query("f27_percent_difference", f"WITH {OBS} SELECT time, lat_i, lon_i, round((tasmax - tasmin) / tasmin * 100, 6) AS pct FROM obs")
def _(spark, sf):
    return obs(spark, sf).select("time", *CELL, r6(S.percent_difference(F.col("tasmax"), F.col("tasmin")), "pct"))


# ---------------------------------------------------------------- calendars and windows

_SPINE = f"""{OBS}, span AS (SELECT lat_i, lon_i, min(time) AS a, max(time) AS b FROM obs GROUP BY ALL),
days AS (SELECT lat_i, lon_i, unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS time FROM span),
f AS (SELECT days.time, days.lat_i, days.lon_i, pr, date_diff('day', DATE '1970-01-01', days.time) AS d FROM days LEFT JOIN obs ON days.time = obs.time AND days.lat_i = obs.lat_i AND days.lon_i = obs.lon_i),
g AS (SELECT *, last_value(pr IGNORE NULLS) OVER b AS x0, first_value(pr IGNORE NULLS) OVER a AS x1, last_value(CASE WHEN pr IS NOT NULL THEN d END IGNORE NULLS) OVER b AS t0, first_value(CASE WHEN pr IS NOT NULL THEN d END IGNORE NULLS) OVER a AS t1 FROM f
      WINDOW b AS (PARTITION BY lat_i, lon_i ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY lat_i, lon_i ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (SELECT time, lat_i, lon_i, coalesce(pr, x0 + (x1 - x0) * (d - t0)::DOUBLE / (t1 - t0)::DOUBLE) AS pr FROM g)"""


@query("f02_standard_calendar", f"WITH {_SPINE} SELECT time, lat_i, lon_i, round(pr, 6) AS pr FROM filled")
def _(spark, sf):
    t = F.col("time")
    rows = obs(spark, sf, CELL).select(*CELL, "pr", F.year(t).alias("year"), F.month(t).alias("month"), F.dayofmonth(t).alias("day"))
    return C.to_standard_calendar(rows, "noleap", ["pr"]).select("time", *CELL, r6("pr", "pr"))


@query("w01_rolling_mean", f"WITH {OBS}, w AS (SELECT time, lat_i, lon_i, avg(pr) OVER w AS m, count(pr) OVER w AS n FROM obs WINDOW w AS (PARTITION BY lat_i, lon_i ORDER BY time ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING)) SELECT time, lat_i, lon_i, round(CASE WHEN n = 21 THEN m END, 6) AS m FROM w")
def _(spark, sf):
    return C.rolling_mean(obs(spark, sf), "pr", 21, "m", CELL, "time").select("time", *CELL, r6("m", "m"))


_PAD = """i AS (SELECT *, row_number() OVER (PARTITION BY lat_i, lon_i ORDER BY time) AS i, row_number() OVER (PARTITION BY lat_i, lon_i ORDER BY time DESC) AS j, (max(time) OVER (PARTITION BY lat_i, lon_i) - min(time) OVER (PARTITION BY lat_i, lon_i) + 1)::INT AS s FROM {0}),
{1} AS (SELECT time, lat_i, lon_i, pr, false AS padded FROM i UNION ALL SELECT time + s, lat_i, lon_i, pr, true FROM i WHERE i <= {2} UNION ALL SELECT time - s, lat_i, lon_i, pr, true FROM i WHERE j <= {2})"""


@query("w02_circular_pad", f"WITH {OBS}, {_PAD.format('obs', 'p', 5)} SELECT time, lat_i, lon_i, pr, padded FROM p")
def _(spark, sf):
    return C.circular_pad(obs(spark, sf).select("time", *CELL, "pr"), 5)


@query(
    "w05_epoch_trend",
    f"""WITH {OBS}, {_PAD.format('obs', 'p', 10)},
    s AS (SELECT *, avg(pr) OVER w AS s, count(*) OVER w AS n FROM p WINDOW w AS (PARTITION BY lat_i, lon_i ORDER BY time ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING)),
    d AS (SELECT time, lat_i, lon_i, s, dayofyear(time) AS doy, year(time) AS y FROM s WHERE NOT padded AND n = 21),
    h0 AS (SELECT * FROM obs WHERE year(time) <= 1998), {_PAD.format('h0', 'hp', 10).replace('i AS (', 'hi AS (').replace('FROM i', 'FROM hi')},
    hs AS (SELECT *, avg(pr) OVER w AS s, count(*) OVER w AS n FROM hp WINDOW w AS (PARTITION BY lat_i, lon_i ORDER BY time ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING)),
    hm AS (SELECT dayofyear(time) AS doy, lat_i, lon_i, avg(s) AS m FROM hs WHERE NOT padded AND n = 21 GROUP BY ALL),
    k AS (SELECT *, row_number() OVER (PARTITION BY lat_i, lon_i, doy ORDER BY y) AS k, count(*) OVER (PARTITION BY lat_i, lon_i, doy) AS c FROM d),
    e AS (SELECT a.time, a.lat_i, a.lon_i, a.doy, avg(b.s) AS cycle FROM k a JOIN k b ON a.lat_i = b.lat_i AND a.lon_i = b.lon_i AND a.doy = b.doy
          AND b.k >= greatest(1, least(a.k - least(a.c, 3) // 2, a.c - least(a.c, 3) + 1)) AND b.k < greatest(1, least(a.k - least(a.c, 3) // 2, a.c - least(a.c, 3) + 1)) + least(a.c, 3) GROUP BY ALL)
    SELECT e.time, e.lat_i, e.lon_i, round(cycle - m, 6) + 0.0::DOUBLE AS trend FROM e JOIN hm USING (lat_i, lon_i, doy)""",
)
def _(spark, sf):
    out = C.epoch_trend(obs(spark, sf, CELL), "pr", F.year("time") <= 1998, 21, 3)
    return out.select("time", *CELL, (r6("trend") + F.lit(0.0)).alias("trend"))


@query("w06_rolling_any", f"WITH {OBS} SELECT time, lat_i, lon_i, round(pr - avg(pr) OVER (PARTITION BY lat_i, lon_i ORDER BY time ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING), 6) AS pr FROM obs")
def _(spark, sf):
    out = C.rolling_mean(obs(spark, sf), "pr", 31, "m", CELL, "time", min_periods=1)
    return out.select("time", *CELL, r6(F.col("pr") - F.col("m"), "pr"))


@query("w08_monotonic", f"WITH {OBS}, x AS (SELECT lat_i, lon_i, pr - lag(pr) OVER (PARTITION BY lat_i, lon_i ORDER BY time) AS d FROM obs) SELECT lat_i, lon_i, bool_and(coalesce(d > 0, true)) AS monotonic FROM x GROUP BY ALL")
def _(spark, sf):
    return C.is_monotonic(obs(spark, sf), "pr", "time", CELL)


@query("w09_interpolate", f"WITH {_SPINE} SELECT year(time)::INT AS year, lat_i, lon_i, round(sum(pr), 4) AS pr FROM filled GROUP BY ALL")
def _(spark, sf):
    filled = C.interpolate_linear(C.day_spine(obs(spark, sf, CELL).select("time", *CELL, "pr")), ["pr"])
    return filled.groupBy(F.year("time").alias("year"), *CELL).agg(F.round(F.sum("pr"), 4).alias("pr"))


# ---------------------------------------------------------------- joins and set operations

#: Observations brought to the model's grid by two-by-two means.
_COARSE = "coarse AS (SELECT time, (lat_i // 2)::INT AS lat_i, (lon_i // 2)::INT AS lon_i, avg(pr) AS pr FROM obs GROUP BY time, lat_i // 2, lon_i // 2)"


@query("j01_aligned_difference", f"WITH {OBS}, {GCM}, {_COARSE} SELECT time, lat_i, lon_i, round(g.pr - c.pr, 4) AS diff FROM gcm g JOIN coarse c USING (time, lat_i, lon_i)")
def _(spark, sf):
    c = G.coarsen(obs(spark, sf), 2, ["pr"], tasks=tasks(spark, sf, "lineitem")).withColumnRenamed("pr", "o")
    return gcm(spark, sf).join(c, ["time", *CELL]).select("time", *CELL, F.round(F.col("pr") - F.col("o"), 4).alias("diff"))


@query("j02_add_climatology", f"WITH {OBS}, m AS (SELECT month(time) AS m, lat_i, lon_i, avg(pr) AS c FROM obs GROUP BY ALL) SELECT time, o.lat_i, o.lon_i, round(pr - c, 6) AS anomaly FROM obs o JOIN m ON m.m = month(time) AND m.lat_i = o.lat_i AND m.lon_i = o.lon_i")
def _(spark, sf):
    return X.anomalies(obs(spark, sf), "pr", F.month("time")).select("time", *CELL, r6("anomaly", "anomaly"))


@query("j04_complete_models", "WITH c AS (SELECT p_brand, p_size FROM part GROUP BY ALL HAVING count(DISTINCT p_type) >= 2) SELECT p_partkey, p_brand, p_size FROM part JOIN c USING (p_brand, p_size)")
def _(spark, sf):
    p = table(spark, sf, "part")
    full = p.groupBy("p_brand", "p_size").agg(F.count_distinct("p_type").alias("n")).filter("n >= 2").drop("n")
    return p.join(full, ["p_brand", "p_size"]).select("p_partkey", "p_brand", "p_size")


@query("j05_combine_regions", f"WITH {OBS}, {CELLS}, g AS (SELECT DISTINCT lat_i, lon_i FROM cells), r AS (SELECT region_id, lat_i, lon_i, sum(pr) AS pr FROM obs JOIN cells USING (lat_i, lon_i) WHERE region_id IN (0, 2) GROUP BY ALL) SELECT lat_i, lon_i, region_id, pr FROM g LEFT JOIN r USING (lat_i, lon_i)")
def _(spark, sf):
    c, o = cells(spark, sf), obs(spark, sf)
    tiles = X.with_regions(o, c).groupBy("region_id", *CELL).agg(F.sum("pr").alias("pr"))
    return X.combine_regions(c, tiles, ["pr"], [0, 2]).select(*CELL, "region_id", "pr")


@query("j07_day_pairs", "WITH d AS (SELECT unnest(range(1, 367)) AS doy), k AS (SELECT unnest(range(-45, 46)) AS k), p AS (SELECT doy, ((doy - 1 + k) % 365 + 365) % 365 + 1 AS other FROM d, k UNION SELECT doy, 366 FROM d WHERE least(abs(doy - 366), 365 - abs(doy - 366)) <= 45) SELECT DISTINCT doy::INT AS doy, other::INT AS other FROM p")
def _(spark, sf):
    from ..operators.models import doy_pairs

    return doy_pairs(spark, 45)


@query(
    "j08_analog_days",
    f"""WITH {OBS}, {GCM}, {_COARSE}, x AS (SELECT time AS gcm_day, lat_i, lon_i, pr / 10000 AS pr FROM gcm WHERE year(time) >= 1999),
    d AS (SELECT unnest(range(1, 367)) AS doy), k AS (SELECT unnest(range(-10, 11)) AS k),
    p AS (SELECT doy, ((doy - 1 + k) % 365 + 365) % 365 + 1 AS other FROM d, k UNION SELECT doy, 366 FROM d WHERE least(abs(doy - 366), 365 - abs(doy - 366)) <= 10),
    f AS (SELECT gcm_day, c.time AS obs_day, round(sqrt(sum((x.pr - c.pr) * (x.pr - c.pr))) / count(*), 6) AS rmse FROM x JOIN p ON p.doy = dayofyear(gcm_day) JOIN coarse c ON dayofyear(c.time) = p.other AND c.lat_i = x.lat_i AND c.lon_i = x.lon_i GROUP BY gcm_day, c.time)
    SELECT gcm_day, obs_day, rmse, row_number() OVER (PARTITION BY gcm_day ORDER BY rmse, obs_day)::INT AS rank FROM f QUALIFY rank <= 10""",
)
def _(spark, sf):
    from ..operators.models import analog_days

    g = gcm(spark, sf).filter(F.year("time") >= 1999).withColumn("pr", F.col("pr") / 10000)
    far = analog_days(g, G.coarsen(obs(spark, sf), 2, ["pr"], tasks=tasks(spark, sf, "lineitem")), "pr", 1_000_000, 10).withColumn("rmse", F.round("rmse", 6)).drop("rank")
    order = Window.partitionBy("gcm_day").orderBy("rmse", "obs_day")
    return far.withColumn("rank", F.row_number().over(order)).filter("rank <= 10")


@query("j11_mosaic", f"WITH {OBS}, a AS (SELECT time, lat_i, lon_i, pr FROM obs WHERE lat_i < 6), b AS (SELECT time, lat_i, lon_i, tasmax FROM obs WHERE lat_i > 3) SELECT time, lat_i, lon_i, pr, tasmax FROM a FULL JOIN b USING (time, lat_i, lon_i)")
def _(spark, sf):
    o = obs(spark, sf)
    return o.filter("lat_i < 6").select("time", *CELL, "pr").join(o.filter("lat_i > 3").select("time", *CELL, "tasmax"), ["time", *CELL], "full")


@query("j12_first_match", "SELECT o_orderkey, l_partkey FROM orders LEFT JOIN (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_quantity > 45 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) = 1) ON o_orderkey = l_orderkey")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").filter("l_quantity > 45")
    first = A.first_of(lines, ["l_orderkey"], [F.col("l_linenumber"), F.col("l_partkey")]).select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    return table(spark, sf, "orders").select("o_orderkey").join(first, "o_orderkey", "left")


@query("j13_attach_winds", f"WITH {OBS}, {GCM} SELECT o.time, o.lat_i, o.lon_i, o.pr, g.pr AS wind FROM obs o LEFT JOIN gcm g USING (time, lat_i, lon_i)")
def _(spark, sf):
    return X.attach(obs(spark, sf).select("time", *CELL, "pr"), gcm(spark, sf), {"pr": "wind"}, ["time", *CELL])


@query("u01_hist_plus_scenario", f"WITH {OBS} SELECT time, lat_i, lon_i, pr, 'historical' AS scenario FROM obs WHERE year(time) < 1999 UNION ALL SELECT time, lat_i, lon_i, pr, 'ssp245' FROM obs WHERE year(time) >= 1999 AND pr > 10")
def _(spark, sf):
    from ..sources.readers import with_history

    o = obs(spark, sf).select("time", *CELL, "pr")
    return with_history(o.filter(F.year("time") < 1999), o.filter((F.year("time") >= 1999) & (F.col("pr") > 10)), "ssp245", 1999, 1995)


@query("u03_append_catalog", "WITH a AS (SELECT p_brand, p_type, p_size, 0 AS s FROM part WHERE p_partkey % 2 = 0), b AS (SELECT p_brand, p_type, p_size, 1 FROM part WHERE p_partkey % 3 = 0) SELECT p_brand, p_type, max(CASE WHEN s = m THEN p_size END) AS p_size FROM (SELECT *, max(s) OVER (PARTITION BY p_brand, p_type) AS m FROM (SELECT * FROM a UNION ALL SELECT * FROM b)) GROUP BY ALL")
def _(spark, sf):
    from ..sources.catalog import append_catalog

    p = table(spark, sf, "part").select("p_brand", "p_type", "p_size", "p_partkey")
    out = append_catalog(p.filter("p_partkey % 2 = 0").drop("p_partkey"), p.filter("p_partkey % 3 = 0").drop("p_partkey"), ["p_brand", "p_type"], [F.desc("p_size")])
    return out.select("p_brand", "p_type", "p_size")


@query("u04_distinct_regions", f"WITH {CELLS} SELECT DISTINCT region_id FROM cells")
def _(spark, sf):
    return cells(spark, sf).select("region_id").distinct()


@query("u05_symmetric_difference", "(SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0 EXCEPT SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0) UNION ALL (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0 EXCEPT SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0)")
def _(spark, sf):
    o = table(spark, sf, "orders")
    a, b = (o.filter(F.col("o_orderkey") % k == 0).select("o_custkey") for k in (2, 3))
    return a.subtract(b).unionAll(b.subtract(a))


# ---------------------------------------------------------------- regridding

#: Linear weights from the half-width axis to the full one, as SQL.
_LINEAR = f"""n AS (SELECT {WIDTH} AS w, {WIDTH} // 2 AS h), t AS (SELECT unnest(range(0, w)) AS dst, h FROM n),
u AS (SELECT dst, h, greatest(0, least(h - 1, (dst + 0.5::DOUBLE) / 2 - 0.5::DOUBLE)) AS p FROM t),
v AS (SELECT dst, floor(p)::INT AS a, p - floor(p) AS f, h FROM u),
lin AS (SELECT dst::INT AS dst, a AS src, 1 - f AS w FROM v WHERE f < 1 UNION ALL SELECT dst::INT, a + 1, f FROM v WHERE f > 0)"""


def _bilinear_weights(spark, sf):
    w = grid_width(spark, sf)
    lin = G.linear_axis_weights([2 * i + 0.5 for i in range(w // 2)], list(range(w)))
    return G.weights(spark, lin, lin)


@query("r01_bilinear", f"WITH {GCM}, {_LINEAR} SELECT time, a.dst AS lat_i, b.dst AS lon_i, round(sum(a.w * b.w * pr) / sum(a.w * b.w) + 1e-6, 4) AS pr FROM gcm JOIN lin a ON a.src = lat_i JOIN lin b ON b.src = lon_i GROUP BY ALL")
def _(spark, sf):
    return G.regrid(gcm(spark, sf), _bilinear_weights(spark, sf), ["pr"], tasks=tasks(spark, sf, "orders")).select("time", *CELL, F.round(F.col("pr") + F.lit(1e-6), 4).alias("pr"))


@query("r03_conservative", f"WITH {OBS}, {_COARSE} SELECT time, lat_i, lon_i, round(pr, 6) AS pr FROM coarse")
def _(spark, sf):
    w = grid_width(spark, sf)
    lap = G.overlap_axis_weights(list(range(w)), [2 * i + 0.5 for i in range(w // 2)], False)
    return G.regrid(obs(spark, sf), G.weights(spark, lap, lap), ["pr"]).select("time", *CELL, r6("pr", "pr"))


@query("r04_coarsen_interpolate", f"WITH {OBS}, {_COARSE}, {_LINEAR} SELECT time, a.dst AS lat_i, b.dst AS lon_i, round(sum(a.w * b.w * pr) / sum(a.w * b.w), 6) AS pr FROM coarse JOIN lin a ON a.src = lat_i JOIN lin b ON b.src = lon_i GROUP BY ALL")
def _(spark, sf):
    return G.regrid(G.coarsen(obs(spark, sf), 2, ["pr"], tasks=tasks(spark, sf, "lineitem")), _bilinear_weights(spark, sf), ["pr"], tasks=tasks(spark, sf, "lineitem")).select("time", *CELL, r6("pr", "pr"))


@query("r07_weights", f"WITH {_LINEAR} SELECT a.dst AS dst_lat, b.dst AS dst_lon, a.src AS src_lat, b.src AS src_lon, round(a.w * b.w, 6) AS w FROM lin a, lin b")
def _(spark, sf):
    return _bilinear_weights(spark, sf).withColumn("w", F.round("w", 6))


@query("r08_pyramid", f"WITH {OBS}, l AS (SELECT unnest(range(0, 3)) AS level), p AS (SELECT time, level, (lat_i // pow(2, 2 - level)::INT)::INT AS y, (lon_i // pow(2, 2 - level)::INT)::INT AS x, pr FROM obs, l) SELECT time, level::INT AS level, y, x, round(avg(pr), 6) AS pr, (y // 2)::INT AS tile_y, (x // 2)::INT AS tile_x FROM p GROUP BY ALL")
def _(spark, sf):
    return G.pyramid(obs(spark, sf), 3, "pr", tile=2, tasks=tasks(spark, sf, "lineitem")).withColumn("pr", F.round("pr", 6))


@query("r12_patches", f"WITH {OBS}, o AS (SELECT y, x FROM (SELECT unnest(range(0, {WIDTH} - 4 + 1, 2)) AS y), (SELECT unnest(range(0, {WIDTH} - 4 + 1, 2)) AS x)), m AS (SELECT date_trunc('month', time)::DATE AS time, lat_i, lon_i, sum(pr) AS pr FROM obs GROUP BY ALL) SELECT time, y::INT AS y0, x::INT AS x0, sum(pr) AS total FROM m JOIN o ON lat_i BETWEEN y AND y + 3 AND lon_i BETWEEN x AND x + 3 GROUP BY ALL HAVING count(*) = 16")
def _(spark, sf):
    w = grid_width(spark, sf)
    out = G.patches(A.time_summary(obs(spark, sf).select("time", *CELL, "pr")), "pr", 4, 2, w, w)
    return out.filter(G.patch_is_usable("patch")).select("time", "y0", "x0", F.aggregate("patch", F.lit(0.0), lambda a, x: a + x).alias("total"))


def _field_sql(seed: int, modes: int, length_space: float, length_time: float, y: str, x: str, t: str) -> str:
    """The field of a seed as a sum over its modes written out."""
    rng = np.random.default_rng(seed)
    k = rng.normal(size=(modes, 3)) / np.array([length_space, length_space, length_time])
    a = rng.normal(size=(modes, 2))
    rows = ", ".join("[" + ", ".join(repr(float(v)) + "::DOUBLE" for v in (*k[i], *a[i])) + "]" for i in range(modes))
    phase = f"(m[1] * {y} + m[2] * {x} + m[3] * {t})"
    return f"list_sum(list_transform([{rows}], lambda m: m[4] * cos{phase} + m[5] * sin{phase})) / sqrt({modes})"


@query("r13_random_field", f"WITH n AS (SELECT {WIDTH} AS w), i AS (SELECT unnest(range(0, w * w * 30)) AS i, w FROM n) SELECT (i % w)::INT AS lon_i, ((i // w) % w)::INT AS lat_i, (i // (w * w))::INT AS step, round({_field_sql(1981, 200, 4.0, 2.0, '((i // w) % w)', '(i % w)', '(i // (w * w))')}, 6) AS field FROM i")
def _(spark, sf):
    w = grid_width(spark, sf)
    grid = spark.range(0, w * w * 30).select((F.col("id") % w).cast("int").alias("lon_i"), (F.floor(F.col("id") / w) % w).cast("int").alias("lat_i"), F.floor(F.col("id") / (w * w)).cast("int").alias("step"))
    return G.random_field(grid, 4.0, 2.0, 1981).withColumn("field", r6("field"))


_MILLER = "6371.0::DOUBLE * 1.25 * ln(tan(pi() / 4 + 0.4::DOUBLE * (lat_i * 2 + 30) * pi() / 180))", "6371.0::DOUBLE * lon_i * 2 * pi() / 180"


@query("r13_random_record", f"""WITH {OBS}, d AS (SELECT DISTINCT time, lat_i, lon_i FROM obs WHERE lat_i < 4 AND lon_i < 4), p AS (SELECT *, {_MILLER[0]} AS y, {_MILLER[1]} AS x FROM d)
SELECT time, lat_i, lon_i, round(CASE WHEN year(time) < 1998 THEN {_field_sql(1997, 20, 900.0, 5.0, 'y', 'x', "(time - DATE '1995-01-01')")} ELSE {_field_sql(2000, 20, 900.0, 5.0, 'y', 'x', "(time - DATE '1998-01-01')")} END, 5) AS field FROM p WHERE year(time) BETWEEN 1995 AND 2000""")
def _(spark, sf):
    days = obs(spark, sf).filter("lat_i < 4 AND lon_i < 4").select("time", *CELL)
    at = days.withColumn("lat", F.col("lat_i") * 2 + F.lit(30.0)).withColumn("lon", F.col("lon_i") * F.lit(2.0))
    return G.random_record(at, "pr", 900.0, 5.0, 1995, 2000, years=3, modes=20).select("time", *CELL, F.round("field", 5).alias("field"))


# ---------------------------------------------------------------- spatial disaggregation


@query("m09_spatial_anomaly", f"WITH {OBS}, {_COARSE}, {_LINEAR}, i AS (SELECT time, a.dst AS lat_i, b.dst AS lon_i, sum(a.w * b.w * pr) / sum(a.w * b.w) AS pr FROM coarse JOIN lin a ON a.src = lat_i JOIN lin b ON b.src = lon_i GROUP BY ALL) SELECT month(time)::INT AS month, lat_i, lon_i, round(avg(o.pr - i.pr) + 1e-8, 6) AS anomaly FROM obs o JOIN i USING (time, lat_i, lon_i) GROUP BY ALL")
def _(spark, sf):
    from ..operators.downscale import spatial_anomalies

    o = obs(spark, sf)
    interpolated = G.regrid(G.coarsen(o, 2, ["pr"], tasks=tasks(spark, sf, "lineitem")), _bilinear_weights(spark, sf), ["pr"], tasks=tasks(spark, sf, "lineitem"))
    return spatial_anomalies(o, interpolated, "pr").select("month", *CELL, r6(nudged("anomaly"), "anomaly"))


@query("p11_weight_lookup", "SELECT p_brand, p_type, p_size, min(p_partkey) AS p_partkey FROM part WHERE p_size IN (1, 7) AND p_brand LIKE '%1%' GROUP BY ALL")
def _(spark, sf):
    from ..sources.catalog import lookup

    p = table(spark, sf, "part").filter(F.col("p_size").isin(1, 7) & F.col("p_brand").contains("1"))
    return lookup(p, {}, ["p_brand", "p_type", "p_size"], [F.col("p_partkey")]).select("p_brand", "p_type", "p_size", "p_partkey")


@query("s03_catalog_search", "SELECT p_partkey, p_brand, p_type FROM part WHERE p_brand IN ('Brand#11', 'Brand#12', 'Brand#13') AND p_size = 10")
def _(spark, sf):
    from ..sources.catalog import search

    return search(table(spark, sf, "part"), p_brand=["Brand#11", "Brand#12", "Brand#13"], p_size=10).select("p_partkey", "p_brand", "p_type")


@query("s14_parse_paths", "SELECT page_id, string_split(url, '/')[1] AS scheme, string_split(url, '/')[3] AS host, coalesce(regexp_extract(url, '/([a-z]{2})/(\\d+)', 1), '') AS lang, regexp_extract(url, '/([a-z]{2})/(\\d+)', 2) AS item FROM pages")
def _(spark, sf):
    from ..sources.catalog import parse_paths

    return parse_paths(table(spark, sf, "pages").select("page_id", F.col("url").alias("path")), {"scheme": 1, "host": 3}, {"lang": (r"/([a-z]{2})/(\d+)", 1), "item": (r"/([a-z]{2})/(\d+)", 2)}).drop("path")


@query("s16_file_patterns", "SELECT y::INT AS year, m::INT AS month, v AS variable, y || '/' || lpad(m::VARCHAR, 2, '0') || '/data/' || v || '.zarr' AS path FROM (SELECT unnest(range(1979, 1982)) AS y), (SELECT unnest(range(1, 13)) AS m), (SELECT unnest(['pr', 'tasmax']) AS v)")
def _(spark, sf):
    from ..sources.catalog import file_patterns

    return file_patterns(spark, 1979, 1981, ["pr", "tasmax"], "%d/%02d/data/%s.zarr")


@query("x05_run_configs", "WITH c AS (SELECT DISTINCT p_brand, p_size FROM part WHERE p_size < 4) SELECT p_brand, p_size, m AS method, '{\"method\":\"' || m || '\",\"model\":\"' || p_brand || '\",\"member\":' || p_size || '}' AS config FROM c, (SELECT unnest(['bcsd', 'gard']) AS m)")
def _(spark, sf):
    rows = table(spark, sf, "part").filter("p_size < 4").select("p_brand", "p_size").distinct()
    rows = rows.withColumn("method", F.explode(F.array(F.lit("bcsd"), F.lit("gard"))))
    return rows.withColumn("config", F.to_json(F.struct("method", F.col("p_brand").alias("model"), F.col("p_size").alias("member"))))
