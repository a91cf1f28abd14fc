"""Queries of selections, scalar functions and aggregations over the gridded views."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import aggregate as A
from ..operators import select as X
from ..params import BBox, TimePeriod
from ..sources import readers
from ..sources.cube import CELLS, CITIES, GCM, HOURLY, OBS, cells, cities, gcm, hourly, obs, table
from .registry import nudged, query, r6

CELL = A.CELL


@query(
    "a01_time_summary_month",
    f"WITH {OBS} SELECT date_trunc('month', time)::DATE AS time, lat_i, lon_i, sum(pr) AS pr, round(avg(tasmax) + 1e-8, 6) AS tasmax, round(avg(tasmin) + 1e-8, 6) AS tasmin FROM obs GROUP BY ALL",
)
def _(spark, sf):
    return A.time_summary(obs(spark, sf)).select("time", *CELL, "pr", r6(nudged("tasmax"), "tasmax"), r6(nudged("tasmin"), "tasmin"))


@query("a01_time_summary_year", f"WITH {OBS} SELECT date_trunc('year', time)::DATE AS time, lat_i, lon_i, sum(pr) AS pr, round(avg(tasmax) + 1e-8, 6) AS tasmax, round(avg(tasmin) + 1e-8, 6) AS tasmin FROM obs GROUP BY ALL")
def _(spark, sf):
    return A.time_summary(obs(spark, sf), "1AS").select("time", *CELL, "pr", r6(nudged("tasmax"), "tasmax"), r6(nudged("tasmin"), "tasmin"))


@query("a02_hourly_to_daily", f"WITH {HOURLY} SELECT ts::DATE AS time, cell, round(avg(value), 6) AS mean, max(value) AS high, min(value) AS low, round(sum(value::DECIMAL(18,4))::DOUBLE, 3) AS total FROM hourly GROUP BY ALL")
def _(spark, sf):
    rows = hourly(spark, sf).withColumn("dec", F.col("value").cast("decimal(18,4)"))
    out = A.to_daily(rows, {"mean": "mean:value", "high": "max:value", "low": "min:value", "total": "sum:dec"}, ["cell"])
    return out.select("time", "cell", r6("mean", "mean"), "high", "low", F.round(F.col("total").cast("double"), 3).alias("total"))


@query("a03_raw_model_month", f"WITH {GCM} SELECT date_trunc('month', time)::DATE AS time, lat_i, lon_i, round(sum((pr * 86400)::DECIMAL(30,2))::DOUBLE, 2) AS pr FROM gcm WHERE year(time) BETWEEN 1950 AND 2100 GROUP BY ALL")
def _(spark, sf):
    rows = gcm(spark, sf).filter(TimePeriod("1950", "2100").predicate()).withColumn("pr", S.flux_to_mm_day(F.col("pr")).cast("decimal(30,2)"))
    return rows.groupBy(F.trunc("time", "MM").alias("time"), *CELL).agg(F.round(F.sum("pr").cast("double"), 2).alias("pr"))


@query("a04_month_to_year", f"WITH {OBS}, m AS (SELECT date_trunc('month', time)::DATE AS time, lat_i, lon_i, sum(pr) AS pr FROM obs GROUP BY ALL) SELECT date_trunc('year', time)::DATE AS time, lat_i, lon_i, sum(pr) AS pr FROM m GROUP BY ALL")
def _(spark, sf):
    return A.time_summary(A.time_summary(obs(spark, sf).select("time", *CELL, "pr")), "YS")


@query("a05_monthly_climatology", f"WITH {OBS} SELECT month(time)::INT AS month, lat_i, lon_i, round(avg(pr), 6) AS pr FROM obs GROUP BY ALL")
def _(spark, sf):
    return A.climatology(obs(spark, sf), "month", ["pr"]).select("month", *CELL, r6("pr", "pr"))


@query("a06_day_climatology", f"WITH {OBS} SELECT dayofyear(time)::INT AS dayofyear, lat_i, lon_i, round(avg(pr), 6) AS pr FROM obs GROUP BY ALL")
def _(spark, sf):
    return A.climatology(obs(spark, sf), "dayofyear", ["pr"]).select("dayofyear", *CELL, r6("pr", "pr"))


_SEASON = "CASE WHEN month(time) IN (12, 1, 2) THEN 'DJF' WHEN month(time) IN (3, 4, 5) THEN 'MAM' WHEN month(time) IN (6, 7, 8) THEN 'JJA' ELSE 'SON' END"
for _how, _sql in {"mean": "round(avg(pr), 6)", "max": "max(pr)", "min": "min(pr)", "std": "round(stddev_pop(pr), 6)"}.items():

    @query(f"a07_seasonal_{_how}", f"WITH {OBS} SELECT {_SEASON} AS season, lat_i, lon_i, {_sql} AS pr FROM obs GROUP BY ALL")
    def _(spark, sf, how=_how):
        return A.climatology(obs(spark, sf), "season", ["pr"], aggregator=how).select("season", *CELL, r6("pr", "pr"))


for _side, _op in {"over": ">", "under": "<"}.items():

    @query(f"a08_days_{_side}", f"WITH {OBS}, y AS (SELECT year(time) AS y, lat_i, lon_i, count(*) FILTER (tasmax {_op} 50000) AS n FROM obs GROUP BY ALL) SELECT lat_i, lon_i, round(avg(n), 6) AS days FROM y GROUP BY ALL")
    def _(spark, sf, side=_side):
        return A.days_over(obs(spark, sf), "tasmax", 50000, side).select(*CELL, r6("days", "days"))


for _name, _sql in {"mean": "avg(pr)", "median": "median(pr)", "std": "stddev_pop(pr)", "percentile5": "quantile_cont(pr, 0.05)", "percentile99": "quantile_cont(pr, 0.99)"}.items():

    @query(f"a09_{_name}", f"WITH {OBS} SELECT lat_i, lon_i, round({_sql}, 6) AS {_name} FROM obs GROUP BY ALL")
    def _(spark, sf, name=_name):
        return A.metric_calc(obs(spark, sf), name, "pr").select(*CELL, r6(name, name))


@query("a09_skipna_false", f"WITH {OBS}, g AS (SELECT lat_i, lon_i, CASE WHEN pr <= 45 THEN pr END AS pr FROM obs) SELECT lat_i, lon_i, round(CASE WHEN count(*) = count(pr) THEN avg(pr) END, 6) AS mean FROM g GROUP BY ALL")
def _(spark, sf):
    return A.metric_calc(obs(spark, sf).withColumn("pr", F.when(F.col("pr") <= 45, F.col("pr"))), "mean", "pr").select(*CELL, r6("mean", "mean"))


@query("a10_wet_day_mean", f"WITH {OBS} SELECT lat_i, lon_i, round(avg(pr) FILTER (pr > 10), 6) AS mean FROM obs GROUP BY ALL")
def _(spark, sf):
    return A.wet_day_amount(obs(spark, sf), "mean", threshold=10).select(*CELL, r6("mean", "mean"))


@query("a10_wet_day_percentile95", f"WITH {OBS} SELECT lat_i, lon_i, round(quantile_cont(pr, 0.95) FILTER (pr > 10), 6) AS percentile95 FROM obs GROUP BY ALL")
def _(spark, sf):
    return A.wet_day_amount(obs(spark, sf), "percentile95", threshold=10).select(*CELL, r6("percentile95", "percentile95"))


for _kind, _v in {"wet": "pr > 20", "dry": "NOT (pr > 20)"}.items():

    @query(
        f"a11_p_{_kind}_{_kind}",
        f"""WITH {OBS}, v AS (SELECT lat_i, lon_i, time, {_v} AS v FROM obs),
        y AS (SELECT *, coalesce(lag(v) OVER c, last_value(v) OVER (PARTITION BY lat_i, lon_i ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS y FROM v WINDOW c AS (PARTITION BY lat_i, lon_i ORDER BY time))
        SELECT lat_i, lon_i, round(avg(v::INT::DOUBLE) FILTER (y), 6) AS probability FROM y GROUP BY ALL""",
    )
    def _(spark, sf, kind=_kind):
        return A.probability_two_days(obs(spark, sf), kind, threshold=20).select(*CELL, r6("probability", "probability"))


@query("a12_p_wet", f"WITH {OBS} SELECT lat_i, lon_i, round(avg((pr > 20)::INT::DOUBLE), 6) AS probability FROM obs GROUP BY ALL")
def _(spark, sf):
    return A.probability_wet(obs(spark, sf), threshold=20).select(*CELL, r6("probability", "probability"))


for _name, _sql in {"mean": "avg(n)", "std": "stddev_pop(n)", "percentile90": "quantile_cont(n, 0.9)"}.items():

    @query(
        f"a13_spell_{_name}",
        f"""WITH {OBS}, v AS (SELECT lat_i, lon_i, pr > 20 AS o, row_number() OVER (PARTITION BY lat_i, lon_i ORDER BY time) AS i FROM obs),
        g AS (SELECT lat_i, lon_i, i - row_number() OVER (PARTITION BY lat_i, lon_i ORDER BY i) AS g FROM v WHERE o),
        r AS (SELECT lat_i, lon_i, g, count(*)::DOUBLE AS n FROM g GROUP BY ALL)
        SELECT c.lat_i, c.lon_i, round(x, 6) AS {_name} FROM (SELECT DISTINCT lat_i, lon_i FROM obs) c LEFT JOIN (SELECT lat_i, lon_i, {_sql} AS x FROM r GROUP BY ALL) s ON c.lat_i = s.lat_i AND c.lon_i = s.lon_i""",
    )
    def _(spark, sf, name=_name):
        return A.spell_length(obs(spark, sf), F.col("pr") > 20, name).select(*CELL, r6(name, name))


@query("a14_monthly_variability", f"WITH {OBS}, m AS (SELECT date_trunc('month', time) AS m, lat_i, lon_i, sum(pr) AS x FROM obs GROUP BY ALL) SELECT lat_i, lon_i, round(stddev_pop(x), 6) AS std FROM m GROUP BY ALL")
def _(spark, sf):
    return A.monthly_variability(obs(spark, sf)).select(*CELL, r6("std", "std"))


@query("a15_weighted_mean", f"WITH {OBS} SELECT lat_i, lon_i, round(sum(pr * day(last_day(time))) / sum(day(last_day(time))), 6) AS mean FROM obs GROUP BY ALL")
def _(spark, sf):
    return A.weighted_mean(obs(spark, sf), "pr").select(*CELL, r6("mean", "mean"))


_CHANGE = {"mean": "avg(pr)", "std": "stddev_pop(pr)", "percentile5": "quantile_cont(pr, 0.05)", "percentile95": "quantile_cont(pr, 0.95)"}


@query("a16_change", f"WITH {OBS} SELECT lat_i, lon_i, " + ", ".join(f"round({s} FILTER (year(time) BETWEEN 1999 AND 2001) - {s} FILTER (year(time) BETWEEN 1995 AND 1998), 6) + 0.0::DOUBLE AS {n}" for n, s in _CHANGE.items()) + " FROM obs WHERE year(time) BETWEEN 1995 AND 2001 GROUP BY ALL")
def _(spark, sf):
    out = A.change(obs(spark, sf), "pr", TimePeriod("1995", "1998").predicate(), TimePeriod("1999", "2001").predicate(), list(_CHANGE))
    return out.select(*CELL, *[(r6(c) + F.lit(0.0)).alias(c) for c in _CHANGE])


@query(
    "a17_qaqc",
    f"""WITH {OBS}, b AS (SELECT year(time)::INT AS year, lat_i, lon_i, (pr IS NULL)::INT AS nulls, (pr > 40)::INT AS high FROM obs),
    g AS (SELECT year, lat_i, lon_i, sum(nulls)::BIGINT AS nulls, sum(high)::BIGINT AS aphysical FROM b GROUP BY GROUPING SETS ((year), (lat_i, lon_i)))
    SELECT year, lat_i, lon_i, 'nulls' AS qaqc_check, nulls AS n FROM g UNION ALL SELECT year, lat_i, lon_i, 'aphysical_high_precip', aphysical FROM g""",
)
def _(spark, sf):
    return A.qaqc(obs(spark, sf).withColumn("pr", F.col("pr") + F.lit(2960.0)), "pr", ["nulls", "aphysical_high_precip"])


@query("a18_spatial_normalize", f"WITH {OBS} SELECT time, lat_i, lon_i, round((pr - avg(pr) OVER t) / (stddev_pop(pr) OVER t + 1e-6), 6) AS pr FROM obs WINDOW t AS (PARTITION BY time)")
def _(spark, sf):
    return A.normalize(obs(spark, sf), "pr").select("time", *CELL, r6("pr", "pr"))


@query("a19_z_score", f"WITH {OBS}, h AS (SELECT lat_i, lon_i, avg(pr) AS m, stddev_pop(pr) AS s FROM obs WHERE year(time) <= 1998 GROUP BY ALL) SELECT time, lat_i, lon_i, round((pr - m) / (s + 1e-6), 6) AS pr FROM obs JOIN h USING (lat_i, lon_i) WHERE year(time) > 1998")
def _(spark, sf):
    o = obs(spark, sf)
    return A.z_score_against(o.filter(F.year("time") > 1998), o.filter(F.year("time") <= 1998), "pr").select("time", *CELL, r6("pr", "pr"))


@query("a19_rescale", f"WITH {OBS}, h AS (SELECT lat_i, lon_i, avg(pr) AS m, stddev_pop(pr) AS s FROM obs GROUP BY ALL) SELECT time, lat_i, lon_i, round(greatest((tasmin - 20000) / 40000 * (s + 1e-6) + m, 0), 6) AS pr FROM obs o JOIN h USING (lat_i, lon_i)")
def _(spark, sf):
    o = obs(spark, sf)
    scores = o.select("time", *CELL, ((F.col("tasmin") - 20000) / 40000).alias("pr"))
    return A.rescale(scores, o, "pr", floor=0.0).select("time", *CELL, r6("pr", "pr"))


@query("a20_first_store", "SELECT p_brand, p_partkey, p_type FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_type, p_partkey) = 1")
def _(spark, sf):
    return A.first_of(table(spark, sf, "part"), ["p_brand"], [F.col("p_type"), F.col("p_partkey")]).select("p_brand", "p_partkey", "p_type")


@query("a21_distinct_counts", "SELECT p_brand, count(DISTINCT p_type) AS n_types, count(DISTINCT p_size) AS n_sizes FROM part GROUP BY ALL")
def _(spark, sf):
    return table(spark, sf, "part").groupBy("p_brand").agg(F.count_distinct("p_type").alias("n_types"), F.count_distinct("p_size").alias("n_sizes"))


@query("a22_keep_last", "SELECT p_brand, p_type, p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey DESC) = 1")
def _(spark, sf):
    return A.first_of(table(spark, sf, "part"), ["p_brand", "p_type"], [F.desc("p_partkey")]).select("p_brand", "p_type", "p_partkey")


@query("a23_latest_version", "WITH v AS (SELECT p_partkey, p_brand, p_partkey % 3 AS a, p_size % 12 AS b FROM part) SELECT p_brand, a || '.' || b || '.0' AS version, p_partkey FROM v QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY a DESC, b DESC, p_partkey) = 1")
def _(spark, sf):
    v = F.format_string("%d.%d.0", F.col("p_partkey") % 3, F.col("p_size") % 12)
    rows = table(spark, sf, "part").select("p_partkey", "p_brand", v.alias("version"))
    return A.first_of(rows, ["p_brand"], [F.desc(S.semver(F.col("version"))), F.col("p_partkey")]).select("p_brand", "version", "p_partkey")


@query("a24_ecdf", f"WITH {OBS}, c AS (SELECT month(time)::INT AS month, pr, cume_dist() OVER (PARTITION BY month(time) ORDER BY pr) AS share FROM obs) SELECT DISTINCT month, pr, round(share, 6) AS share FROM c")
def _(spark, sf):
    return A.empirical_cdf(obs(spark, sf).withColumn("month", F.month("time")), "pr", ["month"]).select("month", "pr", r6("share", "share"))


@query("a24_histogram", f"WITH {OBS} SELECT CASE WHEN pr < 0 THEN 0 WHEN pr >= 60 THEN 13 ELSE floor(pr / 5)::BIGINT + 1 END AS bin, count(*) AS n FROM obs GROUP BY ALL")
def _(spark, sf):
    return A.histogram(obs(spark, sf), "pr", 0, 60, 12)


@query("a25_audit", f"WITH {OBS} SELECT lat_i, lon_i, count(*) FILTER (pr IS NULL) AS pr_null, count(*) FILTER (pr < 0) AS pr_negative, count(*) FILTER (pr = 0) AS pr_zero FROM (SELECT lat_i, lon_i, CASE WHEN pr <> 7 THEN pr - 10 END AS pr FROM obs) GROUP BY ALL")
def _(spark, sf):
    return A.audit(obs(spark, sf).withColumn("pr", F.when(F.col("pr") != 7, F.col("pr") - 10)), ["pr"])


@query("a26_ensemble", f"WITH {OBS}, {GCM}, a AS (SELECT time, avg(pr) AS obs FROM obs GROUP BY ALL), b AS (SELECT time, avg(pr) AS gcm FROM gcm GROUP BY ALL) SELECT time, round(obs + 1e-8, 6) AS obs, round(gcm + 1e-6, 4) AS gcm FROM a FULL JOIN b USING (time)")
def _(spark, sf):
    return A.ensemble({"obs": obs(spark, sf), "gcm": gcm(spark, sf)}, "pr").select("time", r6(nudged("obs"), "obs"), F.round(F.col("gcm") + F.lit(1e-6), 4).alias("gcm"))


@query("a27_period_mean", f"WITH {OBS} SELECT lat_i, lon_i, round(avg(tasmax) + 1e-8, 6) AS tasmax FROM obs WHERE time BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' GROUP BY ALL")
def _(spark, sf):
    return A.spatial_mean(obs(spark, sf).filter(TimePeriod("1996", "1997").predicate()), ["tasmax"], CELL).select(*CELL, r6(nudged("tasmax"), "tasmax"))


@query("a28_variogram", f"WITH {OBS}, l AS (SELECT unnest(range(1, 5))::INT AS lag) SELECT lag, round(avg((a.pr - b.pr) * (a.pr - b.pr)) / 2, 6) AS gamma, count(*) AS n FROM obs a, l, obs b WHERE b.time = a.time AND b.lat_i = a.lat_i AND b.lon_i = a.lon_i + lag GROUP BY ALL")
def _(spark, sf):
    return A.variogram(obs(spark, sf), "pr", "lon_i", 4, ["time", "lat_i"]).select("lag", r6("gamma", "gamma"), "n")


@query("a29_coarsen_time", f"WITH {OBS}, i AS (SELECT *, (row_number() OVER (PARTITION BY lat_i, lon_i ORDER BY time) - 1) // 30 AS block FROM obs) SELECT lat_i, lon_i, block::BIGINT AS block, round(avg(pr), 6) AS mean, min(pr) AS min, max(pr) AS max FROM i GROUP BY lat_i, lon_i, block HAVING count(*) = 30")
def _(spark, sf):
    return A.coarsen_steps(obs(spark, sf), "pr", 30, "trim").select(*CELL, "block", r6("mean", "mean"), "min", "max")


@query("a30_extremes", f"WITH {OBS} SELECT time, min(pr) AS low, max(pr) AS high, count(*) FILTER (pr = 25) AS n_exact, bool_and(isfinite(pr)) AS finite FROM obs GROUP BY ALL")
def _(spark, sf):
    return A.extremes(obs(spark, sf), "pr", 25)


# ---------------------------------------------------------------- selections


@query("p01_box", f"WITH {OBS} SELECT time, lat_i, lon_i, pr FROM obs WHERE lat_i BETWEEN 1 AND 3 AND lon_i BETWEEN 0 AND 2 AND time BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'")
def _(spark, sf):
    return obs(spark, sf).filter(BBox(1, 3, 0, 2).predicate(*CELL) & TimePeriod("1996", "1997").predicate()).select("time", *CELL, "pr")


@query("p05_nearest_level", "SELECT DISTINCT p_brand, first_value(p_size) OVER (PARTITION BY p_brand ORDER BY abs(p_size - 23.4), p_size) AS size FROM part")
def _(spark, sf):
    rows = table(spark, sf, "part").select("p_brand", F.col("p_size").alias("plev"), F.col("p_size").alias("size"))
    return readers.level_of(rows, 23.4, "plev", ["p_brand"])


@query("p06_nearest_city", f"WITH {CITIES}, {OBS}, g AS (SELECT DISTINCT lat_i FROM obs), h AS (SELECT DISTINCT lon_i FROM obs) SELECT city, (SELECT lat_i FROM g ORDER BY abs(lat_i - lat), lat_i LIMIT 1) AS lat_i, (SELECT lon_i FROM h ORDER BY abs(lon_i - lon), lon_i LIMIT 1) AS lon_i FROM cities WHERE population > 5000")
def _(spark, sf):
    from ..operators.grid import nearest_points

    o = obs(spark, sf)
    axis = lambda c: o.select(c).distinct().select(F.col(c).alias("index"), F.col(c).cast("double").alias("position"))
    return nearest_points(cities(spark, sf).filter("population > 5000"), axis("lat_i"), axis("lon_i")).select("city", *CELL)


@query("p07_first_and_last", f"WITH {OBS} SELECT lat_i, lon_i, arg_min(pr, time) AS first, arg_max(pr, time) AS last FROM obs GROUP BY ALL")
def _(spark, sf):
    return obs(spark, sf).groupBy(*CELL).agg(F.min_by("pr", "time").alias("first"), F.max_by("pr", "time").alias("last"))


@query("p08_day_membership", f"WITH {OBS} SELECT time, lat_i, lon_i, pr FROM obs WHERE dayofyear(time) IN (1, 15, 60, 366)")
def _(spark, sf):
    return X.days_of_year(obs(spark, sf), [1, 15, 60, 366]).select("time", *CELL, "pr")


@query("p09_land_mask", f"WITH {OBS}, {CELLS} SELECT time, lat_i, lon_i, CASE WHEN is_land THEN pr END AS pr FROM obs LEFT JOIN cells USING (lat_i, lon_i)")
def _(spark, sf):
    return X.mask_land(obs(spark, sf), cells(spark, sf), ["pr"]).select("time", *CELL, "pr")


@query("p10_regions", f"WITH {OBS}, {CELLS} SELECT region_id, time, lat_i, lon_i, pr FROM obs JOIN cells USING (lat_i, lon_i) WHERE region_id < 3")
def _(spark, sf):
    return X.with_regions(obs(spark, sf), cells(spark, sf), last=2).select("region_id", "time", *CELL, "pr")


for _check, _sql in {"nulls": "pr IS NULL", "aphysical_high_temp": "pr > 353", "aphysical_low_temp": "pr < 0", "aphysical_low_precip": "pr < 0", "aphysical_high_precip": "pr > 3000"}.items():

    @query(f"p12_{_check}", f"WITH {OBS}, x AS (SELECT time, lat_i, lon_i, CASE WHEN pr <> 7 THEN (pr - 5) * 90 END AS pr FROM obs) SELECT time, lat_i, lon_i, coalesce({_sql}, false) AS bad FROM x")
    def _(spark, sf, check=_check):
        x = F.when(F.col("pr") != 7, (F.col("pr") - 5) * 90)
        return obs(spark, sf).select("time", *CELL, A.is_bad(x, check).alias("bad"))


@query("p13_valid_cells", f"WITH {OBS}, {CELLS}, l AS (SELECT lat_i, lon_i, arg_max(CASE WHEN pr > 5 THEN pr ELSE -1 END, time) AS p FROM obs GROUP BY ALL) SELECT lat_i, lon_i FROM l JOIN cells USING (lat_i, lon_i) WHERE is_land AND p > 0")
def _(spark, sf):
    from ..operators.water import valid_cells

    rows = obs(spark, sf).join(cells(spark, sf), list(CELL)).select("time", *CELL, F.col("is_land").cast("int").alias("mask"), F.lit(100.0).alias("awc"), F.col("elev").alias("elevation"), F.when(F.col("pr") > 5, F.col("pr")).alias("ppt"))
    return valid_cells(rows)


@query("p14_wet_days", f"WITH {OBS} SELECT time, lat_i, lon_i, coalesce(CASE WHEN pr <> 7 THEN pr END > 20, false) AS wet FROM obs")
def _(spark, sf):
    return obs(spark, sf).select("time", *CELL, A.is_wet(F.when(F.col("pr") != 7, F.col("pr")), 20).alias("wet"))


@query("p16_version_range", "SELECT p_partkey, a || '.' || b AS version FROM (SELECT p_partkey, p_partkey % 3 AS a, p_size % 12 AS b FROM part) WHERE (a * 100 + b) BETWEEN 9 AND 201")
def _(spark, sf):
    v = F.format_string("%d.%d", F.col("p_partkey") % 3, F.col("p_size") % 12)
    rows = table(spark, sf, "part").select("p_partkey", v.alias("version"))
    return rows.filter((S.semver(F.col("version")) >= F.array(F.lit(0), F.lit(9))) & (S.semver(F.col("version")) <= F.array(F.lit(2), F.lit(1))))


@query("o01_sorted_keys", "SELECT p_brand, row_number() OVER (ORDER BY p_brand)::INT AS at FROM (SELECT DISTINCT p_brand FROM part)")
def _(spark, sf):
    # A handful of catalogue keys: one task may number them.
    return table(spark, sf, "part").select("p_brand").distinct().withColumn("at", F.row_number().over(Window.orderBy("p_brand")))


@query("o02_big_cities", f"WITH {CITIES}, t AS (SELECT city, country, population FROM cities QUALIFY row_number() OVER (PARTITION BY country ORDER BY population DESC, city) = 1), n AS (SELECT * FROM t ORDER BY population DESC, city LIMIT 10) SELECT * FROM n UNION ALL SELECT city, country, population FROM cities WHERE city IN ('Customer#000000007', 'Customer#000000011') AND city NOT IN (SELECT city FROM n)")
def _(spark, sf):
    c = cities(spark, sf).select("city", "country", "population")
    return X.largest(c, ["country"], [F.desc("population"), F.col("city")], 10, "city", ["Customer#000000007", "Customer#000000011"])


@query("o04_key_slice", "SELECT p_type FROM (SELECT p_type, row_number() OVER (ORDER BY p_type) AS i FROM (SELECT DISTINCT p_type FROM part)) WHERE i BETWEEN 3 AND 7")
def _(spark, sf):
    rows = table(spark, sf, "part").select("p_type").distinct().withColumn("i", F.row_number().over(Window.orderBy("p_type")))
    return rows.filter(F.col("i").between(3, 7)).select("p_type")


@query("o05_sample", f"WITH {OBS} SELECT time, lat_i, lon_i, pr FROM obs WHERE substr(md5('7|' || time::VARCHAR || '|' || lat_i || '|' || lon_i), 1, 7) < '1999999'")
def _(spark, sf):
    return X.sample(obs(spark, sf), 0.1, ["time", *CELL], 7).select("time", *CELL, "pr")
