"""Queries of the remaining sources, sinks, layouts and small operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import aggregate as A
from ..operators import calendar as C
from ..operators import grid as G
from ..operators import select as X
from ..sources import catalog, readers, sinks
from ..sources.cube import CELLS, CITIES, GCM, OBS, WIDTH, cells, cities, gcm, grid_width, obs, table, tasks
from .grids import _LINEAR
from .models import _scratch
from .registry import query, r6

CELL = A.CELL


@query("s02_many_stores", f"WITH {OBS} SELECT time, lat_i, lon_i, pr, CASE WHEN year(time) > 1996 THEN tasmax END AS tasmax FROM obs WHERE year(time) IN (1996, 1997)")
def _(spark, sf):
    path, o = _scratch(spark), obs(spark, sf)
    a = sinks.write(o.filter("year(time) = 1996").select("time", *CELL, "pr"), path + "/a")
    b = sinks.write(o.filter("year(time) = 1997").select("time", *CELL, "pr", "tasmax"), path + "/b")
    return readers.scan_many(spark, [a, b])


@query("s04_scenario_activity", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'CMIP' ELSE 'ScenarioMIP' END AS activity FROM part")
def _(spark, sf):
    scenario = F.when(F.col("p_size") % 2 == 0, "historical").otherwise("ssp245")
    return table(spark, sf, "part").select("p_partkey", catalog.activity_of(scenario).alias("activity"))


@query("s05_reanalysis", f"WITH {OBS}, {GCM} SELECT o.time, o.lat_i::DOUBLE AS lat, CASE WHEN o.lon_i * 60.0 < 180 THEN o.lon_i * 60.0::DOUBLE ELSE o.lon_i * 60.0::DOUBLE - 360 END AS lon, o.pr * 86400.0::DOUBLE AS pr, g.pr AS ua FROM obs o LEFT JOIN gcm g USING (time, lat_i, lon_i) WHERE year(o.time) BETWEEN 1996 AND 1997")
def _(spark, sf):
    at = [F.col("lat_i").cast("double").alias("lat"), (F.col("lon_i") * F.lit(60.0)).alias("lon")]
    fields, winds = obs(spark, sf).select("time", *at, "pr"), gcm(spark, sf).select("time", *at, F.col("pr").alias("ua"))
    return readers.open_reanalysis(fields, winds, 1996, 1997)


@query("s06_assets", "SELECT p_brand || '.' || p_size || '.' || p_type AS key, min(p_name) AS zstore FROM part WHERE p_size < 6 GROUP BY ALL")
def _(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("source_id"), F.col("p_size").cast("string").alias("member_id"), F.col("p_type").alias("experiment_id"), F.col("p_name").alias("zstore"))
    return catalog.assets(p, member_id=["1", "2", "3", "4", "5"])


@query("s07_csv_round_trip", f"WITH {CITIES} SELECT city, country, population, lat, lon FROM cities")
def _(spark, sf):
    path = sinks.export_csv(cities(spark, sf), _scratch(spark) + "/cities", single=True)
    return readers.read_csv(spark, path, "city string, country string, population double, lat double, lon double")


@query("s08_json_round_trip", "SELECT r_regionkey::BIGINT AS r_regionkey, r_name FROM region")
def _(spark, sf):
    path = sinks.export_json(table(spark, sf, "region"), _scratch(spark) + "/regions")
    return readers.read_json(spark, path, "r_regionkey bigint, r_name string", multi_line=False)


@query("s10_pyramid_level", f"WITH {OBS} SELECT time, (lat_i // 2)::INT AS y, (lon_i // 2)::INT AS x, round(avg(pr), 6) AS pr FROM obs GROUP BY time, lat_i // 2, lon_i // 2")
def _(spark, sf):
    path = sinks.write_pyramid(G.pyramid(obs(spark, sf), 3, "pr", tile=2, tasks=tasks(spark, sf, "lineitem")), _scratch(spark) + "/pyramid")
    return readers.read_level(spark, path, 1).select("time", "y", "x", r6("pr", "pr"))


@query("s12_elevation", f"WITH {CELLS} SELECT lat_i, lon_i, elev FROM cells")
def _(spark, sf):
    return cells(spark, sf).select(*CELL, "elev")


@query("k03_append_variables", f"WITH {OBS} SELECT time, lat_i, lon_i, pr, tasmax, tasmin FROM obs")
def _(spark, sf):
    o = obs(spark, sf)
    return sinks.combine_variables([o.select("time", *CELL, v) for v in ("pr", "tasmax", "tasmin")], ["time", *CELL])


@query("k04_blank_grid", f"WITH {CELLS} SELECT lat_i, lon_i, NULL::DOUBLE AS pr FROM cells")
def _(spark, sf):
    return sinks.blank(cells(spark, sf).select(*CELL), ["pr"])


@query("p03_rename", f"WITH {OBS} SELECT time AS day, lat_i, lon_i, pr AS precipitation FROM obs")
def _(spark, sf):
    return obs(spark, sf).drop("tasmax", "tasmin").withColumnsRenamed({"time": "day", "pr": "precipitation"})


@query("p15_patch_filter", f"WITH {OBS}, o AS (SELECT y, x FROM (SELECT unnest(range(0, {WIDTH} - 3 + 1, 3)) AS y), (SELECT unnest(range(0, {WIDTH} - 3 + 1, 3)) AS x)), m AS (SELECT lat_i, lon_i, sum(pr - 24) AS v FROM obs GROUP BY ALL) SELECT y::INT AS y0, x::INT AS x0, count(*) AS n FROM m JOIN o ON lat_i BETWEEN y AND y + 2 AND lon_i BETWEEN x AND x + 2 GROUP BY ALL HAVING count(*) = 9 AND count(*) FILTER (abs(v) < 600) <= 0.7 * 9")
def _(spark, sf):
    w = grid_width(spark, sf)
    sums = obs(spark, sf).groupBy(*CELL).agg(F.sum(F.col("pr") - 24).alias("v"))
    out = G.patches(sums, "v", 3, 3, w, w, keys=())
    return out.filter(G.patch_is_usable("patch", flat=600)).select("y0", "x0", F.size("patch").cast("bigint").alias("n"))


@query("j03_training_days", f"WITH {OBS}, {GCM} SELECT o.time, lat_i, lon_i, o.pr AS y, g.pr AS x FROM obs o JOIN gcm g USING (time, lat_i, lon_i) WHERE year(o.time) < 1999")
def _(spark, sf):
    o = obs(spark, sf).filter(F.year("time") < 1999).select("time", *CELL, F.col("pr").alias("y"))
    return o.join(gcm(spark, sf).withColumnRenamed("pr", "x"), ["time", *CELL])


@query("j06_city_series", f"WITH {CITIES}, {OBS}, g AS (SELECT DISTINCT lat_i FROM obs), h AS (SELECT DISTINCT lon_i FROM obs), n AS (SELECT city, (SELECT lat_i FROM g ORDER BY abs(lat_i - lat), lat_i LIMIT 1) AS lat_i, (SELECT lon_i FROM h ORDER BY abs(lon_i - lon), lon_i LIMIT 1) AS lon_i FROM cities WHERE population > 9500) SELECT city, time, pr FROM n JOIN obs USING (lat_i, lon_i)")
def _(spark, sf):
    o = obs(spark, sf)
    axis = lambda c: o.select(c).distinct().select(F.col(c).alias("index"), F.col(c).cast("double").alias("position"))
    points = G.nearest_points(cities(spark, sf).filter("population > 9500"), axis("lat_i"), axis("lon_i"))
    return o.join(points.select("city", *CELL), list(CELL)).select("city", "time", "pr")


@query("j09_grid_semi_join", f"WITH {OBS}, {GCM} SELECT time, lat_i, lon_i, pr FROM obs WHERE (time, lat_i, lon_i) IN (SELECT time, lat_i, lon_i FROM gcm)")
def _(spark, sf):
    return obs(spark, sf).select("time", *CELL, "pr").join(gcm(spark, sf), ["time", *CELL], "left_semi")


@query("f03_postprocess", f"WITH {OBS} SELECT time, lat_i::DOUBLE AS lat, CASE WHEN lon_i * 40.0 < 180 THEN lon_i * 40.0::DOUBLE ELSE lon_i * 40.0::DOUBLE - 360 END AS lon, pr FROM obs")
def _(spark, sf):
    t = F.col("time")
    raw = obs(spark, sf).select(F.year(t).alias("year"), F.month(t).alias("month"), F.dayofmonth(t).alias("day"), F.col("lat_i").cast("double").alias("lat"), (F.col("lon_i") * F.lit(40.0)).alias("lon"), "pr", F.lit(2.0).alias("height"))
    return C.postprocess(raw, "standard", ["pr"]).select("time", "lat", "lon", "pr")


@query("f24_licenses", "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'CC-BY-4.0' WHEN 1 THEN 'CC-BY-SA-4.0' ELSE 'CC-BY-4.0' END AS license, CASE p_size % 3 WHEN 1 THEN 'https://creativecommons.org/licenses/by-sa/4.0/' ELSE 'https://creativecommons.org/licenses/by/4.0/' END AS license_url FROM part")
def _(spark, sf):
    licences = spark.createDataFrame([("0", "CC0-1.0"), ("1", "CC-BY-SA-4.0"), ("2", "CC-BY-4.0")], "source_id string, license string")
    p = table(spark, sf, "part").select("p_partkey", (F.col("p_size") % 3).cast("string").alias("source_id"))
    return catalog.with_license(p, licences, derived=True).select("p_partkey", "license", "license_url")


@query("f28_by_month", f"WITH {OBS} SELECT month(time)::INT AS month, count(*) AS n FROM obs GROUP BY ALL")
def _(spark, sf):
    return obs(spark, sf).groupBy(F.month("time").alias("month")).agg(F.count("*").alias("n"))


@query("f30_starting_resolution", "SELECT p_brand, round(least(min(round(p_size / 7.0::DOUBLE, 2)), min(round(p_retailprice / 1000, 2))), 2) AS res FROM part GROUP BY ALL")
def _(spark, sf):
    return X.starting_resolution(table(spark, sf, "part"), [F.col("p_size") / F.lit(7.0), F.col("p_retailprice") / 1000], ["p_brand"])


@query("w03_yearly_rolling", f"WITH {OBS} SELECT time, lat_i, lon_i, round(avg(pr) OVER (PARTITION BY lat_i, lon_i, dayofyear(time) ORDER BY year(time) ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS pr FROM obs")
def _(spark, sf):
    rows = obs(spark, sf).withColumn("doy", F.dayofyear("time")).withColumn("year", F.year("time"))
    return C.rolling_mean(rows, "pr", 3, "m", [*CELL, "doy"], "year", min_periods=1).select("time", *CELL, r6("m", "pr"))


@query("w07_roll_by_one", f"WITH {OBS} SELECT time, lat_i, lon_i, coalesce(lag(pr) OVER (PARTITION BY lat_i, lon_i ORDER BY time), last_value(pr) OVER (PARTITION BY lat_i, lon_i ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS pr FROM obs")
def _(spark, sf):
    return X.rolled(obs(spark, sf).select("time", *CELL, "pr"), "pr")


@query("w11_rank_positions", f"WITH {OBS} SELECT time, lat_i, lon_i, round((row_number() OVER (PARTITION BY lat_i, lon_i ORDER BY pr, time) - 0.4::DOUBLE) / (count(*) OVER (PARTITION BY lat_i, lon_i) + 0.2::DOUBLE), 6) AS position FROM obs")
def _(spark, sf):
    return X.rank_positions(obs(spark, sf), "pr").select("time", *CELL, r6("position", "position"))


@query("u02_union_checks", f"WITH {OBS} SELECT time, lat_i, lon_i, 'high' AS qaqc_check, pr > 40 AS bad FROM obs UNION ALL SELECT time, lat_i, lon_i, 'low', pr < 5 FROM obs")
def _(spark, sf):
    checks = F.explode(F.create_map(F.lit("high"), F.col("pr") > 40, F.lit("low"), F.col("pr") < 5)).alias("qaqc_check", "bad")
    return obs(spark, sf).select("time", *CELL, checks)


@query("r02_bilinear_double", f"WITH {GCM}, {_LINEAR} SELECT time, a.dst AS lat_i, round(sum(a.w * pr) / sum(a.w) + 1e-6, 4) AS pr FROM (SELECT time, lat_i, avg(pr) AS pr FROM gcm GROUP BY ALL) JOIN lin a ON a.src = lat_i GROUP BY ALL")
def _(spark, sf):
    w = grid_width(spark, sf)
    lin = G.linear_axis_weights([2 * i + 0.5 for i in range(w // 2)], list(range(w)))
    zonal = gcm(spark, sf).groupBy("time", "lat_i").agg(F.avg("pr").alias("pr")).withColumn("lon_i", F.lit(0))
    return G.regrid(zonal, G.weights(spark, lin, [(0, 0, 1.0)]), ["pr"]).select("time", "lat_i", F.round(F.col("pr") + F.lit(1e-6), 4).alias("pr"))


_GLOBAL = "(SELECT i AS dst, greatest(0, least(h - 1, (({low} + (i + 0.5::DOUBLE) * 15) - ({low} + {span} / 2.0::DOUBLE / h)) / ({span}::DOUBLE / h))) AS p FROM (SELECT unnest(range(0, {n})) AS i), n)"
_ALONG = "SELECT dst::INT AS dst, floor(p)::INT AS src, 1 - (p - floor(p)) AS w FROM {0} UNION ALL SELECT dst::INT, floor(p)::INT + 1, p - floor(p) FROM {0} WHERE p > floor(p)"


@query("r02_bilinear_global", f"""WITH {GCM}, n AS (SELECT {WIDTH} // 2 AS h), y AS ({_ALONG.format(_GLOBAL.format(low=-90, span=180, n=12))}), x AS ({_ALONG.format(_GLOBAL.format(low=-180, span=360, n=24))})
SELECT time, y.dst AS lat_i, x.dst AS lon_i, round(sum(y.w * x.w * pr) / sum(y.w * x.w) + 1e-6, 4) AS pr FROM gcm JOIN y ON y.src = lat_i JOIN x ON x.src = lon_i WHERE y.w * x.w > 0 GROUP BY ALL""")
def _(spark, sf):
    """Both axes onto cells of fifteen degrees; the model's grid covers the globe."""
    h = grid_width(spark, sf) // 2
    lats, lons = [-90 + 180 / h * (i + 0.5) for i in range(h)], [-180 + 360 / h * (i + 0.5) for i in range(h)]
    return G.to_global(gcm(spark, sf), lats, lons, 15.0, ["pr"]).select("time", *CELL, F.round(F.col("pr") + F.lit(1e-6), 4).alias("pr"))


_RUNS_SQL = "SELECT 'CMIP.X.' || replace(p_brand, '.', '') || '.ssp245.r1.day.' || p_type || CASE WHEN p_size % 9 = 0 THEN '' ELSE '.pr' END AS name, '0.' || p_size % 11 || '.' || p_partkey % 13 || CASE WHEN p_partkey % 10 = 0 THEN '+local' ELSE '' END AS version, CASE WHEN p_partkey % 17 > 0 THEN 'az://pyramids/' || p_partkey END AS pyramid, 'az://daily/' || p_partkey AS daily, p_partkey, p_size % 11 AS minor, p_partkey % 13 AS patch FROM part"


@query("x04_web_catalog", f"""WITH r AS ({_RUNS_SQL}), k AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY minor DESC, patch DESC, pyramid DESC) AS n FROM r WHERE version NOT LIKE '%+%' AND minor >= 2 AND minor <= 9)
SELECT name, version FROM k WHERE n = 1 AND name LIKE '%.pr' AND len(string_split(name, '.')) = 8 AND (SELECT count(*) FROM k o WHERE o.name = k.name AND o.minor = k.minor AND o.patch = k.patch AND o.pyramid IS NULL) = 0""")
def _(spark, sf):
    """Names with the versions that are shown; of runs with one version any may be, so addresses are left to the tests."""
    p = table(spark, sf, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    name = F.concat(F.lit("CMIP.X."), F.regexp_replace("p_brand", r"\.", ""), F.lit(".ssp245.r1.day."), "p_type", F.when(size % 9 == 0, "").otherwise(".pr"))
    version = F.concat(F.lit("0."), (size % 11).cast("string"), F.lit("."), (key % 13).cast("string"), F.when(key % 10 == 0, "+local").otherwise(""))
    runs = p.select(name.alias("name"), version.alias("version"), F.when(key % 17 > 0, F.concat(F.lit("az://pyramids/"), key.cast("string"))).alias("pyramid"), F.concat(F.lit("az://daily/"), key.cast("string")).alias("daily"))
    unsure = runs.filter("pyramid IS NULL").select("name", "version").distinct()
    found = catalog.web_catalog(runs, "https://data", "https://cdn", "0.2.0", "0.9.12")
    return found.join(unsure, ["name", "version"], "left_anti").select("name", "version")


@query("r09_layouts", f"WITH {OBS} SELECT time, lat_i, lon_i, pr FROM obs")
def _(spark, sf):
    return sinks.by_time(sinks.by_cell(obs(spark, sf).select("time", *CELL, "pr")))


@query("r14_land_boxes", f"WITH {CELLS} SELECT (lat_i // 2)::INT AS box_y, (lon_i // 2)::INT AS box_x, count(*) FILTER (is_land) AS n_land FROM cells GROUP BY lat_i // 2, lon_i // 2 HAVING count(*) FILTER (is_land) >= 3")
def _(spark, sf):
    return X.land_boxes(cells(spark, sf), 2, 3)


@query("x04_published_names", "SELECT p_partkey, p_brand AS source_id, p_type AS method, 'pr' AS variable_id FROM part")
def _(spark, sf):
    name = F.concat_ws(".", F.lit("CMIP"), F.lit("X"), F.regexp_replace("p_brand", r"\.", ""), F.lit("ssp245"), F.lit("r1"), F.lit("day"), "p_type", F.lit("pr"))
    rows = catalog.parse_name(table(spark, sf, "part").select("p_partkey", name.alias("name")))
    return rows.select("p_partkey", "source_id", "method", "variable_id")


@query("v02_series_udaf", f"WITH {OBS} SELECT lat_i, lon_i, round(max(pr) - min(pr), 6) AS spread FROM obs GROUP BY ALL")
def _(spark, sf):
    return obs(spark, sf).groupBy(*CELL).agg(r6(F.max("pr") - F.min("pr"), "spread"))


@query("g01_ecdf_by_season", f"WITH {OBS}, s AS (SELECT CASE WHEN month(time) IN (12, 1, 2) THEN 'DJF' WHEN month(time) IN (3, 4, 5) THEN 'MAM' WHEN month(time) IN (6, 7, 8) THEN 'JJA' ELSE 'SON' END AS season, pr FROM obs), c AS (SELECT season, pr, cume_dist() OVER (PARTITION BY season ORDER BY pr) AS share FROM s) SELECT DISTINCT season, pr, round(share, 6) AS share FROM c")
def _(spark, sf):
    return A.empirical_cdf(obs(spark, sf).withColumn("season", S.season(F.col("time"))), "pr", ["season"]).select("season", "pr", r6("share", "share"))
