"""Queries of mergeable series aggregates, table functions and layouts that last."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import figures
from ..operators import grid as G
from ..operators import overlap as V
from ..operators import series as S
from ..params import TimePeriod
from ..sources import layouts
from ..sources.cube import OBS, WIDTH, grid_width, obs
from ..sources.scratch import scratch
from .registry import query, r6

CELL = S.CELL
_GROWTH = 1.01 / 0.99


@query(
    "v02_quantile_sketch",
    f"""WITH {OBS}, b AS (SELECT lat_i, lon_i, CASE WHEN tasmax = 0 THEN 0 ELSE ceil(ln(abs(tasmax)) / {math.log(_GROWTH)!r})::INT END AS bucket, count(*) AS n FROM obs GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY lat_i, lon_i ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY lat_i, lon_i) AS whole FROM b), p AS (SELECT unnest([0.1, 0.5, 0.9, 0.99])::DOUBLE AS p)
SELECT lat_i, lon_i, p, round(2 * pow({_GROWTH!r}::DOUBLE, bucket) / ({_GROWTH!r}::DOUBLE + 1), 5) AS value FROM c, p WHERE upto >= greatest(1, ceil(p * whole)) AND upto - n < greatest(1, ceil(p * whole))""",
)
def _(spark, sf):
    """Sketches of the years put together; a year's could come from another day's run."""
    rows = obs(spark, sf)
    early, late = (S.quantile_sketch(rows.filter(c), "tasmax") for c in ("time < DATE '1996-01-01'", "time >= DATE '1996-01-01'"))
    return S.sketch_quantiles(S.merge_sketches([early, late]), [0.1, 0.5, 0.9, 0.99]).withColumn("value", F.round("value", 5))


_ROWS_OF_CELLS = f"{OBS}, d AS (SELECT time, lat_i, max(pr) AS pr FROM obs GROUP BY time, lat_i)"


def _rows_of_cells(spark, sf):
    return obs(spark, sf).groupBy("time", "lat_i").agg(F.max("pr").alias("pr"))


@query(
    "v02_spell_states",
    f"WITH {_ROWS_OF_CELLS}, g AS (SELECT lat_i, time - (row_number() OVER (PARTITION BY lat_i ORDER BY time))::INT AS g FROM d WHERE pr > 20), r AS (SELECT lat_i, count(*) AS days FROM g GROUP BY lat_i, g) SELECT lat_i, count(*) AS n_spells, round(avg(days), 6) AS mean_days, max(days) AS longest FROM r GROUP BY lat_i",
)
def _(spark, sf):
    out = S.spells(_rows_of_cells(spark, sf), F.col("pr") > 20, ["lat_i"], block_days=64)
    return out.select("lat_i", "n_spells", r6("mean_days", "mean_days"), "longest")


@query(
    "v06_heat_waves",
    f"""WITH {_ROWS_OF_CELLS}, g AS (SELECT *, time - (row_number() OVER (PARTITION BY lat_i ORDER BY time))::INT AS g FROM d WHERE pr > 20)
SELECT lat_i, min(time) AS start, max(time) AS end, count(*)::INT AS days, max(pr)::DOUBLE AS peak, arg_max(time, (pr, -epoch(time))) AS peak_day FROM g GROUP BY lat_i, g HAVING count(*) >= 3""",
)
def _(spark, sf):
    return S.heat_waves(_rows_of_cells(spark, sf), "pr", 20.0, 3, ["lat_i"])


@query("r09_bucketed", f"WITH {OBS}, r AS (SELECT lat_i, lon_i, max(s) AS wettest FROM (SELECT lat_i, lon_i, sum(pr) OVER (PARTITION BY lat_i, lon_i ORDER BY time ROWS 6 PRECEDING) AS s FROM obs) GROUP BY ALL) SELECT lat_i, lon_i, 1::BIGINT AS files, count(*) AS n, any_value(wettest) AS wettest FROM obs JOIN r USING (lat_i, lon_i) GROUP BY ALL")
def _(spark, sf):
    """One file a cell's bucket, a step per cell on it, and no second writing when it is asked for again."""
    name, path = f"cells_{uuid.uuid4().hex}", scratch(spark, "bucketed")
    rows = obs(spark, sf).select("time", *CELL, "pr")
    layouts.rechunked(rows, name, path, buckets=8)
    table = layouts.rechunked(rows, name, path)
    week = Window.partitionBy(*CELL).orderBy("time").rowsBetween(-6, 0)
    wettest = table.withColumn("s", F.sum("pr").over(week)).groupBy(*CELL).agg(F.max("s").alias("wettest"))
    return layouts.files_per_key(table).join(wettest, list(CELL)).select(*CELL, "files", "n", "wettest")


@query("g01_cdfs", f"""WITH {OBS}, u AS (SELECT 'seen (1992-1995)' AS label, lat_i, lon_i, tasmax AS x FROM obs WHERE year(time) BETWEEN 1992 AND 1995 UNION ALL SELECT 'later (1996-1998)', lat_i, lon_i, tasmax FROM obs WHERE year(time) BETWEEN 1996 AND 1998),
c AS (SELECT label, lat_i, lon_i, x, count(*) AS n FROM u GROUP BY ALL) SELECT label, lat_i, lon_i, x, round(sum(n) OVER (PARTITION BY label, lat_i, lon_i ORDER BY x) / sum(n) OVER (PARTITION BY label, lat_i, lon_i) + 1e-8, 6) AS share FROM c""")
def _(spark, sf):
    rows = obs(spark, sf)
    out = figures.cdfs({"seen": (rows, TimePeriod("1992", "1995")), "later": (rows, TimePeriod("1996", "1998"))}, "tasmax", CELL)
    return out.withColumn("share", r6(F.col("share") + F.lit(1e-8)))


@query("g01_values_and_difference", f"""WITH {OBS}, a AS (SELECT lat_i, lon_i, avg(pr) AS v FROM obs WHERE year(time) < 1996 GROUP BY ALL), b AS (SELECT lat_i, lon_i, avg(pr) AS v FROM obs WHERE year(time) >= 1996 GROUP BY ALL)
SELECT lat_i, lon_i, round(a.v + 1e-8, 6) AS first, round(b.v + 1e-8, 6) AS second, round(greatest(-5, least(5, (b.v - a.v) / a.v * 100)) + 1e-8, 6) AS difference FROM a JOIN b USING (lat_i, lon_i)""")
def _(spark, sf):
    rows = obs(spark, sf)
    out = figures.values_and_difference(rows.filter("time < DATE '1996-01-01'"), rows.filter("time >= DATE '1996-01-01'"), "pr", "mean", "percent", 5.0)
    return out.select(*CELL, *[r6(F.col(c) + F.lit(1e-8), c) for c in ("first", "second", "difference")])


def _cells(spark, height: int, width: int, x0: float, y0: float, dx: float, dy: float):
    """A grid of boxes as polygons, by the corner where it begins and the size of a cell."""
    rows = spark.range(0, height * width).select(F.floor(F.col("id") / width).cast("int").alias("lat_i"), (F.col("id") % width).cast("int").alias("lon_i"))
    x, y = F.col("lon_i") * F.lit(dx) + x0, F.col("lat_i") * F.lit(dy) + y0
    return rows.withColumn("corners", F.array(*[F.struct((x + a * dx).alias("x"), (y + b * dy).alias("y")) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1))]))


@query("r03_overlap_polygons", f"""WITH {OBS}, n AS (SELECT {WIDTH} AS w), t AS (SELECT i, j FROM (SELECT unnest(range(0, w // 2))::INT AS i FROM n), (SELECT unnest(range(0, w // 2))::INT AS j FROM n)),
o AS (SELECT time, i, j, pr, greatest(0, least(lat_i + 1, i * 1.75 + 0.25 + 1.75) - greatest(lat_i, i * 1.75 + 0.25)) * greatest(0, least(lon_i + 1, j * 1.75 + 0.5 + 1.75) - greatest(lon_i, j * 1.75 + 0.5)) AS a
 FROM obs JOIN t ON lat_i + 1 > i * 1.75 + 0.25 AND lat_i < i * 1.75 + 2 AND lon_i + 1 > j * 1.75 + 0.5 AND lon_i < j * 1.75 + 2.25)
SELECT time, i AS lat_i, j AS lon_i, round(sum(a * pr) / sum(a) + 1e-6, 5) AS pr FROM o WHERE a > 0 GROUP BY ALL""")
def _(spark, sf):
    """Onto a shifted grid of other cells, by clipped polygons."""
    w = grid_width(spark, sf)
    table = V.overlap_weights(_cells(spark, w, w, 0.0, 0.0, 1.0, 1.0), _cells(spark, w // 2, w // 2, 0.5, 0.25, 1.75, 1.75), False)
    return G.regrid(obs(spark, sf), table, ["pr"]).select("time", *CELL, F.round(F.col("pr") + F.lit(1e-6), 5).alias("pr"))


@query("r03_conservative_spherical", f"""WITH {OBS}, n AS (SELECT {WIDTH} AS w), c AS (SELECT time, lat_i // 2 AS i, lon_i // 2 AS j, sum(pr * (sin(radians(lat_i * 3.0 + 1.5 - 60)) - sin(radians(lat_i * 3.0 - 1.5 - 60)))) AS x, sum(sin(radians(lat_i * 3.0 + 1.5 - 60)) - sin(radians(lat_i * 3.0 - 1.5 - 60))) AS a FROM obs GROUP BY ALL)
SELECT time, i::INT AS lat_i, j::INT AS lon_i, round(x / a + 1e-6, 5) AS pr FROM c""")
def _(spark, sf):
    """Rows of cells of three degrees from 60 S on, in pairs: latitudes weigh by their sines."""
    w = grid_width(spark, sf)
    lat = G.overlap_axis_weights([3.0 * i - 60 for i in range(w)], [6.0 * i + 1.5 - 60 for i in range(w // 2)], True)
    lon = G.overlap_axis_weights(list(range(w)), [2 * i + 0.5 for i in range(w // 2)], False)
    return G.regrid(obs(spark, sf), G.weights(spark, lat, lon), ["pr"]).select("time", *CELL, F.round(F.col("pr") + F.lit(1e-6), 5).alias("pr"))
