"""Queries of array stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid as G
from ..sources import chunks
from ..sources.cube import OBS, obs, tasks
from ..sources.scratch import scratch
from .registry import query, r6

CHUNKS = {"time": 400, "lat_i": 4, "lon_i": 4}


@query("s01_array_chunks", f"WITH {OBS} SELECT time, lat_i, lon_i, pr, tasmax FROM obs WHERE time BETWEEN DATE '1994-03-01' AND DATE '1995-10-31' AND lat_i IN (1, 2, 7) AND lon_i >= 3")
def _(spark, sf):
    path = scratch(spark, "arrays")
    chunks.write_chunks(obs(spark, sf), path, CHUNKS, ["pr", "tasmax"], {"tasmax": (0.01, 0.0)})
    box = F.col("time").between("1994-03-01", "1995-10-31") & F.col("lat_i").isin(1, 2, 7) & (F.col("lon_i") >= 3)
    return chunks.read_chunks(spark, path).filter(box).withColumn("tasmax", F.round("tasmax", 2))


@query("s10_array_pyramid", f"WITH {OBS}, l AS (SELECT unnest([1, 2])::INT AS level) SELECT level, time, (lat_i // (4 >> level))::INT AS y, (lon_i // (4 >> level))::INT AS x, round(avg(pr) + 1e-8, 6) AS pr FROM obs, l GROUP BY ALL")
def _(spark, sf):
    path, levels = scratch(spark, "array-pyramid"), G.pyramid(obs(spark, sf), 3, "pr", tasks=tasks(spark, sf, "lineitem"))
    for level in (1, 2):
        chunks.write_chunks(levels.filter(F.col("level") == level), path, {"time": 400, "y": 8, "x": 8}, ["pr"], group=str(level))
    read = [chunks.read_chunks(spark, path, group=str(level)).withColumn("level", F.lit(level)) for level in (1, 2)]
    return read[0].unionByName(read[1]).select("level", "time", "y", "x", r6(F.col("pr") + F.lit(1e-8), "pr"))


@query("k03_append_variable", f"WITH {OBS} SELECT time, lat_i, lon_i, pr, tasmax, CASE WHEN lat_i < 5 THEN tasmin END AS tasmin FROM obs WHERE lon_i = 3")
def _(spark, sf):
    """Variables that come one by one into one store, the last of them for some cells."""
    path, rows = scratch(spark, "appended"), obs(spark, sf)
    chunks.write_chunks(rows, path, CHUNKS, ["pr"])
    chunks.write_chunks(rows, path, CHUNKS, ["tasmax"], append=True)
    chunks.write_chunks(rows.filter("lat_i < 5"), path, CHUNKS, ["tasmin"], append=True)
    return chunks.read_chunks(spark, path).filter("lon_i = 3")
