"""Queries that train networks on the given tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import downscale as D
from ..operators import training as T
from ..sources import networks, records
from ..sources.cube import CELLS, OBS, cells, grid_width, obs
from ..sources.scratch import scratch
from .registry import query

CELL = A.CELL

RATE, MOMENTUM, STEPS = 0.05, 0.9, 20


def _monthly(spark, sf):
    month = F.trunc("time", "month").alias("time")
    return obs(spark, sf).groupBy(month, *CELL).agg(F.sum("pr").alias("pr"))


_LINEAR_SQL = f"""WITH RECURSIVE {OBS}, {CELLS}, m AS (SELECT date_trunc('month', time)::DATE AS time, lat_i, lon_i, sum(pr) AS pr FROM obs GROUP BY date_trunc('month', time), lat_i, lon_i),
q AS (SELECT time, lat_i // 2 AS qy, lon_i // 2 AS qx, sum(pr) AS block FROM m GROUP BY ALL HAVING count(*) = 4),
d AS (SELECT (pr / 1000)::FLOAT::DOUBLE AS y, (block / 4000)::FLOAT::DOUBLE AS x1, (elev / 10000)::FLOAT::DOUBLE AS x2 FROM m JOIN q ON q.time = m.time AND qy = lat_i // 2 AND qx = lon_i // 2 JOIN cells USING (lat_i, lon_i)),
s AS (SELECT count(*)::DOUBLE AS n, sum(x1 * x1) AS a11, sum(x1 * x2) AS a12, sum(x2 * x2) AS a22, sum(x1) AS a1, sum(x2) AS a2, sum(x1 * y) AS c1, sum(x2 * y) AS c2, sum(y) AS c, sum(y * y) AS yy FROM d),
t AS (SELECT 0 AS step, 0::DOUBLE AS w1, 0::DOUBLE AS w2, 0::DOUBLE AS b, 0::DOUBLE AS v1, 0::DOUBLE AS v2, 0::DOUBLE AS vb UNION ALL
 SELECT step + 1, w1 + n1, w2 + n2, b + nb, n1, n2, nb FROM (SELECT t.*, {MOMENTUM} * v1 - {RATE} * 2 / n * (w1 * a11 + w2 * a12 + b * a1 - c1) AS n1, {MOMENTUM} * v2 - {RATE} * 2 / n * (w1 * a12 + w2 * a22 + b * a2 - c2) AS n2,
 {MOMENTUM} * vb - {RATE} * 2 / n * (w1 * a1 + w2 * a2 + b * n - c) AS nb FROM t, s WHERE step < {STEPS - 1}))
SELECT step, round((w1 * w1 * a11 + w2 * w2 * a22 + b * b * n + yy + 2 * (w1 * w2 * a12 + w1 * b * a1 + w2 * b * a2 - w1 * c1 - w2 * c2 - b * c)) / n, 6) AS loss FROM t, s"""


@query("m16_training_linear", _LINEAR_SQL)
def _(spark, sf):
    """One layer with a kernel of one pixel is a regression, whose descent SQL can follow."""
    rows = _monthly(spark, sf).join(cells(spark, sf).select(*CELL, "elev"), list(CELL))
    at = (F.col("lat_i") % 2) * 2 + F.col("lon_i") % 2
    blocks = rows.groupBy("time", F.expr("lat_i div 2").alias("by"), F.expr("lon_i div 2").alias("bx")).agg(F.sum("pr").alias("block"), F.sort_array(F.collect_list(F.struct(at.alias("at"), "pr", "elev"))).alias("cells")).filter(F.size("cells") == 4)
    pixels = F.flatten(F.transform("cells", lambda c: F.array((F.col("block") / 4000).cast("float"), (c["elev"] / 10000).cast("float"))))
    patches = blocks.select(pixels.alias("image"), F.transform("cells", lambda c: (c["pr"] / 1000).cast("float")).alias("label"))
    layers = [(np.zeros((1, 1, 2, 1)), np.zeros(1))]
    done = T.train(patches, scratch(spark, "training"), layers, STEPS, batch=1 << 60, rate=RATE, momentum=MOMENTUM, every=10)
    return spark.createDataFrame(list(enumerate(done.losses)), "step int, loss double").withColumn("loss", F.round("loss", 6))


@query("m16_training")
def _(spark, sf):
    """The network of three layers, from patches in record files to a store that ``m17_deepsd_network`` could read; a row a step and a row a layer."""
    w = grid_width(spark, sf)
    maps = D.maps_of(_monthly(spark, sf).withColumn("pr", F.col("pr") / 1000), "pr", w, w)
    patches = T.training_pairs(maps, networks.elevation_matrix(cells(spark, sf), w, w) / 1e4, min(8, w), 4)
    files = scratch(spark, "training-records")
    records.write_examples(patches.select("y0", "x0", "image", "label"), files)
    examples = records.read_examples(spark, files, "image array<float>, label array<float>")
    done = T.train(examples, scratch(spark, "training"), T.initial_layers(3, (5, 1, 3), (8, 4)), STEPS, batch=200, rate=0.02, every=10)
    steps = spark.createDataFrame(list(enumerate(done.losses)), "step int, loss double").select(F.lit("step").alias("kind"), F.col("step").alias("number"), F.round("loss", 4).alias("value"))
    stored = spark.read.schema(networks.SCHEMA).parquet(done.path)
    layers = stored.select(F.lit("layer").alias("kind"), F.col("layer").alias("number"), F.size("kernel").cast("double").alias("value"))
    return steps.union(layers)
