"""Overlaps of polygons on a plane and on the sphere."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from terrafield.operators import overlap as V


def test_planar_overlaps():
    square = [(0, 0), (2, 0), (2, 2), (0, 2)]
    assert V.overlap(square, [(1, 1), (3, 1), (3, 3), (1, 3)]) == pytest.approx(1)
    assert V.overlap(square, [(1, 1), (1, 3), (3, 3), (3, 1)]) == pytest.approx(1)  # the other way round
    assert V.overlap(square, [(1, -1), (3, 1), (1, 3), (-1, 1)]) == pytest.approx(4)  # a larger one, turned: the square lies within
    assert V.overlap(square, [(1, 0), (2, 1), (1, 2), (0, 1)]) == pytest.approx(2)
    assert V.overlap(square, [(5, 5), (6, 5), (6, 6)]) == 0


def test_spherical_areas():
    octant = [V.on_sphere(0, 0), V.on_sphere(90, 0), V.on_sphere(0, 90)]
    assert V.area(octant) == pytest.approx(math.pi / 2)
    assert V.overlap(octant, [V.on_sphere(45, 0), V.on_sphere(135, 0), V.on_sphere(0, 90)]) == pytest.approx(math.pi / 4)
    rng = random.Random(1)
    a = [V.on_sphere(x + rng.uniform(-1, 1), y + rng.uniform(-1, 1)) for x, y in ((170, 60), (190, 60), (190, 75), (170, 75))]
    cuts = [[V.on_sphere(160, 50), V.on_sphere(180, 50), V.on_sphere(0, 90)], [V.on_sphere(180, 50), V.on_sphere(200, 50), V.on_sphere(0, 90)]]
    assert sum(V.overlap(a, c) for c in cuts) == pytest.approx(abs(V.area(a)))


def grid(spark, height, width, turn=0.0):
    """Cells around the whole sphere, turned about an axis through the equator."""
    t = math.radians(turn)
    rows = []
    for i in range(height):
        for j in range(width):
            corners = []
            for a, b in ((0, 0), (1, 0), (1, 1), (0, 1)):
                x, y, z = V.on_sphere(360 * (j + a) / width, -90 + 180 * (i + b) / height)
                y, z = y * math.cos(t) - z * math.sin(t), y * math.sin(t) + z * math.cos(t)
                corners.append((math.degrees(math.atan2(y, x)), math.degrees(math.asin(max(-1.0, min(1.0, z))))))
            rows.append((i, j, corners))
    return spark.createDataFrame(rows, "lat_i int, lon_i int, corners array<struct<x: double, y: double>>")


@pytest.mark.parametrize("side", [0.05, 0.4])
def test_weights_of_turned_cells_add_up(spark, side):
    source, target = grid(spark, 8, 12), grid(spark, 6, 8, 35.0)
    w = V.overlap_weights(source, target, True, side)
    sums = w.groupBy("dst_lat", "dst_lon").agg(F.sum("w").alias("w"), F.count("*").alias("n")).collect()
    assert len(sums) == 48 and all(r.w == pytest.approx(1) for r in sums)
    assert w.groupBy("dst_lat", "dst_lon", "src_lat", "src_lon").count().filter("count > 1").count() == 0
    point = lambda corners: [V.on_sphere(c.x, c.y) for c in corners]
    cells = {(r.lat_i, r.lon_i): point(r.corners) for r in source.collect()}
    turned = {(r.lat_i, r.lon_i): point(r.corners) for r in target.collect()}
    want = {(*t, *s) for t, b in turned.items() for s, a in cells.items() if V.overlap(a, b) > 1e-15}
    assert {tuple(r)[:4] for r in w.collect()} == want
    # Cells cover the sphere, but for what great circles leave out along parallels; all of a target is covered.
    assert all(sum(V.overlap(a, turned[t]) for a in cells.values()) == pytest.approx(abs(V.area(turned[t])), rel=1e-6) for t in list(turned)[::7])


def test_grid_onto_itself(spark):
    same = grid(spark, 5, 6)
    w = V.overlap_weights(same, same)
    assert w.count() == 30 and w.filter("dst_lat <> src_lat OR dst_lon <> src_lon OR abs(w - 1) > 1e-9").count() == 0
    assert V.overlap_weights(same.limit(0), same).count() == 0
