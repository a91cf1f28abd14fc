"""Conservative weights between grids of any convex cells: curved, shifted or turned, on a plane or on the sphere.

Cells are polygons. Those that could meet are found by an equi-join on the boxes they touch (on the sphere boxes of space, so neither the date line nor the poles are
special), each pair once; its overlap is one polygon clipped by the other's edges, which on the sphere are great circles.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Point = tuple[float, ...]


def _cross(a: Point, b: Point) -> Point:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def _dot(a: Point, b: Point) -> float:
    return sum(x * y for x, y in zip(a, b))


def on_sphere(lon: float, lat: float) -> Point:
    """Degrees as a unit vector."""
    a, b = math.radians(lon), math.radians(lat)
    return math.cos(b) * math.cos(a), math.cos(b) * math.sin(a), math.sin(b)


def area(polygon: list[Point]) -> float:
    """The signed area: of points of a plane, or of unit vectors (in square radians), positive if the corners go round against the clock."""
    total = 0.0
    if len(polygon) > 2 and len(polygon[0]) == 3:
        a = polygon[0]
        for b, c in zip(polygon[1:], polygon[2:]):
            total += 2 * math.atan2(_dot(a, _cross(b, c)), 1 + _dot(a, b) + _dot(b, c) + _dot(c, a))
        return total
    for (x0, y0), (x1, y1) in zip(polygon, polygon[1:] + polygon[:1]):
        total += (x0 * y1 - x1 * y0) / 2
    return total


def clip(polygon: list[Point], by: list[Point]) -> list[Point]:
    """The part of a polygon within a convex one whose corners go round against the clock."""
    flat = len(by[0]) == 2
    for p, q in zip(by, by[1:] + by[:1]):
        if flat:
            side = lambda v, p=p, q=q: (q[0] - p[0]) * (v[1] - p[1]) - (q[1] - p[1]) * (v[0] - p[0])
        else:
            side = lambda v, n=_cross(p, q): _dot(n, v)
        out, sides = [], [side(v) for v in polygon]
        for v, w, a, b in zip(polygon, polygon[1:] + polygon[:1], sides, sides[1:] + sides[:1]):
            if a >= 0:
                out.append(v)
            if a * b < 0:  # where the edge crosses: along the chord, then out to the sphere
                x = tuple((b * s - a * t) / (b - a) for s, t in zip(v, w))
                size = 1.0 if flat else math.sqrt(_dot(x, x))
                out.append(tuple(c / size for c in x))
        polygon = out
        if len(polygon) < 3:
            return []
    return polygon


def overlap(a: list[Point], b: list[Point]) -> float:
    """The area that two convex polygons share, whichever way their corners go."""
    a, b = (x if area(x) >= 0 else x[::-1] for x in (a, b))
    return abs(area(clip(a, b)))


def _beside(boxes: Column, span: Column) -> Column:
    """Boxes with one more axis: each of them once for every number of ``span``."""
    return F.flatten(F.transform(boxes, lambda b: F.transform(span, lambda k: F.concat(b, F.array(k)))))


def _boxes(corners: str, spherical: bool, side: float) -> tuple[Column, list[Column]]:
    """The boxes that a cell touches, and the first of them along each axis."""
    c = F.col(corners)
    if spherical:
        lon, lat = lambda p: F.radians(p["x"]), lambda p: F.radians(p["y"])
        axes = [F.transform(c, lambda p: F.cos(lat(p)) * F.cos(lon(p))), F.transform(c, lambda p: F.cos(lat(p)) * F.sin(lon(p))), F.transform(c, lambda p: F.sin(lat(p)))]
    else:
        axes = [F.transform(c, lambda p: p["x"].cast("double")), F.transform(c, lambda p: p["y"].cast("double"))]
    low, high = [F.array_min(a) for a in axes], [F.array_max(a) for a in axes]
    if spherical:  # arcs and faces bulge beyond the corners, by no more than half the widest chord's height
        chord = sum(((h - x) * (h - x) for x, h in zip(low, high)), F.lit(0.0))
        bulge = 1 - F.sqrt(F.greatest(F.lit(0.0), 1 - F.least(chord, F.lit(4.0)) / 4))
        low, high = [x - bulge for x in low], [h + bulge for h in high]
    spans = [F.sequence(F.floor(x / side), F.floor(h / side)) for x, h in zip(low, high)]
    boxes = F.transform(spans[0], lambda k: F.array(k))
    for span in spans[1:]:
        boxes = _beside(boxes, span)
    return boxes, [F.floor(x / side) for x in low]


def overlap_weights(source: DataFrame, target: DataFrame, spherical: bool = True, side: float | None = None) -> DataFrame:
    """dst_lat, dst_lon, src_lat, src_lon, w: the share of each target cell's covered area that each source cell covers; a target's weights add up to one.

    Both tables have lat_i, lon_i and corners, an array of (x, y) of a convex cell: longitudes and latitudes in degrees if ``spherical``, else points of a plane.
    ``side`` is the width of the boxes that cells meet by (near that of a cell, by default 0.05 of the sphere's radius, or 1): any gives the same weights.
    Cells with fewer than three corners meet none; nulls among the corners are an error.
    """
    side = side or (0.05 if spherical else 1.0)

    def dealt(df: DataFrame, to: str) -> DataFrame:
        boxes, first = _boxes("corners", spherical, side)
        rows = df.filter(F.size("corners") > 2).select(F.col("lat_i").alias(f"{to}_lat"), F.col("lon_i").alias(f"{to}_lon"), F.col("corners").alias(f"{to}_corners"), F.array(*first).alias(f"{to}_first"), F.explode(boxes).alias("box"))
        return rows

    met = dealt(source, "src").join(dealt(target, "dst"), "box")
    # Two cells that share several boxes meet in the first of those.
    met = met.filter(F.col("box") == F.zip_with("src_first", "dst_first", lambda a, b: F.greatest(a, b))).drop("box", "src_first", "dst_first")
    point = (lambda p: on_sphere(p["x"], p["y"])) if spherical else (lambda p: (float(p["x"]), float(p["y"])))
    names = ["dst_lat", "dst_lon", "src_lat", "src_lon"]

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(k).to_pylist() for k in (4, 5))
            shared = [overlap(list(map(point, x)), list(map(point, y))) for x, y in zip(a, b)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(shared, pa.float64())], [*names, "area"])

    kinds = dict(source.dtypes)["lat_i"], dict(source.dtypes)["lon_i"]
    found = met.select(*names, "src_corners", "dst_corners").mapInArrow(measure, f"dst_lat {kinds[0]}, dst_lon {kinds[1]}, src_lat {kinds[0]}, src_lon {kinds[1]}, area double").filter("area > 1e-15")
    total = found.groupBy("dst_lat", "dst_lon").agg(F.sum("area").alias("whole"))
    return found.join(total, ["dst_lat", "dst_lon"]).select(*names, (F.col("area") / F.col("whole")).alias("w"))
