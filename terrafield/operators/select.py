"""Selections and joins of fields: masks, regions, days, boxes, ranks; all expressions and equi-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import TimePeriod
from ..functions.scalar import d
from .aggregate import CELL, first_of


def mask_land(df: DataFrame, land: DataFrame, values: Sequence[str], cell: Sequence[str] = CELL, flag: str = "is_land") -> DataFrame:
    """Values of cells off the land, or that ``land`` does not know, as nulls."""
    known = df.join(land.select(*cell, F.col(flag).alias("_land")), list(cell), "left")
    return known.withColumns({v: F.when(F.col("_land"), F.col(v)) for v in values}).drop("_land")


def with_regions(df: DataFrame, regions: DataFrame, without: Sequence[int] = (), last: int | None = None, cell: Sequence[str] = CELL, region: str = "region_id") -> DataFrame:
    """Rows with their region's number, which later steps group by; rows outside all regions, in those of
    ``without``, and in the ``last`` numbers (the polar ones of a catalogue of regions) are left out."""
    kept = regions.select(*cell, region)
    if without:
        kept = kept.filter(~F.col(region).isin(list(without)))
    if last:
        highest = regions.select(region).distinct().orderBy(F.desc(region)).limit(last)
        kept = kept.join(F.broadcast(highest), region, "left_anti")
    return df.join(kept, list(cell))


def combine_regions(grid: DataFrame, parts: DataFrame, values: Sequence[str], wanted: Sequence[int] | None = None, cell: Sequence[str] = CELL, region: str = "region_id") -> DataFrame:
    """Every cell of the grid with the values of the region that covers it (of ``wanted`` ones), else nulls; ``parts`` is read once."""
    chosen = parts if wanted is None else parts.filter(F.col(region).isin(list(wanted)))
    return grid.select(*cell).distinct().join(chosen.select(*cell, region, *values), list(cell), "left")


def anomalies(df: DataFrame, value: str, by: Column, cell: Sequence[str] = CELL, out: str = "anomaly") -> DataFrame:
    """Values less their cell's mean over rows with the same ``by`` (a month, say), in one shuffle."""
    return df.withColumn(out, F.col(value) - F.avg(value).over(Window.partitionBy(*cell, by)))


def attach(df: DataFrame, other: DataFrame, columns: dict[str, str], keys: Sequence[str]) -> DataFrame:
    """Columns of another table under new names, null where it has no row."""
    return df.join(other.select(*keys, *[F.col(a).alias(b) for a, b in columns.items()]), list(keys), "left")


def raw_month(df: DataFrame, values: Sequence[str], keys: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """Monthly means over all rows of a month, whatever days a model's calendar has."""
    return df.groupBy(F.trunc(time, "MM").alias(time), *keys).agg(*[F.avg(v).alias(v) for v in values])


def largest(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, name: str, always: Sequence[str] = ()) -> DataFrame:
    """The first row of each group, of these the first ``n``, and rows named by ``always`` besides."""
    top = first_of(df, by, order).orderBy(*order).limit(n)
    extra = df.filter(F.col(name).isin(list(always))).join(top.select(name), name, "left_anti").select(df.columns)
    return top.unionByName(extra)


def days_of_year(df: DataFrame, days: Sequence[int], time: str = "time") -> DataFrame:
    return df.filter(F.dayofyear(time).isin(list(days)))


def rolled(df: DataFrame, value: str, cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """Each series moved by one step around its end: the first step has the last one's value."""
    order = Window.partitionBy(*cell).orderBy(time)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn(value, F.coalesce(F.lag(value).over(order), F.last(value).over(whole)))


def rank_positions(df: DataFrame, value: str, cell: Sequence[str] = CELL, time: str = "time", out: str = "position") -> DataFrame:
    """Cunnane's plotting position of each value within its series; ties in order of time."""
    own = Window.partitionBy(*cell)
    return df.withColumn(out, (F.row_number().over(own.orderBy(value, time)) - d(0.4)) / (F.count("*").over(own) + d(0.2)))


def starting_resolution(df: DataFrame, spacings: Sequence[Column], by: Sequence[str], digits: int = 2, out: str = "res") -> DataFrame:
    """The finest spacing of each group, rounded."""
    rounded = [F.round(c, digits) for c in spacings]
    return df.groupBy(*by).agg(F.round(F.least(*[F.min(c) for c in rounded]), digits).alias(out))


def land_boxes(land: DataFrame, size: int, least: int, cell: Sequence[str] = CELL, flag: str = "is_land") -> DataFrame:
    """Boxes of ``size`` by ``size`` cells with at least so many on the land."""
    lat, lon = cell
    box = lambda c: F.floor(F.col(c) / size).cast("int")
    return land.groupBy(box(lat).alias("box_y"), box(lon).alias("box_x")).agg(F.count_if(flag).alias("n_land")).filter(F.col("n_land") >= least)


def sample(df: DataFrame, share: float, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """About a share of the rows, by a hash of their keys: the same ones wherever and however often it runs."""
    own = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])), 1, 7)
    return df if share >= 1 else df.filter(own < F.lit(f"{int(share * 16**7):07x}"))


def subset(df: DataFrame, variables: Sequence[str], first: int, last: int, lat: tuple[float, float] | None = None, lon: tuple[float, float] | None = None, keys: Sequence[str] = ("time", "lat", "lon")) -> DataFrame:
    """Some variables for whole years and a box: what a run observes, or (over its prediction years) validates with."""
    time, y, x = keys
    out = df.filter(TimePeriod(str(first), str(last)).predicate(time))
    for c, limits in ((y, lat), (x, lon)):
        if limits is not None:
            out = out.filter(F.col(c).between(*limits))
    return out.select(*keys, *variables)


def squeeze(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table without keys of one value; a key with more is an error."""
    counts = df.agg(*[F.min(k).eqNullSafe(F.max(k)).alias(k) for k in keys]).first()
    if many := [k for k in keys if not counts[k]]:
        raise ValueError(f"{', '.join(many)}: more than one value")
    return df.drop(*keys)


def in_ring(ring: Column, y: Column, x: Column) -> Column:
    """Whether a point lies within a ring (array of structs x, y; closed or not), by counting the edges to its east."""
    n = F.size(ring)

    def crossed(i: Column) -> Column:
        a, b = ring[i], ring[F.pmod(i + 1, n)]
        at = a["x"] + (y - a["y"]) / (b["y"] - a["y"]) * (b["x"] - a["x"])
        return ((a["y"] > y) != (b["y"] > y)) & (x < at)

    odd = F.size(F.filter(F.sequence(F.lit(0), n - 1), crossed)) % 2 == 1
    return F.coalesce((n > 2) & odd, F.lit(False))


#: Corners of polygons that are broadcast at most; more are joined by boxes of whole degrees.
BROADCAST_CORNERS = 2_000_000


def regions_of(points: DataFrame, polygons: DataFrame, lat: str = "lat", lon: str = "lon", region: str = "region_id") -> DataFrame:
    """Points with the number of the polygon they lie in; a point in none is left out, one in several has a row each.

    ``polygons`` has the number and a ring (array of structs x, y). A polygon meets only points of its
    own whole-degree boxes: an equi-join, broadcast if the rings are small.
    """
    box = F.transform(F.col("ring"), lambda p: p["y"]), F.transform(F.col("ring"), lambda p: p["x"])
    span = lambda v: F.sequence(F.floor(F.array_min(v)), F.floor(F.array_max(v)))
    cut = polygons.filter(F.size("ring") > 2).select(region, "ring", F.explode(span(box[0])).alias("_y"), span(box[1]).alias("_xs")).select(region, "ring", "_y", F.explode("_xs").alias("_x"))
    corners = polygons.agg(F.coalesce(F.sum(F.size("ring").cast("bigint")), F.lit(0)).alias("n")).first().n
    small = corners <= BROADCAST_CORNERS and cut.limit(BROADCAST_CORNERS // 100 + 1).count() <= BROADCAST_CORNERS // 100
    keyed = points.withColumn("_y", F.floor(F.col(lat))).withColumn("_x", F.floor(F.col(lon)))
    met = keyed.join(F.broadcast(cut) if small else cut, ["_y", "_x"])
    return met.filter(in_ring(F.col("ring"), F.col(lat).cast("double"), F.col(lon).cast("double"))).drop("_y", "_x", "ring")
