"""Sources of tidy tables: Parquet layouts, text files, stacked files, random-field tiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalar import lon_to_180
from ..params import TimePeriod


#: Columns that place a row; they are never missing, and are left as they are stored.
COORDINATES = frozenset(("time", "lat", "lon", "level", "plev", "x", "y"))


def nan_to_null(df: DataFrame, coordinates: Sequence[str] = tuple(COORDINATES)) -> DataFrame:
    """Missing values as nulls, whatever they were before. Coordinates pass as they are, so that filters on them reach the scan."""
    return df.select([F.when(~F.isnan(c), F.col(c)).alias(c) if kind in ("double", "float") and c not in coordinates else F.col(c) for c, kind in df.dtypes])


def scan(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A tidy table of one store; columns, and filters on coordinates and other columns that are not floating, are pushed into the scan."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return nan_to_null(reader.parquet(path))


def read_polygons(spark: SparkSession, path: str, number: str = "region_id") -> DataFrame:
    """(region_id, ring) of a GeoJSON file's polygons and multi-polygons; ``number`` names the property that numbers them.

    Holes are taken into the ring by a way there and back from its first corner, which counting the edges to a point's east
    passes twice or not at all: so a point in a hole lies in no region.
    """
    shape = "features array<struct<properties: map<string, string>, geometry: struct<type: string, coordinates: string>>>"
    features = spark.read.option("multiLine", True).schema(shape).json(path).select(F.inline("features"))
    text = F.col("geometry.coordinates")
    one = F.array(F.from_json(text, "array<array<array<double>>>"))
    rings = F.when(F.col("geometry.type") == "Polygon", one).otherwise(F.from_json(text, "array<array<array<array<double>>>>"))
    parts = features.select(F.col("properties")[number].cast("int").alias("region_id"), F.explode(rings).alias("part"))
    whole = F.flatten(F.transform("part", lambda ring: F.concat(ring, F.array(F.col("part")[0][0]))))
    ring = F.when(F.size("part") > 1, whole).otherwise(F.col("part")[0])
    return parts.select("region_id", F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))).alias("ring"))


def read_batches(spark: SparkSession, path: str, size: int, seed: int = 0) -> DataFrame:
    """A store of patches in shuffled batches of ``size`` (the last one may be smaller): adds batch and shuffle, the order within all.

    The order is a hash of the patch and the seed; ranges of it are counted, and then numbered side by side.
    """
    return shuffled_batches(spark.read.parquet(path), size, seed)


def shuffled_batches(rows: DataFrame, size: int, seed: int = 0) -> DataFrame:
    """Rows with a column ``patch`` in shuffled batches, as ``read_batches`` deals them."""
    keyed = rows.withColumn("shuffle", F.xxhash64(F.lit(seed), *[c for c in rows.columns if c != "patch"]))
    tasks = max(1, rows.count() // (64 * size))
    part = F.floor((F.shiftrightunsigned("shuffle", 33) * tasks) / F.lit(float(1 << 31))).cast("bigint")
    keyed = keyed.withColumn("_part", part)
    # One row a range, some 64 batches of patches: how many patches lie in the ranges before it.
    counts = keyed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).drop("_n")
    order = Window.partitionBy("_part").orderBy("shuffle", *[c for c in rows.columns if c != "patch"])
    numbered = keyed.withColumn("_place", F.row_number().over(order) - 1).join(F.broadcast(before), "_part")
    return numbered.withColumn("batch", F.floor((F.col("_before") + F.col("_place")) / size)).drop("_part", "_place", "_before")


def elevation(spark: SparkSession, root: str, degrees: float) -> DataFrame:
    """The elevation grid of a resolution, one store each under ``root``."""
    return scan(spark, f"{root}/elevation_{degrees:g}deg")


def scan_many(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Several stores put together along time, in one scan; columns that a store lacks are null there."""
    return nan_to_null(spark.read.option("mergeSchema", True).parquet(*paths))


def scan_years(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Whole years of a store that is partitioned by ``year``; other years' files are not opened."""
    return scan(spark, path).filter(F.col("year").between(first, last))


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_json(spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = True) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    return reader.schema(schema).json(path) if schema else reader.json(path)


def read_level(spark: SparkSession, path: str, level: int) -> DataFrame:
    """One zoom level of a pyramid partitioned by ``level``."""
    return spark.read.parquet(path).filter(F.col("level") == level)


def open_reanalysis(fields: DataFrame, winds: DataFrame | None, first: int, last: int, keys: Sequence[str] = ("time", "lat", "lon")) -> DataFrame:
    """Observed fields of some years, winds attached from a store of their own, precipitation as mm a day, longitudes to +-180."""
    years = TimePeriod(str(first), str(last)).predicate()
    out = fields.filter(years)
    if winds is not None:
        out = out.join(winds.filter(years), list(keys), "left")
    if "pr" in out.columns:
        out = out.withColumn("pr", F.col("pr") * F.lit(86400.0))
    return out.withColumn("lon", lon_to_180(F.col("lon")))


def with_history(historical: DataFrame, scenario: DataFrame, name: str, turn: int = 2015, start: int = 1950) -> DataFrame:
    """A scenario, with the historical run before it where the wanted years begin before the turn."""
    out = scenario.withColumn("scenario", F.lit(name))
    return historical.withColumn("scenario", F.lit("historical")).unionByName(out) if start < turn else out


def tile_random_field(field: DataFrame, decades: int, years: int = 10, grid: DataFrame | None = None, time: str = "time", keys: Sequence[str] = ("lat_i", "lon_i")) -> DataFrame:
    """A record of some years repeated to cover a longer period, its dates moved, cut to the cells and days of ``grid``."""
    moved = field.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(decades - 1))))
    moved = moved.withColumn(time, F.add_months(F.col(time), F.col("_k") * 12 * years)).drop("_k")
    return moved if grid is None else moved.join(grid.select(time, *keys).distinct(), [time, *keys], "left_semi")


def level_of(df: DataFrame, wanted: float, level: str = "plev", keys: Sequence[str] = ("time", "lat", "lon")) -> DataFrame:
    """The rows of the level nearest to one wanted, without the level."""
    order: Column = F.struct(F.abs(F.col(level) - F.lit(float(wanted))), F.col(level))
    rest = [c for c in df.columns if c not in (*keys, level)]
    return df.groupBy(*keys).agg(*[F.min_by(c, order).alias(c) for c in rest])
