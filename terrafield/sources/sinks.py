"""Sinks: partitioned Parquet with a manifest, cached steps, dynamic overwrites, exports and run records."""

from __future__ import annotations

import datetime
import json
import math
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..params import RunParameters, str_to_hash


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> bool:
    """Removes a file or a store; whether there was one."""
    fs, where = _fs(spark, path)
    return fs.delete(where, True)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A file of these bytes."""
    fs, where = _fs(spark, path)
    out = fs.create(where, True)
    out.write(bytearray(data))
    out.close()


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a store was written to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def write(df: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str = "zstd", check: bool = False) -> str:
    """A store, replaced as a whole; ``check`` reads it back and compares the number of rows."""
    counted = Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("n")) if check else df
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", compression).partitionBy(*partition_by).parquet(path)
    if check and df.sparkSession.read.parquet(path).count() != counted.get["n"]:
        raise ValueError(f"{path} does not hold what was written")
    return path


def opens(spark: SparkSession, path: str, least_rows: int = 1) -> bool:
    """Whether a store was written to its end, can be opened and has so many rows."""
    if not is_complete(spark, path):
        return False
    try:
        return spark.read.parquet(path).limit(least_rows).count() >= least_rows
    except AnalysisException:  # files that are no table
        return False


def _probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether each store was written to its end and its first file with rows can be read, a store after another in tasks."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    from .chunks import _open

    def good(uri: str | None) -> bool:
        if uri is None:
            return False
        fs, root = _open(uri)
        if fs.get_file_info(f"{root}/_SUCCESS").type != pafs.FileType.File:
            return False
        for f in fs.get_file_info(pafs.FileSelector(root, recursive=True)):
            if f.type == pafs.FileType.File and f.base_name.endswith(".parquet"):
                try:
                    with fs.open_input_file(f.path) as file:
                        if pq.read_metadata(file).num_rows:
                            return True
                except pa.ArrowInvalid:  # a file that is no table
                    return False
        return False

    for batch in batches:
        yield batch.filter(pa.array([good(x) for x in batch.column(0).to_pylist()], pa.bool_()))


def valid_stores(catalog: DataFrame, column: str = "zstore") -> DataFrame:
    """The rows of a catalogue whose stores open: probed by tasks in one job, and joined."""
    kind = catalog.schema[column].dataType.simpleString()
    good = catalog.select(column).distinct().mapInArrow(_probe, f"`{column}` {kind}")
    return catalog.join(good, column, "left_semi")


def write_patches(df: DataFrame, path: str) -> str:
    """Patches (array<double>) as single-precision arrays, the form that training reads."""
    write(df.withColumn("patch", F.col("patch").cast("array<float>")), path)
    return path


def publish_catalog(catalog: DataFrame, path: str, name: str, columns: Sequence[str] | None = None, version: str = "v1") -> str:
    """A catalogue as one JSON document {name, version, datasets} (with some columns only: the small one that a page loads) and as CSV.

    Catalogues have a row a published dataset, so both are single files.
    """
    rows = catalog.select(*(columns or catalog.columns))
    document = rows.agg(F.sort_array(F.collect_list(F.struct("*"))).alias("datasets")).select(F.lit(name).alias("name"), F.lit(version).alias("version"), "datasets")
    document.coalesce(1).write.mode("overwrite").json(f"{path}/json")
    export_csv(rows, f"{path}/csv", single=True)
    return path


def empty_catalog(spark: SparkSession, columns: Sequence[str], path: str) -> str:
    """A catalogue without rows, for others to append to."""
    return export_csv(spark.createDataFrame([], ", ".join(f"{c} string" for c in columns)), path, single=True)


def cached(spark: SparkSession, root: str, name: str, parts: Sequence[str], build: Callable[[], DataFrame], partition_by: Sequence[str] = ()) -> DataFrame:
    """The table of a step, built once for its inputs: the path holds a hash of all that identifies them."""
    path = f"{root}/{name}/{str_to_hash('|'.join(parts))}"
    if not is_complete(spark, path):
        write(build(), path, partition_by)
    return spark.read.parquet(path)


def write_regions(df: DataFrame, path: str, by: str) -> str:
    """Only the partitions that ``df`` has rows for are replaced; the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    return path


def blank(grid: DataFrame, values: Sequence[str]) -> DataFrame:
    """The grid's rows with null values, to be filled in by region."""
    return grid.select("*", *[F.lit(None).cast("double").alias(v) for v in values])


def combine_variables(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Variables that came one by one, side by side."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, list(keys), "full")
    return out


def export_csv(df: DataFrame, path: str, single: bool = False) -> str:
    """A text export; ``single`` is for point series and catalogues, which fit one task."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)
    return path


def export_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def write_pyramid(df: DataFrame, path: str) -> str:
    """A pyramid, partitioned by zoom level and sorted by tile, so that a tile is one range of a file."""
    df.repartition("level", "tile_y", "tile_x").sortWithinPartitions("level", "tile_y", "tile_x", "y", "x").write.mode("overwrite").partitionBy("level").parquet(path)
    return path


def by_time(df: DataFrame, time: str = "time") -> DataFrame:
    """The layout for maps: whole steps together."""
    return df.repartition(time).sortWithinPartitions(time)


def by_cell(df: DataFrame, cell: Sequence[str] = ("lat_i", "lon_i"), time: str = "time") -> DataFrame:
    """The layout for series: whole cells together, in order of time."""
    return df.repartition(*cell).sortWithinPartitions(*cell, time)


def copy_attributes(df: DataFrame, source: DataFrame) -> DataFrame:
    """Column metadata of one table put on another's columns of the same names."""
    known = {f.name: f.metadata for f in source.schema.fields}
    return df.select([F.col(c).alias(c, metadata=known[c]) if known.get(c) else F.col(c) for c in df.columns])


def finalize(spark: SparkSession, root: str, run: RunParameters, status: str = "complete", **paths: str) -> str:
    """A run's record, as a file of its time and as the latest one."""
    record = json.dumps({"parameters": {k: str(v) for k, v in run.__dict__.items()}, "status": status, "datasets": paths, "attrs": {"run_id": run.run_id, "hash": run.run_id_hash}}, sort_keys=True)
    stamp = datetime.datetime.now(datetime.timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    for name in (stamp, "latest"):
        write_bytes(spark, f"{root}/{run.run_id}/{name}.json", record.encode())
    return f"{root}/{run.run_id}/latest.json"


def copy_store(spark: SparkSession, source: str, target: str, rename: dict[str, str] | None = None) -> bool:
    """A copy with columns renamed, unless the target is complete; returns whether anything was copied."""
    if is_complete(spark, target):
        return False
    write(spark.read.parquet(source).withColumnsRenamed(rename or {}), target)
    return True


def chunk_lengths(lengths: dict[str, int], split: tuple[str, ...], item_bytes: int, target: int = 100_000_000) -> dict[str, int]:
    """Lengths of chunks of about ``target`` bytes: the dimensions of ``split`` are cut alike, the others stay whole."""
    if not isinstance(split, tuple):
        raise TypeError("split must be a tuple of dimensions")
    whole = math.prod(n for k, n in lengths.items() if k not in split)
    each = math.ceil((target / (item_bytes * whole)) ** (1 / len(split)))
    return {k: min(each, n) if k in split else n for k, n in lengths.items()}


def partitions_for(lengths: dict[str, int], split: tuple[str, ...], item_bytes: int, target: int = 100_000_000) -> int:
    """How many such chunks there are: partitions for ``repartition``."""
    chunks = chunk_lengths(lengths, split, item_bytes, target)
    return math.prod(-(-n // chunks[k]) for k, n in lengths.items())
