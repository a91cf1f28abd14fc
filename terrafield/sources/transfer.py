"""Listing of folders and copying of files as bytes, by tasks.

A crawl lists a frontier of folders a round, each folder by a task that gets it, and writes what it finds; the driver sees counts. A copy streams every file
in blocks and keeps a manifest of lengths and checksums, by which a copy that was broken off goes on and a damaged file is found.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import _open
from .scratch import written
from .sinks import exists

BLOCK = 8 << 20
FOUND = "path string, folder boolean, bytes bigint, modified timestamp"


def _list(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies right in each folder."""
    for batch in batches:
        for uri in batch.column(0).to_pylist():
            fs, root = _open(uri)
            found = sorted(fs.get_file_info(pafs.FileSelector(root, recursive=False, allow_not_found=True)), key=lambda f: f.path)
            head = uri.rstrip("/")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{head}/{f.base_name}" for f in found], pa.string()), pa.array([f.type == pafs.FileType.Directory for f in found], pa.bool_()),
                    pa.array([None if f.type == pafs.FileType.Directory else f.size for f in found], pa.int64()), pa.array([f.mtime for f in found], pa.timestamp("us", "UTC")),
                ],
                ["path", "folder", "bytes", "modified"],
            )


def crawl(spark: SparkSession, root: str, tasks: int | None = None) -> DataFrame:
    """path, folder, bytes, modified of everything below ``root``: a round a level, a folder a row of its frontier. A root that is not there has nothing."""
    tasks = tasks or spark.sparkContext.defaultParallelism
    found, frontier = None, spark.createDataFrame([(root.rstrip("/"),)], "path string")
    while True:
        level = written(frontier.repartition(tasks).mapInArrow(_list, FOUND), "crawl")
        found = level if found is None else found.unionByName(level)
        frontier = level.filter("folder").select("path")
        if frontier.isEmpty():
            return found


def _copier(source: str, target: str):
    def copy(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each file to a part beside its place, then into it; lengths and checksums of what was read."""
        for batch in batches:
            for name in batch.column(0).to_pylist():
                (fs, root), (to, folder) = _open(source), _open(target)
                place = f"{folder}/{name}"
                part, crc, size = f"{place}.{uuid.uuid4().hex}.part", 0, 0
                to.create_dir(place.rsplit("/", 1)[0], recursive=True)
                with fs.open_input_stream(f"{root}/{name}") as read, to.open_output_stream(part) as out:
                    while block := read.read(BLOCK):
                        out.write(block)
                        crc, size = zlib.crc32(block, crc), size + len(block)
                to.move(part, place)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64()), pa.array([crc], pa.int64())], ["name", "bytes", "crc32"])

    return copy


def _summer(root: str):
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lengths and checksums of files; those that are not there are left out."""
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, folder = _open(root)
                if fs.get_file_info(f"{folder}/{name}").type != pafs.FileType.File:
                    continue
                crc = size = 0
                with fs.open_input_stream(f"{folder}/{name}") as read:
                    while block := read.read(BLOCK):
                        crc, size = zlib.crc32(block, crc), size + len(block)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64()), pa.array([crc], pa.int64())], ["name", "bytes", "crc32"])

    return add


_SUMS = "name string, bytes bigint, crc32 bigint"


def checksums(names: DataFrame, root: str, tasks: int | None = None) -> DataFrame:
    """name, bytes, crc32 of files (named below ``root``) as they are now."""
    return names.select("name").repartition(tasks or names.sparkSession.sparkContext.defaultParallelism).mapInArrow(_summer(root), _SUMS)


def names_below(found: DataFrame, root: str) -> DataFrame:
    """name, bytes of the files of a crawl, named from its root on."""
    return found.filter(~F.col("folder")).select(F.expr(f"substring(path, {len(root.rstrip('/')) + 2})").alias("name"), "bytes")


def copy_files(spark: SparkSession, source: str, target: str, manifest: str, verify: bool = False, tasks: int | None = None) -> int:
    """Every file below ``source`` as bytes below ``target``; returns how many were copied.

    ``manifest`` is a table of what was copied: name, bytes, crc32, a run's rows beside those of the runs before. Files that it has with the source's length and
    whose copy has that length are not copied again; with ``verify`` the copies are read, and those that differ from their checksum are.
    """
    tasks = tasks or spark.sparkContext.defaultParallelism
    todo = names_below(crawl(spark, source, tasks), source)
    if exists(spark, manifest):
        known = spark.read.schema("run bigint, " + _SUMS).parquet(manifest)
        known = known.groupBy("name").agg(F.max_by("bytes", "run").alias("bytes"), F.max_by("crc32", "run").alias("crc32"), F.max("run").alias("run"))
        run = (known.agg(F.max("run")).first()[0] or 0) + 1
        now = checksums(known, target, tasks) if verify else names_below(crawl(spark, target, tasks), target)
        good = known.join(now, ["name", "bytes", "crc32"] if verify else ["name", "bytes"])
        todo = todo.join(good, ["name", "bytes"], "left_anti")
    else:
        run = 0
    todo = written(todo.select("name"), "copy-list")
    done = todo.repartition(tasks).mapInArrow(_copier(source, target), _SUMS).withColumn("run", F.lit(run).cast("bigint"))
    done.select("run", "name", "bytes", "crc32").write.mode("append").parquet(manifest)
    return todo.count()
