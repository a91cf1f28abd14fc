"""Scratch tables, schemas and small helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that end a word in "plain words" (after lower-casing A-Z): all ASCII but 0-9 and a-z.
_PLAIN = bytes(
    (b + 32 if 65 <= b <= 90 else b) if (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) else 32
    for b in range(256)
)


def plain_words(text: str | None) -> list[bytes]:
    r"""Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of a text with A-Z lower-cased, as UTF-8 bytes."""
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).split() if text else []


def space_words(text: str | None) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+`` of a text with A-Z lower-cased, as UTF-8 bytes."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    ``spark.checkpoint.dir`` names it. Where that is unset, a temporary folder is made and set if
    all runs in this process (as in tests); on a cluster that is an error, since no other machine would see it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = set_dir.get() if set_dir.isDefined() else None
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="terrafield-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/") if "://" in path or path.startswith("file:") else "file://" + os.path.abspath(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/terrafield/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, **settings: str):
    """Spark settings for what is planned meanwhile."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


#: Scratch tables as zstd, for callers of ``settings``: texts take a third less than by Spark's default.
ZSTD = {"spark.sql.parquet.compression.codec": "zstd"}


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    The write's own shuffle files go as it ends, not when garbage is next collected.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with settings(spark, **{"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pieces(batch: pa.RecordBatch, text: int, rows: int = 512, letters: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch with their texts (null: empty), of so many rows and letters at most, or of one row."""
    texts = [t or "" for t in batch.column(text).to_pylist()]
    begin = size = 0
    for i, t in enumerate(texts):
        if i > begin and (i - begin >= rows or size + len(t) > letters):
            yield batch.slice(begin, i - begin), texts[begin:i]
            begin, size = i, 0
        size += len(t)
    if texts:
        yield batch.slice(begin), texts[begin:]


def clear_shuffles(spark: SparkSession) -> None:
    """Has the driver collect its garbage, upon which Spark's cleaner removes the shuffle files of tables already written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def at_most(df: DataFrame, column: str, size: int) -> DataFrame:
    """Rows of the highest counts in ``column``, ``size`` of them at most: all rows from a count on.

    The count comes from a histogram on a logarithmic scale (some thousand bins; below 32 each count is a bin),
    so no task sorts or gathers more than the rows it returns. Rows that tie in a bin stay or go
    together. Callers use what is chosen for speed alone and have another way for the rest.
    """
    fine = F.floor(F.log2(F.col(column).cast("double")) * 32)
    bins = sorted(((r.b, r.n) for r in df.filter(F.col(column) > 0).groupBy(fine.alias("b")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, total = None, 0
    for b, n in bins:
        total += n
        if total > size:
            break
        least = b
    return df.filter(fine >= least) if least is not None else df.limit(0)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_scratch(df: DataFrame) -> None:
    """Removes the files of a table that ``materialise`` wrote, once nothing reads it any more."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/terrafield/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def by_position(df: DataFrame) -> DataFrame:
    """``df`` with its columns named by their places, for steps that names with points, or that differ in case alone, would upset."""
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))])


def map_rows(df: DataFrame, function) -> DataFrame:
    """``mapInArrow`` for a function that takes columns by place and hands all of them on."""
    plain = by_position(df)
    return plain.mapInArrow(function, plain.schema).toDF(*df.columns)
