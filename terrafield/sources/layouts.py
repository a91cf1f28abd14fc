"""Layouts that last: tables bucketed by cell, so that steps per cell do not shuffle again.

A bucketed table is Parquet files, one a bucket, each sorted; Spark's catalogue knows how it is dealt, and windows, groupings and joins by the
same columns read it as it lies. ``rechunked`` writes one unless it is there already.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CELL = ("lat_i", "lon_i")
#: What a task holds of one bucket at most.
BUCKET_BYTES = 128 << 20
#: Bytes of a value in memory, to reckon a table's size by.
VALUE_BYTES = 8


def buckets_for(rows: int, columns: int, most_bytes: int = BUCKET_BYTES) -> int:
    """So many buckets that one of them fits the memory of a task."""
    return max(1, math.ceil(rows * columns * VALUE_BYTES / most_bytes))


def layout_of(spark: SparkSession, name: str) -> dict[str, object]:
    """How a table of the catalogue is dealt: buckets, by, sort; nothing for one that is not bucketed or is not there."""
    if not spark.catalog.tableExists(name):
        return {}
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if "Num Buckets" not in facts:
        return {}
    listed = lambda text: [c.strip(" `") for c in (text or "").strip("[]").split(",") if c.strip(" `")]
    return {"buckets": int(facts["Num Buckets"]), "by": listed(facts.get("Bucket Columns")), "sort": listed(facts.get("Sort Columns")), "path": facts.get("Location")}


def conforms(spark: SparkSession, name: str, by: Sequence[str] = CELL, sort: Sequence[str] = ("time",), buckets: int | None = None) -> bool:
    """Whether a table is dealt so already (whatever its number of buckets, unless that is given)."""
    found = layout_of(spark, name)
    return bool(found) and found["by"] == list(by) and found["sort"] == [*by, *sort] and buckets in (None, found["buckets"])


def rechunked(df: DataFrame, name: str, path: str, by: Sequence[str] = CELL, sort: Sequence[str] = ("time",), buckets: int | None = None, most_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The table ``name`` at ``path`` with the rows of ``df``, bucketed ``by`` and sorted; a table that conforms is read as it is, not written again.

    Without ``buckets`` there are so many that one takes at most ``most_bytes`` in memory. One shuffle deals the rows, each bucket being one file.
    """
    spark = df.sparkSession
    if not conforms(spark, name, by, sort, buckets):
        n = buckets or buckets_for(df.count(), len(df.columns), most_bytes)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        # A file a bucket: rows are dealt by the hash that the writer uses.
        dealt = df.repartition(n, *by)
        dealt.write.mode("overwrite").format("parquet").bucketBy(n, *by).sortBy(*by, *sort).option("path", path).saveAsTable(name)
    return spark.table(name)


def files_per_key(table: DataFrame, by: Sequence[str] = CELL) -> DataFrame:
    """keys, files, n: over how many files the rows of each key are spread, and how many rows it has."""
    return table.select(*by, F.input_file_name().alias("_file")).groupBy(*by).agg(F.count_distinct("_file").alias("files"), F.count("*").alias("n"))
