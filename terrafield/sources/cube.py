"""Gridded views of the driver's tables: daily fields as tidy rows (time, lat_i, lon_i, values).

======  =========================================  ==================================
view    columns                                    from
======  =========================================  ==================================
obs     time, lat_i, lon_i, pr, tasmax, tasmin      lineitem, a supplier being a cell
gcm     time, lat_i, lon_i, pr                      orders, customers folded on a grid of half the width
hourly  ts, cell, value                             events
cells   cell, lat_i, lon_i, region_id, is_land, elev   supplier and nation
cities  city, country, population, lat, lon          customer and nation
======  =========================================  ==================================
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CELL = ("lat_i", "lon_i")
DAY = ("time", *CELL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WIDTHS: dict[tuple[str, str], int] = {}


def grid_width(spark: SparkSession, sf_dir: str) -> int:
    """Cells per row: the root of the number of suppliers, rounded up to an even number; asked of the table once an application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WIDTHS:
        n = table(spark, sf_dir, "supplier").agg(F.max("s_suppkey")).first()[0] + 1
        w = math.ceil(math.sqrt(n))
        _WIDTHS[key] = w + w % 2
    return _WIDTHS[key]


#: Rows of a table that a task groups into cells' days, about; shuffles that are sized by bytes hand a task the more of them the better they pack.
TASK_ROWS = 250_000

_TASKS: dict[tuple[str, str, str], int] = {}


def tasks(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Tasks for a table's rows, in proportion to their number (which the files' footers tell); counted once an application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _TASKS:
        _TASKS[key] = max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, name).count() // TASK_ROWS))
    return _TASKS[key]


def _int(c):
    return c.cast("int")


def obs(spark: SparkSession, sf_dir: str, by: Sequence[str] = DAY) -> DataFrame:
    """Rows are dealt out once, by cells' days, or by cells for steps along a cell's series; ``by`` says which."""
    w = grid_width(spark, sf_dir)
    cell = F.col("l_suppkey")
    rows = table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("time"), _int(F.floor(cell / w)).alias("lat_i"), _int(cell % w).alias("lon_i"), "l_quantity", "l_extendedprice"
    )
    rows = rows.repartition(tasks(spark, sf_dir, "lineitem"), *by)
    return rows.groupBy("time", *CELL).agg(F.sum("l_quantity").alias("pr"), F.max("l_extendedprice").alias("tasmax"), F.min("l_extendedprice").alias("tasmin"))


def gcm(spark: SparkSession, sf_dir: str, by: Sequence[str] = DAY) -> DataFrame:
    """Dealt out as ``obs``."""
    h = grid_width(spark, sf_dir) // 2
    cell = F.col("o_custkey") % (h * h)
    rows = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("time"), _int(F.floor(cell / h)).alias("lat_i"), _int(cell % h).alias("lon_i"), F.col("o_totalprice").cast("decimal(18,2)").alias("p"))
    rows = rows.repartition(tasks(spark, sf_dir, "orders"), *by)
    return rows.groupBy("time", *CELL).agg(F.sum("p").cast("double").alias("pr"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("ts", _int(F.col("user_id") % 25).alias("cell"), "value")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = grid_width(spark, sf_dir)
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    key = F.col("s_suppkey")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        key.alias("cell"), _int(F.floor(key / w)).alias("lat_i"), _int(key % w).alias("lon_i"), _int(F.col("n_regionkey")).alias("region_id"), (F.col("s_acctbal") > 0).alias("is_land"), F.col("s_acctbal").alias("elev")
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    h = grid_width(spark, sf_dir)
    key = F.col("c_custkey")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_name").alias("city"), F.col("n_name").alias("country"), F.col("c_acctbal").alias("population"), ((key * 7 % (10 * h)) / F.lit(10.0)).alias("lat"), ((key * 13 % (10 * h)) / F.lit(10.0)).alias("lon")
    )


# The same views as SQL, for the queries' oracles.
WIDTH = "(SELECT w + w % 2 FROM (SELECT ceil(sqrt(max(s_suppkey) + 1))::BIGINT AS w FROM supplier))"
OBS = f"obs AS (SELECT l_shipdate::DATE AS time, (l_suppkey // {WIDTH})::INT AS lat_i, (l_suppkey % {WIDTH})::INT AS lon_i, sum(l_quantity) AS pr, max(l_extendedprice) AS tasmax, min(l_extendedprice) AS tasmin FROM lineitem GROUP BY ALL)"
GCM = f"gcm AS (SELECT time, (c // h)::INT AS lat_i, (c % h)::INT AS lon_i, sum(p)::DOUBLE AS pr FROM (SELECT o_orderdate::DATE AS time, h, o_custkey % (h * h) AS c, o_totalprice::DECIMAL(18,2) AS p FROM orders, (SELECT {WIDTH} // 2 AS h)) GROUP BY time, c // h, c % h)"
HOURLY = "hourly AS (SELECT ts, (user_id % 25)::INT AS cell, value FROM events)"
CELLS = f"cells AS (SELECT s_suppkey AS cell, (s_suppkey // {WIDTH})::INT AS lat_i, (s_suppkey % {WIDTH})::INT AS lon_i, n_regionkey::INT AS region_id, s_acctbal > 0 AS is_land, s_acctbal AS elev FROM supplier JOIN nation ON s_nationkey = n_nationkey)"
CITIES = f"cities AS (SELECT c_name AS city, n_name AS country, c_acctbal AS population, (c_custkey * 7 % (10 * {WIDTH})) / 10.0::DOUBLE AS lat, (c_custkey * 13 % (10 * {WIDTH})) / 10.0::DOUBLE AS lon FROM customer JOIN nation ON c_nationkey = n_nationkey)"
