"""Incremental feeds: daily aggregates, wet spells and a water bucket over a stream of readings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.water import Bucket


def read_stream(spark: SparkSession, path: str, schema: str, ts: str = "ts", files_per_trigger: int | None = None) -> DataFrame:
    """A folder of Parquet files as a stream; its time column becomes an instant (watermarks need one)."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).withColumn(ts, F.col(ts).cast("timestamp"))


def daily(stream: DataFrame, keys: list[str], value: str = "value", ts: str = "ts", late: str = "2 days") -> DataFrame:
    """Daily mean, maximum, minimum and count by key; readings later than the watermark are left out."""
    day = F.window(ts, "1 day")
    out = stream.withWatermark(ts, late).groupBy(day, *keys).agg(F.avg(value).alias("mean"), F.max(value).alias("high"), F.min(value).alias("low"), F.count(value).alias("n"))
    return out.select(F.to_date("window.start").alias("time"), *keys, "mean", "high", "low", "n")


def spells(stream: DataFrame, keys: list[str], condition, gap: str = "1 day", ts: str = "ts", late: str = "2 days") -> DataFrame:
    """Runs of readings that meet a condition with at most ``gap`` between them: start, end and number."""
    out = stream.filter(condition).withWatermark(ts, late).groupBy(F.session_window(ts, gap), *keys).agg(F.count("*").alias("n"))
    return out.select(*keys, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def bucket(stream: DataFrame, key: str = "cell", awc: float = 100.0) -> DataFrame:
    """The water bucket's state carried from month to month; ``stream`` has the key, month (a text that sorts), ppt, pet and melt.

    Months must arrive in order within a key; earlier ones than the state's are left out.
    """

    def step(keys: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        soil, swe, last = state.get if state.exists else (awc, 0.0, "")
        water = Bucket(np.array([awc]), np.array([soil]), np.array([swe]))
        rows = []
        for frame in frames:
            for r in frame.sort_values("month").itertuples():
                if r.month <= last:
                    continue
                month = water.step(np.array([r.ppt]), np.array([r.pet]), np.array([r.melt]))
                last = r.month
                rows.append((keys[0], r.month, *(float(month[c][0]) for c in ("aet", "def", "q", "soil", "swe"))))
        state.update((float(water.soil[0]), float(water.snow[0]), last))
        yield pd.DataFrame(rows, columns=[key, "month", "aet", "def", "q", "soil", "swe"])

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, month string, aet double, def double, q double, soil double, swe double", "soil double, swe double, last string", "append", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """All that is there now, written exactly once to a Parquet folder with a checkpoint beside it."""
    query = stream.writeStream.outputMode(mode).format("parquet").option("path", f"{path}/data").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/data")
