"""Aggregates of long series whose partial states merge: no group ever holds a whole series.

A quantile sketch is a count a bucket, buckets growing by a constant factor, so states merge by adding counts. Spells (runs of days on which
something holds) merge at their ends: a block of days keeps its first and last run and sums of those between, and
blocks are joined in order. Both are DataFrame expressions; Spark merges states ahead of each shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult
from pyspark.sql.types import DateType, DoubleType, IntegerType, StructType

CELL = ("lat_i", "lon_i")

#: Days of a block whose runs are found at once.
BLOCK_DAYS = 512


def _growth(error: float) -> float:
    if not 0 < error < 1:
        raise ValueError("the relative error lies between 0 and 1")
    return (1 + error) / (1 - error)


def quantile_sketch(df: DataFrame, value: str, keys: Sequence[str] = CELL, error: float = 0.01) -> DataFrame:
    """keys, sign, bucket, n: how many values of each key lie in each bucket; missing ones (null, NaN) in none.

    All values of a bucket are within ``error`` of its own value, relative to it. A key has some hundred buckets per
    factor of e ** (100 * 2 * error), however many values there are. Sketches of the same error are put together by ``merge_sketches``.
    """
    x = F.col(value).cast("double")
    bucket = F.when(x == 0, F.lit(0)).otherwise(F.ceil(F.log(F.abs(x)) / F.lit(math.log(_growth(error))))).cast("int")
    return df.filter(x.isNotNull() & ~F.isnan(x)).groupBy(*keys, F.signum(x).cast("int").alias("sign"), bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merge_sketches(sketches: Sequence[DataFrame], keys: Sequence[str] = CELL) -> DataFrame:
    """One sketch of the values of several."""
    out = sketches[0]
    for s in sketches[1:]:
        out = out.unionByName(s)
    return out.groupBy(*keys, "sign", "bucket").agg(F.sum("n").alias("n"))


def sketch_quantiles(sketch: DataFrame, probabilities: Sequence[float], keys: Sequence[str] = CELL, error: float = 0.01) -> DataFrame:
    """keys, p, value: the least value with at least a share ``p`` of the values at or below it, within ``error`` of it."""
    growth = _growth(error)
    order = Window.partitionBy(*keys).orderBy("sign", F.col("sign") * F.col("bucket"))
    whole = Window.partitionBy(*keys)
    counted = sketch.select("*", F.sum("n").over(order).alias("upto"), F.sum("n").over(whole).alias("all"))
    asked = counted.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    rank = F.greatest(F.lit(1), F.ceil(F.col("p") * F.col("all")))
    here = asked.filter((F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank))
    return here.select(*keys, "p", (F.col("sign") * 2 * F.pow(F.lit(growth), F.col("bucket")) / (growth + 1)).alias("value"))


# A block's state: its number; its first and last run, that touch its ends; whether both are the one run of a whole block; and number, sum and longest of the runs within.
_STATE = "struct<block: bigint, whole: boolean, first: bigint, last: bigint, n: bigint, total: bigint, longest: bigint>"


def spell_states(df: DataFrame, holds: Column, keys: Sequence[str] = CELL, time: str = "time", block_days: int = BLOCK_DAYS) -> DataFrame:
    """keys, state: a state for each block of days with any day on which ``holds`` is true; days that are missing break a run."""
    day = F.unix_date(F.col(time))
    rows = df.filter(holds).select(*keys, day.alias("_day"), F.floor(day / block_days).alias("_block")).distinct()
    within = Window.partitionBy(*keys, "_block").orderBy("_day")
    runs = rows.withColumn("_run", F.col("_day") - F.row_number().over(within)).groupBy(*keys, "_block", "_run").agg(F.min("_day").alias("_from"), F.max("_day").alias("_to"))
    begin = F.col("_block") * block_days
    length = (F.col("_to") - F.col("_from") + 1).cast("bigint")
    at_first, at_last = F.col("_from") == begin, F.col("_to") == begin + block_days - 1
    inner = ~at_first & ~at_last
    some = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    state = F.struct(
        F.col("_block").alias("block"), F.max(at_first & at_last).alias("whole"), some(F.max(F.when(at_first, length))).alias("first"), some(F.max(F.when(at_last, length))).alias("last"),
        F.count_if(inner).alias("n"), some(F.sum(F.when(inner, length))).alias("total"), some(F.max(F.when(inner, length))).alias("longest"),
    )
    return runs.groupBy(*keys, "_block").agg(state.cast(_STATE).alias("state")).select(*keys, "state")


def _joined(a: Column, b: Column) -> Column:
    """The state of two stretches of blocks, ``b`` behind ``a``; blocks between them that have no state hold no run."""
    follows = a["block"] + 1 == b["block"]
    bridge = F.when(follows, a["last"] + b["first"]).otherwise(F.lit(0))  # the run across the border
    a_open, b_open = a["whole"] & follows, b["whole"] & follows  # one whole side: the run goes on as the first or last of both
    none = F.lit(0).cast("bigint")
    ended = [
        F.when(a_open | b_open, none).otherwise(bridge),
        F.when(follows | a["whole"], none).otherwise(a["last"]),  # a run of a whole side stays the first or last
        F.when(follows | b["whole"], none).otherwise(b["first"]),
    ]
    n = a["n"] + b["n"]
    for e in ended:
        n = n + (e > 0).cast("bigint")
    return F.struct(
        b["block"].alias("block"), (a_open & b_open).alias("whole"), F.when(a_open, bridge).otherwise(a["first"]).alias("first"), F.when(b_open, bridge).otherwise(b["last"]).alias("last"),
        n.alias("n"), (a["total"] + b["total"] + ended[0] + ended[1] + ended[2]).alias("total"), F.greatest(a["longest"], b["longest"], *ended).alias("longest"),
    ).cast(_STATE)


def spells(df: DataFrame, holds: Column, keys: Sequence[str] = CELL, time: str = "time", block_days: int = BLOCK_DAYS) -> DataFrame:
    """keys, n_spells, mean_days, longest of the runs of days on which ``holds`` is true; keys without any are left out."""
    states = spell_states(df, holds, keys, time, block_days).groupBy(*keys).agg(F.array_sort(F.collect_list("state")).alias("_states"))
    rest = F.slice("_states", 2, F.size("_states"))
    whole = states.withColumn("_s", F.aggregate(rest, F.col("_states")[0], _joined))
    s = F.col("_s")
    # What is open at both ends counts as it is; a single run that is first and last counts once.
    ends = [s["first"], F.when(s["whole"], F.lit(0)).otherwise(s["last"])]
    n = s["n"] + (ends[0] > 0).cast("bigint") + (ends[1] > 0).cast("bigint")
    total = s["total"] + ends[0] + ends[1]
    return whole.select(*keys, n.alias("n_spells"), (total / n).alias("mean_days"), F.greatest(s["longest"], *ends).alias("longest"))


class HeatWaves:
    """A table function over one place's days in order: a row for each run of days on end above a threshold.

    Arguments: a table (PARTITION BY the place, ORDER BY time) whose columns are found by name, the threshold, and the least days. Columns out: the
    partition's keys, start, end, days, peak (the highest value) and peak_day (the first of it). Null values end a run.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument, threshold: AnalyzeArgument, least: AnalyzeArgument, time: AnalyzeArgument, value: AnalyzeArgument) -> AnalyzeResult:
        schema = StructType([f for f in rows.dataType.fields if f.name not in (time.value, value.value)])
        for name, kind in (("start", DateType()), ("end", DateType()), ("days", IntegerType()), ("peak", DoubleType()), ("peak_day", DateType())):
            schema = schema.add(name, kind)
        return AnalyzeResult(schema=schema)

    def __init__(self):
        self.keys, self.run = (), []
        self.least = 1

    def eval(self, row, threshold: float, least: int, time: str, value: str):
        day, x = row[time], row[value]
        self.least = least
        self.keys = tuple(row[c] for c in row.asDict() if c not in (time, value))
        over = x is not None and x > threshold
        if self.run and not (over and (day - self.run[-1][0]).days == 1):
            yield from self._wave()
        if over:
            self.run.append((day, x))

    def terminate(self):
        yield from self._wave()

    def _wave(self):
        run, self.run = self.run, []
        if len(run) >= self.least:
            peak = max(x for _, x in run)
            yield (*self.keys, run[0][0], run[-1][0], len(run), float(peak), next(d for d, x in run if x == peak))


def heat_waves(df: DataFrame, value: str, threshold: float, least: int = 3, keys: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """keys, start, end, days, peak, peak_day of each run of at least so many days on end above the threshold, a row a run."""
    waves = F.udtf(HeatWaves)
    rows = df.select(*keys, time, F.col(value).cast("double").alias(value))
    return waves(rows.asTable().partitionBy(*keys).orderBy(time), F.lit(float(threshold)), F.lit(int(least)), F.lit(time), F.lit(value))
