"""Calendars, gaps and windows along time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import d, lon_to_180

CELL = ("lat_i", "lon_i")

STANDARD = ("standard", "gregorian", "proleptic_gregorian")
SHORT_OR_LONG = ("noleap", "365_day", "366_day", "all_leap")


def day_spine(df: DataFrame, cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """Every day from each cell's first to its last, with the cell's values where there are any.

    Each row makes the days up to the next row itself, so one shuffle by cell does it, which the
    windows that follow use again; no join with a calendar.
    """
    after = F.lead(time).over(Window.partitionBy(*cell).orderBy(time))
    end = F.greatest(F.col(time), F.coalesce(F.date_sub(after, 1), F.col(time)))
    values = [c for c in df.columns if c not in (*cell, time)]
    days = df.withColumn("_end", end).select("*", F.explode(F.sequence(time, "_end", F.expr("interval 1 day"))).alias("_day"))
    own = F.col("_day") == F.col(time)
    return days.select(*cell, F.col("_day").alias(time), *[F.when(own, F.col(v)).alias(v) for v in values])


def interpolate_linear(df: DataFrame, values: Sequence[str], cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """Nulls between two values of a cell become the line between them; nulls at the ends stay."""
    # Both frames grow row by row; one that shrinks towards the end would be summed anew for each row.
    before = Window.partitionBy(*cell).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*cell).orderBy(F.desc(time)).rowsBetween(Window.unboundedPreceding, 0)
    day = F.datediff(F.col(time), F.lit("1970-01-01").cast("date"))
    out = df
    for v in values:
        at = F.when(F.col(v).isNotNull(), day)
        x0, x1 = F.last(v, True).over(before), F.last(v, True).over(after)
        t0, t1 = F.last(at, True).over(before), F.last(at, True).over(after)
        line = x0 + (x1 - x0) * (day - t0).cast("double") / (t1 - t0).cast("double")
        out = out.withColumn(v, F.when(F.col(v).isNotNull(), F.col(v)).otherwise(line))
    return out


def to_standard_calendar(df: DataFrame, calendar: str, values: Sequence[str], cell: Sequence[str] = CELL, year: str = "year", month: str = "month", day: str = "day") -> DataFrame:
    """Rows of (year, month, day) of a model calendar as dates, the days that it lacks filled between neighbours.

    Days that the real calendar lacks are left out. 360-day calendars are refused.
    """
    if calendar not in STANDARD + SHORT_OR_LONG:
        raise ValueError(f"calendar {calendar!r} cannot be converted")
    dated = df.withColumn("time", F.try_make_date(year, month, day) if hasattr(F, "try_make_date") else F.to_date(F.format_string("%04d-%02d-%02d", year, month, day)))
    dated = dated.filter(F.col("time").isNotNull()).drop(year, month, day)
    if calendar in STANDARD:
        return dated
    return interpolate_linear(day_spine(dated, cell), values, cell)


def postprocess(df: DataFrame, calendar: str, values: Sequence[str], lat: str = "lat", lon: str = "lon") -> DataFrame:
    """A raw model table made standard: longitudes to +-180, auxiliary columns dropped, real dates at midnight."""
    keep = [c for c in df.columns if c in {lat, lon, "year", "month", "day", *values}]
    out = df.select(*keep).withColumn(lon, lon_to_180(F.col(lon)))
    return to_standard_calendar(out, calendar, values, (lat, lon))


def rolling_mean(df: DataFrame, value: str, width: int, out: str, partition: Sequence[str], order: str, min_periods: int | None = None) -> DataFrame:
    """Centred mean of an odd number of steps; null unless ``min_periods`` (all of them, by default) have values."""
    if width % 2 == 0:
        raise ValueError(f"a centred window needs an odd width, not {width}")
    h = width // 2
    over = Window.partitionBy(*partition).orderBy(order).rowsBetween(-h, h)
    least = width if min_periods is None else min_periods
    return df.withColumn(out, F.when(F.count(value).over(over) >= least, F.avg(value).over(over)))


def circular_pad(df: DataFrame, offset: int, cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """The series with its last ``offset`` steps put before it and its first ones behind it, their dates moved by the series' span.

    Adds ``padded``: whether the row is a copy.
    """
    order = Window.partitionBy(*cell).orderBy(time)
    back = Window.partitionBy(*cell).orderBy(F.desc(time))
    whole = Window.partitionBy(*cell)
    rows = df.withColumn("_i", F.row_number().over(order)).withColumn("_j", F.row_number().over(back)).withColumn("_a", F.min(time).over(whole)).withColumn("_b", F.max(time).over(whole))
    span = F.datediff("_b", "_a") + 1
    # A row near an end is there once more, near both ends twice more; the windows are planned once.
    copies = F.array_compact(F.array(F.lit(0), F.when(F.col("_i") <= offset, span), F.when(F.col("_j") <= offset, -span)))
    moved = rows.withColumn("_moved", F.explode(copies))
    return moved.withColumn(time, F.date_add(time, F.col("_moved"))).withColumn("padded", F.col("_moved") != 0).drop("_i", "_j", "_a", "_b", "_moved")


def epoch_trend(df: DataFrame, value: str, historical: Column, day_window: int = 21, year_window: int = 31, cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """(time, cell, trend): a slow cycle of the series less the historical mean of its day of the year.

    The series is padded in a circle and smoothed over ``day_window`` steps, then over years within
    each day of the year. Years too near an end for a whole year window take the trend of the
    nearest year that has one. Both windows are odd. One shuffle by cell serves all but the join
    of the (small) climatology.
    """
    if day_window % 2 == 0 or year_window % 2 == 0:
        raise ValueError("both windows must be odd")
    h = day_window // 2

    def smooth(rows: DataFrame) -> DataFrame:
        padded = circular_pad(rows.select(time, *cell, value), h, cell, time)
        return rolling_mean(padded, value, day_window, "_s", cell, time).filter("NOT padded AND _s IS NOT NULL")

    history = smooth(df.filter(historical)).groupBy(F.dayofyear(time).alias("_doy"), *cell).agg(F.avg("_s").alias("_mean"))
    days = smooth(df).withColumn("_doy", F.dayofyear(time)).withColumn("_year", F.year(time))
    by_day = Window.partitionBy(*cell, "_doy")
    in_order = by_day.orderBy("_year")
    half = year_window // 2
    days = days.withColumn("_n", F.count("*").over(by_day)).withColumn("_k", F.row_number().over(in_order))
    # Near an end the window of the nearest year that has one: the day's first, or last, years.
    first = F.avg(F.when(F.col("_k") <= year_window, F.col("_s"))).over(by_day)
    last = F.avg(F.when(F.col("_k") > F.col("_n") - year_window, F.col("_s"))).over(by_day)
    cycle = F.when(F.col("_n") <= year_window, F.avg("_s").over(by_day)).when(F.col("_k") <= half, first).when(F.col("_k") > F.col("_n") - half, last)
    days = days.withColumn("_cycle", cycle.otherwise(F.avg("_s").over(in_order.rowsBetween(-half, half))))
    return days.join(history, [*cell, "_doy"]).select(time, *cell, (F.col("_cycle") - F.col("_mean")).alias("trend"))


def generate_batches(df_or_n: int, batch_size: int, buffer_size: int, spark, one_indexed: bool = False) -> DataFrame:
    """(batch, item, is_core): items 0 to n - 1 in batches of a size, each with a buffer on both sides that wraps around."""
    n = df_or_n
    starts = spark.range(0, -(-n // batch_size)).select(F.col("id").cast("int").alias("batch"), (F.col("id") * batch_size).cast("int").alias("a"))
    ends = F.least(F.col("a") + batch_size, F.lit(n))
    rows = starts.select("batch", "a", ends.alias("b")).select("batch", "a", "b", F.explode(F.sequence(F.col("a") - buffer_size, F.col("b") + buffer_size - 1)).alias("i"))
    base = int(one_indexed)
    return rows.select("batch", (F.pmod("i", F.lit(n)) + base).cast("int").alias("item"), ((F.col("i") >= F.col("a")) & (F.col("i") < F.col("b"))).alias("is_core"))


def is_monotonic(df: DataFrame, value: str, order: str, by: Sequence[str] = ()) -> DataFrame:
    """Whether a coordinate rises at every step, by group."""
    step = F.col(value) - F.lag(value).over(Window.partitionBy(*by).orderBy(order))
    return df.withColumn("_d", step).groupBy(*by).agg(F.bool_and(F.coalesce(F.col("_d") > 0, F.lit(True))).alias("monotonic"))
