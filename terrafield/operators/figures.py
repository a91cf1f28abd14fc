"""The data of figures; drawing them is left to whoever looks at them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import TimePeriod


def cdfs(datasets: dict[str, tuple[DataFrame, TimePeriod]], value: str, place: Sequence[str] = ("city",), time: str = "time") -> DataFrame:
    """label, place, x, share: the empirical distribution of each dataset over its period at each place, a row a distinct value.

    ``share`` is the part of the values at or below x; missing values have none. Labels name the dataset and its years.
    """
    rows = None
    for name, (df, period) in datasets.items():
        one = df.filter(period.predicate(time)).select(F.lit(f"{name} ({period.start}-{period.stop})").alias("label"), *place, F.col(value).cast("double").alias("x"))
        rows = one if rows is None else rows.unionByName(one)
    counted = rows.filter(F.col("x").isNotNull() & ~F.isnan("x")).groupBy("label", *place, "x").agg(F.count("*").alias("n"))
    own = Window.partitionBy("label", *place)
    upto = own.orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.select("label", *place, "x", (F.sum("n").over(upto) / F.sum("n").over(own)).alias("share"))


def values_and_difference(first: DataFrame, second: DataFrame, value: str, metric: str = "mean", method: str = "absolute", limit: float | None = None, place: Sequence[str] = ("lat_i", "lon_i")) -> DataFrame:
    """place, first, second, difference: a metric (mean, min, max or stddev_pop) of two datasets at each place that both have, and what the second has more.

    ``method`` percent gives the difference in hundredths of the first (null where that is zero); ``limit`` clips it on both sides, as a colour bar does.
    """
    of = {"mean": F.avg, "min": F.min, "max": F.max, "stddev_pop": F.stddev_pop}
    if metric not in of or method not in ("absolute", "percent"):
        raise ValueError(f"no metric {metric!r} or method {method!r}")
    a, b = (df.groupBy(*place).agg(of[metric](F.col(value).cast("double")).alias(name)) for df, name in ((first, "first"), (second, "second")))
    difference = F.col("second") - F.col("first")
    if method == "percent":
        difference = F.when(F.col("first") != 0, difference / F.col("first") * 100)
    if limit is not None:
        difference = F.when(difference.isNotNull(), F.greatest(F.lit(-float(limit)), F.least(F.lit(float(limit)), difference)))
    return a.join(b, list(place)).select(*place, "first", "second", difference.alias("difference"))
