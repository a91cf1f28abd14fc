"""Aggregations over time, space and calendar keys of tidy daily fields.

``cell`` names the columns that make up a grid cell. Missing values are nulls; aggregates skip
them unless ``skipna`` says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import d, days_in_month, season
from ..params import percentile_of

CELL = ("lat_i", "lon_i")
#: How a variable is summarised over time.
RULES = {"tasmax": "avg", "tasmin": "avg", "pr": "sum"}
FREQUENCIES = {"1MS": "MM", "MS": "MM", "1AS": "YY", "YS": "YY", "1D": "DD"}


def _sum0(c: Column) -> Column:
    """A sum that is 0 over nothing but nulls."""
    return F.coalesce(F.sum(c), d(0))


def time_summary(df: DataFrame, freq: str = "1MS", cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """Monthly (1MS) or yearly (1AS) summary: temperatures averaged, precipitation summed, other columns left out."""
    unit = FREQUENCIES[freq]
    known = [v for v in df.columns if v in RULES]
    aggs = [(F.avg(v) if RULES[v] == "avg" else _sum0(F.col(v))).alias(v) for v in known]
    return df.groupBy(F.trunc(time, unit).alias(time), *cell).agg(*aggs)


def to_daily(df: DataFrame, modes: dict[str, str], keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Daily values of sub-daily rows; ``modes`` maps an output column to 'mode:column' (mean, sum, max, min)."""
    functions = {"mean": F.avg, "sum": F.sum, "max": F.max, "min": F.min}
    aggs = [functions[m.split(":")[0]](m.split(":")[1]).alias(out) for out, m in modes.items()]
    return df.groupBy(F.to_date(ts).alias("time"), *keys).agg(*aggs)


def climatology(df: DataFrame, by: str, values: Sequence[str], cell: Sequence[str] = CELL, time: str = "time", aggregator: str = "mean") -> DataFrame:
    """Mean (max, min, std) of values by month, dayofyear or season and cell."""
    key = {"month": F.month(time), "dayofyear": F.dayofyear(time), "season": season(F.col(time))}[by]
    functions = {"mean": F.avg, "max": F.max, "min": F.min, "std": F.stddev_pop}
    return df.groupBy(key.alias(by), *cell).agg(*[functions[aggregator](v).alias(v) for v in values])


def days_over(df: DataFrame, value: str, threshold: float, side: str = "over", cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """Days a year beyond a threshold, averaged over the years."""
    if side not in ("over", "under"):
        raise NotImplementedError(side)
    c = F.col(value) > threshold if side == "over" else F.col(value) < threshold
    yearly = df.groupBy(F.year(time).alias("year"), *cell).agg(F.count_if(F.coalesce(c, F.lit(False))).alias("n"))
    return yearly.groupBy(*cell).agg(F.avg("n").alias("days"))


def metric(name: str, value: Column) -> Column:
    """mean, median, std or percentileN as an aggregate that skips nulls."""
    if name == "mean":
        return F.avg(value)
    if name == "median":
        return F.median(value)
    if name == "std":
        return F.stddev_pop(value)
    return F.percentile(value, percentile_of(name))


def metric_calc(df: DataFrame, name: str, value: str, by: Sequence[str] = CELL, skipna: bool = False) -> DataFrame:
    """A metric by key; without ``skipna`` a single null makes it null."""
    out = metric(name, F.col(value))
    if not skipna:
        out = F.when(F.count(F.lit(1)) == F.count(value), out)
    return df.groupBy(*by).agg(out.alias(name))


def is_wet(value: Column, threshold: float = 0.01) -> Column:
    """Whether it rains; no value is not wet."""
    return F.coalesce(value > threshold, F.lit(False))


def wet_day_amount(df: DataFrame, name: str = "mean", value: str = "pr", threshold: float = 0.01, by: Sequence[str] = CELL) -> DataFrame:
    return df.groupBy(*by).agg(metric(name, F.when(is_wet(F.col(value), threshold), F.col(value))).alias(name))


def probability_wet(df: DataFrame, value: str = "pr", threshold: float = 0.01, by: Sequence[str] = CELL) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(is_wet(F.col(value), threshold).cast("double")).alias("probability"))


def probability_two_days(df: DataFrame, kind: str = "wet", value: str = "pr", threshold: float = 0.01, cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """P(wet | wet the step before), or dry given dry; the step before the first is the last."""
    if kind not in ("wet", "dry"):
        raise NotImplementedError(kind)
    wet = is_wet(F.col(value), threshold)
    v = wet if kind == "wet" else ~wet
    order = Window.partitionBy(*cell).orderBy(time)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag(v).over(order), F.last(v).over(whole))
    rows = df.select(*cell, v.alias("v"), before.alias("y"))
    return rows.groupBy(*cell).agg(F.avg(F.when(F.col("y"), F.col("v").cast("double"))).alias("probability"))


def spell_length(df: DataFrame, condition: Column, name: str = "mean", cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """A metric of the lengths of runs of steps for which a condition holds; null without any run."""
    order = Window.partitionBy(*cell).orderBy(time)
    marked = df.select(*cell, time, F.coalesce(condition, F.lit(False)).alias("on")).withColumn("n", F.row_number().over(order))
    runs = marked.filter("on").withColumn("run", F.col("n") - F.row_number().over(order))
    lengths = runs.groupBy(*cell, "run").agg(F.count("*").alias("length"))
    found = lengths.groupBy(*cell).agg(metric(name, F.col("length")).alias(name))
    return df.select(*cell).distinct().join(found, list(cell), "left")


def monthly_variability(df: DataFrame, value: str = "pr", method: str = "sum", cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """Standard deviation of monthly sums or means."""
    if method not in ("sum", "mean"):
        raise ValueError(method)
    monthly = df.groupBy(F.trunc(time, "MM").alias("month"), *cell).agg((_sum0(F.col(value)) if method == "sum" else F.avg(value)).alias("x"))
    return monthly.groupBy(*cell).agg(F.stddev_pop("x").alias("std"))


def weighted_mean(df: DataFrame, value: str, cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """Mean weighted by the days of each row's month, over rows with a value."""
    w = F.when(F.col(value).isNotNull(), days_in_month(F.col(time)).cast("double"))
    return df.groupBy(*cell).agg((F.sum(F.col(value) * w) / F.sum(w)).alias("mean"))


CHANGE_METRICS = ("mean", "std", "percentile1", "percentile5", "percentile95", "percentile99")


def change(df: DataFrame, value: str, historic: Column, future: Column, metrics: Sequence[str] = CHANGE_METRICS, cell: Sequence[str] = CELL) -> DataFrame:
    """Future less historic of each metric, in one pass over both periods."""
    at = lambda period, m: metric(m, F.when(period, F.col(value)))
    return df.filter(historic | future).groupBy(*cell).agg(*[(at(future, m) - at(historic, m)).alias(m) for m in metrics])


def normalize(df: DataFrame, value: str, by: Sequence[str] = ("time",), epsilon: float = 1e-6) -> DataFrame:
    """(x - mean) / (std + epsilon) within each group."""
    over = Window.partitionBy(*by)
    return df.withColumn(value, (F.col(value) - F.avg(value).over(over)) / (F.stddev_pop(value).over(over) + d(epsilon)))


def z_score_against(df: DataFrame, reference: DataFrame, value: str, cell: Sequence[str] = CELL, epsilon: float = 1e-6) -> DataFrame:
    """(x - mean) / (std + epsilon) with the moments of another period, cell by cell."""
    moments = reference.groupBy(*cell).agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_std"))
    return df.join(moments, list(cell)).withColumn(value, (F.col(value) - F.col("_mean")) / (F.col("_std") + d(epsilon))).drop("_mean", "_std")


def rescale(df: DataFrame, reference: DataFrame, value: str, cell: Sequence[str] = CELL, epsilon: float = 1e-6, floor: float | None = None) -> DataFrame:
    """The inverse of a z-score with another series' moments; ``floor`` for variables that cannot be negative."""
    moments = reference.groupBy(*cell).agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_std"))
    x = F.col(value) * (F.col("_std") + d(epsilon)) + F.col("_mean")
    if floor is not None:
        x = F.when(x.isNotNull(), F.greatest(x, d(floor)))
    return df.join(moments, list(cell)).withColumn(value, x).drop("_mean", "_std")


#: Ranges of values that a distribution is summed up in.
RANGES = 64


def empirical_cdf(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Distinct values with the share of values at most as large.

    Values are counted first, and the counts summed up range by range of values, so that a group's
    values are shared out over ``RANGES`` tasks; the sums of the ranges before come by a join.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    bounds = counts.stat.approxQuantile(value, [k / RANGES for k in range(1, RANGES)], 0.25 / RANGES)
    ranged = counts.withColumn("_range", F.size(F.filter(F.array(*[d(b) for b in sorted(set(bounds))]).cast("array<double>"), lambda b: b < F.col(value))))
    sums = ranged.groupBy(*by, "_range").agg(F.sum("_n").alias("_sum"))
    own = Window.partitionBy(*by)
    sums = sums.select(*by, "_range", (F.sum("_sum").over(own.orderBy("_range")) - F.col("_sum")).alias("_before"), F.sum("_sum").over(own).alias("_all"))
    within = F.sum("_n").over(Window.partitionBy(*by, "_range").orderBy(value))
    return ranged.withColumn("_within", within).join(sums, [*by, "_range"]).select(*by, value, ((F.col("_before") + F.col("_within")) / F.col("_all")).alias("share"))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts of equal bins of [low, high); 0 and bins + 1 hold what lies outside."""
    return df.filter(F.col(value).isNotNull()).groupBy(*by, F.width_bucket(F.col(value), d(low), d(high), F.lit(bins)).alias("bin")).agg(F.count("*").alias("n"))


def audit(df: DataFrame, values: Sequence[str], by: Sequence[str] = CELL) -> DataFrame:
    """Null, negative and zero counts of each variable."""
    aggs = []
    for v in values:
        aggs += [F.count_if(F.col(v).isNull()).alias(f"{v}_null"), F.count_if(F.col(v) < 0).alias(f"{v}_negative"), F.count_if(F.col(v) == 0).alias(f"{v}_zero")]
    return df.groupBy(*by).agg(*aggs)


def extremes(df: DataFrame, value: str, exact: float, by: Sequence[str] = ("time",)) -> DataFrame:
    """Extremes per step, how many values equal one exactly, and whether all are finite."""
    c = F.col(value)
    return df.groupBy(*by).agg(F.min(c).alias("low"), F.max(c).alias("high"), F.count_if(c == exact).alias("n_exact"), F.bool_and(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))).alias("finite"))


def coarsen_steps(df: DataFrame, value: str, size: int, boundary: str = "exact", cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """Mean, min and max of blocks of ``size`` steps; a tail that does not fill a block is left out by 'trim' and refused by 'exact'."""
    if boundary not in ("exact", "trim"):
        raise ValueError(boundary)
    order = Window.partitionBy(*cell).orderBy(time)
    rows = df.withColumn("block", F.floor((F.row_number().over(order) - 1) / size).cast("bigint"))
    out = rows.groupBy(*cell, "block").agg(F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), F.count("*").alias("n"))
    if boundary == "exact" and not out.filter(F.col("n") != size).isEmpty():
        raise ValueError(f"steps do not fill blocks of {size}")
    return out.filter(F.col("n") == size).drop("n")


#: Bounds of what a variable can be.
BAD = {"nulls": lambda c: c.isNull(), "aphysical_high_temp": lambda c: c > 353, "aphysical_low_temp": lambda c: c < 0, "aphysical_low_precip": lambda c: c < 0, "aphysical_high_precip": lambda c: c > 3000}


def is_bad(value: Column, check: str) -> Column:
    if check not in BAD:
        raise TypeError(check)
    return F.coalesce(BAD[check](value), F.lit(False))


def qaqc(df: DataFrame, value: str, checks: Sequence[str], cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """Counts of bad values by check: per year over all cells (cell columns null) and per cell over all time (year null), in one pass."""
    counts = [F.count_if(is_bad(F.col(value), c)).alias(c) for c in checks]
    rows = df.withColumn("year", F.year(time))
    sets = [["year"], list(cell)]
    grouped = rows.groupingSets([[F.col(c) for c in s] for s in sets], "year", *cell).agg(*counts)
    return grouped.unpivot(["year", *cell], list(checks), "qaqc_check", "n")


def spatial_mean(df: DataFrame, values: Sequence[str], by: Sequence[str] = ("time",)) -> DataFrame:
    return df.groupBy(*by).agg(*[F.avg(v).alias(v) for v in values])


def ensemble(runs: dict[str, DataFrame], value: str, time: str = "time") -> DataFrame:
    """Spatial means of several runs side by side, a column a run."""
    union = None
    for name, df in runs.items():
        one = spatial_mean(df, [value], (time,)).withColumn("run", F.lit(name))
        union = one if union is None else union.unionByName(one)
    return union.groupBy(time).pivot("run", list(runs)).agg(F.first(value))


def first_of(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group in a stated order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def variogram(df: DataFrame, value: str, axis: str, most_lag: int, keys: Sequence[str]) -> DataFrame:
    """Half the mean squared difference of values ``lag`` steps apart on an integer axis, for lags up to ``most_lag``.

    Rows are ordered along the axis once, and each looks at those within ``most_lag`` after it; no row is sent for each lag.
    """
    rows = df.select(*keys, F.col(axis).alias("_at"), F.col(value).alias("_a")).dropna(subset=[*keys, "_at"])
    ahead = Window.partitionBy(*keys).orderBy("_at").rangeBetween(1, most_lag)
    others = rows.withColumn("_others", F.collect_list(F.struct("_at", F.col("_a").alias("_b"))).over(ahead)).select("_at", "_a", F.explode("_others").alias("_o"))
    gap = F.col("_a") - F.col("_o._b")
    return others.groupBy((F.col("_o._at") - F.col("_at")).alias("lag")).agg((F.avg(gap * gap) / d(2)).alias("gamma"), F.count("*").alias("n"))


def variogram_in_time(df: DataFrame, value: str, most_lag: int, cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """The variogram along days, for lags of 1 to ``most_lag`` days within each cell."""
    return variogram(df.withColumn("_day", F.datediff(time, F.lit("1970-01-01").cast("date"))), value, "_day", most_lag, list(cell))


def fit_gaussian(lags: Sequence[float], gamma: Sequence[float], weights: Sequence[float] | None = None) -> tuple[float, float, float]:
    """(length, sill, nugget) of a Gaussian variogram, nugget + sill * (1 - exp(-pi / 4 * (lag / length) ** 2)), by weighted least squares.

    For a length the other two follow from a line, held at zero where they would be negative; the length is
    searched on a grid that is refined around its best value.
    """
    h, y = np.asarray(lags, float), np.asarray(gamma, float)
    w = np.ones(len(h)) if weights is None else np.asarray(weights, float)

    def line(length: float) -> tuple[float, float, float]:
        x = 1 - np.exp(-np.pi / 4 * (h / length) ** 2)
        mean_x, mean_y = np.average(x, weights=w), np.average(y, weights=w)
        spread = (w * (x - mean_x) ** 2).sum()
        sill = (w * (x - mean_x) * (y - mean_y)).sum() / spread if spread > 0 else 0.0
        nugget = mean_y - sill * mean_x
        if nugget < 0:
            nugget, sill = 0.0, (w * x * y).sum() / max((w * x * x).sum(), 1e-300)
        if sill < 0:
            nugget, sill = mean_y, 0.0
        return float((w * (y - nugget - sill * x) ** 2).sum()), float(sill), float(nugget)

    low, high = np.log(h.min() / 10), np.log(h.max() * 10)
    for _ in range(12):
        grid = np.linspace(low, high, 41)
        at = int(np.argmin([line(np.exp(g))[0] for g in grid]))
        low, high = grid[max(at - 1, 0)], grid[min(at + 1, 40)]
    length = float(np.exp((low + high) / 2))
    return length, *line(length)[1:]


def correlation_lengths(df: DataFrame, value: str, most_lag: int, cell: Sequence[str] = CELL, time: str = "time") -> dict[str, tuple[float, float, float]]:
    """Fitted (length, sill, nugget) along each grid axis and along time; some lags an axis come to the driver."""
    from ..sources.scratch import written

    lat, lon = cell
    rows = written(df.select(time, *cell, value), "correlation-rows")  # read along three axes
    found = {lat: variogram(rows, value, lat, most_lag, [time, lon]), lon: variogram(rows, value, lon, most_lag, [time, lat]), time: variogram_in_time(rows, value, most_lag, cell, time)}
    fits = {}
    for name, table in found.items():
        rows = sorted((r.lag, r.gamma, r.n) for r in table.collect())
        fits[name] = fit_gaussian(*zip(*rows)) if len(rows) > 2 else (float("nan"),) * 3
    return fits


def report(tables: dict[str, DataFrame], values: Sequence[str], time: str = "time") -> DataFrame:
    """A row a table and variable: days, rows, missing values, mean, extremes; what a run's report shows of its stores."""
    out = None
    for name, df in tables.items():
        here = [v for v in values if v in df.columns]
        if not here:
            continue
        asked = [F.count_distinct(time).alias("_days"), F.count("*").alias("_rows")]
        for i, v in enumerate(here):
            c = F.col(v).cast("double")
            asked.append(F.struct(F.count_if(c.isNull()).alias("n_null"), F.avg(c).alias("mean"), F.min(c).alias("low"), F.max(c).alias("high")).alias(f"_{i}"))
        facts = ("n_null", "mean", "low", "high")
        each = F.array(*[F.struct(F.lit(v).alias("variable"), F.col("_days").alias("n_days"), F.col("_rows").alias("n_rows"), *[F.col(f"_{i}")[k].alias(k) for k in facts]) for i, v in enumerate(here)])
        one = df.agg(*asked).select(F.lit(name).alias("name"), F.inline(each))  # one scan of the table
        out = one if out is None else out.unionByName(one)
    return out
