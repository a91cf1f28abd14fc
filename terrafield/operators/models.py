"""Per-cell statistical models along time.

What is relational (moments, straight lines, ranks of analogs) is a DataFrame plan; what needs a
cell's whole series at once runs in a grouped Arrow function, one cell (or one region and day) a
group, so a group's size is the length of a series and not of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import d, normal_cdf, normal_ppf

CELL = ("lat_i", "lon_i")

# ---------------------------------------------------------------- series functions (numpy)


def plotting_positions(n: int, alpha: float = 0.4, beta: float = 0.4) -> np.ndarray:
    """(i - alpha) / (n + 1 - alpha - beta) for i = 1..n; 0.4 and 0.4 are Cunnane's."""
    return (np.arange(1, n + 1) - alpha) / (n + 1 - alpha - beta)


def ecdf(sample: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cunnane positions of x within a sample, linear between its sorted values, flat beyond."""
    s = np.sort(sample)
    return np.interp(x, s, plotting_positions(len(s)))


def quantiles(sample: np.ndarray, p: np.ndarray) -> np.ndarray:
    s = np.sort(sample)
    return np.interp(p, plotting_positions(len(s)), s)


def line(t: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The least-squares line through x, at t."""
    if len(t) < 2 or np.ptp(t) == 0:
        return np.full(len(t), x.mean() if len(x) else 0.0)
    slope = ((t - t.mean()) * (x - x.mean())).sum() / ((t - t.mean()) ** 2).sum()
    return x.mean() + slope * (t - t.mean())


def quantile_map(hist: np.ndarray, obs: np.ndarray, x: np.ndarray, detrend: bool = False, t: np.ndarray | None = None, extrapolate: bool = True) -> np.ndarray:
    """x through the distribution of ``hist`` onto that of ``obs``; beyond ``hist`` the end's shift holds; a trend is taken out and put back."""
    trend = line(t, x) - x.mean() if detrend and t is not None and len(x) else np.zeros(len(x))
    y = x - trend
    out = quantiles(obs, ecdf(hist, y))
    if extrapolate:
        out = np.where(y > hist.max(), obs.max() + (y - hist.max()), np.where(y < hist.min(), obs.min() + (y - hist.min()), out))
    return out + trend


def quantile_mapper(obs: np.ndarray, x: np.ndarray, detrend: bool = False, t: np.ndarray | None = None) -> np.ndarray:
    """x through its own distribution onto that of ``obs``."""
    return quantile_map(x, obs, x, detrend, t)


def quantile_transform(sample: np.ndarray, x: np.ndarray, distribution: str = "uniform", n_quantiles: int | None = None) -> np.ndarray:
    """x as its position among a sample's quantiles, or that position's normal score."""
    p = np.linspace(0, 1, n_quantiles or len(sample))
    q = np.quantile(sample, p)
    u = 0.5 * (np.interp(x, q, p) - np.interp(-x, -q[::-1], -p[::-1]))
    if distribution == "uniform":
        return u
    from statistics import NormalDist

    return np.array([NormalDist().inv_cdf(min(max(v, 1e-7), 1 - 1e-7)) for v in u])


def equidistant_cdf(hist: np.ndarray, obs: np.ndarray, x: np.ndarray, kind: str = "difference") -> np.ndarray:
    """Each x moved by obs less hist (or times their ratio) at x's own quantile within x."""
    u = ecdf(x, x)
    o, h = quantiles(obs, u), quantiles(hist, u)
    if kind == "difference":
        return x + o - h
    if kind == "ratio":
        return x * np.divide(o, h, out=np.ones(len(x)), where=h != 0)
    raise NotImplementedError(kind)


#: Variables corrected by ratios.
RATIO_VARIABLES = ("pr", "huss", "vas", "uas")

SERIES: dict[str, Callable] = {
    "quantile_map": lambda hist, obs, x, t, **k: quantile_map(hist, obs, x, **k),
    "detrended_quantile_map": lambda hist, obs, x, t, **k: quantile_map(hist, obs, x, True, t, **k),
    "quantile_mapper": lambda hist, obs, x, t, **k: quantile_mapper(obs, x, t=t, **k),
    "quantile_transform": lambda hist, obs, x, t, **k: quantile_transform(hist, x, **k),
    "cunnane_transform": lambda hist, obs, x, t, **k: ecdf(hist, x),
    "z_score": lambda hist, obs, x, t, **k: (x - hist.mean()) / hist.std(),
    "edcdf": lambda hist, obs, x, t, **k: equidistant_cdf(hist, obs, x, **k),
    "none": lambda hist, obs, x, t, **k: x,
}


# ---------------------------------------------------------------- grouped application


def days_of(column: pa.ChunkedArray) -> np.ndarray:
    """Days since 1970, with the part of a day that a timestamp has; nulls are NaN."""
    at = column.to_numpy()
    unit = np.timedelta64(1, "D") if np.datetime_data(at.dtype)[0] == "D" else np.timedelta64(86_400_000_000, "us")
    return (at - at.dtype.type(0, np.datetime_data(at.dtype)[0])) / unit


def fit_predict(train: DataFrame, predict: DataFrame, function: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str, keys: Sequence[str] = CELL) -> DataFrame:
    """A model of one's own, cell by cell: gets a cell's training and prediction rows, returns its result rows."""
    return train.groupBy(*keys).cogroup(predict.groupBy(*keys)).applyInPandas(function, schema)


def bias_correct(hist: DataFrame | None, obs: DataFrame, predict: DataFrame, value: str, method: str, cell: Sequence[str] = CELL, time: str = "time", by_month: bool = False, **settings) -> DataFrame:
    """The prediction's values corrected cell by cell; the same columns come back.

    Cells without history, observations or prediction, and null values, are left out. With
    ``by_month`` each calendar month is corrected by itself. A group is a cell's series, as columns of Arrow.
    Without ``hist`` the prediction is its own history.
    """
    if method not in SERIES:
        raise NotImplementedError(method)
    def part(df: DataFrame, role: int) -> DataFrame:
        # Days matter for the prediction alone; the others' are not sent.
        day = F.col(time) if role == 2 else F.lit(None).cast(df.schema[time].dataType)
        month = [F.month(time).alias("_month")] if by_month else []
        return df.filter(F.col(value).isNotNull()).select(F.lit(role).alias("_role"), *cell, day.alias(time), F.col(value).cast("double").alias("_x"), *month)

    rows = part(obs, 1).union(part(predict, 2))
    rows = rows if hist is None else part(hist, 0).union(rows)
    past = 2 if hist is None else 0
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in (time, *cell)) + f", {value} double"

    def correct(rows: pa.Table) -> pa.Table:
        role, x = rows["_role"].to_numpy(), rows["_x"].to_numpy()
        t = days_of(rows[time])
        months = rows["_month"].fill_null(0).to_numpy() if by_month else np.zeros(len(x), int)
        out = np.full(len(x), np.nan)
        done = np.zeros(len(x), bool)
        for month in np.unique(months):
            h, o, p = (np.flatnonzero((role == k) & (months == month)) for k in (past, 1, 2))
            if len(h) and len(o) and len(p):
                p = p[np.argsort(t[p], kind="stable")]
                out[p] = SERIES[method](x[h], x[o], x[p], np.floor(t[p]), **settings)
                done[p] = True
        found = rows.select([time, *cell]).append_column(value, pa.array(out))
        return found.filter(pa.array(done))

    return rows.groupBy(*cell).applyInArrow(correct, schema)


def kind_of(value: str) -> str:
    """Whether a variable is corrected by ratios or by differences."""
    return "ratio" if value in RATIO_VARIABLES else "difference"


def batches_of(batches: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each batch of (batch, item, is_core) whether a day of the year is one of its items, and of its core."""
    of_batch: dict[int, tuple[set, set]] = {}
    for r in batches.collect():
        items, core = of_batch.setdefault(r.batch, (set(), set()))
        items.add(r.item)
        if r.is_core:
            core.add(r.item)
    return [(np.isin(np.arange(367), list(a)), np.isin(np.arange(367), list(b))) for a, b in of_batch.values()]


def days_of_year(days: np.ndarray) -> np.ndarray:
    """Days of the year of numpy's days or times, from 1."""
    return (days.astype("datetime64[D]") - days.astype("datetime64[Y]").astype("datetime64[D]")).astype(int) + 1


def equidistant_by_day(members: list[tuple[np.ndarray, np.ndarray]], kind: str, day: np.ndarray, x: np.ndarray, trained: np.ndarray, seen_day: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """A cell's model values corrected batch by batch; fits take the days that observations and the trained model days share. NaN where a batch has no such day."""
    both = np.intersect1d(seen_day, day[trained])
    shared, seen_shared = np.isin(day, both), np.isin(seen_day, both)
    doy, seen_doy = days_of_year(day), days_of_year(seen_day)
    out = np.full(len(x), np.nan)
    for items, core in members:
        inside, theirs = items[doy], items[seen_doy] & seen_shared
        if theirs.any() and inside.any():
            mine = core[doy[inside]]
            out[np.flatnonzero(inside)[mine]] = equidistant_cdf(x[inside & shared], seen[theirs], x[inside], kind)[mine]
    return out


def edcdf_by_day(gcm: DataFrame, obs: DataFrame, train, value: str, batches: DataFrame, cell: Sequence[str] = CELL, time: str = "time", kind: str | None = None) -> DataFrame:
    """Equidistant CDF matching in batches of days of the year, each fitted with its buffer; only core days are returned.

    ``batches`` has (batch, item, is_core) with item a day of the year (some 1,000 rows); ``train`` is a
    predicate. A cell's series is gathered once, and the batches are taken out of it.
    """
    kind, members = kind or kind_of(value), batches_of(batches)
    part = lambda df, role, trained: df.filter(F.col(value).isNotNull()).select(time, *cell, F.col(value).cast("double").alias("_x"), F.lit(role).alias("_role"), trained.alias("_train"))
    rows = part(gcm, 0, train).union(part(obs.filter(train), 1, F.lit(True)))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in (time, *cell)) + f", {value} double"

    def correct(rows: pd.DataFrame) -> pd.DataFrame:
        role, x, trained = rows["_role"].to_numpy(), rows["_x"].to_numpy(), rows["_train"].to_numpy().astype(bool)
        day, model, seen = pd.to_datetime(rows[time]).to_numpy(), role == 0, role == 1
        out = np.full(len(rows), np.nan)
        out[model] = equidistant_by_day(members, kind, day[model], x[model], trained[model], day[seen], x[seen])
        found = rows[[time, *cell]].copy()
        found[value] = out
        return found[~np.isnan(out)]

    return rows.groupBy(*cell).applyInPandas(correct, schema)


def linear_regression(train: DataFrame, predict: DataFrame, x: str, y: str, cell: Sequence[str] = CELL) -> DataFrame:
    """One-feature least squares cell by cell, in the JVM: adds pred and prediction_error (the fit's root mean square)."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a = train.filter(both)
    fit = a.groupBy(*cell).agg(F.regr_slope(y, x).alias("_slope"), F.regr_intercept(y, x).alias("_intercept"), F.regr_syy(y, x).alias("_syy"), F.regr_sxx(y, x).alias("_sxx"), F.count("*").alias("_n"))
    error = F.sqrt(F.greatest(F.col("_syy") - F.col("_slope") * F.col("_slope") * F.col("_sxx"), d(0)) / F.col("_n"))
    out = predict.join(fit, list(cell)).withColumn("pred", F.col("_slope") * F.col(x) + F.col("_intercept")).withColumn("prediction_error", error)
    return out.drop("_slope", "_intercept", "_syy", "_sxx", "_n")


def gard_model(name: str, n_analogs: int = 10, thresh: float | None = None) -> Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """(features, target, new features) to columns pred, exceedance_prob, prediction_error."""

    def logistic(x: np.ndarray, y: np.ndarray, new: np.ndarray) -> np.ndarray:
        if y.all() or not y.any():
            return np.full(len(new), float(y.all()))
        a = np.column_stack([np.ones(len(x)), x])
        w = np.zeros(a.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            w -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-6 * np.eye(len(w)), a.T @ (p - y) + 1e-6 * w)
        return 1 / (1 + np.exp(-np.clip(np.column_stack([np.ones(len(new)), new]) @ w, -30, 30)))

    def ols(x: np.ndarray, y: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, float]:
        a = np.column_stack([np.ones(len(x)), x])
        w, *_ = np.linalg.lstsq(a, y, rcond=None)
        return np.column_stack([np.ones(len(new)), new]) @ w, float(np.sqrt(np.mean((a @ w - y) ** 2)))

    def regression(x, y, new):
        wet = y > thresh if thresh is not None else np.ones(len(y), bool)
        chance = logistic(x, wet.astype(float), new) if thresh is not None else np.ones(len(new))
        if not wet.any():
            return np.column_stack([np.zeros(len(new)), chance, np.zeros(len(new))])
        pred, error = ols(x[wet], y[wet], new)
        return np.column_stack([pred, chance, np.full(len(new), error)])

    def analogs(x, y, new, regress):
        k = min(n_analogs, len(y))
        out = np.empty((len(new), 3))
        for i, row in enumerate(new):
            at = np.argsort(((x - row) ** 2).sum(axis=1), kind="stable")[:k]
            over = y[at] > thresh if thresh is not None else np.ones(k, bool)
            if not over.any():
                out[i] = (0.0, 0.0, 0.0)
            elif regress and over.sum() > x.shape[1] + 1:
                pred, error = ols(x[at][over], y[at][over], row[None])
                out[i] = (pred[0], over.mean(), error)
            else:
                out[i] = (y[at][over].mean(), over.mean(), y[at][over].std())
        return out

    if name == "PureRegression":
        return regression
    if name == "PureAnalog":
        return lambda x, y, new: analogs(x, y, new, False)
    if name == "AnalogRegression":
        return lambda x, y, new: analogs(x, y, new, True)
    raise NotImplementedError(f"no such analog or regression model: {name!r}")


def gard_fit_predict(train: DataFrame, predict: DataFrame, features: Sequence[str], target: str, model: str = "PureRegression", cell: Sequence[str] = CELL, time: str = "time", roots: Sequence[str] = ("pr",), n_analogs: int = 10, thresh: float | None = None) -> DataFrame:
    """time, cell, pred, exceedance_prob, prediction_error; cube roots of ``roots`` are fitted and their predictions cubed. Analogs as near as each other go by time."""
    fitted = gard_model(model, n_analogs, thresh)
    root = lambda df, cols: df.select(time, *cell, *[(F.cbrt(c) if c.split("__")[0] in roots else F.col(c)).cast("double").alias(c) for c in cols])
    t, p = root(train, dict.fromkeys([*features, target])), root(predict, features)
    kinds = {f.name: f.dataType.simpleString() for f in p.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in (time, *cell)) + ", pred double, exceedance_prob double, prediction_error double"
    cube = target.split("__")[0] in roots

    values = [*features, target]
    columns = lambda rows, names: np.column_stack([rows[c].to_numpy() for c in names])

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        whole = lambda rows: rows.filter(pa.array(~np.isnan(columns(rows, [c for c in rows.column_names if c in values])).any(axis=1))).drop_null()
        a, b = whole(a), whole(b)
        a = a.take(pa.array(np.argsort(days_of(a[time]), kind="stable")))
        got = fitted(columns(a, features), a[target].to_numpy(), columns(b, features)) if len(a) and len(b) else np.empty((0, 3))
        out = b.slice(0, len(got)).select([time, *cell])
        for name, x in zip(("pred", "exceedance_prob", "prediction_error"), ((got[:, 0] ** 3 if cube else got[:, 0]), got[:, 1], got[:, 2])):
            out = out.append_column(name, pa.array(x))
        return out

    return t.groupBy(*cell).cogroup(p.groupBy(*cell)).applyInArrow(run, schema)


def random_effects(df: DataFrame, field: str, thresh: float | None, cube: bool, out: str) -> DataFrame:
    """Adds ``out``: the prediction with a random field's error; with a threshold only where the field exceeds it, and nothing below zero."""
    pred, p, e, z = F.col("pred"), F.col("exceedance_prob"), F.col("prediction_error"), F.col(field)
    if thresh is None:
        return df.withColumn(out, pred + z * e)
    r = normal_ppf((normal_cdf(z) - (d(1) - p)) / p)
    x = F.pow(F.cbrt(pred) + e * r, d(3)) if cube else pred + e * r
    return df.withColumn(out, F.when(F.coalesce(x >= 0, F.lit(False)), x).otherwise(d(0)))


# ---------------------------------------------------------------- constructed analogs


def doy_pairs(spark, doy_range: int = 45) -> DataFrame:
    """Pairs of days of the year within a range of each other around the year; 366 x (2 range + 1) rows at most."""
    days = spark.range(1, 367).select(F.col("id").cast("int").alias("doy"))
    near = F.explode(F.sequence(F.lit(-doy_range), F.lit(doy_range)))
    pairs = days.select("doy", near.alias("k")).select("doy", (F.pmod(F.col("doy") - 1 + F.col("k"), F.lit(365)) + 1).cast("int").alias("other"))
    leap = days.crossJoin(days.select(F.lit(366).alias("other"))).filter(F.least(F.abs(F.col("doy") - 366), 365 - F.abs(F.col("doy") - 366)) <= doy_range)
    return pairs.union(leap).distinct()


#: Days of the year whose model days are compared together.
ANALOG_BLOCK = 15


def analog_fits(gcm: DataFrame, obs: DataFrame, value: str, n_analogs: int = 10, doy_range: int = 45, cell: Sequence[str] = CELL, time: str = "time", by: Sequence[str] = (), regress: bool = True) -> DataFrame:
    """Each model day's nearest observed days of its season, and the regression of its field on theirs.

    Returns by, gcm_day, obs_days, rmse (both arrays, nearest first, ties to the earlier day) and, with
    ``regress``, intercept, coefficients, and residuals at the cells that all these fields have. The
    distance is the root of the summed squares over shared cells, divided by their number.

    A day's field is one row (of each region, if ``by`` names its column). A block of days of the
    year meets the observed days within its range, and all their distances come from three matrix products;
    no pair of days, and no cell of a pair, is ever a row. A group holds one region's fields of one season.
    """
    spark = gcm.sparkSession
    pairs = doy_pairs(spark, doy_range)
    block = lambda doy: F.floor((doy - 1) / ANALOG_BLOCK).cast("int").alias("_block")
    near = np.zeros((367, 367), dtype=bool)
    for r in pairs.collect():  # some 30,000 rows
        near[r.doy, r.other] = True

    def fields(df: DataFrame) -> DataFrame:
        cells = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(time).alias("day")).agg(F.collect_list(F.struct(*cell, F.col(value).cast("double").alias("_x"))).alias("c"))
        return cells.select(*by, "day", *[F.col("c")[n].alias(n) for n in (*cell, "_x")])

    g = fields(gcm).withColumn("_block", block(F.dayofyear("day")))
    reach = F.broadcast(pairs.select(F.col("other").alias("_doy"), block(F.col("doy"))).distinct())
    o = fields(obs).withColumn("_doy", F.dayofyear("day")).join(reach, "_doy").drop("_doy")

    def match(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        if len(mine) and len(theirs):
            theirs = theirs.sort_values("day", kind="stable").reset_index(drop=True)
            both = pd.concat([mine, theirs])
            size = both["_x"].map(len).to_numpy()
            places, at = np.unique(np.column_stack([np.concatenate([np.asarray(x) for x in both[c]]) for c in cell]), axis=0, return_inverse=True)
            matrix = np.full((len(both), len(places)), np.nan)
            matrix[np.repeat(np.arange(len(both)), size), at.ravel()] = np.concatenate([np.asarray(x) for x in both["_x"]])
            x, y = matrix[: len(mine)], matrix[len(mine) :]
            x_has, y_has = (~np.isnan(x)).astype(float), (~np.isnan(y)).astype(float)
            x0, y0 = np.nan_to_num(x), np.nan_to_num(y)
            shared = x_has @ y_has.T
            square = np.maximum((x0 * x0) @ y_has.T - 2 * x0 @ y0.T + x_has @ (y0 * y0).T, 0)
            doys = [pd.to_datetime(f["day"]).dt.dayofyear.to_numpy() for f in (mine, theirs)]
            with np.errstate(divide="ignore", invalid="ignore"):
                far = np.where((shared > 0) & near[doys[0][:, None], doys[1][None, :]], np.sqrt(square) / shared, np.inf)
            keys = [mine[c].iloc[0] for c in by]
            for i, day in enumerate(mine["day"]):
                k = min(n_analogs, int(np.isfinite(far[i]).sum()))
                if not k:
                    continue
                # The products round; what may be among the nearest is measured again.
                some = np.flatnonzero(far[i] <= np.partition(far[i], k - 1)[k - 1] * (1 + 1e-6) + 1e-6)
                exact = np.sqrt(np.nansum((y[some] - x[i]) ** 2, axis=1)) / shared[i, some]
                first = np.argsort(exact, kind="stable")[:k]
                some, exact = some[first], exact[first]
                row = [*keys, day, theirs["day"].iloc[some].tolist(), exact.tolist()]
                if regress:
                    good = ~np.isnan(x[i]) & ~np.isnan(y[some]).any(axis=0)
                    if not good.any():
                        continue
                    fit = np.column_stack([np.ones(good.sum()), y[some][:, good].T])
                    w, *_ = np.linalg.lstsq(fit, x[i, good], rcond=None)
                    row += [float(w[0]), w[1:].tolist(), *(places[good, c].tolist() for c in range(len(cell))), (x[i, good] - fit @ w).tolist()]
                rows.append(tuple(row))
        return pd.DataFrame(rows, columns=names)

    kinds = {f.name: f.dataType.simpleString() for f in gcm.schema.fields}
    columns = [*((c, kinds[c]) for c in by), ("gcm_day", kinds[time]), ("obs_days", f"array<{kinds[time]}>"), ("rmse", "array<double>")]
    if regress:
        columns += [("intercept", "double"), ("coefficients", "array<double>"), *((f"_{c}", f"array<{kinds[c]}>") for c in cell), ("_residual", "array<double>")]
    names = [c for c, _ in columns]
    out = g.groupBy(*by, "_block").cogroup(o.groupBy(*by, "_block")).applyInPandas(match, ", ".join(f"{c} {k}" for c, k in columns))
    if not regress:
        return out
    residuals = F.transform(F.arrays_zip(*[f"_{c}" for c in cell], "_residual"), lambda z: F.struct(*[z[f"_{c}"].alias(c) for c in cell], z["_residual"].alias("residual")))
    return out.select(*by, "gcm_day", "obs_days", "rmse", "intercept", "coefficients", residuals.alias("residuals"))


def analog_days(gcm: DataFrame, obs: DataFrame, value: str, n_analogs: int = 10, doy_range: int = 45, cell: Sequence[str] = CELL, time: str = "time", by: Sequence[str] = ()) -> DataFrame:
    """(by, gcm_day, obs_day, rmse, rank): each model day's nearest observed days of its season, as ``analog_fits`` finds them."""
    found = analog_fits(gcm, obs, value, n_analogs, doy_range, cell, time, by, regress=False)
    each = found.select(*by, "gcm_day", F.posexplode(F.arrays_zip("obs_days", "rmse")).alias("at", "z"))
    return each.select(*by, "gcm_day", F.col("z.obs_days").alias("obs_day"), F.col("z.rmse").alias("rmse"), (F.col("at") + 1).alias("rank"))


def construct_analogs(gcm: DataFrame, obs_coarse: DataFrame, obs_fine: DataFrame, weights: DataFrame, value: str, n_analogs: int = 10, doy_range: int = 45, cell: Sequence[str] = CELL, time: str = "time", by: Sequence[str] = ()) -> DataFrame:
    """Fine-grid fields: each model day as a regression on its analogs' coarse fields, applied to their fine fields, plus its regridded residual.

    Days' regressions (a row a day) are shared with all tasks, and each tile of the fine grid is sent its own rows and the coarse residuals that reach it
    (``grid.on_tiles``): no row is made of a day, an analog and a cell. Fine values that are null are left out. With ``by`` (a region's column
    in all three tables) each region is constructed by itself, by joins.
    """
    from ..sources.scratch import written
    from .grid import on_tiles, regrid

    fitted = written(analog_fits(gcm, obs_coarse, value, n_analogs, doy_range, cell, time, by), "analogs")  # a row a day
    left = fitted.select(*by, F.col("gcm_day").alias(time), F.inline("residuals")).withColumnRenamed("residual", value)
    if not by:
        shared = gcm.sparkSession.sparkContext.broadcast(analog_rows(fitted))

        def series(tables):
            (days, *_), _ = tables
            x, there = analog_series(shared.value, *tables)
            day, at = np.nonzero(there)
            return days[day], at, [x[day, at]]

        return on_tiles([left], [obs_fine], weights, value, series, [value], time, *cell)
    residual = regrid(left, weights, [value], (time, *by)).withColumnRenamed(value, "residual")
    days = fitted.select(*by, "gcm_day", "intercept", F.explode(F.arrays_zip("obs_days", "coefficients")).alias("z")).select(*by, "gcm_day", "intercept", F.col("z.obs_days").alias("obs_day"), F.col("z.coefficients").alias("w"))
    fine = days.join(obs_fine.select(*by, F.col(time).alias("obs_day"), *cell, F.col(value).alias("f")), [*by, "obs_day"])
    summed = fine.groupBy(*by, F.col("gcm_day").alias(time), *cell).agg((F.sum(F.col("w") * F.col("f")) + F.first("intercept")).alias(value))
    return summed.join(residual, [time, *by, *cell]).select(time, *by, *cell, (F.col(value) + F.col("residual")).alias(value))


def analog_rows(fitted: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fits of ``analog_fits`` (a row a day, some thousands) as arrays in order of days: days, their analogs' days (not a time where there are fewer), coefficients, intercepts."""
    rows = fitted.select("gcm_day", "intercept", "obs_days", "coefficients").toArrow().sort_by("gcm_day")
    size = rows["obs_days"].combine_chunks().value_lengths().to_numpy() if len(rows) else np.zeros(0, int)
    flat = [rows[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("obs_days", "coefficients")]
    shape = len(size), int(size.max(initial=0))
    of, w = np.full(shape, np.datetime64("NaT"), flat[0].dtype), np.zeros(shape)
    inside = np.arange(shape[1]) < size[:, None]
    of[inside], w[inside] = flat
    return rows["gcm_day"].to_numpy(), of, w, rows["intercept"].to_numpy()


def analog_series(fits: tuple, left: tuple, fine: tuple) -> tuple[np.ndarray, np.ndarray]:
    """A tile's constructed days as a matrix of days and cells, and where it has values: where one of a day's analogs has the cell and a residual reaches it.

    ``left`` and ``fine`` are series of ``grid.on_tiles``: the regridded residuals and the fine observations.
    """
    gcm_day, of, w, intercept = fits
    (days, rest, has), (own, f, seen) = left, fine
    row = np.searchsorted(gcm_day, days)
    total, there = np.zeros(rest.shape), np.zeros(rest.shape, bool)
    for k in range(of.shape[1] if len(own) else 0):
        day = of[row, k]
        at = np.minimum(np.searchsorted(own, day), len(own) - 1)
        on = seen[at] & (own[at] == day)[:, None]
        total[on] += (w[row, k][:, None] * f[at])[on]
        there |= on
    return total + intercept[row][:, None] + rest, there & has


# ---------------------------------------------------------------- convolutional super-resolution


#: Rows of a map whose windows are laid out at once.
BAND_ROWS = 64


def convolved(x: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """A same-padded convolution of channels (height, width, in) by a kernel (k, k, in, out), band by band."""
    k = kernel.shape[0]
    padded = np.pad(x, ((k // 2, k // 2), (k // 2, k // 2), (0, 0)))
    windows = np.lib.stride_tricks.sliding_window_view(padded, (k, k), axis=(0, 1))
    return np.concatenate([np.einsum("hwcij,ijco->hwo", windows[a : a + BAND_ROWS], kernel, optimize=True) for a in range(0, len(windows), BAND_ROWS)])


def srcnn(image: np.ndarray, elevation: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """A forward pass over two channels: same-padded convolutions, rectified but for the last. ``layers``: kernels (k, k, in, out) and biases."""
    x = np.stack([image, elevation], axis=-1)
    for n, (kernel, bias) in enumerate(layers):
        x = convolved(x, kernel) + bias
        if n < len(layers) - 1:
            x = np.maximum(x, 0)
    return x[..., 0]


def srcnn_above(elevation: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]) -> Callable[[np.ndarray], np.ndarray]:
    """``srcnn`` over one elevation: what its channel adds to the first layer is the same for all images, and is taken once."""
    (kernel, bias), *rest = layers
    steady = convolved(elevation[..., None], kernel[:, :, 1:]) + bias

    def run(image: np.ndarray) -> np.ndarray:
        x = convolved(image[..., None], kernel[:, :, :1]) + steady
        for kernel_, bias_ in rest:
            x = convolved(np.maximum(x, 0), kernel_) + bias_
        return x[..., 0]

    return run


def resolved_tiles(df: DataFrame, value: str, height: int, width: int, elevations: list[np.ndarray], stages: list[list[tuple[np.ndarray, np.ndarray]]], tile: int | None = None, cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """Rows of days and coarse cells (as ``downscale.maps_of`` takes them) by stacked super-resolution as tiles of the finest grid.

    Returns time, _y, _x (the tile), _w (its width) and _v, its values row by row. A group is one day's coarse field.
    """
    from .grid import TILE

    tile = tile or TILE
    shared = df.sparkSession.sparkContext.broadcast((elevations, stages))
    kind, lat, lon = df.schema[time].dataType.simpleString(), *cell
    fields = [("_y", pa.int32()), ("_x", pa.int32()), ("_w", pa.int32()), ("_v", pa.list_(pa.float64()))]
    nets: list[Callable] = []

    def run(rows: pa.Table) -> pa.Table:
        if not nets:
            nets.extend(srcnn_above(e, net) for e, net in zip(*shared.value))
        y, row = np.unique(rows[lat].to_numpy(), return_inverse=True)
        out: list[tuple] = []
        if len(y) == height:
            x = rows[lon].to_numpy()
            inside, image = (x >= 0) & (x < width), np.zeros((height, width))
            image[row[inside], x[inside]] = rows["_v"].to_numpy()[inside]
            for net in nets:
                image = net(upsample2(image))
            parts = [(a, b, image[a * tile : (a + 1) * tile, b * tile : (b + 1) * tile]) for a in range(-(-image.shape[0] // tile)) for b in range(-(-image.shape[1] // tile))]
            out = [(a, b, p.shape[1], p.ravel()) for a, b, p in parts]
        columns = [pa.array([r[n] for r in out], k) for n, (_, k) in enumerate(fields)]
        return pa.Table.from_arrays([pa.repeat(rows[time][0], len(out)), *columns], names=[time, *(c for c, _ in fields)])

    rows = df.filter(F.col(value).isNotNull()).select(time, lat, lon, F.col(value).cast("double").alias("_v"))
    # Days take the time of their fine fields, and few bytes: as many tasks as shuffles have.
    rows = rows.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), time)
    return rows.groupBy(time).applyInArrow(run, f"{time} {kind}, _y int, _x int, _w int, _v array<double>")


def upsample2(image: np.ndarray) -> np.ndarray:
    """Bilinear doubling with cell centres, edges held."""

    def along(a: np.ndarray) -> np.ndarray:
        n = a.shape[0]
        at = np.clip((np.arange(2 * n) + 0.5) / 2 - 0.5, 0, n - 1)
        i = np.minimum(at.astype(int), max(n - 2, 0))
        f = (at - i)[:, None]
        return a[i] * (1 - f) + a[np.minimum(i + 1, n - 1)] * f

    return along(along(image).T).T


def super_resolve(maps: DataFrame, elevations: list[np.ndarray], stages: list[list[tuple[np.ndarray, np.ndarray]]], time: str = "time") -> DataFrame:
    """Stacked super-resolution of one map a row (time, field array<array<double>>): double, add elevation, convolve, again."""
    context = maps.sparkSession.sparkContext
    shared = context.broadcast((elevations, stages))

    def run(batches):
        """One map at a time: as lists, a fine map takes some times the memory of its numbers."""
        heights, nets = shared.value
        field = pa.list_(pa.list_(pa.float64()))
        for batch in batches:
            for i in range(batch.num_rows):
                image = np.array(batch.column(1)[i].as_py(), float)
                for height, net in zip(heights, nets):
                    image = srcnn(upsample2(image), height, net)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([image.tolist()], field)], [time, "field"])

    kind = maps.schema[time].dataType.simpleString()
    return maps.select(time, "field").mapInArrow(run, f"{time} {kind}, field array<array<double>>")
