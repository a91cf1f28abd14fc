"""The downscaling methods end to end: BCSD, GARD, MACA, DeepSD's numeric wrapper."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import aggregate as A
from . import calendar as C
from . import grid as G
from . import models as M
from ..sources.networks import Network
from ..sources.scratch import written

CELL = A.CELL


def spatial_anomalies(obs: DataFrame, interpolated: DataFrame, value: str, cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """(month, cell, anomaly): the monthly mean of observations less their own coarse view."""
    o = obs.select(time, *cell, F.col(value).alias("_o"))
    i = interpolated.select(time, *cell, F.col(value).alias("_i"))
    both = o.join(i, [time, *cell])
    return both.groupBy(F.month(time).alias("month"), *cell).agg(F.avg(F.col("_o") - F.col("_i")).alias("anomaly"))


def reconstruct(fine: DataFrame, anomalies: DataFrame, value: str, land: DataFrame | None = None, cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """Corrected coarse fields on the fine grid with the month's anomaly added; cells off the land are null."""
    out = fine.withColumn("month", F.month(time)).join(anomalies, ["month", *cell]).withColumn(value, F.col(value) + F.col("anomaly")).drop("month", "anomaly")
    return on_land(out, value, land, cell)


def on_land(df: DataFrame, value: str, land: DataFrame | None, cell: Sequence[str] = CELL) -> DataFrame:
    """Values off the land made null, where ``land`` is given."""
    if land is None:
        return df
    return df.join(land.select(*cell, "is_land"), list(cell), "left").withColumn(value, F.when(F.col("is_land"), F.col(value))).drop("is_land")


def _months(days: np.ndarray) -> np.ndarray:
    """Months of numpy's days, from 0."""
    return days.astype("datetime64[M]").astype(int) % 12


def bcsd(obs: DataFrame, hist: DataFrame, predict: DataFrame, to_coarse: DataFrame, to_fine: DataFrame, value: str, land: DataFrame | None = None) -> DataFrame:
    """Bias-corrected spatial disaggregation.

    The model is corrected on its own grid, month by month; temperatures keep their slow shift (a
    nine-year mean of the month against the historical one), precipitation does not.
    """
    coarse = G.regrid(obs, to_coarse, [value])
    if value in ("tasmax", "tasmin"):
        from pyspark.sql import Window

        base = hist.groupBy(F.month("time").alias("_m"), *CELL).agg(F.avg(value).alias("_base"))
        yearly = predict.groupBy(F.year("time").alias("_y"), F.month("time").alias("_m"), *CELL).agg(F.avg(value).alias("_mean"))
        over = Window.partitionBy("_m", *CELL).orderBy("_y").rowsBetween(-4, 4)
        shift = yearly.withColumn("_roll", F.avg("_mean").over(over)).join(base, ["_m", *CELL]).select("_y", "_m", *CELL, (F.col("_roll") - F.col("_base")).alias("_shift"))
        keyed = predict.withColumn("_y", F.year("time")).withColumn("_m", F.month("time")).join(shift, ["_y", "_m", *CELL])
        still = keyed.select("time", *CELL, (F.col(value) - F.col("_shift")).alias(value))
        corrected = M.bias_correct(hist, coarse, still, value, "quantile_map", by_month=True)
        corrected = corrected.join(keyed.select("time", *CELL, "_shift"), ["time", *CELL]).select("time", *CELL, (F.col(value) + F.col("_shift")).alias(value))
    else:
        corrected = M.bias_correct(hist, coarse, predict, value, "quantile_map", by_month=True)

    def series(tables):
        (own, seen, has_seen), (days, fine, has), (observed, exact, has_exact) = tables
        _, a, b = np.intersect1d(own, observed, return_indices=True)
        both, month = has_seen[a] & has_exact[b], _months(own[a])
        gap = np.where(both, exact[b] - seen[a], 0.0)
        with np.errstate(invalid="ignore"):
            anomaly = np.stack([gap[month == m].sum(axis=0) / both[month == m].sum(axis=0) for m in range(12)])
            known = np.stack([both[month == m].any(axis=0) for m in range(12)])
        month = _months(days)
        day, cell = np.nonzero(has & known[month])
        return days[day], cell, [fine[day, cell] + anomaly[month[day], cell]]

    return on_land(G.on_tiles([coarse, corrected], [obs], to_fine, value, series, [value]), value, land)


def gard(obs: DataFrame, hist: DataFrame, predict: DataFrame, to_coarse: DataFrame, to_fine: DataFrame, field: DataFrame | Callable[[DataFrame], DataFrame], value: str, model: str = "PureRegression", thresh: float | None = None, correction: str = "quantile_map") -> DataFrame:
    """Regression of fine observations on their own coarse view, applied to the corrected model, with a random field's errors.

    ``field`` is a table of it, or what adds its column to rows of days and cells (a field that is a formula needs no join).
    """
    fitted, root = M.gard_model(model, thresh=thresh), value == "pr"

    def series(tables):
        (own, seen, has_seen), (_, past, has_past), (days, new, has_new), (observed, exact, has_exact) = tables
        _, a, b = np.intersect1d(own, observed, return_indices=True)
        t = days.astype("datetime64[D]").astype(float)
        scale = np.cbrt if root else np.asarray
        found: list[tuple] = []
        for c in range(has_new.shape[1]):
            at = np.flatnonzero(has_new[:, c])
            hist, obs = past[has_past[:, c], c], seen[has_seen[:, c], c]
            if not (len(at) and len(hist) and len(obs)):
                continue
            x = scale(M.SERIES[correction](hist, obs, new[at, c], t[at]))
            train = np.column_stack([seen[a, c], exact[b, c]])[has_seen[a, c] & has_exact[b, c]]
            train = scale(train[~np.isnan(train).any(axis=1)])
            at, x = at[~np.isnan(x)], x[~np.isnan(x)]
            if len(train) and len(at):
                got = fitted(train[:, :1], train[:, 1], x[:, None])
                found.append((at, np.full(len(at), c), got[:, 0] ** 3 if root else got[:, 0], got[:, 1], got[:, 2]))
        at, cell, *columns = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, int), np.empty(0, int), *np.empty((3, 0)))
        return days[at], cell, columns

    out = G.on_tiles([G.regrid(obs, to_coarse, [value]), hist, predict], [obs], to_fine, value, series, ["pred", "exceedance_prob", "prediction_error"])
    placed = field(out) if callable(field) else out.join(field, ["time", *CELL])
    return M.random_effects(placed, "field", thresh, value == "pr", value).select("time", *CELL, value)


def maca(obs: DataFrame, model: DataFrame, historical: Column, predict: Column, to_coarse: DataFrame, to_fine: DataFrame, value: str, n_analogs: int = 10, doy_range: int = 45, day_window: int = 21, year_window: int = 31, regions: DataFrame | None = None) -> DataFrame:
    """Multivariate adapted constructed analogs for the days of ``predict``.

    Coarse days are corrected against coarse observations, the slow trend is taken out, analogs are
    constructed (region by region, if ``regions`` has cells' region_id on both grids as ``coarse``
    true or false), the trend is put back, and the fine days are corrected against fine observations. The
    historical days are downscaled too, since that last correction is fitted to them. Both predicates are of ``time`` alone.

    Without regions all steps on the fine grid are taken tile by tile (``grid.on_tiles``), to which only fine observations and the
    coarse residuals and trends are sent.
    """
    spark = obs.sparkSession
    batches = C.generate_batches(366, 15, 15, spark, one_indexed=True)
    coarse = written(G.regrid(obs.filter(historical), to_coarse, [value]), "maca-coarse")
    corrected = written(M.edcdf_by_day(model, coarse, historical, value, batches), "maca-corrected")
    trend = written(C.epoch_trend(corrected, value, historical, day_window, year_window), "maca-trend")
    still = corrected.join(trend, ["time", *CELL]).select("time", *CELL, (F.col(value) - F.col("trend")).alias(value))
    tables, by = [still.filter(historical | predict), coarse, obs.filter(historical).select("time", *CELL, value)], ()
    if regions is None:
        return _maca_on_tiles(*tables, trend, historical, predict, to_fine, value, n_analogs, doy_range, batches)
    by = ("region_id",)
    own = lambda is_coarse: regions.filter(F.col("coarse") == is_coarse).select(*CELL, F.col("region_id").alias("region_id"))  # noqa: E731  # a column of its own for each table
    tables = [t.join(own(k < 2), list(CELL)) for k, t in enumerate(tables)]
    analogs = M.construct_analogs(*tables, to_fine, value, n_analogs, doy_range, by=by).drop(*by)
    fine_trend = G.regrid(trend, to_fine, ["trend"])
    fine = analogs.join(fine_trend, ["time", *CELL]).select("time", *CELL, (F.col(value) + F.col("trend")).alias(value))
    return M.edcdf_by_day(fine, obs, historical, value, batches).filter(predict)


def _maca_on_tiles(still: DataFrame, coarse: DataFrame, obs: DataFrame, trend: DataFrame, historical: Column, predict: Column, to_fine: DataFrame, value: str, n_analogs: int, doy_range: int, batches: DataFrame) -> DataFrame:
    """``maca`` from the coarse days on: analogs, trend and last correction of a tile's cells at once."""
    fitted = written(M.analog_fits(still, coarse, value, n_analogs, doy_range), "analogs")  # a row a day
    days = fitted.select(F.col("gcm_day").alias("time")).select("time", F.coalesce(historical, F.lit(False)).alias("a"), F.coalesce(predict, F.lit(False)).alias("b")).toArrow().sort_by("time")
    flags = [days[c].to_numpy() for c in ("a", "b")]
    shared = obs.sparkSession.sparkContext.broadcast((M.analog_rows(fitted), *flags))
    members, kind = M.batches_of(batches), M.kind_of(value)

    def series(tables):
        fits, past, wanted = shared.value
        left, (when, slow, has_slow), (own, f, seen) = tables
        x, there = M.analog_series(fits, left, tables[2])
        day, a, b = np.intersect1d(left[0], when, return_indices=True)
        x, there = x[a] + slow[b], there[a] & has_slow[b]
        at = np.searchsorted(fits[0], day)
        trained, wanted = past[at], wanted[at]
        out = np.full(x.shape, np.nan)
        for c in np.flatnonzero(there.any(axis=0) & seen.any(axis=0)):
            mine, theirs = there[:, c], seen[:, c]
            out[mine, c] = M.equidistant_by_day(members, kind, day[mine], x[mine, c], trained[mine], own[theirs], f[theirs, c])
        k, cell = np.nonzero(~np.isnan(out) & wanted[:, None])
        return day[k], cell, [out[k, cell]]

    left = fitted.select(F.col("gcm_day").alias("time"), F.inline("residuals")).withColumnRenamed("residual", value)
    return G.on_tiles([left, trend.withColumnRenamed("trend", value)], [obs], to_fine, value, series, [value])


def maca_variables(obs: DataFrame, model: DataFrame, values: Sequence[str], *settings, **more) -> DataFrame:
    """``maca`` for several variables, side by side; ``settings`` are its others in order."""
    from ..sources.sinks import combine_variables

    historical, predict, to_coarse, to_fine, *rest = settings
    return combine_variables([maca(obs, model, historical, predict, to_coarse, to_fine, v, *rest, **more) for v in values], ["time", *CELL])


def maps_of(df: DataFrame, value: str, height: int, width: int, time: str = "time") -> DataFrame:
    """One map a row (time, field array<array<double>>) of days that have all rows of the grid; cells without a value are zero."""
    lat, lon = CELL
    cells = df.filter(F.col(value).isNotNull()).groupBy(time, lat).agg(F.map_from_entries(F.collect_list(F.struct(F.col(lon), F.col(value).cast("double")))).alias("_row"))
    row = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda x: F.coalesce(F.col("_row")[x], F.lit(0.0)))
    rows = cells.select(time, lat, row.alias("_row")).groupBy(time).agg(F.sort_array(F.collect_list(F.struct(lat, "_row"))).alias("_rows"))
    return rows.filter(F.size("_rows") == height).select(time, F.transform("_rows", lambda r: r["_row"]).alias("field"))


def cells_of(maps: DataFrame, value: str, time: str = "time") -> DataFrame:
    """Maps back as rows of cells."""
    lat, lon = CELL
    rows = maps.select(time, F.posexplode("field").alias(lat, "_row"))
    return rows.select(time, lat, F.posexplode("_row").alias(lon, value))


def deepsd(predict: DataFrame, hist: DataFrame, obs: DataFrame, to_fine: DataFrame | None, value: str, land: DataFrame | None = None, network: Network | None = None, elevations: list[np.ndarray] | None = None) -> DataFrame:
    """Stacked super-resolution: z-scores by the historical run, the network's fine fields, the observations' moments, a last correction.

    ``network`` has the trained stages (``sources.networks``), each doubling the grid, with an elevation
    matrix of the finer grid each; its days are maps with all rows of the coarse grid, which is half
    the size of the first matrix. Without a network the fields are regridded by ``to_fine``. Fine maps are cut into tiles, which
    meet the observations of their cells; no row is a cell of a day before it is corrected.
    """
    scores = A.z_score_against(predict, hist, value)
    floor = 0.0 if value == "pr" else None
    if network is None:
        back = A.rescale(G.regrid(scores, to_fine, [value]), obs, value, floor=floor)
        return on_land(M.bias_correct(None, obs, back, value, "quantile_mapper"), value, land)
    height, width = (n // 2 for n in elevations[0].shape)
    scaled = [(e - e.mean()) / (e.std() + 1e-6) for e in elevations]
    tiles = M.resolved_tiles(scores, value, height, width, scaled, network)
    block = lambda c: F.floor(F.col(c) / G.TILE).cast("int")
    lat, lon = CELL
    seen = obs.filter(F.col(value).isNotNull()).select(block(lat).alias("_y"), block(lon).alias("_x"), lat, lon, F.col(value).cast("double").alias("_o"))
    kinds = {f.name: f.dataType.simpleString() for f in predict.schema.fields}

    def correct(tiles: pa.Table, seen: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(tiles) and len(seen):
            x = tiles["_v"].combine_chunks().flatten().to_numpy().reshape(len(tiles), -1)
            y, across = seen[lat].to_numpy(), seen[lon].to_numpy()
            top, start, wide = tiles["_y"][0].as_py() * G.TILE, tiles["_x"][0].as_py() * G.TILE, tiles["_w"][0].as_py()
            known = (y >= top) & (y < top + x.shape[1] // wide) & (across >= start) & (across < start + wide)
            cell, o = ((y - top) * wide + across - start)[known], seen["_o"].to_numpy()[known]
            order = np.argsort(cell, kind="stable")
            cells, first = np.unique(cell[order], return_index=True)
            for c, own in zip(cells, np.split(o[order], first[1:])):
                back = x[:, c] * (own.std() + 1e-6) + own.mean()
                back = back if floor is None else np.maximum(back, floor)
                found.append((top + c // wide, start + c % wide, M.quantile_mapper(own, back)))
        days = tiles["time"].combine_chunks()
        columns = [pa.concat_arrays([days] * len(found)) if found else days.slice(0, 0), *[pa.array(np.repeat([r[n] for r in found], len(days)).astype("int64")).cast(index) for n in (0, 1)], pa.array(np.concatenate([r[2] for r in found]) if found else np.zeros(0))]
        return pa.Table.from_arrays(columns, names=["time", lat, lon, value])

    index = {"int": pa.int32(), "bigint": pa.int64()}[kinds[lat]]
    # As many tasks as shuffles have: a tile takes time for its cells, of which its bytes say little.
    n = int(predict.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = tiles.repartition(n, "_y", "_x").groupBy("_y", "_x").cogroup(seen.groupBy("_y", "_x")).applyInArrow(correct, f"time {kinds['time']}, {lat} {kinds[lat]}, {lon} {kinds[lon]}, {value} double")
    return on_land(out, value, land)
