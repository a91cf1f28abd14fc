"""Queries of per-cell models, whole methods, hydrology and feeds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import calendar as C
from ..operators import downscale as D
from ..operators import grid as G
from ..operators import models as M
from ..operators import water as W
from ..sources.cube import CELLS, GCM, HOURLY, OBS, cells, gcm, grid_width, obs, table, tasks
from ..sources import networks
from ..sources.scratch import scratch
from .grids import _COARSE, _LINEAR, _PET, _bilinear_weights, _field_sql, normal_cdf_sql, normal_ppf_sql
from .registry import query, r6

CELL = A.CELL


def _parts(spark, sf):
    """Coarse observations, the model's history (before 1999) and its projection."""
    g = gcm(spark, sf).withColumn("pr", F.col("pr") / F.lit(10000.0))
    return G.coarsen(obs(spark, sf), 2, ["pr"], tasks=tasks(spark, sf, "lineitem")), g.filter(F.year("time") < 1999), g.filter(F.year("time") >= 1999)


def _weights(spark, sf):
    w = grid_width(spark, sf)
    lap = G.overlap_axis_weights(list(range(w)), [2 * i + 0.5 for i in range(w // 2)], False)
    return G.weights(spark, lap, lap), _bilinear_weights(spark, sf)


def _scratch(spark) -> str:
    return scratch(spark, "feeds")


def _mapping_sql(hist: str, obs: str, new: str, extrapolate: bool = True) -> str:
    """CTEs that map ``x`` of table ``new`` (g, x, and others) through the distribution of ``hist`` onto that of ``obs`` (both g, x), by group g.

    Leaves ``mapped``: the rows of ``new`` with u (Cunnane's position) and y (the mapped value).
    """
    ends = "CASE WHEN p.x > hs.hi THEN os.hi + (p.x - hs.hi) WHEN p.x < hs.lo THEN os.lo + (p.x - hs.lo) ELSE {} END" if extrapolate else "{}"
    quantile = "CASE WHEN f <= 1 THEN a.x WHEN f >= os.n THEN a.x ELSE a.x + (f - a.i) * (b.x - a.x) END"
    return f"""hr AS (SELECT g, x, row_number() OVER (PARTITION BY g ORDER BY x) AS i FROM {hist}),
    hs AS (SELECT g, count(*) AS n, min(x) AS lo, max(x) AS hi FROM {hist} GROUP BY g), os AS (SELECT g, count(*) AS n, min(x) AS lo, max(x) AS hi FROM {obs} GROUP BY g),
    hd AS (SELECT g, x, max(i) AS i, min(i) AS i0, lead(x) OVER (PARTITION BY g ORDER BY x) AS x2 FROM hr GROUP BY g, x),
    oi AS (SELECT g, x, row_number() OVER (PARTITION BY g ORDER BY x) AS i FROM {obs}),
    pu AS (SELECT p.*, CASE WHEN hd.x IS NULL THEN 0.6::DOUBLE / (hs.n + 0.2::DOUBLE) WHEN hd.x2 IS NULL THEN (hs.n - 0.4::DOUBLE) / (hs.n + 0.2::DOUBLE)
             ELSE (hd.i - 0.4::DOUBLE + (p.x - hd.x) / (hd.x2 - hd.x)) / (hs.n + 0.2::DOUBLE) END AS u, hd.i AS last_i, hd.i0 AS first_i, hd.x AS below, hd.x2 AS above, hs.n AS hn
           FROM {new} p JOIN hs ON hs.g = p.g ASOF LEFT JOIN hd ON hd.g = p.g AND p.x >= hd.x),
    pf AS (SELECT pu.*, u * (os.n + 0.2::DOUBLE) + 0.4::DOUBLE AS f FROM pu JOIN os USING (g)),
    mapped AS (SELECT p.*, {ends.format(quantile)} AS y FROM pf p JOIN hs ON hs.g = p.g JOIN os ON os.g = p.g
               JOIN oi a ON a.g = p.g AND a.i = greatest(1, least(os.n, floor(f)::BIGINT)) LEFT JOIN oi b ON b.g = p.g AND b.i = a.i + 1)"""


_PARTS_SQL = f"""{OBS}, {GCM}, {_COARSE}, h AS (SELECT lat_i * 100000 + lon_i AS g, pr / 10000 AS x FROM gcm WHERE year(time) < 1999), o AS (SELECT lat_i * 100000 + lon_i AS g, pr AS x FROM coarse WHERE year(time) < 1999),
p AS (SELECT time, lat_i, lon_i, lat_i * 100000 + lon_i AS g, pr / 10000 AS x FROM gcm WHERE year(time) >= 1999)"""
_SERIES_SQL = {
    "quantile_transform": f"WITH {_PARTS_SQL}, {_mapping_sql('h', 'o', 'p')} SELECT time, lat_i, lon_i, round(CASE WHEN hn = 1 OR below IS NULL THEN 0 WHEN x = below THEN ((last_i - 1) + (first_i - 1)) / 2.0::DOUBLE / (hn - 1) WHEN above IS NULL THEN 1 ELSE (last_i - 1 + (x - below) / (above - below)) / (hn - 1) END, 5) AS pr FROM mapped",
    "quantile_mapper": f"WITH {_PARTS_SQL}, {_mapping_sql('p', 'o', 'p', False)} SELECT time, lat_i, lon_i, round(y, 5) AS pr FROM mapped",
    "quantile_map": f"WITH {_PARTS_SQL}, {_mapping_sql('h', 'o', 'p')} SELECT time, lat_i, lon_i, round(y, 5) AS pr FROM mapped",
    "detrended_quantile_map": f"""WITH {_PARTS_SQL}, k AS (SELECT g, coalesce(regr_slope(x, time - DATE '1999-01-01'), 0) AS a, avg(time - DATE '1999-01-01') AS t FROM p GROUP BY g),
    q AS (SELECT time, lat_i, lon_i, g, x - a * ((time - DATE '1999-01-01') - t) AS x, a * ((time - DATE '1999-01-01') - t) AS trend FROM p JOIN k USING (g)), {_mapping_sql('h', 'o', 'q')} SELECT time, lat_i, lon_i, round(y + trend, 5) AS pr FROM mapped""",
    "cunnane_transform": f"WITH {_PARTS_SQL}, {_mapping_sql('h', 'o', 'p')} SELECT time, lat_i, lon_i, round(u, 5) AS pr FROM mapped",
}

for _id, _method in {"m01_quantile_transform": "quantile_transform", "m03_quantile_mapper": "quantile_mapper", "m04_quantile_map": "quantile_map", "m05_detrended_quantile_map": "detrended_quantile_map", "m06_cunnane": "cunnane_transform"}.items():

    @query(_id, _SERIES_SQL[_method])
    def _(spark, sf, method=_method):
        o, h, p = _parts(spark, sf)
        return M.bias_correct(h, o.filter(F.year("time") < 1999), p, "pr", method).select("time", *CELL, F.round("pr", 5).alias("pr"))


@query("m02_z_score", f"WITH {OBS}, {GCM}, h AS (SELECT lat_i, lon_i, avg(pr / 10000) AS m, stddev_pop(pr / 10000) AS s FROM gcm WHERE year(time) < 1999 GROUP BY ALL) SELECT time, lat_i, lon_i, round((pr / 10000 - m) / s, 6) AS pr FROM gcm JOIN h USING (lat_i, lon_i) WHERE year(time) >= 1999")
def _(spark, sf):
    _, h, p = _parts(spark, sf)
    return A.z_score_against(p, h, "pr", epsilon=0.0).select("time", *CELL, r6("pr", "pr"))


_BCSD_SQL = f"""WITH {OBS}, {GCM}, {_COARSE}, {_LINEAR}, {CELLS}, h2 AS (SELECT lat_i * 10000000 + lon_i * 100 + month(time) AS g, pr / 10000 AS x FROM gcm WHERE year(time) < 1999), o2 AS (SELECT lat_i * 10000000 + lon_i * 100 + month(time) AS g, pr AS x FROM coarse),
p2 AS (SELECT time, lat_i, lon_i, lat_i * 10000000 + lon_i * 100 + month(time) AS g, pr / 10000 AS x FROM gcm WHERE year(time) >= 1999), {_mapping_sql('h2', 'o2', 'p2')},
fine AS (SELECT time, a.dst AS lat_i, b.dst AS lon_i, sum(a.w * b.w * y) / sum(a.w * b.w) AS y FROM mapped m JOIN lin a ON a.src = m.lat_i JOIN lin b ON b.src = m.lon_i GROUP BY ALL),
i AS (SELECT time, a.dst AS lat_i, b.dst AS lon_i, sum(a.w * b.w * pr) / sum(a.w * b.w) AS pr FROM coarse JOIN lin a ON a.src = lat_i JOIN lin b ON b.src = lon_i GROUP BY ALL),
an AS (SELECT month(time) AS m, lat_i, lon_i, avg(o.pr - i.pr) AS d FROM obs o JOIN i USING (time, lat_i, lon_i) GROUP BY ALL)
SELECT f.time, f.lat_i, f.lon_i, CASE WHEN is_land THEN round(y + d + 1e-7, 5) END AS pr FROM fine f JOIN an ON an.m = month(f.time) AND an.lat_i = f.lat_i AND an.lon_i = f.lon_i LEFT JOIN cells c ON c.lat_i = f.lat_i AND c.lon_i = f.lon_i"""


@query("m08_bcsd", _BCSD_SQL)
def _(spark, sf):
    _, h, p = _parts(spark, sf)
    coarse, fine = _weights(spark, sf)
    return D.bcsd(obs(spark, sf), h, p, coarse, fine, "pr", cells(spark, sf)).select("time", *CELL, F.round(F.col("pr") + F.lit(1e-7), 5).alias("pr"))


_TEMPERATURE_SQL = (
    _BCSD_SQL.replace(
        "p2 AS (SELECT time, lat_i, lon_i, lat_i * 10000000 + lon_i * 100 + month(time) AS g, pr / 10000 AS x FROM gcm WHERE year(time) >= 1999)",
        """yl AS (SELECT lat_i * 10000000 + lon_i * 100 + month(time) AS g, year(time) AS y, avg(pr / 10000) AS x FROM gcm WHERE year(time) >= 1999 GROUP BY ALL),
        sh AS (SELECT yl.g, y, avg(yl.x) OVER (PARTITION BY yl.g ORDER BY y ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) - base AS shift FROM yl JOIN (SELECT g, avg(x) AS base FROM h2 GROUP BY g) b USING (g)),
        p2 AS (SELECT time, lat_i, lon_i, sh.g, pr / 10000 - shift AS x, shift FROM gcm JOIN sh ON sh.g = lat_i * 10000000 + lon_i * 100 + month(time) AND sh.y = year(time))""",
    )
    .replace("sum(a.w * b.w * y)", "sum(a.w * b.w * (y + shift))")
    .replace("END AS pr FROM fine", "END AS tasmax FROM fine")
)


@query("m08_bcsd_temperature", _TEMPERATURE_SQL)
def _(spark, sf):
    o, h, p = (df.withColumnRenamed("pr", "tasmax") for df in (obs(spark, sf).select("time", *CELL, "pr"), *_parts(spark, sf)[1:]))
    coarse, fine = _weights(spark, sf)
    return D.bcsd(o, h, p, coarse, fine, "tasmax", cells(spark, sf)).select("time", *CELL, F.round(F.col("tasmax") + F.lit(1e-7), 5).alias("tasmax"))


def _quantile_sql(of: str, u: str, out: str) -> str:
    """A CTE: rows of table ``u`` (g, u, ...) with ``out``, the quantile at u of table ``of`` (g, x) in its group."""
    return f"""{out}_i AS (SELECT g, x, row_number() OVER (PARTITION BY g ORDER BY x) AS i FROM {of}), {out}_n AS (SELECT g, count(*) AS n FROM {of} GROUP BY g),
    {out}_t AS (SELECT t.* EXCLUDE (f, n), CASE WHEN f <= 1 OR f >= n THEN a.x ELSE a.x + (f - a.i) * (b.x - a.x) END AS {out} FROM (SELECT {u}.*, u * (n + 0.2::DOUBLE) + 0.4::DOUBLE AS f, n FROM {u} JOIN {out}_n USING (g)) t
      JOIN {out}_i a ON a.g = t.g AND a.i = greatest(1, least(n, floor(f)::BIGINT)) LEFT JOIN {out}_i b ON b.g = t.g AND b.i = a.i + 1)"""


_EDCDF_SQL = f"""WITH {OBS}, {GCM}, {_COARSE}, bt AS (SELECT b, 1 + ((15 * b + k) % 366 + 366) % 366 AS doy, bool_or(k >= 0 AND k < least(15, 366 - 15 * b)) AS core FROM (SELECT unnest(range(0, 25)) AS b), (SELECT unnest(range(-15, 30)) AS k) WHERE k < least(15, 366 - 15 * b) + 15 GROUP BY ALL),
sh AS (SELECT time, lat_i, lon_i FROM gcm WHERE year(time) < 1999 INTERSECT SELECT time, lat_i, lon_i FROM coarse WHERE year(time) < 1999),
p AS (SELECT time, lat_i, lon_i, (lat_i * 1000 + lon_i) * 100 + b AS g, pr / 10000 AS x, core FROM gcm JOIN bt ON doy = dayofyear(time)),
h AS (SELECT g, x FROM p JOIN sh USING (time, lat_i, lon_i)), o AS (SELECT (lat_i * 1000 + lon_i) * 100 + b AS g, pr AS x FROM coarse JOIN sh USING (time, lat_i, lon_i) JOIN bt ON doy = dayofyear(time)),
pu AS (SELECT *, (count(*) OVER (PARTITION BY g ORDER BY x RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 0.4::DOUBLE) / (count(*) OVER (PARTITION BY g) + 0.2::DOUBLE) AS u FROM p),
{_quantile_sql('o', 'pu', 'oq')}, {_quantile_sql('h', 'oq_t', 'hq')}
SELECT time, lat_i, lon_i, round(x * CASE WHEN hq <> 0 THEN oq / hq ELSE 1 END + 1e-7, 4) AS pr FROM hq_t WHERE core"""


@query("m10_edcdf", _EDCDF_SQL)
def _(spark, sf):
    o, h, p = _parts(spark, sf)
    out = M.edcdf_by_day(h.union(p), o, F.year("time") < 1999, "pr", C.generate_batches(366, 15, 15, spark, one_indexed=True))
    return out.select("time", *CELL, F.round(F.col("pr") + F.lit(1e-7), 4).alias("pr"))


@query("m11_constructed_analogs")
def _(spark, sf):
    o, _, p = _parts(spark, sf)
    return M.construct_analogs(p, o.filter(F.year("time") < 1999), obs(spark, sf).filter(F.year("time") < 1999), _weights(spark, sf)[1], "pr", 5, 20)


@query(
    "m12_pure_regression",
    f"""WITH {OBS}, {GCM}, {_COARSE}, t AS (SELECT c.time, lat_i, lon_i, c.pr AS y, g.pr / 10000 AS x FROM coarse c JOIN gcm g USING (time, lat_i, lon_i) WHERE year(time) < 1999),
    f AS (SELECT lat_i, lon_i, regr_slope(y, x) AS a, regr_intercept(y, x) AS b, sqrt(greatest(regr_syy(y, x) - regr_slope(y, x) * regr_slope(y, x) * regr_sxx(y, x), 0) / count(*)) AS e FROM t GROUP BY ALL)
    SELECT time, lat_i, lon_i, round(a * pr / 10000 + b, 5) AS pred, round(e, 5) AS prediction_error FROM gcm JOIN f USING (lat_i, lon_i) WHERE year(time) >= 1999""",
)
def _(spark, sf):
    o, h, p = _parts(spark, sf)
    train = o.withColumnRenamed("pr", "y").join(h.withColumnRenamed("pr", "x"), ["time", *CELL])
    out = M.linear_regression(train, p.withColumnRenamed("pr", "x"), "x", "y")
    return out.select("time", *CELL, F.round("pred", 5).alias("pred"), F.round("prediction_error", 5).alias("prediction_error"))


_GARD_SQL = f"""WITH RECURSIVE {OBS}, {GCM}, {_COARSE}, t AS MATERIALIZED (SELECT time, lat_i, lon_i, cbrt(c.pr::DOUBLE) AS y, cbrt(g.pr / 10000) AS x FROM coarse c JOIN gcm g USING (time, lat_i, lon_i) WHERE year(time) < 1999),
p AS MATERIALIZED (SELECT time, lat_i, lon_i, cbrt(pr / 10000) AS x FROM gcm WHERE year(time) >= 1999)"""
# Ten nearest days of the cell; the line through the wet ones, where there are three or more of them, else their mean.
_ANALOG_SQL = """{head}, n AS (SELECT p.time, lat_i, lon_i, p.x AS new, t.x, t.y, t.y > 1 AS wet FROM p JOIN t USING (lat_i, lon_i) QUALIFY row_number() OVER (PARTITION BY p.time, lat_i, lon_i ORDER BY (t.x - p.x) * (t.x - p.x), t.time) <= 10),
a AS (SELECT time, lat_i, lon_i, new, count(*) FILTER (wet) AS k, avg(wet::INT) AS share, avg(y) FILTER (wet) AS mean, stddev_pop(y) FILTER (wet) AS sd, regr_slope(y, x) FILTER (wet) AS a, regr_intercept(y, x) FILTER (wet) AS b, regr_syy(y, x) FILTER (wet) AS syy, regr_sxx(y, x) FILTER (wet) AS sxx FROM n GROUP BY ALL)
SELECT time, lat_i, lon_i, round(coalesce(pow(CASE WHEN {line} THEN a * new + b ELSE mean END, 3), 0), 5) AS pred, round(share, 5) AS exceedance_prob, round(coalesce(CASE WHEN {line} THEN sqrt(greatest(syy - a * a * sxx, 0) / k) ELSE sd END, 0), 5) AS prediction_error FROM a"""
# A logistic fit of wet days by 25 Newton steps with a slight ridge, and a line through the wet days.
_REGRESSION_SQL = f"""{_GARD_SQL}, w AS (SELECT lat_i, lon_i, 0 AS step, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1 FROM (SELECT DISTINCT lat_i, lon_i FROM t)
UNION ALL SELECT lat_i, lon_i, step + 1, w0 - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01), w1 - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01)
FROM (SELECT lat_i, lon_i, step, w0, w1, sum(q * (1 - q)) + 1e-6 AS h00, sum(q * (1 - q) * x) AS h01, sum(q * (1 - q) * x * x) + 1e-6 AS h11, sum(q - (y > 1)::INT) + 1e-6 * w0 AS g0, sum((q - (y > 1)::INT) * x) + 1e-6 * w1 AS g1
FROM (SELECT w.*, x, y, 1 / (1 + exp(-greatest(least(w0 + w1 * x, 30), -30))) AS q FROM w JOIN t USING (lat_i, lon_i) WHERE step < 25) GROUP BY lat_i, lon_i, step, w0, w1)),
f AS (SELECT lat_i, lon_i, min((y > 1)::INT) AS least, max((y > 1)::INT) AS most, regr_slope(y, x) FILTER (y > 1) AS a, regr_intercept(y, x) FILTER (y > 1) AS b, sqrt(greatest(regr_syy(y, x) FILTER (y > 1) - pow(regr_slope(y, x) FILTER (y > 1), 2) * regr_sxx(y, x) FILTER (y > 1), 0) / count(*) FILTER (y > 1)) AS e FROM t GROUP BY ALL)
SELECT p.time, lat_i, lon_i, round(coalesce(pow(a * x + b, 3), 0), 5) AS pred, round(CASE WHEN least = most THEN least ELSE 1 / (1 + exp(-greatest(least(w0 + w1 * x, 30), -30))) END, 5) AS exceedance_prob, round(coalesce(e, 0), 5) AS prediction_error FROM p JOIN f USING (lat_i, lon_i) JOIN w USING (lat_i, lon_i) WHERE step = 25"""


for _model, _sql in (("PureRegression", _REGRESSION_SQL), ("PureAnalog", _ANALOG_SQL.format(head=_GARD_SQL, line="false")), ("AnalogRegression", _ANALOG_SQL.format(head=_GARD_SQL, line="k > 2"))):

    @query(f"m13_gard_{_model.lower()}", _sql)
    def _(spark, sf, model=_model):
        o, h, p = _parts(spark, sf)
        train = o.withColumnRenamed("pr", "pr__y").join(h.withColumnRenamed("pr", "pr__x"), ["time", *CELL])
        out = M.gard_fit_predict(train, p.withColumnRenamed("pr", "pr__x"), ["pr__x"], "pr__y", model, thresh=1.0)
        return out.select("time", *CELL, *[F.round(c, 5).alias(c) for c in ("pred", "exceedance_prob", "prediction_error")])


_EFFECTS_SQL = f"""WITH a AS (SELECT p_partkey, p_size + 1.0::DOUBLE AS pred, p_size / 60.0::DOUBLE + 0.05::DOUBLE AS p, (p_partkey % 41) / 10.0::DOUBLE - 2 AS field FROM part), c AS (SELECT DISTINCT field, {normal_cdf_sql('field')} AS f FROM a),
b AS (SELECT a.*, (f - (1 - p)) / p AS u FROM a JOIN c USING (field)), n AS {normal_ppf_sql('b')} SELECT p_partkey, round(coalesce(CASE WHEN pow(cbrt(pred) + 0.3::DOUBLE * z, 3) >= 0 THEN pow(cbrt(pred) + 0.3::DOUBLE * z, 3) END, 0), 5) AS pr FROM b LEFT JOIN n USING (u)"""


@query("m14_random_effects", _EFFECTS_SQL)
def _(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", (F.col("p_size") + 1).cast("double").alias("pred"), (F.col("p_size") / F.lit(60.0) + 0.05).alias("exceedance_prob"), F.lit(0.3).alias("prediction_error"), ((F.col("p_partkey") % 41) / F.lit(10.0) - 2).alias("field"))
    return M.random_effects(rows, "field", 0.1, True, "pr").select("p_partkey", F.round("pr", 5).alias("pr"))


def _fine_sql(rows: str) -> str:
    """Rows (time, lat_i, lon_i, x) of the coarse grid on the fine one, with g, the cell's number."""
    return f"SELECT time, lat_i, lon_i, lat_i * 100000 + lon_i AS g, x FROM (SELECT time, a.dst AS lat_i, b.dst AS lon_i, sum(a.w * b.w * x) / sum(a.w * b.w) AS x FROM ({rows}) r JOIN lin a ON a.src = r.lat_i JOIN lin b ON b.src = r.lon_i GROUP BY ALL)"


_GARD_WHOLE_SQL = f"""WITH {OBS}, {GCM}, {_COARSE}, {_LINEAR}, ip AS ({_fine_sql('SELECT time, lat_i, lon_i, pr AS x FROM coarse WHERE year(time) < 1999')}),
hf AS ({_fine_sql('SELECT time, lat_i, lon_i, pr / 10000 AS x FROM gcm WHERE year(time) < 1999')}), pn AS ({_fine_sql('SELECT time, lat_i, lon_i, pr / 10000 AS x FROM gcm WHERE year(time) >= 1999')}), {_mapping_sql('hf', 'ip', 'pn')},
tr AS (SELECT g, cbrt(ip.x) AS x, cbrt(pr::DOUBLE) AS y FROM ip JOIN obs USING (time, lat_i, lon_i)),
rg AS (SELECT g, regr_slope(y, x) AS a, regr_intercept(y, x) AS b, sqrt(greatest(regr_syy(y, x) - pow(regr_slope(y, x), 2) * regr_sxx(y, x), 0) / count(*)) AS e FROM tr GROUP BY g)
SELECT time, lat_i, lon_i, round(pow(a * cbrt(y) + b, 3) + e * {_field_sql(1999, 40, 4.0, 2.0, 'lat_i', 'lon_i', "(time - DATE '1999-01-01')")}, 5) AS pr FROM mapped JOIN rg USING (g)"""


@query("m13_gard_end_to_end", _GARD_WHOLE_SQL)
def _(spark, sf):
    _, h, p = _parts(spark, sf)
    coarse, fine = _weights(spark, sf)
    field = lambda rows: G.random_field(rows.withColumn("step", F.datediff("time", F.lit("1999-01-01").cast("date"))), 4.0, 2.0, 1999, modes=40)
    return D.gard(obs(spark, sf).filter(F.year("time") < 1999), h, p, coarse, fine, field, "pr").select("time", *CELL, F.round("pr", 5).alias("pr"))


@query("m11_maca_end_to_end")
def _(spark, sf):
    _, h, p = _parts(spark, sf)
    coarse, fine = _weights(spark, sf)
    return D.maca(obs(spark, sf), h.union(p), F.year("time") < 1999, F.year("time") >= 1999, coarse, fine, "pr", 5, 20, 21, 3)


def _layers(stages: int = 1):
    """Layers of the published sizes (kernels 9, 3 and 5), drawn from a seed."""
    rng = np.random.default_rng(5)
    return [[(rng.normal(size=(k, k, a, b)) * 0.05, np.zeros(b)) for k, a, b in ((9, 2, 8), (3, 8, 4), (5, 4, 1))] for _ in range(stages)]


def _network(spark, stages: int = 1):
    """The layers, written and read as a store."""
    return networks.read_network(spark, networks.write_network(spark, scratch(spark, "network"), _layers(stages)))


def _convolved_sql(rows: str, elevation: str) -> str:
    """CTEs that pass maps of ``rows`` (time, lat_i, lon_i, x; a day needs all rows of its grid) and of ``elevation`` (lat_i, lon_i, x) through one stage.

    Leaves ``c3`` (time, i, j, x) on the fine grid. Needs the CTEs of ``_LINEAR``.
    """
    ctes = f"""mr AS ({rows}), md AS (SELECT time FROM mr GROUP BY time HAVING count(DISTINCT lat_i) = (SELECT h FROM n)),
    mg AS (SELECT time, i, j, coalesce(x, 0) AS x FROM (SELECT time, i, j FROM md, (SELECT unnest(range(0, h)) AS i FROM n), (SELECT unnest(range(0, h)) AS j FROM n)) g LEFT JOIN mr ON mr.time = g.time AND lat_i = i AND lon_i = j),
    c0 AS (SELECT time, a.dst AS i, b.dst AS j, 0 AS o, sum(a.w * b.w * x) AS x FROM (SELECT * FROM mg) m JOIN lin a ON a.src = i JOIN lin b ON b.src = j GROUP BY time, a.dst, b.dst UNION ALL SELECT time, lat_i, lon_i, 1, x FROM md, ({elevation}))"""
    ctes = ctes.replace("SELECT time, i, j, coalesce(x, 0)", "SELECT g.time, i, j, coalesce(x, 0)")
    for k, (kernel, _) in enumerate(_layers()[0], 1):
        half = kernel.shape[0] // 2
        values = ", ".join(f"({di - half}, {dj - half}, {a}, {o}, {float(v)!r}::DOUBLE)" for (di, dj, a, o), v in np.ndenumerate(kernel))
        value = "sum(x * v)" if k == 3 else "greatest(sum(x * v), 0)"
        ctes += f""", k{k} AS MATERIALIZED (SELECT * FROM (VALUES {values}) AS k(di, dj, a, o, v)),
    c{k} AS MATERIALIZED (SELECT time, i - di AS i, j - dj AS j, k.o, {value} AS x FROM c{k - 1} c JOIN k{k} k ON k.a = c.o WHERE i - di BETWEEN 0 AND (SELECT w - 1 FROM n) AND j - dj BETWEEN 0 AND (SELECT w - 1 FROM n) GROUP BY time, i - di, j - dj, k.o)"""
    return ctes


_ELEVATION = "(SELECT i AS lat_i, j AS lon_i, coalesce(elev, 0)::DOUBLE AS x FROM (SELECT unnest(range(0, w)) AS i, w FROM n) JOIN (SELECT unnest(range(0, w)) AS j FROM n) ON true LEFT JOIN cells ON lat_i = i AND lon_i = j)"
_MAPS_SQL = _convolved_sql("SELECT time, lat_i, lon_i, pr / 1e5 AS x FROM gcm", f"SELECT lat_i, lon_i, x / 1e4 AS x FROM {_ELEVATION}")


@query("m15_super_resolution", f"WITH {GCM}, {CELLS}, {_LINEAR}, {_MAPS_SQL} SELECT time, count(DISTINCT i)::INT AS rows, round(sum(x), 5) AS total FROM c3 GROUP BY time")
def _(spark, sf):
    w = grid_width(spark, sf) // 2
    maps = D.maps_of(gcm(spark, sf).withColumn("pr", F.col("pr") / F.lit(1e5)), "pr", w, w)
    elevation = networks.elevation_matrix(cells(spark, sf), 2 * w, 2 * w)
    out = M.super_resolve(maps.repartition(tasks(spark, sf, "orders"), "time"), [elevation / 1e4], _network(spark))
    return out.select("time", F.size("field").alias("rows"), F.round(F.aggregate(F.flatten("field"), F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


_DEEPSD_SQL = f"""WITH {OBS}, {GCM}, {_LINEAR}, {CELLS}, zm AS (SELECT lat_i, lon_i, avg(pr / 10000) AS m, stddev_pop(pr / 10000) AS s FROM gcm WHERE year(time) < 1999 GROUP BY ALL),
sf AS ({_fine_sql('SELECT time, lat_i, lon_i, (pr / 10000 - m) / (s + 1e-6) AS x FROM gcm JOIN zm USING (lat_i, lon_i) WHERE year(time) >= 1999')}), ob AS (SELECT lat_i * 100000 + lon_i AS g, pr::DOUBLE AS x FROM obs),
bk AS (SELECT time, lat_i, lon_i, sf.g, greatest(sf.x * (s + 1e-6) + m, 0) AS x FROM sf JOIN (SELECT g, avg(x) AS m, stddev_pop(x) AS s FROM ob GROUP BY g) mo ON mo.g = sf.g), {_mapping_sql('bk', 'ob', 'bk', False)}
SELECT q.time, q.lat_i, q.lon_i, CASE WHEN is_land THEN round(y, 5) END AS pr FROM mapped q LEFT JOIN cells c ON c.lat_i = q.lat_i AND c.lon_i = q.lon_i"""


_SCORES = "SELECT time, lat_i, lon_i, (pr / 10000 - m) / (s + 1e-6) AS x FROM gcm JOIN zm USING (lat_i, lon_i) WHERE year(time) >= 1999"
_HEIGHTS = f"SELECT lat_i, lon_i, (x - avg(x) OVER ()) / (stddev_pop(x) OVER () + 1e-6) AS x FROM {_ELEVATION}"
_DEEPSD_NETWORK_SQL = _DEEPSD_SQL.replace(f"sf AS ({_fine_sql(_SCORES)})", f"{_convolved_sql(_SCORES, _HEIGHTS)}, sf AS (SELECT time, i AS lat_i, j AS lon_i, i * 100000 + j AS g, x FROM c3)")


@query("m17_deepsd_network", _DEEPSD_NETWORK_SQL)
def _(spark, sf):
    _, h, p = _parts(spark, sf)
    w = grid_width(spark, sf) // 2
    return D.deepsd(p, h, obs(spark, sf), None, "pr", cells(spark, sf), _network(spark), [networks.elevation_matrix(cells(spark, sf), 2 * w, 2 * w)]).select("time", *CELL, F.round("pr", 5).alias("pr"))


@query("m17_deepsd", _DEEPSD_SQL)
def _(spark, sf):
    _, h, p = _parts(spark, sf)
    return D.deepsd(p, h, obs(spark, sf), _weights(spark, sf)[1], "pr", cells(spark, sf)).select("time", *CELL, F.round("pr", 5).alias("pr"))


def _monthly_weather(spark, sf):
    """A synthetic monthly climate for each cell: the observations' precipitation with a yearly cycle of temperatures."""
    m = A.time_summary(obs(spark, sf).select("time", *CELL, "pr")).withColumnRenamed("pr", "ppt")
    phase = F.cos((F.month("time") - 1) * F.lit(2 * np.pi / 12))
    return m.select(
        "time", *CELL, "ppt", (F.lit(18.0) - phase * 12).alias("tmax"), (F.lit(6.0) - phase * 12).alias("tmin"), (F.lit(3.0) - phase * 10).alias("tdew"), (F.lit(180.0) - phase * 90).alias("srad"),
        F.lit(3.0).alias("ws"), F.lit(120.0).alias("awc"), (F.col("lat_i") * 100.0).alias("elevation"), (F.col("lat_i") + 35.0).alias("lat"),
    )


_STEPS = _PET[_PET.index("a AS (") : _PET.index("SELECT p_partkey, month::INT")].replace("ORDER BY month", "ORDER BY time")
_MELT = "(CASE WHEN t < -2 THEN 0 WHEN t > 6.5 THEN 1 ELSE 1 - (-48.2292::DOUBLE * (tanh(0.7205::DOUBLE * (t - 1.1662::DOUBLE)) - 1.0223::DOUBLE)) / 100 END)"
_BALANCE_SQL = f"""WITH RECURSIVE {OBS}, w AS (SELECT date_trunc('month', time)::DATE AS time, lat_i, lon_i, sum(pr) AS ppt, cos((month(any_value(time)) - 1) * 2 * pi() / 12) AS phase FROM obs GROUP BY date_trunc('month', time), lat_i, lon_i),
x AS (SELECT lat_i * 100000 + lon_i AS p_partkey, lat_i, lon_i, time, month(time) AS month, ppt, 18.0::DOUBLE - phase * 12 AS tmax, 6.0::DOUBLE - phase * 12 AS tmin, 3.0::DOUBLE - phase * 10 AS tdew, (180.0::DOUBLE - phase * 90) * 0.0864::DOUBLE AS srad, 3.0::DOUBLE AS ws, lat_i + 35.0::DOUBLE AS lat, lat_i * 100.0::DOUBLE AS elev,
 [31,28,31,30,31,30,31,31,30,31,30,31][month(time)] AS nd, [31,59,90,120,151,181,212,243,273,304,334,365][month(time)] AS last FROM w),
{_STEPS.rstrip().rstrip(",")},
mo AS (SELECT p_partkey AS c, lat_i, lon_i, time, row_number() OVER (PARTITION BY p_partkey ORDER BY time) AS k, ppt, {_MELT} AS melt, {_MELT} * 0.408::DOUBLE * (delta * (net - 0.14::DOUBLE * (t - before) * nd) + pa * 0.001013::DOUBLE * greatest(0, es - ea) / ra * 86400 * nd) / (delta + gamma * (1 + rs / ra)) AS pet FROM f),
s1 AS (SELECT *, (1 - melt) * ppt AS snow FROM mo),
r AS (SELECT c, 0::BIGINT AS k, 120.0::DOUBLE AS soil, 0.0::DOUBLE AS swe, NULL::DOUBLE AS aet, NULL::DOUBLE AS def, NULL::DOUBLE AS q FROM (SELECT DISTINCT c FROM mo)
 UNION ALL SELECT c, k, soil + stored - drawn, pack - sub, least(water, pet) + sub + drawn, pet - (least(water, pet) + sub + drawn), runoff + greatest(water - pet, 0) - stored
 FROM (SELECT *, least(greatest(pet - water, 0) - sub, soil) * (1 - exp(-soil / 120.0::DOUBLE)) AS drawn, least(greatest(water - pet, 0), 120 - soil) AS stored
  FROM (SELECT *, least(pack, greatest(pet - water, 0)) AS sub FROM (SELECT s1.c, s1.k, pet, r.soil, (1 - melt) * (r.swe + snow) AS pack, 0.95::DOUBLE * melt * (ppt + r.swe + snow) AS water, 0.05::DOUBLE * melt * (ppt + r.swe + snow) AS runoff FROM r JOIN s1 ON s1.c = r.c AND s1.k = r.k + 1))))
SELECT time, lat_i, lon_i, round(aet, 4) AS aet, round(r.def, 4) AS def, round(pet, 4) AS pet, round(q, 4) AS q, round(soil, 4) AS soil, round(swe, 4) AS swe FROM r JOIN mo ON mo.c = r.c AND mo.k = r.k"""


@query("m18_water_balance", _BALANCE_SQL)
def _(spark, sf):
    out = W.water_balance(_monthly_weather(spark, sf), with_pdsi=False)
    return out.select("time", *CELL, *[F.round(c, 4).alias(c) for c in ("aet", "def", "pet", "q", "soil", "swe")])


@query("m19_pdsi")
def _(spark, sf):
    months = F.sequence(F.lit("1985-01-01").cast("date"), F.lit("2000-12-01").cast("date"), F.expr("interval 1 month"))
    grid = cells(spark, sf).select(*CELL).withColumn("time", F.explode(months))
    wet = F.pmod(F.xxhash64("time", *CELL), F.lit(90)).cast("double")
    phase = F.cos((F.month("time") - 1) * F.lit(2 * np.pi / 12))
    rows = grid.select(
        "time", *CELL, wet.alias("ppt"), (F.lit(18.0) - phase * 12).alias("tmax"), (F.lit(6.0) - phase * 12).alias("tmin"), (F.lit(3.0) - phase * 10).alias("tdew"), (F.lit(180.0) - phase * 90).alias("srad"),
        F.lit(3.0).alias("ws"), F.lit(120.0).alias("awc"), F.lit(100.0).alias("elevation"), F.lit(40.0).alias("lat"),
    )
    return W.water_balance(rows).select("time", *CELL, "pdsi")


@query("m19_pdsi_observed")
def _(spark, sf):
    """Drought severity of the observed months' precipitation; the record is seven years, so five of its climatology lead in."""
    out = W.water_balance(_monthly_weather(spark, sf), normal=(1992, 1998), pad_years=5)
    return out.select("time", *CELL, F.round("pdsi", 4).alias("pdsi"))


_SOIL_SQL = f"""WITH RECURSIVE {OBS}, m AS (SELECT date_trunc('month', time)::DATE AS time, lat_i, lon_i, sum(pr) / 25.4::DOUBLE AS p FROM obs GROUP BY ALL),
o AS (SELECT *, 1 + month(time) % 6 * 0.8::DOUBLE AS e, lat_i * 0.5::DOUBLE AS size, row_number() OVER (PARTITION BY lat_i, lon_i ORDER BY time) AS k FROM m),
r AS (SELECT lat_i, lon_i, 0::BIGINT AS k, 1::DOUBLE AS a, any_value(size) AS b, 0::DOUBLE AS et, 0::DOUBLE AS r, 0::DOUBLE AS ro, 0::DOUBLE AS l FROM o GROUP BY lat_i, lon_i UNION ALL
 SELECT lat_i, lon_i, k, a + ia - fa, b + ib - fb, CASE WHEN p >= e THEN e ELSE p + fa + fb END, ia + ib, greatest(p - e, 0) - ia - ib, fa + fb FROM (
  SELECT *, least(greatest(p - e, 0) - ia, size - b) AS ib, least((greatest(e - p, 0) - fa) * b / (1 + size), b) AS fb FROM (
   SELECT o.lat_i, o.lon_i, o.k, p, e, size, r.a, r.b, least(greatest(p - e, 0), 1 - r.a) AS ia, least(r.a, greatest(e - p, 0)) AS fa FROM r JOIN o ON o.lat_i = r.lat_i AND o.lon_i = r.lon_i AND o.k = r.k + 1)))
SELECT time, lat_i, lon_i, round(et, 5) AS et, round(r, 5) AS r, round(ro, 5) AS ro, round(l, 5) AS l FROM r JOIN o USING (lat_i, lon_i, k)"""


@query("m19_soil_terms", _SOIL_SQL)
def _(spark, sf):
    """The two layers of soil behind the index, with the observed months' precipitation."""
    month = F.trunc("time", "month").alias("time")
    rows = obs(spark, sf).groupBy(month, *CELL).agg((F.sum("pr") / F.lit(25.4)).alias("p"))
    rows = rows.select("time", *CELL, "p", (F.month("time") % 6 * F.lit(0.8) + 1).alias("e"), (F.col("lat_i") * F.lit(0.5) + 1).alias("awc"))
    out = W.soil_balance(rows, "p", "e", "awc")
    return out.select("time", *CELL, *[F.round(c, 5).alias(c) for c in ("et", "r", "ro", "l")])


@query("st_daily_feed", f"WITH {HOURLY} SELECT ts::DATE AS time, cell, round(avg(value), 6) AS mean, max(value) AS high, min(value) AS low, count(value) AS n FROM hourly GROUP BY ALL")
def _(spark, sf):
    from ..streaming import daily_feed as S

    # A file source reads folders; the glob keeps to the one table.
    rows = spark.readStream.schema(table(spark, sf, "events").schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf}/events.parquet*")
    rows = rows.select(F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 25).cast("int").alias("cell"), "value")
    path = _scratch(spark)
    closed: list[int] = []

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{path}/batch-{number}")
        closed.append(number)

    out = S.daily(rows, ["cell"])
    # Whole days in one go: a day that is still open at the end is not written in append mode, so the last ones are taken from an update.
    query_ = out.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query_.awaitTermination()
    done = spark.read.parquet(*[f"{path}/batch-{n}" for n in closed]).groupBy("time", "cell").agg(*[F.max_by(c, "n").alias(c) for c in ("mean", "high", "low", "n")])
    return done.select("time", "cell", r6("mean", "mean"), "high", "low", "n")


@query("k01_partitioned_round_trip", f"WITH {OBS} SELECT year(time)::INT AS year, time, lat_i, lon_i, pr FROM obs WHERE year(time) = 1996")
def _(spark, sf):
    from ..sources import readers, sinks

    path = sinks.write(obs(spark, sf).select(F.year("time").alias("year"), "time", *CELL, "pr"), _scratch(spark) + "/obs", ["year"])
    return readers.scan_years(spark, path, 1996, 1996).select(F.col("year").cast("int").alias("year"), "time", *CELL, "pr")


@query("k04_region_overwrite", f"WITH {OBS} SELECT lat_i, lon_i, sum(pr) + CASE WHEN lat_i = 2 THEN 1 ELSE 0 END AS pr FROM obs GROUP BY lat_i, lon_i")
def _(spark, sf):
    from ..sources import sinks

    totals = obs(spark, sf).groupBy(*CELL).agg(F.sum("pr").alias("pr"))
    path = sinks.write(totals, _scratch(spark) + "/regions", ["lat_i"])
    sinks.write_regions(totals.filter("lat_i = 2").withColumn("pr", F.col("pr") + 1), path, "lat_i")
    return spark.read.parquet(path).select(F.col("lat_i").cast("int").alias("lat_i"), "lon_i", "pr")


@query("k12_report", "SELECT count(DISTINCT p_brand) AS p_brand, count(DISTINCT p_type) AS p_type, count(DISTINCT p_size) AS p_size FROM part")
def _(spark, sf):
    from ..sources.catalog import report

    return report(table(spark, sf, "part").select("p_brand", "p_type", "p_size"))


@query("s11_tiled_field", f"WITH {GCM}, m AS (SELECT time, lat_i, lon_i, pr FROM gcm WHERE year(time) = 1996), k AS (SELECT unnest(range(0, 3)) AS k) SELECT (time + to_months((k * 12)::INT))::DATE AS time, lat_i, lon_i, pr FROM m, k")
def _(spark, sf):
    from ..sources.readers import tile_random_field

    return tile_random_field(gcm(spark, sf).filter("year(time) = 1996"), 3, 1).select("time", *CELL, "pr")


@query("g01_city_seasonality", f"WITH {OBS} SELECT month(time)::INT AS month, lat_i, lon_i, round(avg(tasmax) + 1e-8, 6) AS mean FROM obs WHERE (lat_i, lon_i) IN ((0, 1), (2, 2)) GROUP BY ALL")
def _(spark, sf):
    rows = obs(spark, sf).filter("(lat_i = 0 AND lon_i = 1) OR (lat_i = 2 AND lon_i = 2)")
    out = A.climatology(rows, "month", ["tasmax"])
    return out.select("month", *CELL, r6(F.col("tasmax") + F.lit(1e-8), "mean"))
