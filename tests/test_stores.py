"""Push-down, polygons, variogram fits, analogs and the methods' ends against direct computation."""

from __future__ import annotations

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafield.operators import aggregate as A
from terrafield.operators import downscale as D
from terrafield.operators import grid as G
from terrafield.operators import models as M
from terrafield.operators import select as X
from terrafield.sources import networks, readers, scratch, sinks


def test_coordinate_filters_reach_the_scan(spark, tmp_path):
    rows = spark.range(100).select((F.col("id") / 4.0).alias("lat"), F.lit(float("nan")).alias("pr"))
    scanned = readers.scan(spark, sinks.write(rows, f"file://{tmp_path}/s")).filter(F.col("lat").between(3, 5))
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(lat,3.0)" in plan and "LessThanOrEqual(lat,5.0)" in plan
    assert scanned.count() == 9 and scanned.filter("pr IS NULL").count() == 9


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    assert scratch.scratch(spark, "x").startswith("file:")


def inside(ring, x, y):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) / (y2 - y1) * (x2 - x1):
            odd = not odd
    return odd


def test_points_in_polygons(spark):
    rng = np.random.default_rng(4)
    rings = [[tuple(map(float, p)) for p in rng.uniform(-20, 20, (n, 2))] for n in (3, 4, 5, 7, 9)]
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-25, 25, (300, 2)))]
    polygons = spark.createDataFrame([(k, ring) for k, ring in enumerate(rings)] + [(99, []), (98, [(0.0, 0.0), (1.0, 1.0)])], "region_id int, ring array<struct<x: double, y: double>>")
    got = sorted((r.id, r.region_id) for r in X.regions_of(spark.createDataFrame(points, "id int, lon double, lat double"), polygons).collect())
    assert got == sorted((i, k) for i, x, y in points for k, ring in enumerate(rings) if inside(ring, x, y))


def test_gaussian_fit_finds_what_made_it():
    lags = np.arange(1, 30)
    gamma = 2.0 + 5.0 * (1 - np.exp(-np.pi / 4 * (lags / 7.0) ** 2))
    assert A.fit_gaussian(lags, gamma) == pytest.approx((7.0, 5.0, 2.0), rel=1e-3)
    length, sill, nugget = A.fit_gaussian(lags, 5.0 * (1 - np.exp(-np.pi / 4 * (lags / 3.0) ** 2)))
    assert (length, sill, nugget) == pytest.approx((3.0, 5.0, 0.0), abs=1e-2)


def fields(spark, rng, first, n, gap=0.0, regions=False):
    day = datetime.date.fromisoformat(first)
    rows = [(day + datetime.timedelta(days=k), i, j, float(rng.gamma(2, 3)), i // 2) for k in range(n) for i in range(4) for j in range(3) if rng.random() >= gap]
    df = spark.createDataFrame(rows, "time date, lat_i int, lon_i int, pr double, region_id int")
    return (df if regions else df.drop("region_id")), rows


def test_analogs_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    (g, a), (o, b) = fields(spark, rng, "2001-02-20", 15, 0.1), fields(spark, rng, "1999-12-01", 400, 0.1)
    near = {(r.doy, r.other) for r in M.doy_pairs(spark, 10).collect()}
    by_day = lambda rows: {t: {(i, j): x for u, i, j, x, _ in rows if u == t} for t in {r[0] for r in rows}}
    mine, theirs = by_day(a), by_day(b)
    want = []
    for day, x in mine.items():
        far = []
        for other, y in theirs.items():
            both = x.keys() & y.keys()
            if both and (day.timetuple().tm_yday, other.timetuple().tm_yday) in near:
                far.append((sum((x[c] - y[c]) ** 2 for c in both) ** 0.5 / len(both), other))
        want += [(day, k + 1, other, round(f, 9)) for k, (f, other) in enumerate(sorted(far)[:5])]
    got = sorted((r.gcm_day, r.rank, r.obs_day, round(r.rmse, 9)) for r in M.analog_days(g, o, "pr", 5, 10).collect())
    assert got == sorted(want)


def test_constructed_analogs_by_region(spark):
    """With as many analogs as a region allows and fields made of them, the construction gives the fields back."""
    rng = np.random.default_rng(9)
    obs, rows = fields(spark, rng, "2000-03-01", 12, regions=True)
    x = {(t, i, j): v for t, i, j, v, _ in rows}
    days = sorted({r[0] for r in rows})
    made = [(datetime.date(2010, 3, 5), i, j, 0.25 * x[days[4], i, j] + 0.75 * x[days[5], i, j], i // 2) for i in range(4) for j in range(3)]
    model = spark.createDataFrame(made, obs.schema)
    weights = G.weights(spark, [(i, i, 1.0) for i in range(4)], [(j, j, 1.0) for j in range(3)])
    got = {(r.lat_i, r.lon_i): r.pr for r in M.construct_analogs(model, obs, obs, weights, "pr", 3, 30, by=["region_id"]).collect()}
    assert got == pytest.approx({(i, j): v for _, i, j, v, _ in made}, abs=1e-6)


def test_maca_corrects_the_fine_days(spark):
    """The downscaled history has the distribution of the fine observations, by the last correction."""
    rng = np.random.default_rng(10)
    days = [datetime.date(1990 + y, 1, 1) + datetime.timedelta(days=k) for y in range(6) for k in range(0, 360, 6)]
    obs = spark.createDataFrame([(t, i, j, float(rng.gamma(2, 3) + i)) for t in days for i in range(4) for j in range(4)], "time date, lat_i int, lon_i int, tasmax double")
    model = spark.createDataFrame([(t, i, j, float(rng.gamma(2, 2) + 20)) for t in days for i in range(2) for j in range(2)], obs.schema)
    to_coarse = G.weights(spark, *[G.overlap_axis_weights(list(range(4)), [0.5, 2.5], False)] * 2)
    to_fine = G.weights(spark, *[G.linear_axis_weights([0.5, 2.5], list(range(4)))] * 2)
    out = D.maca(obs, model, F.year("time") < 1994, F.year("time") < 1994, to_coarse, to_fine, "tasmax", 3, 45, 21, 3)
    a, b = (df.filter(F.year("time") < 1994).groupBy("lat_i").agg(F.avg("tasmax").alias("m")).orderBy("lat_i").collect() for df in (out, obs))
    assert [r.m for r in a] == pytest.approx([r.m for r in b], abs=0.35)
    assert out.columns == ["time", "lat_i", "lon_i", "tasmax"]


def test_networks_and_maps_round_trip(spark, tmp_path):
    rng = np.random.default_rng(2)
    stages = [[(rng.normal(size=(3, 3, 2, 4)), rng.normal(size=4)), (rng.normal(size=(1, 1, 4, 1)), np.zeros(1))] for _ in range(2)]
    read = networks.read_network(spark, networks.write_network(spark, f"file://{tmp_path}/n", stages))
    assert all((a == c).all() and (b == d).all() for own, got in zip(stages, read) for (a, b), (c, d) in zip(own, got))
    rows = [(datetime.date(2000, 1, 1), i, j, float(10 * i + j)) for i in range(3) for j in range(2)] + [(datetime.date(2000, 1, 2), 0, 0, 1.0)]
    df = spark.createDataFrame(rows, "time date, lat_i int, lon_i int, pr double")
    maps = D.maps_of(df, "pr", 3, 2)
    assert [r.field for r in maps.collect()] == [[[0.0, 1.0], [10.0, 11.0], [20.0, 21.0]]]
    assert sorted(map(tuple, D.cells_of(maps, "pr").collect())) == rows[:6]
    elevation = spark.createDataFrame([(0, 1, 5.0), (2, 1, None), (9, 9, 1.0)], "lat_i int, lon_i int, elev double")
    assert networks.elevation_matrix(elevation, 3, 2).tolist() == [[0, 5], [0, 0], [0, 0]]


def test_batches_and_samples(spark, tmp_path):
    rows = spark.range(1000).select("id", F.array(F.col("id").cast("double")).alias("patch"))
    path = sinks.write_patches(rows, f"file://{tmp_path}/p")
    first, again, other = (readers.read_batches(spark, path, 64, seed).orderBy("batch", "shuffle").collect() for seed in (1, 1, 2))
    assert first == again and sorted(r.id for r in first) == list(range(1000)) and [r.id for r in first] != [r.id for r in other] != list(range(1000))
    some = X.sample(rows, 0.2, ["id"], 5)
    assert 150 < some.count() < 250 and some.collect() == X.sample(rows.repartition(7), 0.2, ["id"], 5).orderBy("id").collect()
    with pytest.raises(ValueError):
        X.squeeze(rows.select("id"), ["id"])
    with pytest.raises(TypeError):
        sinks.chunk_lengths({"time": 10}, ["time"], 4)


def test_web_catalog(spark):
    from terrafield.sources import catalog

    name = "CMIP.I.M.ssp245.r1.day.bcsd.pr"
    runs = [(name, "0.1.9", "az://p/a", "az://d/a"), (name, "0.1.10", "az://p/b", None), (name, "0.2.0+local", "az://p/c", "az://d/c"), ("too.short", "1.0.0", "az://p/d", "az://d/d"), (name.replace("pr", "tas"), "0.1.0", None, "az://d/e")]
    rows = catalog.web_catalog(spark.createDataFrame(runs, "name string, version string, pyramid string, daily string"), "https://data/", "https://cdn").collect()
    assert [(r.variable_id, r.method, r.version, r.source, r.original) for r in rows] == [("pr", "bcsd", "0.1.10", "https://cdn/p/b", None)]
