"""Calendars, windows, regridding and models against NumPy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafield.operators import calendar as C
from terrafield.operators import grid as G
from terrafield.operators import models as M
from terrafield.operators import water as W
from terrafield.sources import catalog, readers, sinks

CELL = ("lat_i", "lon_i")


def daily(spark, values, start="2001-01-01", cell=(0, 0)):
    df = spark.createDataFrame([(k, *cell, None if v is None else float(v)) for k, v in enumerate(values)], "k int, lat_i int, lon_i int, pr double")
    return df.select(F.date_add(F.lit(start).cast("date"), F.col("k")).alias("time"), *CELL, "pr")


def test_leap_day_is_filled(spark):
    rows = [(2020, m, d, 0, 0, 1.0) for m in range(1, 13) for d in range(1, (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)[m - 1] + 1)]
    df = spark.createDataFrame(rows, "year int, month int, day int, lat_i int, lon_i int, pr double")
    out = C.to_standard_calendar(df, "noleap", ["pr"])
    assert out.count() == 366 and out.filter("pr IS NULL OR pr <> 1").count() == 0
    with pytest.raises(ValueError):
        C.to_standard_calendar(df, "360_day", ["pr"])


def test_interpolation_leaves_the_ends(spark):
    out = C.interpolate_linear(daily(spark, [None, 1, None, None, 4, None]), ["pr"]).orderBy("time")
    assert [r.pr for r in out.collect()] == [None, 1.0, 2.0, 3.0, 4.0, None]


def test_batches_wrap(spark):
    rows = C.generate_batches(10, 5, 3, spark).collect()
    items = lambda b, core: [r.item for r in rows if r.batch == b and (r.is_core or not core)]
    assert [items(0, True), items(1, True)] == [[0, 1, 2, 3, 4], [5, 6, 7, 8, 9]]
    assert [items(0, False), items(1, False)] == [[7, 8, 9, 0, 1, 2, 3, 4, 5, 6, 7], [2, 3, 4, 5, 6, 7, 8, 9, 0, 1, 2]]


def test_windows_must_be_odd(spark):
    with pytest.raises(ValueError):
        C.rolling_mean(daily(spark, [1]), "pr", 4, "m", CELL, "time")
    with pytest.raises(ValueError):
        C.epoch_trend(daily(spark, [1]), "pr", F.lit(True), 20, 31)


def test_trend_of_a_constant_is_zero(spark):
    out = C.epoch_trend(daily(spark, [3] * 1100), "pr", F.year("time") == 2001, 5, 3)
    assert out.count() == 1100 and out.filter("abs(trend) > 1e-9").count() == 0


def test_bilinear_keeps_planes_and_constants(spark):
    field = spark.createDataFrame([(0, y, x, 1.0 + 2 * y + 3 * x, 5.0) for y in range(4) for x in range(4)], "time int, lat_i int, lon_i int, pr double, one double")
    inner = [0.5, 1.25, 2.0]
    w = G.weights(spark, G.linear_axis_weights(range(4), inner), G.linear_axis_weights(range(4), [*inner, 9.0]))
    for r in G.regrid(field, w, ["pr", "one"]).collect():
        x = [*inner, 3.0][r.lon_i]
        assert r.pr == pytest.approx(1 + 2 * inner[r.lat_i] + 3 * x) and r.one == pytest.approx(5)


def test_conservative_weights_add_to_one():
    for spherical in (False, True):
        table = G.overlap_axis_weights(G.axis(-90, 90, 1.5), G.axis(-90, 90, 4), spherical)
        sums = np.zeros(45)
        for i, _, w in table:
            sums[i] += w
        assert sums == pytest.approx(1)


def test_composed_weights(spark):
    a = G.linear_axis_weights(range(4), [0.5, 1.5, 2.5])
    b = G.linear_axis_weights(range(3), [0.5, 1.5])
    wa, wb = G.weights(spark, a, a), G.weights(spark, b, b)
    field = spark.createDataFrame([(0, y, x, float(y * x)) for y in range(4) for x in range(4)], "time int, lat_i int, lon_i int, pr double")
    two = {(r.lat_i, r.lon_i): r.pr for r in G.regrid(G.regrid(field, wa, ["pr"]), wb, ["pr"]).collect()}
    one = {(r.lat_i, r.lon_i): r.pr for r in G.regrid(field, G.compose(wa, wb), ["pr"]).collect()}
    assert one == pytest.approx(two)


def test_missing_source_cells(spark):
    field = spark.createDataFrame([(0, 0, 0, 1.0), (0, 0, 1, None)], "time int, lat_i int, lon_i int, pr double")
    w = G.weights(spark, [(0, 0, 1.0)], [(0, 0, 0.5), (0, 1, 0.5)])
    assert G.regrid(field, w, ["pr"]).first().pr == 1.0
    assert G.regrid(field, w, ["pr"], renormalise=False).first().pr is None
    assert G.regrid(field, w, ["pr"], small=False).first().pr == 1.0


def test_patches(spark):
    field = spark.createDataFrame([(0, y, x, float(10 * y + x)) for y in range(5) for x in range(6)], "time int, lat_i int, lon_i int, pr double")
    got = {(r.y0, r.x0): r.patch for r in G.patches(field, "pr", 3, 2, 5, 6).collect()}
    assert set(got) == {(y, x) for y in (0, 2) for x in (0, 2)}
    assert got[2, 2] == [22, 23, 24, 32, 33, 34, 42, 43, 44]


def test_random_field_is_standard_and_repeats(spark):
    grid = spark.range(0, 4000).select((F.col("id") % 20).cast("int").alias("lon_i"), (F.floor(F.col("id") / 20) % 20).cast("int").alias("lat_i"), F.floor(F.col("id") / 400).cast("int").alias("step"))
    a, b = (G.random_field(grid, 2.0, 1.0, 3).agg(F.avg("field"), F.stddev_pop("field"), F.sum("field")).first() for _ in range(2))
    assert a == b and abs(a[0]) < 0.3 and 0.7 < a[1] < 1.3


# ---------------------------------------------------------------- models


def test_quantile_mapping_moves_a_shift():
    rng = np.random.default_rng(1)
    hist = rng.normal(size=500)
    obs = hist * 2 + 3
    assert M.quantile_map(hist, obs, hist) == pytest.approx(obs)
    assert M.quantile_map(hist, hist, np.array([100.0])) == pytest.approx([100.0])
    assert M.equidistant_cdf(hist, hist + 1, hist) == pytest.approx(hist + 1)
    assert M.equidistant_cdf(np.exp(hist), 2 * np.exp(hist), np.exp(hist), "ratio") == pytest.approx(2 * np.exp(hist))
    t = np.arange(500.0)
    x = hist + 0.01 * t
    assert np.polyfit(t, M.quantile_map(hist, hist, x, True, t), 1)[0] == pytest.approx(np.polyfit(t, x, 1)[0], rel=0.05)
    u = M.quantile_transform(hist, hist)
    assert u.min() == 0 and u.max() == 1


def test_bias_correction_by_cell(spark):
    hist = daily(spark, range(50)).union(daily(spark, range(50), cell=(0, 1)))
    obs = daily(spark, [x + 10 for x in range(50)]).union(daily(spark, [2 * x for x in range(50)], cell=(0, 1)))
    out = M.bias_correct(hist, obs, hist.union(daily(spark, [1], cell=(5, 5))), "pr", "quantile_map")
    got = {r.lon_i: r.s for r in out.groupBy("lon_i").agg(F.sum("pr").alias("s")).collect()}
    assert got == pytest.approx({0: sum(range(50)) + 500, 1: 2 * sum(range(50))})
    with pytest.raises(NotImplementedError):
        M.bias_correct(hist, obs, hist, "pr", "x")


def test_regressions():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 2))
    y = 1 + x @ [2, -1]
    new = rng.normal(size=(20, 2))
    for name in ("PureRegression", "AnalogRegression"):
        got = M.gard_model(name, 30)(x, y, new)
        assert got[:, 0] == pytest.approx(1 + new @ [2, -1], abs=1e-6) and got[:, 1] == pytest.approx(1)
    chance = M.gard_model("PureRegression", thresh=1.0)(x, y, new)[:, 1]
    assert ((chance > 0.5) == (1 + new @ [2, -1] > 1)).mean() > 0.9
    with pytest.raises(NotImplementedError):
        M.gard_model("x")


def test_convolutions():
    rng = np.random.default_rng(2)
    image, height = rng.normal(size=(6, 7)), rng.normal(size=(6, 7))
    kernel, bias = rng.normal(size=(3, 3, 2, 1)), np.array([0.3])
    got = M.srcnn(image, height, [(kernel, bias)])
    padded = np.pad(np.stack([image, height], -1), ((1, 1), (1, 1), (0, 0)))
    want = np.array([[(padded[i : i + 3, j : j + 3] * kernel[..., 0]).sum() + 0.3 for j in range(7)] for i in range(6)])
    assert got == pytest.approx(want)
    assert M.upsample2(np.full((3, 3), 2.0)) == pytest.approx(np.full((6, 6), 2.0))


def test_bucket_balances():
    """What comes in is evaporated, run off or stored, for all cells at once; none gives more than it has."""
    rng = np.random.default_rng(7)
    water = W.Bucket.full(np.array([100.0, 20.0, 0.0, 350.0]))
    for _ in range(400):
        ppt, pet, melt = rng.gamma(1, 60, 4), rng.uniform(0, 120, 4), rng.uniform(size=4)
        before = water.soil + water.snow
        month = water.step(ppt, pet, melt)
        assert all((v >= -1e-9).all() for v in month.values()) and (month["soil"] <= water.capacity + 1e-9).all()
        assert month["aet"] + month["def"] == pytest.approx(pet)
        assert before + ppt == pytest.approx(water.soil + water.snow + month["aet"] + month["q"])


def test_bucket_by_hand():
    """100 mm of soil; dry month: (1 - exp(-1)) of the unmet 50 mm; cold month: all falls as snow, which then serves the demand first."""
    water = W.Bucket.full(np.array([100.0]))
    month = water.step(np.array([0.0]), np.array([50.0]), np.array([1.0]))
    assert month["aet"][0] == pytest.approx(50 * (1 - np.exp(-1))) and month["q"][0] == 0
    water = W.Bucket.full(np.array([100.0]))
    month = water.step(np.array([30.0]), np.array([30.0]), np.array([0.0]))
    assert (month["aet"][0], month["def"][0], month["soil"][0], month["swe"][0]) == (30, 0, 100, 0)
    month = water.step(np.array([40.0]), np.array([10.0]), np.array([1.0]))
    assert (month["aet"][0], month["q"][0], month["soil"][0]) == (10, 2 + 28, 100)


def test_severity_by_hand():
    """Months of Palmer's index worked by hand: onset, an established drought, its end and the look back."""
    got = W.severity(np.array([-3.0, -3.0, -3.0]))
    assert got == pytest.approx([-1.0, -1.897, -0.897 * 1.897 - 1])
    # A drought of -1 needs 2.691 * 1 - 1.5 = 1.191 to end: 0.5 + 0.15 does not do it, so the month stays open and, as it goes on, dry.
    got = W.severity(np.array([-3.0, 0.5, -3.0]))
    assert got == pytest.approx([-1.0, -0.897 + 0.5 / 3, 0.897 * (-0.897 + 0.5 / 3) - 1])
    # 3 does: the month then starts a wet spell; the month before the drought's end that had been open turns wet with it.
    got = W.severity(np.array([-3.0, 0.5, 3.0]))
    assert got == pytest.approx([-1.0, 0.5 / 3, 0.897 * 0.5 / 3 + 1])
    assert (W.severity(np.full(40, 0.01)) >= 0).all()
    z = np.random.default_rng(0).normal(0, 2, 600)
    assert W.severity(z) == pytest.approx(-W.severity(-z))


def test_drought_follows_rain():
    months = 12 * 40
    rng = np.random.default_rng(3)
    ppt = rng.gamma(4, 15, months)
    ppt[240:300] *= 0.2
    pet = 50 + 30 * np.sin(np.arange(months) * 2 * np.pi / 12)
    years, month = 1965 + np.arange(months) // 12, np.arange(months) % 12 + 1
    got = W.pdsi(ppt[:, None], pet[:, None], np.array([120.0]), years, month)[:, 0]
    assert len(got) == months and np.abs(got).max() <= 16 and got[270:300].mean() < -2 < got[:200].mean()
    with pytest.raises(ValueError):
        W.pdsi(ppt[:100, None], pet[:100, None], np.array([120.0]), years[:100], month[:100])


# ---------------------------------------------------------------- catalogues and sinks


def test_catalogue(spark):
    df = spark.createDataFrame([("a", "v1", "1.2.0"), ("a", "v1", "1.10.0"), ("b", "v2", "0.1+dirty")], "source_id string, zstore string, version string")
    assert catalog.exactly_one(catalog.search(df, source_id="b")) == "v2"
    for facets in ({"source_id": "a"}, {"source_id": "c"}):
        with pytest.raises(ValueError):
            catalog.exactly_one(catalog.search(df, **facets))
    assert {r.version for r in catalog.latest(df, ["source_id"]).collect()} == {"1.10.0", "0.1+dirty"}
    assert catalog.filter_versions(df, "1.3", None, True).count() == 1
    licences = spark.createDataFrame([("a", "CC0-1.0"), ("b", "CC-BY-SA-4.0")], "source_id string, license string")
    assert {r.license for r in catalog.with_license(df, licences, True).collect()} == {"CC-BY-4.0", "CC-BY-SA-4.0"}


def test_cache_and_regions(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.createDataFrame([(1, 2.0), (2, 3.0)], "region int, pr double")

    for _ in range(2):
        assert sinks.cached(spark, str(tmp_path), "step", ["a", "b"], build).count() == 2
    assert len(built) == 1
    path = sinks.write(build(), str(tmp_path / "r"), ["region"], check=True)
    sinks.write_regions(spark.createDataFrame([(2, 9.0)], "region int, pr double"), path, "region")
    assert {(r.region, r.pr) for r in spark.read.parquet(path).collect()} == {(1, 2.0), (2, 9.0)}
    assert sinks.copy_store(spark, path, str(tmp_path / "c"), {"pr": "rain"}) and not sinks.copy_store(spark, path, str(tmp_path / "c"))


def test_missing_values_become_null(spark, tmp_path):
    spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "pr double, k int").write.parquet(str(tmp_path / "n"))
    assert readers.scan(spark, str(tmp_path / "n")).filter("pr IS NULL").count() == 1


def test_run_record(spark, tmp_path):
    import json

    from terrafield.params import RunParameters

    path = sinks.finalize(spark, str(tmp_path), RunParameters("bcsd", "pr"), daily="x")
    assert json.loads(open(path).read())["datasets"] == {"daily": "x"}


def test_severities_of_many_cells_are_those_of_each():
    rng = np.random.default_rng(4)
    scale = rng.choice([0.3, 1, 3, 6], 300)
    z = rng.normal(size=(150, 300)) * scale + rng.choice([-0.5, 0, 0.5], 300)
    z[:, :20] = np.repeat(z[::10, :20], 10, axis=0)
    got = W.severities(z)
    for c in range(z.shape[1]):
        assert got[:, c] == pytest.approx(W.severity(z[:, c]))


def test_soil_of_many_cells_is_that_of_each():
    """Palmer's two layers, a cell and a month at a time in plain numbers."""
    rng = np.random.default_rng(1)
    ppt, pet, awc = rng.gamma(1, 3, (60, 40)), rng.gamma(2, 1, (60, 40)), rng.choice([0.5, 1.0, 4.0, 9.0], 40)
    got = W.soil_terms(ppt, pet, awc)
    for c in range(40):
        size, upper, lower = max(awc[c] - 1, 0), 1.0, max(awc[c] - 1, 0)
        for i in range(60):
            want = {"pr": 1 + size - upper - lower, "pro": upper + lower}
            first = min(pet[i, c], upper)
            want["pl"] = first + min((pet[i, c] - first) * lower / (1 + size), lower)
            left = ppt[i, c] - pet[i, c]
            if left >= 0:
                a = min(left, 1 - upper)
                b = min(left - a, size - lower)
                want |= {"r": a + b, "ro": left - a - b, "l": 0.0, "et": pet[i, c]}
                upper, lower = upper + a, lower + b
            else:
                a = min(upper, -left)
                b = min((-left - a) * lower / (1 + size), lower)
                want |= {"r": 0.0, "ro": 0.0, "l": a + b, "et": ppt[i, c] + a + b}
                upper, lower = upper - a, lower - b
            assert {k: got[k][i, c] for k in want} == pytest.approx(want)
