"""Grids that are wider than the test tables', by hand."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from terrafield.functions import hydrology as H
from terrafield.operators import grid as G
from terrafield.sources import readers


def test_evapotranspiration_under_a_dark_sky(spark):
    """latitudes without clear-sky radiation, where a share of it would divide by zero."""
    rows = spark.createDataFrame([(lat, m) for lat in (40.0, 80.0, 112.0, 135.0) for m in range(1, 13)], "lat double, m int")
    d = lambda x: F.lit(float(x))
    pet = H.penman_monteith(d(18), d(6), d(10), d(3), d(3), d(12), F.col("lat"), d(100), F.col("m"))
    found = rows.select("lat", "m", pet.alias("pet")).collect()
    assert all(r.pet is not None and math.isfinite(r.pet) for r in found)
    dark = {r.m: r.pet for r in found if r.lat == 112.0}
    # Under a dark sky the share is one, as it is where the sun does not set at all.
    assert dark[6] == next(r.pet for r in found if r.lat == 135.0 and r.m == 6)


def test_latitudes_past_a_pole(spark):
    """areas go on as the sines do; a cell evenly over a pole weighs nothing, and a mean of it alone is no number."""
    w = G.overlap_axis_weights([84.0, 87.0, 90.0, 93.0, 96.0, 99.0], [85.5, 91.5, 97.5], True)
    assert [(i, k) for i, k, _ in w] == [(0, 0), (0, 1), (1, 2), (1, 3), (2, 4), (2, 5)]
    assert w[2][2] == 0 and w[3][2] == 1
    area = lambda lat: math.sin(math.radians(lat + 1.5)) - math.sin(math.radians(lat - 1.5))
    assert math.isclose(w[4][2], area(96) / (area(96) + area(99)), rel_tol=1e-12)
    rows = spark.createDataFrame([(0, 2, 0, 5.0), (1, 2, 0, 5.0), (1, 3, 0, 7.0), (2, 3, 0, None)], "time int, lat_i int, lon_i int, pr double")
    out = {r.time: r.pr for r in G.regrid(rows, G.weights(spark, w, [(0, 0, 1.0)]), ["pr"]).collect()}
    assert math.isnan(out[0]) and out[1] == 7.0 and out[2] is None
    assert G.overlap_axis_weights([-90.0, 0.0, 90.0], [-90.0], True) == [(0, 0, 1.0)]


def test_batches_are_whole(spark):
    """all batches but the last have their size, however many ranges are numbered side by side."""
    rows = spark.range(1503).select("id", F.array(F.col("id").cast("double")).alias("patch"))
    found = readers.shuffled_batches(rows, 5, 3).orderBy("batch", "shuffle").collect()
    sizes = {}
    for r in found:
        sizes[r.batch] = sizes.get(r.batch, 0) + 1
    assert [sizes[b] for b in range(301)] == [5] * 300 + [3] and sorted(r.id for r in found) == list(range(1503))


def test_tasks_grow_with_the_table(spark, monkeypatch):
    """A task groups so many rows of a table, and not a share of it; means of blocks go to as many."""
    from terrafield.sources import cube

    rows = spark.range(4000)
    day = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("id") % 50).cast("int"))
    line = rows.select((F.col("id") % 10).alias("l_suppkey"), day.cast("timestamp").alias("l_shipdate"), F.lit(1.0).alias("l_quantity"), F.lit(2.0).alias("l_extendedprice"))
    order = rows.select((F.col("id") % 10).alias("o_custkey"), day.cast("timestamp").alias("o_orderdate"), F.lit(1.0).alias("o_totalprice"))
    tables = {"lineitem": line, "orders": order, "supplier": spark.range(10).select(F.col("id").alias("s_suppkey"))}
    monkeypatch.setattr(cube, "table", lambda spark, sf, name: tables[name])
    monkeypatch.setattr(cube, "TASK_ROWS", 100)
    parts = [cube.obs(spark, "made up"), cube.obs(spark, "made up", cube.CELL), cube.gcm(spark, "made up")]
    assert [p.rdd.getNumPartitions() for p in parts] == [40, 40, 40]
    assert [p.agg(F.sum("pr")).first()[0] for p in parts] == [4000.0] * 3
    coarse = G.coarsen(parts[0], 2, ["pr"], tasks=23)
    assert coarse.rdd.getNumPartitions() == 23
    assert sorted(coarse.collect()) == sorted(G.coarsen(parts[0], 2, ["pr"]).collect())


def test_maps_pass_one_by_one(spark):
    """fine maps leave a task one by one, and bands of a map are convolved as the whole is."""
    import numpy as np

    from terrafield.operators import models as M

    rng = np.random.default_rng(1)
    layers = [(rng.normal(size=(9, 9, 2, 3)), np.zeros(3)), (rng.normal(size=(5, 5, 3, 1)), np.ones(1))]
    images, height = rng.normal(size=(6, 70, 3)), rng.normal(size=(140, 6))
    rows = spark.createDataFrame([(k, m.tolist()) for k, m in enumerate(images)], "time int, field array<array<double>>").coalesce(1)
    found = M.super_resolve(rows, [height], [layers])
    assert "MapInArrow" in found._jdf.queryExecution().toString()
    got = {r.time: np.array(r.field) for r in found.collect()}
    for k, image in enumerate(images):
        x = np.stack([M.upsample2(image), height], axis=-1)
        for n, (kernel, bias) in enumerate(layers):
            h = kernel.shape[0] // 2
            padded = np.pad(x, ((h, h), (h, h), (0, 0)))
            x = sum(padded[i : i + 140, j : j + 6] @ kernel[i, j] for i in range(2 * h + 1) for j in range(2 * h + 1)) + bias
            x = np.maximum(x, 0) if n == 0 else x
        assert np.allclose(got[k], x[..., 0], rtol=1e-10)


def _fields(spark, shape, days, seed, gaps=True):
    """Days' fields with cells left out, and one value each that is null, no number and infinite; as rows and as they are."""
    import numpy as np

    rng = np.random.default_rng(seed)
    rows = [(t, i, k, float(rng.normal())) for t in range(days) for i in range(shape[0]) for k in range(shape[1]) if rng.random() < 0.7]
    if gaps:
        rows[3], rows[40], rows[90] = ((*rows[n][:3], x) for n, x in ((3, None), (40, math.nan), (90, math.inf)))
    day = F.date_add(F.lit("1995-01-01").cast("date"), F.col("t"))
    return spark.createDataFrame(rows, "t int, lat_i int, lon_i int, pr double").select(day.alias("time"), "lat_i", "lon_i", "pr")


def _same(a, b):
    return a == b or (a is not None and b is not None and (math.isnan(a) and math.isnan(b) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)))


def test_fields_are_weighed_without_rows_of_pairs(spark):
    """No row is made of a source and a target cell; results are those of the join."""
    lin = G.linear_axis_weights([2 * i + 0.5 for i in range(5)], list(range(10)))
    table, df = G.weights(spark, lin, lin), _fields(spark, (5, 5), 6, 1)
    for renormalise in (True, False):
        out, joined = (G.regrid(df, table, ["pr"], renormalise=renormalise, small=small) for small in (None, False))
        assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString() and out.schema == joined.schema
        a, b = ({(r.time, r.lat_i, r.lon_i): r.pr for r in x.collect()} for x in (out, joined))
        assert a.keys() == b.keys() and len(a) > 500 and all(_same(a[k], b[k]) for k in b)


def test_tiles_see_what_regridding_gives(spark):
    """Series of a tile are those of the regridded tables, whatever the size of tiles and their edges."""
    import numpy as np

    lin = G.linear_axis_weights([2 * i + 0.5 for i in range(5)], list(range(10)))
    table, df, fine = G.weights(spark, lin, lin), _fields(spark, (5, 5), 6, 1), _fields(spark, (12, 10), 4, 2, False)

    def both(tables):
        (days, x, has), (own, y, seen) = tables
        a, b = np.nonzero(has), np.nonzero(seen)
        where = [np.concatenate([p, q]) for p, q in zip(a, b)]
        return np.concatenate([days[a[0]], own[b[0]]]), where[1], [np.concatenate([x[a], np.full(len(b[0]), np.nan)]), np.concatenate([np.full(len(a[0]), np.nan), y[b]])]

    want = {(r.time, r.lat_i, r.lon_i): r.pr for r in G.regrid(df, table, ["pr"]).collect() if r.pr is not None}
    own = {(r.time, r.lat_i, r.lon_i): r.pr for r in fine.collect() if r.lat_i < 10}
    for tile in (3, 16):
        rows = G.on_tiles([df], [fine], table, "pr", both, ["x", "y"], tile=tile).collect()
        assert len(rows) == len(want) + len(own)
        got = {(r.time, r.lat_i, r.lon_i): r.y for r in rows if not math.isnan(r.y)}
        assert got == own
        seen = [r for r in rows if math.isnan(r.y)]
        assert all(_same(want[r.time, r.lat_i, r.lon_i], r.x) for r in seen)


def test_a_field_by_formula_needs_no_join(spark):
    """F8: the random field of GARD is added to rows where they are; a table of it, of few partitions, is not made and joined."""
    from terrafield.plans.catalog import QUERIES

    plan = QUERIES["m13_gard_end_to_end"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "field" in plan and "CoGroupsInArrow" in plan
    assert plan.split("CoGroupsInArrow")[0].count("Join") == 0


def test_steps_read_patches_where_they_lie(spark, tmp_path, monkeypatch):
    """one shard is kept as it was written, by many tasks; a large shard has several files; sums are those of all patches."""
    import os
    import uuid

    import numpy as np

    from terrafield.operators import training as T
    from terrafield.sources import scratch as S

    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(400, 8)).astype("float32"), rng.normal(size=(400, 4)).astype("float32")
    rows = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(x, y)], "image array<float>, label array<float>").repartition(6)
    places = {}
    keep = lambda spark, name: places.setdefault(name, f"file://{tmp_path}/{name}-{uuid.uuid4().hex}")
    monkeypatch.setattr(T, "scratch", keep)
    monkeypatch.setattr(S, "scratch", keep)
    layers = [(np.zeros((1, 1, 2, 1)), np.zeros(1))]
    files = lambda path: [f for f in os.listdir(path.removeprefix("file://")) if f.endswith(".parquet")]
    done = T.train(rows, f"file://{tmp_path}/one", layers, 2, batch=1 << 60, every=5)
    assert "training-shards" not in places and len(files(places["training-patches"])) == 6
    assert done.losses[0] == np.mean(y.astype(float) ** 2) or abs(done.losses[0] - np.mean(y.astype(float) ** 2)) < 1e-9
    monkeypatch.setattr(T, "FILE_PATCHES", 50)
    places.clear()
    two = T.train(rows, f"file://{tmp_path}/two", layers, 2, batch=200, every=5)
    found = {d: len(files(f"{places['training-shards']}/{d}")) for d in ("shard=0", "shard=1")}
    assert min(found.values()) > 1 and spark.read.parquet(places["training-shards"]).count() == 400 and len(two.losses) == 2


def test_variograms_send_no_row_for_each_lag(spark):
    """each row looks ahead along its axis, duplicates, nulls and gaps included; there is no join."""
    from terrafield.operators import aggregate as A

    rows = [(0, 1, 1.0), (0, 2, 3.0), (0, 2, 4.0), (0, 4, None), (0, 5, 7.0), (1, 1, 2.0), (1, 9, 5.0), (None, 1, 1.0), (None, 2, 9.0), (1, None, 3.0)]
    df = spark.createDataFrame(rows, "k int, x int, v double")
    out = A.variogram(df, "v", "x", 3, ["k"])
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    want: dict[int, list] = {}
    for k, x, v in rows:
        for k2, x2, v2 in rows:
            if k is not None and k == k2 and x is not None and x2 is not None and 1 <= x2 - x <= 3:
                want.setdefault(x2 - x, []).append(None if v is None or v2 is None else (v - v2) ** 2)
    got = {r.lag: (r.gamma, r.n) for r in out.collect()}
    known = {lag: [x for x in d if x is not None] for lag, d in want.items()}
    assert got == {lag: (sum(known[lag]) / len(known[lag]) / 2 if known[lag] else None, len(d)) for lag, d in want.items()}


def _analog_tables(spark):
    """A model's days, coarse and fine observations with gaps, of two Decembers and some days of January, and the weights between both grids."""
    near = [G.linear_axis_weights([2 * i + 0.5 for i in range(3)], list(range(6)))] * 2
    lap = [G.overlap_axis_weights(list(range(6)), [2 * i + 0.5 for i in range(3)], False)] * 2
    fine, model = _fields(spark, (6, 6), 40, 3, False), _fields(spark, (3, 3), 60, 4, False)
    return model, fine, G.weights(spark, *lap), G.weights(spark, *near)


def test_analogs_make_no_row_of_day_analog_and_cell(spark):
    """fine fields are summed tile by tile, without a join of days and analogs; results are those of the joins."""
    from terrafield.operators import models as M

    model, fine, to_coarse, to_fine = _analog_tables(spark)
    fine = fine.filter("NOT (lat_i = 1 AND lon_i = 2)")
    coarse = G.regrid(fine, to_coarse, ["pr"])
    out = M.construct_analogs(model, coarse, fine, to_fine, "pr", 3, 20)
    assert "obs_day#" not in out._jdf.queryExecution().optimizedPlan().toString() and out.columns == ["time", "lat_i", "lon_i", "pr"]
    one = lambda df: df.withColumn("region_id", F.lit(0))
    joined = M.construct_analogs(one(model), one(coarse), one(fine), to_fine, "pr", 3, 20, by=["region_id"])
    a, b = ({(r.time, r.lat_i, r.lon_i): r.pr for r in x.collect()} for x in (out, joined))
    assert a.keys() == b.keys() and len(a) > 500 and all(_same(a[k], b[k]) for k in b)
    # A model day with fewer analogs than asked for, and observations that no day may use.
    few = fine.filter("time < '1995-01-03'")
    some = M.construct_analogs(model, G.regrid(few, to_coarse, ["pr"]), few, to_fine, "pr", 3, 20)
    joined = M.construct_analogs(one(model), one(G.regrid(few, to_coarse, ["pr"])), one(few), to_fine, "pr", 3, 20, by=["region_id"])
    a, b = ({(r.time, r.lat_i, r.lon_i): r.pr for r in x.collect()} for x in (some, joined))
    assert a.keys() == b.keys() and len(a) > 10 and all(_same(a[k], b[k]) for k in b)
    none = M.construct_analogs(model, G.regrid(few.filter("false"), to_coarse, ["pr"]), few.filter("false"), to_fine, "pr", 3, 20)
    assert none.count() == 0


def test_maca_shuffles_no_fine_row_but_observations(spark):
    """analogs, trend and last correction are taken tile by tile; results are those of the joins, which one region of all cells takes."""
    from terrafield.operators import downscale as D

    model, fine, to_coarse, to_fine = _analog_tables(spark)
    model, fine = (df.withColumn("pr", F.abs("pr") + 1) for df in (model, fine))
    cells = [spark.range(n * n).select((F.col("id") / n).cast("int").alias("lat_i"), (F.col("id") % n).cast("int").alias("lon_i"), F.lit(0).alias("region_id"), F.lit(n == 3).alias("coarse")) for n in (3, 6)]
    run = lambda regions: D.maca(fine, model, F.col("time") < "1995-01-31", F.col("time") >= "1995-01-21", to_coarse, to_fine, "pr", 3, 20, 5, 3, regions)
    out, joined = run(None), run(cells[0].union(cells[1]))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroupsInArrow" in plan and "FlatMapGroupsInPandas" not in plan and out.columns == joined.columns
    a, b = ({(r.time, r.lat_i, r.lon_i): r.pr for r in x.collect()} for x in (out, joined))
    assert a.keys() == b.keys() and len(a) > 50 and all(_same(a[k], b[k]) for k in b)
    assert min(k[0] for k in a).isoformat() >= "1995-01-21"


def test_fine_maps_are_corrected_by_tiles(spark):
    """fine maps leave the network once, as tiles; results are those of maps, cells, moments and corrections one after the other."""
    import numpy as np

    from terrafield.operators import aggregate as A
    from terrafield.operators import downscale as D
    from terrafield.operators import models as M

    rng = np.random.default_rng(6)
    network = [[(rng.normal(size=(3, 3, 2, 2)), rng.normal(size=2)), (rng.normal(size=(3, 3, 2, 1)), np.ones(1))]]
    model = _fields(spark, (9, 10), 12, 7).filter("NOT (time = '1995-01-03' AND lat_i = 4)").filter("NOT isnan(pr) AND abs(pr) < 1e9")
    hist = _fields(spark, (9, 10), 9, 8, False)
    # Observations lack a cell and have one beyond the grid.
    obs = _fields(spark, (18, 21), 8, 9, False).filter("NOT (lat_i = 3 AND lon_i = 17)")
    height = rng.normal(size=(18, 20))
    out = D.deepsd(model, hist, obs, None, "pr", None, network, [height])
    assert "MapInArrow" not in out._jdf.queryExecution().optimizedPlan().toString()
    scores = A.z_score_against(model, hist, "pr")
    maps = M.super_resolve(D.maps_of(scores, "pr", 9, 10), [(height - height.mean()) / (height.std() + 1e-6)], network)
    back = A.rescale(D.cells_of(maps, "pr"), obs, "pr", floor=0.0)
    want = {(r.time, r.lat_i, r.lon_i): r.pr for r in M.bias_correct(back, obs, back, "pr", "quantile_mapper").collect()}
    got = {(r.time, r.lat_i, r.lon_i): r.pr for r in out.collect()}
    assert got.keys() == want.keys() and len(got) == 11 * (18 * 20 - 1) and all(_same(got[k], want[k]) for k in want)


def test_fields_and_pixels_are_dealt_by_number(spark):
    """What a task holds of fields and pixels follows the number of tasks, and not how well rows pack; results stay."""
    lin = G.linear_axis_weights([2 * i + 0.5 for i in range(5)], list(range(10)))
    edges = [float(i) for i in range(5)]
    df, table = _fields(spark, (5, 5), 6, 1, False), G.weights(spark, lin, lin)
    for step, parts in (
        (lambda n: G.regrid(df, table, ["pr"], tasks=n), 23),
        (lambda n: G.shift_to_centres(df, edges, edges, ["pr"], 1.0, tasks=n), 23),
        (lambda n: G.coarsen_and_interpolate(df, 2, 5, 5, ["pr"], tasks=n), 23),
        (lambda n: G.pyramid(df, 3, "pr", tasks=n), 69),
    ):
        dealt, plain = step(23), step(None)
        assert dealt.rdd.getNumPartitions() == parts
        order = [c for c in dealt.columns if c != "pr"]
        a, b = ({tuple(r[c] for c in order): r.pr for r in x.collect()} for x in (dealt, plain))
        assert a.keys() == b.keys() and len(a) > 80 and all(_same(a[k], b[k]) for k in b)
