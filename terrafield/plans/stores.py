"""Queries of stores, catalogues, polygons, subsets and reports."""

from __future__ import annotations

import json

from pyspark.sql import Row
from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import grid as G
from ..operators import select as X
from ..params import make_run_parameters, str_to_hash
from ..sources import catalog, chunks, netcdf, readers, records, sinks, transfer
from ..sources.cube import CELLS, GCM, OBS, WIDTH, cells, gcm, grid_width, obs, table, tasks
from ..sources.scratch import scratch, written
from .registry import query, r6

CELL = A.CELL


@query("s01_store_scan", f"WITH {OBS} SELECT time, lat_i * 0.5::DOUBLE AS lat, CASE WHEN pr <> 7 THEN pr END AS pr FROM obs WHERE lat_i BETWEEN 3 AND 5")
def _(spark, sf):
    rows = obs(spark, sf).select("time", (F.col("lat_i") * F.lit(0.5)).alias("lat"), F.when(F.col("pr") != 7, F.col("pr")).otherwise(float("nan")).alias("pr"))
    return readers.scan(spark, sinks.write(rows, scratch(spark, "scan"))).filter(F.col("lat").between(1.5, 2.5))


@query("s09_polygons", "SELECT * FROM (VALUES (1, 5), (2, 4), (3, 5), (3, 4)) AS t(region_id, corners)")
def _(spark, sf):
    return readers.read_polygons(spark, _polygons(spark)).select("region_id", F.size("ring").alias("corners"))


def _polygons(spark) -> str:
    """Four rings as a GeoJSON file: two boxes (one of a multi-polygon) and two triangles."""
    box = lambda x0, y0, x1, y1: [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]
    triangle = lambda *p: [list(p[0:2]), list(p[2:4]), list(p[4:6]), list(p[0:2])]
    shapes = [(1, "Polygon", [box(-0.5, -0.5, 3.5, 2.5)]), (2, "Polygon", [triangle(3.5, 2.5, 9.5, 2.5, 3.5, 8.5)]), (3, "MultiPolygon", [[box(-0.5, 4.5, 1.5, 6.5)], [triangle(5.5, -0.5, 9.5, -0.5, 9.5, 1.25)]])]
    document = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"region_id": str(k)}, "geometry": {"type": kind, "coordinates": c}} for k, kind, c in shapes]}
    path = scratch(spark, "polygons")
    spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.text(path)
    return path


@query(
    "p10_polygon_regions",
    f"""WITH {CELLS} SELECT cell, 1 AS region_id FROM cells WHERE lon_i BETWEEN 0 AND 3 AND lat_i BETWEEN 0 AND 2 UNION ALL SELECT cell, 2 FROM cells WHERE lon_i > 3 AND lat_i > 2 AND (lon_i - 3.5) + (lat_i - 2.5) < 6
    UNION ALL SELECT cell, 3 FROM cells WHERE lon_i BETWEEN 0 AND 1 AND lat_i BETWEEN 5 AND 6 UNION ALL SELECT cell, 3 FROM cells WHERE lon_i < 9.5 AND lat_i > -0.5 AND lat_i < -0.5 + (lon_i - 5.5) * 1.75 / 4""",
)
def _(spark, sf):
    return X.regions_of(cells(spark, sf).select("cell", "lat_i", "lon_i"), readers.read_polygons(spark, _polygons(spark)), "lat_i", "lon_i").select("cell", "region_id")


@query("s09_holes", f"WITH {CELLS} SELECT cell, 1 AS region_id FROM cells WHERE lon_i <= 6 AND lat_i <= 7 AND NOT (lon_i BETWEEN 2 AND 3 AND lat_i BETWEEN 1 AND 4) AND NOT (lon_i = 5 AND lat_i BETWEEN 5 AND 6)")
def _(spark, sf):
    """Cells within a box with two holes, read from a GeoJSON file."""
    box = lambda x0, y0, x1, y1: [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]
    rings = [box(-0.5, -0.5, 6.5, 7.5), box(1.5, 0.5, 3.5, 4.5)[::-1], box(4.5, 4.5, 5.5, 6.5)[::-1]]
    document = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"region_id": "1"}, "geometry": {"type": "Polygon", "coordinates": rings}}]}
    path = scratch(spark, "holes")
    spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.text(path)
    return X.regions_of(cells(spark, sf).select("cell", "lat_i", "lon_i"), readers.read_polygons(spark, path), "lat_i", "lon_i").select("cell", "region_id")


@query("s12_elevation_by_resolution", f"WITH {CELLS} SELECT lat_i AS lat, lon_i AS lon, elev FROM cells")
def _(spark, sf):
    root = scratch(spark, "elevation")
    sinks.write(cells(spark, sf).select(F.col("lat_i").alias("lat"), F.col("lon_i").alias("lon"), "elev"), f"{root}/elevation_0.5deg")
    return readers.elevation(spark, root, 0.5)


@query("s13_store_probes", "SELECT * FROM (VALUES ('empty', true, false), ('missing', false, false), ('partial', false, false), ('whole', true, true)) AS t(store, complete, opens)")
def _(spark, sf):
    root, rows = scratch(spark, "probes"), table(spark, sf, "region")
    for name in ("whole", "partial"):
        sinks.write(rows, f"{root}/{name}")
    sinks.write(rows.limit(0), f"{root}/empty")
    sinks.remove(spark, f"{root}/partial/_SUCCESS")
    return spark.createDataFrame([(s, sinks.is_complete(spark, f"{root}/{s}"), sinks.opens(spark, f"{root}/{s}")) for s in ("empty", "missing", "partial", "whole")], "store string, complete boolean, opens boolean")


@query("p17_valid_stores", "SELECT 'whole' AS source_id")
def _(spark, sf):
    root = scratch(spark, "stores")
    sinks.write(table(spark, sf, "region"), f"{root}/whole")
    listed = spark.createDataFrame([(s, f"{root}/{s}") for s in ("whole", "missing")], "source_id string, zstore string")
    return sinks.valid_stores(listed).select("source_id")


@query("s04_open_model", f"WITH {GCM} SELECT time, lat_i, lon_i, pr * 86400 AS pr FROM gcm WHERE year(time) = 1996")
def _(spark, sf):
    root, g = scratch(spark, "models"), gcm(spark, sf).filter("year(time) = 1996")
    sinks.write(g, f"{root}/a")
    listed = spark.createDataFrame([("CMIP", "m", "historical", f"{root}/a"), ("ScenarioMIP", "m", "ssp245", f"{root}/b")], "activity_id string, source_id string, experiment_id string, zstore string")
    return catalog.open_model(listed, {"pr": 86400.0}, source_id="m", experiment_id="historical")


@query("k02_cached_step", "SELECT r_regionkey, r_name, 1 AS built FROM region")
def _(spark, sf):
    root, built = scratch(spark, "cached"), []

    def build():
        built.append(1)
        return table(spark, sf, "region").select("r_regionkey", "r_name")

    for _ in range(2):
        out = sinks.cached(spark, root, "regions", ["a", "b"], build)
    return out.withColumn("built", F.lit(len(built)))


@query("k05_compression", "SELECT r_regionkey, r_name FROM region")
def _(spark, sf):
    rows = table(spark, sf, "region").select("r_regionkey", "r_name")
    return spark.read.parquet(sinks.write(rows, scratch(spark, "packed"), compression="gzip", check=True))


@query("k07_run_record", "SELECT 'complete' AS status, 'maca' AS method, '/out' AS output")
def _(spark, sf):
    run = make_run_parameters(method="maca", variable="pr")
    path = sinks.finalize(spark, scratch(spark, "runs"), run, output="/out")
    return readers.read_json(spark, path, "status string, parameters struct<method: string>, datasets struct<output: string>").select("status", "parameters.method", "datasets.output")


_DATASETS = "SELECT p_brand AS source_id, p_type AS method, count(*) AS n FROM part GROUP BY ALL"


def _published(spark, sf) -> str:
    rows = table(spark, sf, "part").groupBy(F.col("p_brand").alias("source_id"), F.col("p_type").alias("method")).agg(F.count("*").alias("n")).withColumn("note", F.lit("x"))
    return sinks.publish_catalog(rows, scratch(spark, "catalog"), "parts", ["source_id", "method", "n"])


@query("k08_catalog_json", f"SELECT 'parts' AS name, * FROM ({_DATASETS})")
def _(spark, sf):
    document = readers.read_json(spark, f"{_published(spark, sf)}/json", "name string, version string, datasets array<struct<source_id: string, method: string, n: bigint>>", multi_line=False)
    return document.select("name", F.inline("datasets"))


@query("k08_catalog_csv", _DATASETS)
def _(spark, sf):
    return readers.read_csv(spark, f"{_published(spark, sf)}/csv", "source_id string, method string, n bigint")


@query("k09_attributes", "SELECT * FROM (VALUES ('r_name', 'none'), ('r_regionkey', '1')) AS t(name, units)")
def _(spark, sf):
    rows = table(spark, sf, "region").select("r_regionkey", "r_name")
    source = rows.select(F.col("r_regionkey").alias("r_regionkey", metadata={"units": "1"}), F.col("r_name").alias("r_name", metadata={"units": "none"}))
    kept = spark.read.parquet(sinks.write(sinks.copy_attributes(rows, source), scratch(spark, "attributes")))
    return spark.createDataFrame([Row(name=f.name, units=f.metadata["units"]) for f in kept.schema.fields], "name string, units string")


_PATCHES = f"""WITH {CELLS}, n AS (SELECT {WIDTH} AS w), o AS (SELECT unnest(range(0, w - 3, 2)) AS k, w FROM n), a AS (SELECT y.k AS y0, x.k AS x0 FROM o y, o x),
p AS (SELECT y0, x0, count(*) AS n, sum(elev::FLOAT::DOUBLE) AS total FROM a JOIN cells c ON c.lat_i >= y0 AND c.lat_i < y0 + 4 AND c.lon_i >= x0 AND c.lon_i < x0 + 4 GROUP BY y0, x0)"""


@query("k10_patch_files", f"{_PATCHES} SELECT y0::INT AS y0, x0::INT AS x0, round(total, 3) AS total FROM p WHERE n = 16")
def _(spark, sf):
    path = _patch_files(spark, sf)
    total = F.aggregate("patch", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return spark.read.parquet(path).select("y0", "x0", F.round(total, 3).alias("total"))


def _patch_files(spark, sf) -> str:
    w = grid_width(spark, sf)
    rows = cells(spark, sf).select(*CELL, "elev", F.lit(0).alias("step"))
    return sinks.write_patches(G.patches(rows, "elev", 4, 2, w, w, ["step"]).drop("step"), scratch(spark, "patches"))


@query("s17_shuffled_batches", f"{_PATCHES}, c AS (SELECT count(*) AS k FROM p WHERE n = 16) SELECT least(5, k - 5 * b) AS n FROM c, (SELECT unnest(range(0, 1000)) AS b) WHERE 5 * b < k")
def _(spark, sf):
    return readers.read_batches(spark, _patch_files(spark, sf), 5, 3).groupBy("batch").agg(F.count("*").alias("n")).select("n")


def _record_files(spark, sf) -> str:
    """The patches as record files, from the Parquet store of them."""
    path = scratch(spark, "records")
    records.write_examples(spark.read.parquet(_patch_files(spark, sf)).repartition(3), path)
    return path


_EXAMPLE = "y0 int, x0 int, patch array<float>"


@query("k10_record_files", f"{_PATCHES} SELECT y0::INT AS y0, x0::INT AS x0, round(total, 3) AS total FROM p WHERE n = 16")
def _(spark, sf):
    rows = records.read_examples(spark, _record_files(spark, sf), _EXAMPLE)
    return rows.select("y0", "x0", F.round(F.aggregate("patch", F.lit(0.0), lambda a, x: a + x.cast("double")), 3).alias("total"))


@query("s17_record_batches", f"{_PATCHES}, c AS (SELECT count(*) AS k FROM p WHERE n = 16) SELECT least(5, k - 5 * b) AS n FROM c, (SELECT unnest(range(0, 1000)) AS b) WHERE 5 * b < k")
def _(spark, sf):
    rows = written(records.read_examples(spark, _record_files(spark, sf), _EXAMPLE, 4096), "examples")
    return readers.shuffled_batches(rows, 5, 3).groupBy("batch").agg(F.count("*").alias("n")).select("n")


@query("k06_netcdf", f"WITH {OBS} SELECT time, lat_i, lon_i, pr, tasmax FROM obs WHERE lat_i BETWEEN 2 AND 5 AND year(time) = 1996")
def _(spark, sf):
    """A region as one classic file, written side by side by tasks, and read back."""
    path = f"{scratch(spark, 'export')}.nc"
    rows = obs(spark, sf).filter("lat_i BETWEEN 2 AND 5 AND year(time) = 1996").select("time", *CELL, "pr", "tasmax")
    netcdf.write_netcdf(rows, path, ["time", *CELL], ["pr", "tasmax"])
    return netcdf.read_netcdf(spark, path, ["pr", "tasmax"]).filter("pr IS NOT NULL")


@query("s15_raw_copy", "SELECT o_orderstatus, count(*) AS n, 2::BIGINT AS runs, 1::BIGINT AS again FROM orders GROUP BY o_orderstatus")
def _(spark, sf):
    """A store copied as bytes, one file of the copy broken, and copied again: only that file is."""
    root = scratch(spark, "transfer")
    sinks.write(table(spark, sf, "orders"), f"{root}/a", ["o_orderstatus"])
    transfer.copy_files(spark, f"{root}/a", f"{root}/b", f"{root}/manifest")
    broken = transfer.crawl(spark, f"{root}/b").filter("path LIKE '%/part-%.parquet'").agg(F.min("path")).first()[0]
    chunks.put_bytes(broken, b"broken")
    again = transfer.copy_files(spark, f"{root}/a", f"{root}/b", f"{root}/manifest", verify=True)
    runs = spark.read.parquet(f"{root}/manifest").select("run").distinct().count()
    return spark.read.parquet(f"{root}/b").groupBy("o_orderstatus").agg(F.count("*").alias("n")).select(F.col("o_orderstatus"), "n", F.lit(runs).cast("bigint").alias("runs"), F.lit(again).cast("bigint").alias("again"))


@query("s14_crawl", "SELECT DISTINCT o_orderstatus AS status, year(o_orderdate)::INT AS year FROM orders")
def _(spark, sf):
    """A nested store listed level by level; folders' names are parsed."""
    root = scratch(spark, "nested")
    sinks.write(table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year")), root, ["status", "year"])
    files = transfer.crawl(spark, root).filter("path LIKE '%.parquet'")
    found = catalog.parse_paths(files, {}, {"status": ("/status=([^/]+)/", 1), "year": ("/year=(\\d+)/", 1)})
    return found.select("status", F.col("year").cast("int").alias("year")).distinct()


@query("k11_store_copy", "SELECT r_regionkey AS key, r_name, 1 AS copied FROM region")
def _(spark, sf):
    root = scratch(spark, "copies")
    sinks.write(table(spark, sf, "region"), f"{root}/a")
    done = [sinks.copy_store(spark, f"{root}/a", f"{root}/b", {"r_regionkey": "key"}) for _ in range(2)]
    return spark.read.parquet(f"{root}/b").withColumn("copied", F.lit(sum(done)))


@query("p04_squeeze", "SELECT r_regionkey, r_name FROM region")
def _(spark, sf):
    return X.squeeze(table(spark, sf, "region").withColumn("height", F.lit(2.0)).withColumn("member", F.lit("r1")), ["height", "member"]).select("r_regionkey", "r_name")


@query("r05_coarsen_double", f"""WITH {OBS}, c AS (SELECT time, (lat_i // 4)::INT AS lat_i, (lon_i // 4)::INT AS lon_i, avg(pr) AS pr FROM obs GROUP BY time, lat_i // 4, lon_i // 4), n AS (SELECT ceil({WIDTH} / 4.0)::BIGINT AS h),
u AS (SELECT dst, h, greatest(0, least(h - 1, (dst + 0.5::DOUBLE) / 2 - 0.5::DOUBLE)) AS p FROM (SELECT unnest(range(0, 2 * h)) AS dst, h FROM n)), v AS (SELECT dst, floor(p)::INT AS a, p - floor(p) AS f FROM u),
lin AS (SELECT dst::INT AS dst, a AS src, 1 - f AS w FROM v WHERE f < 1 UNION ALL SELECT dst::INT, a + 1, f FROM v WHERE f > 0)
SELECT time, a.dst AS lat_i, b.dst AS lon_i, round(sum(a.w * b.w * pr) / sum(a.w * b.w) + 1e-8, 6) AS pr FROM c JOIN lin a ON a.src = lat_i JOIN lin b ON b.src = lon_i GROUP BY ALL""")
def _(spark, sf):
    w = grid_width(spark, sf)
    return G.coarsen_and_interpolate(obs(spark, sf), 4, w, w, ["pr"], tasks=tasks(spark, sf, "lineitem")).select("time", *CELL, r6(F.col("pr") + F.lit(1e-8), "pr"))


@query("r06_cell_centres", f"WITH {OBS}, n AS (SELECT {WIDTH} AS w), d AS (SELECT unnest([0, 1]) AS k) SELECT time, (lat_i - a.k)::INT AS lat_i, (lon_i - b.k)::INT AS lon_i, round(avg(pr) + 1e-8, 6) AS pr FROM obs, n, d a, d b WHERE lat_i - a.k BETWEEN 0 AND w - 2 AND lon_i - b.k BETWEEN 0 AND w - 2 GROUP BY time, lat_i - a.k, lon_i - b.k")
def _(spark, sf):
    edges = [float(i) for i in range(grid_width(spark, sf))]
    return G.shift_to_centres(obs(spark, sf), edges, edges, ["pr"], 1.0, tasks=tasks(spark, sf, "lineitem")).select("time", *CELL, r6(F.col("pr") + F.lit(1e-8), "pr"))


@query("r10_observed_subset", f"WITH {OBS} SELECT time, lat_i, lon_i, pr FROM obs WHERE year(time) BETWEEN 1993 AND 1995 AND lat_i BETWEEN 1 AND 4 AND lon_i BETWEEN 2 AND 6")
def _(spark, sf):
    return X.subset(obs(spark, sf), ["pr"], 1993, 1995, (1, 4), (2, 6), ("time", *CELL))


@query("r11_validation_subset", f"WITH {OBS} SELECT time, lat_i, lon_i, tasmax FROM obs WHERE year(time) BETWEEN 1997 AND 1998")
def _(spark, sf):
    return X.subset(obs(spark, sf), ["tasmax"], 1997, 1998, keys=("time", *CELL))


@query("f19_chunk_lengths", "SELECT * FROM (VALUES ('lat', 721), ('lon', 1440), ('time', 25)) AS t(dimension, length)")
def _(spark, sf):
    found = sinks.chunk_lengths({"time": 365, "lat": 721, "lon": 1440}, ("time",), 4)
    return spark.createDataFrame(sorted(found.items()), "dimension string, length int")


@query("f19_partitions", "SELECT 'time' AS split, ceil(365 / ceil(1e8 / (4 * 721 * 1440)))::BIGINT AS n UNION ALL SELECT 'lat,lon', (ceil(721 / s) * ceil(1440 / s))::BIGINT FROM (SELECT ceil(sqrt(1e8 / (4 * 365))) AS s)")
def _(spark, sf):
    lengths = {"time": 365, "lat": 721, "lon": 1440}
    return spark.createDataFrame([(",".join(k), sinks.partitions_for(lengths, k, 4)) for k in (("time",), ("lat", "lon"))], "split string, n long")


@query("f20_hash", "SELECT '96ad3bb4a2d666d3' AS hash")
def _(spark, sf):
    return spark.createDataFrame([(str_to_hash("test"),)], "hash string")


@query("f21_run_id", "SELECT true AS same, false AS other")
def _(spark, sf):
    made = [make_run_parameters(method="maca", variable=v, train_dates=["1981", "1982"], predict_dates=["2050", "2051"]).run_id_hash for v in ("pr", "pr", "tasmax")]
    return spark.createDataFrame([(made[0] == made[1], made[0] == made[2])], "same boolean, other boolean")


@query("g02_report", f"WITH {OBS}, {GCM}, u AS (SELECT 'obs' AS name, 'pr' AS variable, time, pr AS x FROM obs UNION ALL SELECT 'obs', 'tasmax', time, tasmax FROM obs UNION ALL SELECT 'gcm', 'pr', time, pr FROM gcm) SELECT name, variable, count(DISTINCT time) AS n_days, count(*) AS n_rows, count(*) FILTER (x IS NULL) AS n_null, round(avg(x) + 1e-6, 4) AS mean, min(x) AS low, max(x) AS high FROM u GROUP BY name, variable")
def _(spark, sf):
    found = A.report({"obs": obs(spark, sf), "gcm": gcm(spark, sf)}, ["pr", "tasmax"])
    return found.withColumn("mean", F.round(F.col("mean") + F.lit(1e-6), 4))


@query("a28_variogram_in_time", f"WITH {OBS}, l AS (SELECT unnest(range(1, 6))::INT AS lag) SELECT lag, round(avg((a.pr - b.pr) * (a.pr - b.pr)) / 2 + 1e-8, 6) AS gamma, count(*) AS n FROM obs a, l, obs b WHERE b.time = a.time + lag AND b.lat_i = a.lat_i AND b.lon_i = a.lon_i GROUP BY ALL")
def _(spark, sf):
    return A.variogram_in_time(obs(spark, sf), "pr", 5).select("lag", r6(F.col("gamma") + F.lit(1e-8), "gamma"), "n")


@query("a28_correlation_lengths")
def _(spark, sf):
    fits = A.correlation_lengths(obs(spark, sf), "pr", 5)
    return spark.createDataFrame([(k, *map(float, v)) for k, v in sorted(fits.items())], "axis string, length double, sill double, nugget double")
