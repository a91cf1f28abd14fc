"""Raw copies, crawls, classic NetCDF files, and scans that are given bounds of days."""

from __future__ import annotations

import datetime
import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafield.operators import select as X
from terrafield.sources import netcdf, readers, sinks, transfer


@pytest.fixture
def tree(tmp_path):
    for name, data in {"a/one.bin": b"1" * 1000, "a/b/two.bin": os.urandom(70_000), "a/b/c/three": b"", "four": b"4"}.items():
        (tmp_path / "src" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "src" / name).write_bytes(data)
    (tmp_path / "src" / "hollow").mkdir()
    return f"file://{tmp_path}"


def test_crawl(spark, tree):
    found = transfer.crawl(spark, f"{tree}/src", 2)
    assert {(r.path.removeprefix(f"{tree}/src/"), r.folder, r.bytes) for r in found.collect()} == {("a", True, None), ("a/b", True, None), ("a/b/c", True, None), ("hollow", True, None), ("four", False, 1), ("a/one.bin", False, 1000), ("a/b/two.bin", False, 70_000), ("a/b/c/three", False, 0)}
    assert transfer.crawl(spark, f"{tree}/nowhere").count() == 0


def test_copies_go_on_and_are_mended(spark, tree):
    source, target, manifest = f"{tree}/src", f"{tree}/dst", f"{tree}/manifest"
    root = target.removeprefix("file://")
    assert transfer.copy_files(spark, source, target, manifest, tasks=2) == 4
    assert transfer.copy_files(spark, source, target, manifest) == 0
    names = transfer.names_below(transfer.crawl(spark, source), source)
    same = lambda: sorted(map(tuple, transfer.checksums(names, source).collect())) == sorted(map(tuple, transfer.checksums(names, target).collect()))
    assert same()
    os.remove(f"{root}/a/one.bin")
    assert transfer.copy_files(spark, source, target, manifest) == 1 and same()
    with open(f"{root}/a/b/two.bin", "r+b") as f:
        f.write(b"broken")
    assert transfer.copy_files(spark, source, target, manifest) == 0 and not same()
    assert transfer.copy_files(spark, source, target, manifest, verify=True) == 1 and same()


def small_reader(path):
    """A reader of its own, for files of this one shape."""
    raw = open(path, "rb").read()
    assert raw[:8] == b"CDF\x02\0\0\0\0"
    at = 8

    def number():
        nonlocal at
        at += 4
        return struct.unpack(">I", raw[at - 4 : at])[0]

    def name():
        nonlocal at
        n = number()
        at += n + -n % 4
        return raw[at - n - -n % 4 :][:n].decode()

    assert number() == 10
    dims = [(name(), number()) for _ in range(number())]
    assert (number(), number()) == (0, 0) and number() == 11
    out = {}
    for _ in range(number()):
        key = name()
        own = [dims[number()] for _ in range(number())]
        if number() == 12:
            for _ in range(number()):
                name()
                kind, n = number(), number()
                size = n * {2: 1, 6: 8}[kind]
                at += size + -size % 4
        else:
            number()
        kind, _ = number(), number()
        begin = struct.unpack(">Q", raw[at : at + 8])[0]
        at += 8
        shape = [n for _, n in own]
        out[key] = np.frombuffer(raw, {4: ">i4", 6: ">f8"}[kind], int(np.prod(shape)), begin).reshape(shape)
    return out


@pytest.mark.parametrize("slab", [1, 1 << 20])
def test_netcdf(spark, tmp_path, slab):
    day = datetime.date(2001, 2, 27)
    rows = [(day + datetime.timedelta(days=t), y * 0.5, x, None if t == y else float(t * 100 + y * 10 + x)) for t in range(5) for y in range(3) for x in range(4) if (t + x) % 3]
    path = f"file://{tmp_path}/out/region.nc"
    netcdf.write_netcdf(spark.createDataFrame(rows, "time date, lat double, lon int, pr double"), path, ["time", "lat", "lon"], ["pr"], slab)
    arrays = small_reader(path.removeprefix("file://"))
    assert arrays["time"].tolist() == [(day - datetime.date(1970, 1, 1)).days + t for t in range(5)] and arrays["lat"].tolist() == [0, 0.5, 1.0] and arrays["lon"].tolist() == [0, 1, 2, 3]
    want = np.full((5, 3, 4), netcdf.FILL)
    for t, y, x, v in rows:
        if v is not None:
            want[(t - day).days, int(y * 2), x] = v
    assert (arrays["pr"] == want).all()
    got = netcdf.read_netcdf(spark, path, ["pr"], slab)
    assert got.count() == 60 and sorted(map(tuple, got.filter("pr IS NOT NULL").collect())) == sorted(r for r in rows if r[3] is not None)
    with pytest.raises(ValueError, match="mounted"):
        netcdf.write_netcdf(got, "s3://bucket/x.nc", ["time", "lat", "lon"], ["pr"])


def test_years_reach_the_scan(spark, tmp_path):
    rows = spark.range(3000).select(F.date_add(F.lit(datetime.date(1993, 1, 1)), F.col("id").cast("int")).alias("time"), F.lit(1.0).alias("lat"), F.lit(200.0).alias("lon"), F.lit(1.0).alias("pr"))
    rows.write.parquet(f"{tmp_path}/fields")
    fields = spark.read.parquet(f"{tmp_path}/fields")
    for out in (X.subset(fields, ["pr"], 1995, 1996), readers.open_reanalysis(fields, None, 1995, 1996)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(time,1995-01-01)" in plan and "LessThan(time,1997-01-01)" in plan
        assert out.count() == 365 + 366
    sinks.write(fields.filter("time < '1994-01-01'"), f"file://{tmp_path}/a")
    sinks.write(fields.filter("time >= '1994-01-01'").withColumn("more", F.lit(float("nan"))), f"file://{tmp_path}/b")
    both = readers.scan_many(spark, [f"file://{tmp_path}/a", f"file://{tmp_path}/b"])
    assert both.count() == 3000 and both.filter("more IS NOT NULL").count() == 0 and "Union" not in both._jdf.queryExecution().executedPlan().toString()


def test_stores_are_probed_in_one_job(spark, tmp_path):
    for name in ("whole", "broken", "partial"):
        sinks.write(spark.range(5), f"file://{tmp_path}/{name}")
    sinks.write(spark.range(0), f"file://{tmp_path}/empty")
    sinks.remove(spark, f"file://{tmp_path}/partial/_SUCCESS")
    for p in (tmp_path / "broken").glob("*.parquet"):
        p.write_bytes(b"no table")
    listed = spark.createDataFrame([(n, f"file://{tmp_path}/{n}") for n in ("whole", "broken", "partial", "empty", "missing")] + [("none", None)], "id string, zstore string")
    assert [r.id for r in sinks.valid_stores(listed).collect()] == ["whole"]
