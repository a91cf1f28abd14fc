"""Array stores: what is written comes back, and only the chunks of a box are opened."""

from __future__ import annotations

import datetime
import json
import os
import zlib

import numpy as np
import pytest

from terrafield.sources import chunks as C

DAY = datetime.date(1999, 12, 30)
ROWS = [(DAY + datetime.timedelta(days=t), y, x, None if (t, y) == (1, 1) else t * 100.0 + y * 10 + x, (t - y) * 0.25) for t in range(7) for y in range(5) for x in range(4) if (t + y + x) % 5]


@pytest.fixture
def store(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    rows = spark.createDataFrame(ROWS, "time date, lat_i int, lon_i int, pr double, tas double")
    assert C.write_chunks(rows, path, {"time": 3, "lat_i": 2, "lon_i": 4}, ["pr", "tas"], {"tas": (0.25, -1.0)}) == 9
    return path


def test_round_trip(spark, store):
    read = C.read_chunks(spark, store)
    assert read.dtypes == [("time", "date"), ("lat_i", "int"), ("lon_i", "int"), ("pr", "double"), ("tas", "double")]
    assert sorted(map(tuple, read.collect()), key=repr) == sorted(ROWS, key=repr)
    only = C.read_chunks(spark, store, ["pr"])
    assert only.count() == sum(r[3] is not None for r in ROWS)
    assert C.read_chunks(spark, store, missing="keep").count() == 7 * 5 * 4


def test_layout_is_plain(store):
    root = store.removeprefix("file://")
    meta = json.load(open(f"{root}/pr/.zarray"))
    assert (meta["shape"], meta["chunks"], meta["dtype"], meta["fill_value"]) == ([7, 5, 4], [3, 2, 4], "<f8", "NaN")
    first = np.frombuffer(zlib.decompress(open(f"{root}/pr/0.0.0", "rb").read()), "<f8").reshape(3, 2, 4)
    assert first[2, 1, 3] == 213.0 and np.isnan(first[0, 0, 0]) and np.isnan(first[1, 1, 0])
    packed = np.frombuffer(zlib.decompress(open(f"{root}/tas/0.0.0", "rb").read()), "<i4").reshape(3, 2, 4)
    assert packed[2, 0, 0] == 6 and packed[0, 0, 0] == -(2**31)


def test_only_chunks_of_the_box_are_opened(spark, store):
    root = store.removeprefix("file://")
    for name in os.listdir(f"{root}/pr"):
        if name[0].isdigit() and not name.startswith("1.1."):
            for v in ("pr", "tas"):
                with open(f"{root}/{v}/{name}", "wb") as f:
                    f.write(b"broken")
    box = C.read_chunks(spark, store).filter("time BETWEEN DATE '2000-01-02' AND DATE '2000-01-04' AND lat_i IN (2, 3) AND lon_i <> 1 AND tas < 100")
    low, high = datetime.date(2000, 1, 2), datetime.date(2000, 1, 4)
    assert sorted(map(tuple, box.collect()), key=repr) == sorted((r for r in ROWS if low <= r[0] <= high and r[1] in (2, 3) and r[2] != 1), key=repr)
    with pytest.raises(Exception, match="error|Error"):
        C.read_chunks(spark, store).filter("lat_i = 0").collect()


def test_partitions_follow_filters(store):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, StringContains

    reader = C.ChunkReader(C.Store(store), ["pr"], False, 1)
    assert len(reader.partitions()) == 9
    other = StringContains(("pr",), "x")
    assert list(reader.pushFilters([IsNotNull(("time",)), EqualTo(("lat_i",), 4), In(("lon_i",), (1, 2)), GreaterThan(("time",), DAY + datetime.timedelta(days=2)), other])) == [other]
    assert [p.chunks for p in reader.partitions()] == [[(1, 2, 0)], [(2, 2, 0)]]
    assert len(C.ChunkReader(C.Store(store), ["pr"], False, 1 << 20).partitions()) == 1


def test_missing_chunks_groups_and_errors(spark, store, tmp_path):
    root = store.removeprefix("file://")
    for v in ("pr", "tas"):
        os.remove(f"{root}/{v}/0.0.0")
    left = C.read_chunks(spark, store).count()
    assert left == sum(not ((r[0] - DAY).days < 3 and r[1] < 2) for r in ROWS)
    twice = spark.createDataFrame([(1, 1.0), (1, 2.0), (None, 3.0)], "x int, v double")
    with pytest.raises(Exception, match="two rows for one cell"):
        C.write_chunks(twice, f"file://{tmp_path}/twice", {"x": 4}, ["v"])
    with pytest.raises(Exception, match="no array store"):
        C.read_chunks(spark, f"file://{tmp_path}/twice").collect()
    C.write_chunks(twice.limit(0), f"file://{tmp_path}/empty", {"x": 4}, ["v"], axes={"x": [1, 2]}, group="a")
    assert C.read_chunks(spark, f"file://{tmp_path}/empty", group="a").count() == 0
    with pytest.raises(Exception, match="has no nothing"):
        C.read_chunks(spark, store, ["nothing"]).collect()


def test_variables_are_appended(spark, store):
    more = spark.createDataFrame([(DAY + datetime.timedelta(days=1), 2, 3, 5.0), (DAY + datetime.timedelta(days=90), 0, 0, 6.0)], "time date, lat_i int, lon_i int, wind double")
    C.write_chunks(more, store, {"time": 0, "lat_i": 0, "lon_i": 0}, ["wind"], append=True)
    read = C.read_chunks(spark, store)
    assert read.columns == ["time", "lat_i", "lon_i", "pr", "tas", "wind"]
    assert [tuple(r)[:3] + (r.wind,) for r in read.filter("wind IS NOT NULL").collect()] == [(DAY + datetime.timedelta(days=1), 2, 3, 5.0)]
    assert sorted((tuple(r)[:5] for r in read.filter("pr IS NOT NULL OR tas IS NOT NULL").collect()), key=repr) == sorted(ROWS, key=repr)
    with pytest.raises(ValueError, match="dimensions"):
        C.write_chunks(more, store, {"lat_i": 0, "time": 0}, ["wind"], append=True)
