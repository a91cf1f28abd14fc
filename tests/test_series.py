"""Mergeable aggregates against plain ones, the table function, and plans of lasting layouts."""

from __future__ import annotations

import datetime
import itertools
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from terrafield.operators import series as S
from terrafield.sources import layouts

DAY = datetime.date(1970, 1, 1)


def day(n):
    return DAY + datetime.timedelta(days=n)


def test_sketch_quantiles_within_the_error(spark):
    rng = random.Random(1)
    values = {k: [rng.choice([-1, 1, 1, 1]) * math.exp(rng.uniform(-3, 9)) if rng.random() > 0.05 else 0.0 for _ in range(n)] for k, n in ((1, 700), (2, 1), (3, 44))}
    rows = spark.createDataFrame([(k, x) for k, v in values.items() for x in v] + [(1, None), (2, float("nan")), (4, None)], "k int, x double")
    parts = [S.quantile_sketch(rows.filter(c), "x", ["k"], 0.02) for c in ("x > 3", "x <= 3")]
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r.k, r.p): r.value for r in S.sketch_quantiles(S.merge_sketches(parts, ["k"]), probabilities, ["k"], 0.02).collect()}
    assert set(got) == {(k, p) for k in values for p in probabilities}
    for (k, p), x in got.items():
        exact = sorted(values[k])[max(1, math.ceil(p * len(values[k]))) - 1]
        assert abs(x - exact) <= 0.02 * abs(exact) + 1e-9
    with pytest.raises(ValueError):
        S.quantile_sketch(rows, "x", ["k"], 1.5)


def brute_spells(days):
    runs = [len(list(g)) for _, g in itertools.groupby(sorted(days), key=lambda d, c=itertools.count(): d - next(c))]
    return len(runs), sum(runs) / len(runs), max(runs)


@pytest.mark.parametrize("block", [1, 2, 5, 512])
def test_spells_do_not_depend_on_blocks(spark, block):
    rng = random.Random(block)
    days = {k: {d for d in range(-40, 60) if rng.random() < share} for k, share in ((1, 0.5), (2, 0.95), (3, 1.1), (4, 0.03), (5, 0.0))}
    days[6], days[7] = {0}, set(range(3)) | set(range(50, 58))
    rows = spark.createDataFrame([(k, day(d), d in s) for k, s in days.items() for d in range(-40, 60)] + [(2, None, True), (2, day(5), None)], "k int, time date, wet boolean")
    got = {r.k: (r.n_spells, r.mean_days, r.longest) for r in S.spells(rows.filter("time IS NOT NULL").union(rows.filter("k = 1")), F.col("wet"), ["k"], block_days=block).collect()}
    assert got == {k: pytest.approx(brute_spells(s)) for k, s in days.items() if s}


def test_heat_waves(spark):
    rows = [("a", day(d), x) for d, x in enumerate([5, 31, 32, 33, 33, 2, 35, 36, None, 40, 40, 40])] + [("b", day(0), 99.0), ("b", day(1), 99.0), ("b", day(3), 98.0), ("c", day(0), 1.0)]
    table = spark.createDataFrame([(c, t, None if x is None else float(x)) for c, t, x in rows], "city string, time date, t double").repartition(3)
    got = sorted(map(tuple, S.heat_waves(table, "t", 30, 2, ["city"]).collect()))
    assert got == [("a", day(1), day(4), 4, 33.0, day(3)), ("a", day(6), day(7), 2, 36.0, day(7)), ("a", day(9), day(11), 3, 40.0, day(9)), ("b", day(0), day(1), 2, 99.0, day(0))]
    assert S.heat_waves(table.limit(0), "t", 30, 2, ["city"]).count() == 0


def test_bucketed_tables_are_not_shuffled_or_written_again(spark, tmp_path):
    rows = spark.range(400).select((F.col("id") % 10).cast("int").alias("lat_i"), (F.col("id") % 7).cast("int").alias("lon_i"), F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("time"), F.col("id").cast("double").alias("pr"))
    path = f"file://{tmp_path}/cells"
    table = layouts.rechunked(rows, "cells_by_test", path, buckets=4)
    assert layouts.conforms(spark, "cells_by_test") and layouts.conforms(spark, "cells_by_test", buckets=4) and not layouts.conforms(spark, "cells_by_test", ["lat_i"]) and not layouts.conforms(spark, "no_such_table")
    files = sorted(p.name for p in (tmp_path / "cells").glob("*.parquet"))
    assert len(files) == 4 and layouts.files_per_key(table).filter("files <> 1").count() == 0
    again = layouts.rechunked(rows.limit(0), "cells_by_test", path)
    assert sorted(p.name for p in (tmp_path / "cells").glob("*.parquet")) == files and again.count() == 400
    window = Window.partitionBy("lat_i", "lon_i").orderBy("time")
    steps = table.withColumn("s", F.sum("pr").over(window)).groupBy("lat_i", "lon_i").agg(F.max("s").alias("s"))
    assert "Exchange" not in steps._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in rows.groupBy("lat_i", "lon_i").count()._jdf.queryExecution().executedPlan().toString()
    other = layouts.rechunked(rows, "cells_by_test", path, ["lat_i"], most_bytes=4000)
    assert layouts.layout_of(spark, "cells_by_test")["buckets"] == layouts.buckets_for(400, 4, 4000) == 4 and other.count() == 400
    spark.sql("DROP TABLE cells_by_test")
