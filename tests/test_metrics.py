"""Aggregations on small series with known results."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from terrafield.operators import aggregate as A

CELL = ("lat_i", "lon_i")


def series(spark, values, start="2001-01-01", cell=(0, 0)):
    rows = [(k, *cell, v) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k int, lat_i int, lon_i int, pr double")
    return df.select(F.date_add(F.lit(start).cast("date"), F.col("k")).alias("time"), *CELL, "pr")


@pytest.mark.parametrize("text", ["TTTTFFTFT", "FTTTTFFTFT", "TTTTFFTFTF", "FTTTTFFTFTF"])
def test_spell_means(spark, text):
    df = series(spark, [float(c == "T") for c in text])
    assert A.spell_length(df, F.col("pr") > 0.5).first()["mean"] == 2.0


def test_no_spell_is_null(spark):
    assert A.spell_length(series(spark, [0.0, 0.0]), F.col("pr") > 0.5).first()["mean"] is None


def test_persistence_wraps_around(spark):
    df = series(spark, [1.0, 1.0, 0.0, 1.0])
    assert A.probability_two_days(df, "wet").first()["probability"] == pytest.approx(2 / 3)
    assert A.probability_two_days(series(spark, [1.0, None, 0.0]), "dry").first()["probability"] == pytest.approx(1 / 2)
    with pytest.raises(NotImplementedError):
        A.probability_two_days(df, "warm")


def test_metrics_and_nulls(spark):
    df = series(spark, [1.0, 2.0, None, 4.0])
    assert A.metric_calc(df, "mean", "pr").first()["mean"] is None
    assert A.metric_calc(df, "mean", "pr", skipna=True).first()["mean"] == pytest.approx(7 / 3)
    assert A.metric_calc(df, "percentile50", "pr", skipna=True).first()["percentile50"] == 2.0
    assert A.metric_calc(df, "std", "pr", skipna=True).first()["std"] == pytest.approx(math.sqrt(14 / 9))
    with pytest.raises(ValueError):
        A.metric_calc(df, "mode", "pr")


def test_summaries(spark):
    df = series(spark, [1.0] * 31 + [None] * 28)
    rows = {r.time.month: r.pr for r in A.time_summary(df).collect()}
    assert rows == {1: 31.0, 2: 0.0}
    assert A.time_summary(df.withColumn("huss", F.lit(1.0))).columns == ["time", *CELL, "pr"]


def test_blocks(spark):
    df = series(spark, [1.0, 3.0, 5.0, 7.0, 9.0])
    assert [r.mean for r in A.coarsen_steps(df, "pr", 2, "trim").orderBy("block").collect()] == [2.0, 6.0]
    with pytest.raises(ValueError):
        A.coarsen_steps(df, "pr", 2)


def test_quality_counts(spark):
    df = series(spark, [-1.0, None, 4000.0, 1.0])
    got = {(r.year, r.lat_i, r.qaqc_check): r.n for r in A.qaqc(df, "pr", ["nulls", "aphysical_low_precip", "aphysical_high_precip"]).collect()}
    assert got[2001, None, "nulls"] == got[None, 0, "aphysical_low_precip"] == got[2001, None, "aphysical_high_precip"] == 1
    with pytest.raises(TypeError):
        A.is_bad(F.col("pr"), "x")


def test_weighted_mean_and_change(spark):
    df = series(spark, [1.0, 2.0], "2001-01-31")  # a day of January, a day of February
    assert A.weighted_mean(df, "pr").first()["mean"] == pytest.approx((31 + 2 * 28) / 59)
    got = A.change(df, "pr", F.month("time") == 1, F.month("time") == 2, ["mean"]).first()
    assert got["mean"] == 1.0


def test_empty(spark):
    df = series(spark, [1.0]).limit(0)
    for out in (A.time_summary(df), A.spell_length(df, F.col("pr") > 0), A.qaqc(df, "pr", ["nulls"]), A.weighted_mean(df, "pr")):
        assert [r for r in out.collect() if any(v for v in r)] == []
