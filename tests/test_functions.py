"""Scalar functions, parameters and sessions."""

from __future__ import annotations

from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from terrafield.functions import hydrology as H
from terrafield.functions import scalar as S
from terrafield.params import BBox, RunParameters, TimePeriod, make_run_parameters, parse_flag, percentile_of, str_to_hash


def value(spark, expression):
    return spark.range(1).select(expression).first()[0]


def test_hash():
    assert str_to_hash("test") == "96ad3bb4a2d666d3"


def test_longitudes(spark):
    got = [value(spark, S.lon_to_180(F.lit(x))) for x in (0.0, 179.0, 180.0, 359.0, -10.0)]
    assert got == [0.0, 179.0, -180.0, -1.0, -10.0]


def test_normal_distribution(spark):
    n = NormalDist()
    rows = spark.createDataFrame([(x / 10,) for x in range(-80, 81)], "x double").select("x", S.normal_cdf(F.col("x")).alias("p"))
    for r in rows.collect():
        assert r.p == pytest.approx(n.cdf(r.x), abs=1e-12)
    rows = spark.createDataFrame([(p,) for p in (1e-9, 1e-4, 0.02, 0.3, 0.5, 0.77, 0.99, 1 - 1e-6)], "p double").select("p", S.normal_ppf(F.col("p")).alias("z"))
    for r in rows.collect():
        assert r.z == pytest.approx(n.inv_cdf(r.p), abs=1e-8)
    assert value(spark, S.normal_ppf(F.lit(1.5))) is None and value(spark, S.normal_cdf(F.lit(None).cast("double"))) is None


def test_vapour(spark):
    assert value(spark, S.saturation_vapor_pressure(F.lit(273.15))) == pytest.approx(6.112)
    assert value(spark, S.dewpoint(F.lit(6.112))) == pytest.approx(0)
    assert value(spark, S.relative_humidity_from_dewpoint(F.lit(290.0), F.lit(290.0))) == 1
    assert value(spark, S.melt_fraction(F.lit(-3.0))) == 0 and value(spark, S.melt_fraction(F.lit(7.0))) == 1
    assert 0 < value(spark, S.melt_fraction(F.lit(1.0))) < 1
    assert value(spark, S.clip(F.lit(None).cast("double"), 0, 1)) is None


def test_humidity_branches(spark):
    base = spark.createDataFrame([(20.0, 10.0, 0.5)], "tmax double, tmin double, rh double")
    first = H.humidity(base).first()
    by_vap = H.humidity(spark.createDataFrame([(20.0, 10.0, first.vap)], "tmax double, tmin double, vap double")).first()
    by_dew = H.humidity(spark.createDataFrame([(20.0, 10.0, first.tdew)], "tmax double, tmin double, tdew double")).first()
    assert by_vap.rh == pytest.approx(0.5) and by_dew.vap == pytest.approx(first.vap, rel=1e-3)
    with pytest.raises(ValueError):
        H.humidity(base.drop("rh"))


def test_texts(spark):
    assert value(spark, S.resolution_text(F.lit(0.25))) == "0_25"
    assert value(spark, S.swap_scheme(F.lit("gs://a/b"), "gs://", "az://")) == "az://a/b"
    assert value(spark, S.semver(F.lit("1.10.2+local"))) == [1, 10, 2]
    assert percentile_of("percentile95") == 0.95


def test_run_parameters():
    run = make_run_parameters(method="maca", variable="pr", train_period=["1981", "1982"], predict_dates=("2050", "2051"), unknown=1)
    assert run.features == ("pr",) and str(run.predict_period) == "2050_2051" and len(run.run_id_hash) == 16
    assert run.run_id_hash != make_run_parameters(method="maca", variable="pr", train_dates=["1981", "1983"], predict_dates=("2050", "2051")).run_id_hash
    with pytest.raises(ValueError):
        RunParameters("bcsd", "pr", train_dates=("1981",))
    assert parse_flag("False") is False and parse_flag(True)
    with pytest.raises(ValueError):
        parse_flag("maybe")


def test_predicates(spark):
    df = spark.createDataFrame([(1.0, 2.0, "1999-12-31"), (1.0, 2.0, "2000-01-01"), (5.0, 2.0, "2000-01-01")], "lat double, lon double, t string").withColumn("time", F.to_date("t"))
    assert df.filter(BBox(1, 3, 2, 4).predicate() & TimePeriod("2000", "2000").predicate()).count() == 1
