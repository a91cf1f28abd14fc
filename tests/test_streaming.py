"""Feeds against their batch counterparts."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafield.operators.water import Bucket
from terrafield.streaming import daily_feed as S

SCHEMA = "ts timestamp, cell int, value double"


def feed(spark, path, batches):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "t string, cell int, value double").select(F.to_timestamp("t").alias("ts"), "cell", "value").coalesce(1).write.mode("append").parquet(f"{path}/in")
    return S.read_stream(spark, f"{path}/in", SCHEMA)


def test_daily_values_and_late_readings(spark, tmp_path):
    rows = [("2001-01-01 01:00:00", 1, 2.0), ("2001-01-01 23:00:00", 1, 4.0), ("2001-01-02 05:00:00", 1, 9.0), ("2001-01-09 00:00:00", 1, 1.0)]
    stream = feed(spark, tmp_path, [rows])
    out = S.run_once(S.daily(stream, ["cell"]), f"file://{tmp_path}/out")
    got = {str(r.time): (r.mean, r.high, r.low, r.n) for r in out.collect()}
    assert got["2001-01-01"] == (3.0, 4.0, 2.0, 2) and got["2001-01-02"] == (9.0, 9.0, 9.0, 1)
    assert "2001-01-09" not in got  # its day is still open


def test_spells(spark, tmp_path):
    rows = [("2001-01-01 00:00:00", 1, 5.0), ("2001-01-01 12:00:00", 1, 5.0), ("2001-01-02 06:00:00", 1, 0.0), ("2001-01-05 00:00:00", 1, 5.0), ("2001-01-20 00:00:00", 2, 5.0)]
    out = S.run_once(S.spells(feed(spark, tmp_path, [rows]), ["cell"], F.col("value") > 1), f"file://{tmp_path}/out")
    assert sorted((r.cell, str(r.start), r.n) for r in out.collect()) == [(1, "2001-01-01 00:00:00", 2), (1, "2001-01-05 00:00:00", 1)]


def test_bucket_state_goes_on(spark, tmp_path):
    months = [("2001-%02d" % (k + 1), 1, 30.0 + 7 * k, 40.0, 0.8) for k in range(6)]
    schema = "month string, cell int, ppt double, pet double, melt double"
    for part in (months[:3], months[3:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        out = S.run_once(S.bucket(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")), f"file://{tmp_path}/out")
    got = {r.month: r.soil for r in out.collect()}
    one = Bucket.full(np.array([100.0]))
    for month, _, ppt, pet, melt in months:
        one.step(np.array([ppt]), np.array([pet]), np.array([melt]))
        assert got[month] == pytest.approx(one.soil[0])
