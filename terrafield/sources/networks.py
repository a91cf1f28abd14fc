"""Trained convolution layers as tables, so that a network is read like any other store."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .sinks import write

SCHEMA = "stage int, layer int, shape array<int>, kernel array<double>, bias array<double>"

Network = list[list[tuple[np.ndarray, np.ndarray]]]  # stages of layers of (kernel (k, k, in, out), bias)


def write_network(spark: SparkSession, path: str, stages: Network) -> str:
    """A row a layer; networks have some ten layers."""
    rows = [(s, n, list(map(int, kernel.shape)), kernel.ravel().tolist(), bias.tolist()) for s, layers in enumerate(stages) for n, (kernel, bias) in enumerate(layers)]
    return write(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)


def read_network(spark: SparkSession, path: str) -> Network:
    """The stages in order, each its layers in order."""
    stages: dict[int, list] = {}
    for r in sorted(spark.read.schema(SCHEMA).parquet(path).collect(), key=lambda r: (r.stage, r.layer)):
        stages.setdefault(r.stage, []).append((np.array(r.kernel).reshape(r.shape), np.array(r.bias)))
    return [stages[s] for s in sorted(stages)]


def elevation_matrix(elevation: DataFrame, height: int, width: int, lat: str = "lat_i", lon: str = "lon_i", value: str = "elev") -> np.ndarray:
    """An elevation grid (of one stage's resolution, at most a few million cells) as a matrix; cells without one are at sea level."""
    out = np.zeros((height, width))
    rows = elevation.select(lat, lon, value).toPandas()
    inside = rows[lat].between(0, height - 1) & rows[lon].between(0, width - 1) & rows[value].notna()
    rows = rows[inside]
    out[rows[lat].to_numpy(), rows[lon].to_numpy()] = rows[value].to_numpy(float)
    return out
