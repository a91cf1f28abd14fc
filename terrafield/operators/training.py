"""Training of super-resolution networks: gradients of patches summed over tasks, step by step.

A step reads one shard of the patches (a folder of about a batch), every task sums the gradients of its share, the sums
are added up in a tree of tasks, and the driver, which holds nothing but the weights, moves them. Weights and
momentum are stored every so many steps; a run that was broken off goes on from the last store that was written to its end.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import networks
from ..sources.scratch import scratch, written
from ..sources.sinks import is_complete, write
from .models import upsample2

Layers = list[tuple[np.ndarray, np.ndarray]]

#: Bytes of the windows that a task unfolds at once.
WINDOW_BYTES = 64 << 20
#: Patches of a file, about, where a shard has more.
FILE_PATCHES = 100_000
#: Sums of gradients that one task (or the driver) adds up.
FAN = 16


def initial_layers(seed: int, kernels: tuple[int, ...] = (9, 1, 5), filters: tuple[int, ...] = (64, 32), channels: int = 2, spread: float | None = None) -> Layers:
    """Layers of odd square kernels, the last with one filter; normal weights whose spread keeps the scale of the input unless it is given."""
    rng, out, depth = np.random.default_rng(seed), [], channels
    for k, n in zip(kernels, (*filters, 1)):
        out.append((rng.normal(0, spread or np.sqrt(2 / (k * k * depth)), (k, k, depth, n)), np.zeros(n)))
        depth = n
    return out


def _windows(x: np.ndarray, k: int) -> np.ndarray:
    """(n, h, w, c) to the k by k surroundings of each pixel, zero beyond the edges: (n, h, w, c, k, k)."""
    padded = np.pad(x, ((0, 0), (k // 2, k // 2), (k // 2, k // 2), (0, 0)))
    return np.lib.stride_tricks.sliding_window_view(padded, (k, k), axis=(1, 2))


def _convolve(x: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    return np.tensordot(_windows(x, kernel.shape[0]), kernel, axes=((4, 5, 3), (0, 1, 2)))


def gradients(images: np.ndarray, labels: np.ndarray, layers: Layers) -> tuple[float, list[tuple[np.ndarray, np.ndarray]]]:
    """The sum of squared errors over all pixels of images (n, h, w, c) against labels (n, h, w), and its gradient by every layer."""
    inputs = [images]
    for kernel, bias in layers[:-1]:
        inputs.append(np.maximum(_convolve(inputs[-1], kernel) + bias, 0))
    error = (_convolve(inputs[-1], layers[-1][0]) + layers[-1][1])[..., 0] - labels
    down, out = 2 * error[..., None], []
    for n in reversed(range(len(layers))):
        kernel = layers[n][0]
        by_kernel = np.tensordot(_windows(inputs[n], kernel.shape[0]), down, axes=((0, 1, 2), (0, 1, 2))).transpose(1, 2, 0, 3)
        out.append((by_kernel, down.sum(axis=(0, 1, 2))))
        if n:  # through the kernel turned about, where the layer before was not rectified away
            down = _convolve(down, kernel[::-1, ::-1].transpose(0, 1, 3, 2)) * (inputs[n] > 0)
    return float((error**2).sum()), out[::-1]


def _flat(layers: Layers) -> np.ndarray:
    return np.concatenate([x.ravel() for layer in layers for x in layer])


def _shaped(flat: np.ndarray, like: Layers) -> Layers:
    out, at = [], 0
    for kernel, bias in like:
        a, b = at + kernel.size, at + kernel.size + bias.size
        out.append((flat[at:a].reshape(kernel.shape), flat[a:b]))
        at = b
    return out


def training_pairs(maps: DataFrame, elevation: np.ndarray, size: int, stride: int, time: str = "time") -> DataFrame:
    """time, y0, x0, image, label: patches of what the network sees of a fine map, its means of 2 by 2 cells doubled again, and of the map itself.

    ``maps`` has a fine map a row (field array<array<double>>) of the shape of ``elevation``, which is the image's second channel; sides are even. Images are
    pixels by row, both channels of each.
    """
    shared = maps.sparkSession.sparkContext.broadcast(elevation)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        height = shared.value
        h, w = height.shape
        corners = [(y, x) for y in range(0, h - size + 1, stride) for x in range(0, w - size + 1, stride)]
        for batch in batches:
            for day, field in zip(batch.column(0), batch.column(1)):
                fine = field.values.flatten().to_numpy().reshape(h, w)
                seen = np.stack([upsample2(fine.reshape(h // 2, 2, w // 2, 2).mean(axis=(1, 3))), height], axis=-1)
                columns = [[day] * len(corners), [y for y, _ in corners], [x for _, x in corners], [seen[y : y + size, x : x + size].ravel() for y, x in corners], [fine[y : y + size, x : x + size].ravel() for y, x in corners]]
                kinds = [batch.column(0).type, pa.int32(), pa.int32(), pa.list_(pa.float32()), pa.list_(pa.float32())]
                yield pa.RecordBatch.from_arrays([pa.array([v.as_py() for v in columns[0]], kinds[0]), *[pa.array(c, k) for c, k in zip(columns[1:], kinds[1:])]], [time, "y0", "x0", "image", "label"])

    kind = maps.schema[time].dataType.simpleString()
    return maps.select(time, "field").mapInArrow(cut, f"{time} {kind}, y0 int, x0 int, image array<float>, label array<float>")


def _step(rows: DataFrame, layers: Layers, tasks: int) -> tuple[float, int, np.ndarray]:
    """The summed error, the number of pixels and the summed gradient of patches."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(layers)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        depth = net[0][0].shape[2]
        total, error, pixels = np.zeros(sum(k.size + b.size for k, b in net)), 0.0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.num_rows
            images, labels = (batch.column(k).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for k in range(2))
            side = int(round(np.sqrt(labels.shape[1])))
            each = max(1, WINDOW_BYTES // (8 * side * side * max(k.shape[0] ** 2 * k.shape[2] for k, _ in net)))
            for i in range(0, n, each):
                x = images[i : i + each].astype(float).reshape(-1, side, side, depth)
                y = labels[i : i + each].astype(float).reshape(-1, side, side)
                e, g = gradients(x, y, net)
                total += _flat(g)
                error += e
                pixels += y.size
        if pixels:
            yield _sum_row(error, pixels, total)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        error, pixels, total = 0.0, 0, None
        for batch in batches:
            for e, n, g in zip(*(batch.column(k).to_pylist() for k in range(3))):
                error, pixels = error + e, pixels + n
                total = np.frombuffer(g) if total is None else total + np.frombuffer(g)
        if total is not None:
            yield _sum_row(error, pixels, total)

    rows = rows.select("image", "label")
    read = rows.rdd.getNumPartitions()
    # Patches are shuffled only where their files keep less than half of the tasks busy.
    rows, tasks = (rows.repartition(tasks), tasks) if 2 * read < tasks else (rows, read)
    sums = rows.mapInArrow(partial, _SUMS)
    while tasks > FAN:
        tasks = -(-tasks // FAN)
        sums = sums.repartition(tasks).mapInArrow(add, _SUMS)
    found = sums.collect()  # at most FAN rows
    shared.destroy()
    gradient = np.sum([np.frombuffer(r.gradient) for r in found], axis=0) if found else np.zeros(len(_flat(layers)))
    return sum(r.error for r in found), sum(r.pixels for r in found), gradient


_SUMS = "error double, pixels bigint, gradient binary"


def _sum_row(error: float, pixels: int, gradient: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([error]), pa.array([pixels], pa.int64()), pa.array([gradient.tobytes()], pa.binary())], ["error", "pixels", "gradient"])


@dataclass(frozen=True)
class Training:
    """A trained stage: its layers, the mean squared error ahead of every step, and where the network is stored."""

    layers: Layers
    losses: list[float]
    path: str


def train(patches: DataFrame, path: str, layers: Layers, steps: int = 1000, batch: int = 200, rate: float = 0.01, momentum: float = 0.9, every: int = 50, seed: int = 0, tasks: int | None = None) -> Training:
    """Gradient descent with momentum on patches (image, label) from ``layers`` on; the network is stored at ``path``/network.

    Steps go through shards of about ``batch`` patches, dealt by a hash of the patch and the seed, so a run that is broken off and begun again
    sees the same ones. States are at ``path``/step-..., one every ``every`` steps.
    """
    spark = patches.sparkSession
    kept = written(patches.select("image", "label"), "training-patches")
    n = kept.count()
    shards = max(1, round(n / batch))
    if shards == 1:
        rows = kept.withColumn("shard", F.lit(0))
    else:
        files = -(-n // (shards * FILE_PATCHES))  # of a shard
        dealt = kept.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "image", "label"), F.lit(shards)).cast("int"))
        stored = scratch(spark, "training-shards")
        dealt.repartition(min(shards * files, 10_000), "shard", F.pmod(F.xxhash64(F.lit(seed + 1), "label"), F.lit(files))).write.partitionBy("shard").parquet(stored)
        rows = spark.read.schema("image array<float>, label array<float>, shard int").parquet(stored)
    tasks = tasks or spark.sparkContext.defaultParallelism

    done, weights, speed, losses = 0, _flat(layers), np.zeros(len(_flat(layers))), []
    for step in range(steps - steps % every, 0, -every):
        if is_complete(spark, f"{path}/step-{step:06d}"):
            stages = networks.read_network(spark, f"{path}/step-{step:06d}")
            done, weights, speed = step, _flat(stages[0]), _flat(stages[1])
            losses = [r.loss for r in spark.read.parquet(f"{path}/losses-{step:06d}").orderBy("step").collect()]
            break
    for step in range(done, steps):
        error, pixels, gradient = _step(rows.filter(F.col("shard") == step % shards), _shaped(weights, layers), tasks)
        losses.append(error / max(pixels, 1))
        speed = momentum * speed - rate * gradient / max(pixels, 1)
        weights = weights + speed
        if (step + 1) % every == 0:
            write(spark.createDataFrame(list(enumerate(losses)), "step int, loss double").coalesce(1), f"{path}/losses-{step + 1:06d}")
            networks.write_network(spark, f"{path}/step-{step + 1:06d}", [_shaped(weights, layers), _shaped(speed, layers)])
    trained = _shaped(weights, layers)
    return Training(trained, losses, networks.write_network(spark, f"{path}/network", [trained]))
