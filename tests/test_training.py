"""Training: gradients against differences, losses that fall, runs that go on where they broke off."""

from __future__ import annotations

import numpy as np
import pytest

from terrafield.operators import downscale as D
from terrafield.operators import models as M
from terrafield.operators import training as T
from terrafield.sources import networks, sinks


def test_forward_pass_is_the_one_that_predicts():
    rng = np.random.default_rng(1)
    layers = T.initial_layers(2, (5, 1, 3), (4, 3))
    image, height, label = rng.normal(size=(3, 7, 6))
    got, _ = T.gradients(np.stack([image, height], axis=-1)[None], label[None], layers)
    assert got == pytest.approx(((M.srcnn(image, height, layers) - label) ** 2).sum())


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(0)
    layers = [(k, rng.normal(0, 0.1, b.shape)) for k, b in T.initial_layers(4, (5, 1, 3), (4, 3))]
    images, labels = rng.normal(size=(3, 6, 7, 2)), rng.normal(size=(3, 6, 7))
    _, found = T.gradients(images, labels, layers)
    for n, (kernel, bias) in enumerate(layers):
        for x, g in ((kernel, found[n][0]), (bias, found[n][1])):
            for at in [tuple(rng.integers(0, s) for s in x.shape) for _ in range(12)]:
                kept, step = x[at], 1e-6
                x[at] = kept + step
                high, _ = T.gradients(images, labels, layers)
                x[at] = kept - step
                low, _ = T.gradients(images, labels, layers)
                x[at] = kept
                assert g[at] == pytest.approx((high - low) / (2 * step), rel=1e-4, abs=1e-5)


@pytest.fixture
def patches(spark):
    """Fine fields that follow the height of the ground beside their coarse means."""
    rng = np.random.default_rng(8)
    height = rng.normal(size=(8, 8))
    maps = spark.createDataFrame([(t, (rng.normal() + 0.5 * height + 0.1 * rng.normal(size=(8, 8))).tolist()) for t in range(30)], "time int, field array<array<double>>")
    return height, T.training_pairs(maps, height, 6, 2)


def test_pairs(patches):
    height, rows = patches
    got = rows.collect()
    assert len(got) == 30 * 4 and {(r.y0, r.x0) for r in got} == {(0, 0), (0, 2), (2, 0), (2, 2)}
    image = np.array(got[1].image).reshape(6, 6, 2)
    assert np.allclose(image[..., 1], height[got[1].y0 : got[1].y0 + 6, got[1].x0 : got[1].x0 + 6], atol=1e-6)


def test_loss_falls_and_broken_runs_go_on(spark, patches, tmp_path):
    _, rows = patches
    layers = T.initial_layers(1, (3, 1, 3), (6, 4))
    whole = T.train(rows, f"file://{tmp_path}/a", layers, 12, batch=40, rate=0.02, every=4, tasks=3)
    assert len(whole.losses) == 12 and np.mean(whole.losses[-3:]) < 0.6 * whole.losses[0]
    T.train(rows, f"file://{tmp_path}/b", layers, 9, batch=40, rate=0.02, every=4, tasks=20)  # broken off behind the state of step 8; a tree of sums
    sinks.remove(spark, f"file://{tmp_path}/b/step-000004")
    again = T.train(rows, f"file://{tmp_path}/b", layers, 12, batch=40, rate=0.02, every=4, tasks=3)
    assert np.allclose(again.losses, whole.losses) and all(np.allclose(a, b) for x, y in zip(again.layers, whole.layers) for a, b in zip(x, y))
    stages = networks.read_network(spark, again.path)
    maps = spark.createDataFrame([(1, np.ones((4, 4)).tolist())], "time int, field array<array<double>>")
    out = D.cells_of(M.super_resolve(maps, [np.zeros((8, 8))], stages), "pr")
    assert out.count() == 64


def test_no_patches(spark, tmp_path):
    empty = spark.createDataFrame([], "image array<float>, label array<float>")
    layers = T.initial_layers(1, (3,), ())
    done = T.train(empty, f"file://{tmp_path}/none", layers, 2, every=5, tasks=2)
    assert done.losses == [0.0, 0.0] and np.allclose(done.layers[0][0], layers[0][0])
