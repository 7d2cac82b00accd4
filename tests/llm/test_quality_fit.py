"""The distributed fit against a plain one on all rows at once."""

import numpy as np

from cohortspark.llm import quality


def isotonic(values, weights):
    """By its max-min formula: the largest of the least means of the runs around a place."""
    n = len(values)
    mean = lambda j, k: np.average(values[j : k + 1], weights=weights[j : k + 1])
    return [max(min(mean(j, k) for k in range(i, n)) for j in range(i + 1)) for i in range(n)]


def plain_ridge(z, y, ridge):
    """Least squares with rows of their own for the penalty."""
    penalty = np.sqrt(ridge * len(z) / (z.shape[1] - 1)) * np.eye(z.shape[1])
    return np.linalg.lstsq(np.vstack([z, penalty]), np.concatenate([y, np.zeros(z.shape[1])]), rcond=None)[0]


def test_weights_and_knots_are_those_of_a_plain_fit(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(240, quality.N_STATISTICS)) * rng.uniform(0.1, 50, quality.N_STATISTICS)
    x[:, 5] = 3.0  # does not vary
    y = (x[:, 0] / x[:, 0].std() + rng.normal(size=240) > 0).astype(int)
    half = rng.integers(0, 2, 240)
    rows = [(a.tolist(), int(b), int(h)) for a, b, h in zip(x, y, half, strict=True)]
    labelled = spark.createDataFrame(rows, "stats array<double>, y int, half int").repartition(5)
    model = quality.fit(labelled, n_features=64)
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, np.where(x.std(axis=0) > 1e-12, x.std(axis=0), 1))
    z = model.features(x)
    assert np.allclose(model.weights, plain_ridge(z, y, 1e-3), atol=1e-6)

    raw = np.empty(240)
    for h in (0, 1):  # rows of a half by the weights of the other one
        raw[half == h] = z[half == h] @ plain_ridge(z[half != h], y[half != h], 1e-3)
    place = (np.clip(raw, -0.5, 1.5) + 0.5) / 2 * 2048
    bins, at, counts = np.unique(np.minimum(place.astype(int), 2047), return_inverse=True, return_counts=True)
    means = np.bincount(at, weights=y) / counts
    assert np.allclose(model.knots, (bins + 0.5) / 2048 * 2 - 0.5)
    assert np.allclose(model.values, isotonic(means, counts))


def test_cosines_approach_the_kernel():
    rng = np.random.default_rng(9)
    n, width = 4096, 4.0
    none = np.zeros(quality.N_STATISTICS)
    directions = rng.standard_normal((quality.N_STATISTICS, n)) / width
    model = quality.Model(none, none + 1, directions, rng.uniform(0, 2 * np.pi, n), np.zeros(n + 1), none, none)
    x = rng.normal(size=(30, quality.N_STATISTICS))
    z = model.features(x)[:, :-1]
    distance = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-distance / (2 * width**2))).max() < 0.08
