"""The neighbour estimator of mutual information against a plain version."""
import math

import numpy as np
import pytest

from tessera.operators.select import MutualInfo, neighbour_information


def psi(n):
    return math.fsum(1 / i for i in range(1, int(n))) - 0.5772156649015329


def brute(x, y, k=3):
    keep = [i for i, v in enumerate(y) if (y == v).sum() > 1]
    x, y = x[keep], y[keep]
    t = 0.0
    for i in range(len(x)):
        own = (y == y[i])
        ny = own.sum()
        d = np.abs(x - x[i])
        r = np.sort(np.delete(d, i)[np.delete(own, i)])[min(k, ny - 1) - 1]
        ki, m = (min(k, ny - 1), (d < r * (1 - 1e-12)).sum()) if r > 0 else ((own & (d == 0)).sum() - 1, (d == 0).sum())
        t += psi(ki) - psi(ny) - psi(m)
    return max(0.0, psi(len(x)) + t / len(x))


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(2)
    y = rng.choice(["a", "b", "c"], 500, p=[.6, .3, .1])
    shift = np.array([{"a": 0.0, "b": 1.5, "c": -2.0}[v] for v in y])
    cols = {"signal": shift + rng.normal(0, 1, 500), "noise": rng.normal(0, 1, 500), "few": rng.integers(0, 4, 500) + (y == "b"),
            "constant": np.zeros(500), "mixed": np.where(rng.random(500) < .5, 0.0, shift + rng.normal(0, .5, 500)), "big": 1e9 + rng.normal(0, 1, 500)}
    y = y.copy()
    y[17] = "lonely"
    return {k: v.astype(float) for k, v in cols.items()}, y


def test_equals_the_plain_version(spark, data):
    cols, y = data
    rows = [(str(y[i]), *(float(v[i]) for v in cols.values())) for i in range(len(y))]
    df = spark.createDataFrame(rows, ["y", *cols]).repartition(5)
    got = {r["feature"]: r["mi"] for r in neighbour_information(df, "y", list(cols)).collect()}
    want = {c: brute(v, y) for c, v in cols.items()}
    assert all(abs(got[c] - want[c]) < 1e-9 for c in cols), (got, want)
    assert got["signal"] > 0.3 and got["noise"] < 0.06 and got["constant"] < 1e-9


def test_known_value(spark):
    """Two normal classes: the estimate is near the true information."""
    rng = np.random.default_rng(4)
    n = 4000
    y = rng.integers(0, 2, n)
    x = rng.normal(2.0 * y, 1)
    grid = np.linspace(-6, 8, 20001)
    p = [np.exp(-(grid - m) ** 2 / 2) / math.sqrt(2 * math.pi) for m in (0, 2)]
    mix = (p[0] + p[1]) / 2
    true = sum(np.sum(.5 * q * np.log(q / mix)) * (grid[1] - grid[0]) for q in p)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, x)], "y int, x double")
    assert abs(neighbour_information(df, "y", ["x"]).first()["mi"] - true) < 0.03


def test_nulls_empty_and_tiny(spark):
    df = spark.createDataFrame([(0, 1.0, None), (0, None, None), (1, 3.0, None), (1, 4.0, None)], "y int, x double, z double")
    got = {r["feature"]: r["mi"] for r in MutualInfo("y", features=["x", "z"]).scores(df).collect()}
    assert got["x"] is not None and got["z"] is None
    assert MutualInfo("y", features=["x"]).scores(df.limit(0)).first()["mi"] is None
