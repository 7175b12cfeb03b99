"""Permutation importance against a plain version of the same cyclic shifts."""
import numpy as np
import pytest

from tessera.functions.kinds import sql_double
from tessera.operators.split import hash_key
from tessera.plans import models as ml


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return np.mean([np.mean((p > neg) + 0.5 * (p == neg)) for p in pos])


@pytest.mark.parametrize("values", [30, 4_000_000])  # many blocks of a few rows; blocks of the usual size
def test_shifted_copies(spark, monkeypatch, values):
    monkeypatch.setattr(ml, "BLOCK_VALUES", values)
    rng = np.random.default_rng(3)
    n = 83
    X = rng.normal(size=(n, 3)).round(3)
    y = (X[:, 0] + 0.3 * rng.normal(size=n) > 0).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), *map(float, X[i])) for i in range(n)], "id long, y int, a double, b double, c double")
    feats = ["a", "b", "c"]
    _, model = ml.rf_importance(df, "y", feats, num_trees=5)
    got = {r["feature"]: r for r in ml.permutation_importance(model, df, "y", "id", feats, n_repeats=4).collect()}

    order = [r["id"] for r in df.select("id", hash_key("id", 42, "perm").alias("h")).orderBy("h", "id").collect()]
    def score(M):
        frame = spark.createDataFrame([(i, *map(float, M[i])) for i in range(n)], "id long, a double, b double, c double")
        rows = ml.score_column(model.transform(frame)).select("id", "score").collect()
        out = np.zeros(n)
        for r in rows:
            out[r["id"]] = r["score"]
        return out
    base = brute_auc(y, score(X))
    for j, f in enumerate(feats):
        drops = []
        for r in range(4):
            M = X.copy()
            for place, i in enumerate(order):
                M[i, j] = X[order[(place + r + 1) % n], j]
            drops.append(base - brute_auc(y, score(M)))
        assert got[f]["importance_mean"] == pytest.approx(np.mean(drops), abs=1e-9)
        assert got[f]["importance_std"] == pytest.approx(np.std(drops), abs=1e-9)
    assert got["a"]["importance_mean"] > max(got["b"]["importance_mean"], got["c"]["importance_mean"])


def test_few_rows(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (2, 1, 2.0), (3, 1, 3.0)], "id long, y int, a double")
    _, model = ml.rf_importance(df, "y", ["a"], num_trees=3)
    assert ml.permutation_importance(model, df, "y", "id", ["a"], n_repeats=5).count() == 1
    assert ml.permutation_importance(model, df.limit(0), "y", "id", ["a"]).count() == 0


def test_literals_are_exact(spark):
    for v in (0.1, -1e-300, float("inf"), 123456789.123456789):
        assert spark.sql(f"select {sql_double(v)}").first()[0] == v
    assert np.isnan(spark.sql(f"select {sql_double(float('nan'))}").first()[0])
    assert spark.sql(f"select {sql_double(None)}").first()[0] is None
