"""Unit tests of the shared kernels against small independent numpy/pandas checks."""
import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import metrics as mt
from tessera.functions.components import connected_components
from tessera.functions.neighbors import eps_pairs, knn_join
from tessera.functions.prefix import running_totals
from tessera.functions.stats import corr_long, exact_quantiles, grouped_quantile
from tessera.operators.split import exact_first_n, stratified_split
from tessera.operators.typos import TypoCorrection, indel_ratio, lcs_length


def _lcs_dp(a, b):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            m[i][j] = m[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(m[i - 1][j], m[i][j - 1])
    return m[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcé d", max_size=12), st.text(alphabet="abcé d", max_size=12))
def test_bit_parallel_lcs_equals_dp(a, b):
    assert lcs_length(a, b) == _lcs_dp(a, b)


def test_indel_ratio_strict_threshold():
    assert indel_ratio("male", "female") == 80.0  # must NOT pass a strict > 80 test
    assert indel_ratio("monthly", "montly") > 80


def test_typo_fixture(spark):
    vals = ["monthly"] * 6 + ["montly"] + ["yearly"] * 4 + ["Yearly"] + ["male", "female"] * 2
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, plan string")
    fit = TypoCorrection(["plan"]).fit(df)
    m = {r["wrong"]: r["right"] for r in fit.corrections().collect()}
    assert m == {"montly": "monthly", "Yearly": "yearly"}
    out = {r["plan"] for r in fit.transform(df).collect()}
    assert out == {"monthly", "yearly", "male", "female"}


def test_exact_quantiles_match_numpy_with_hot_value(spark):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25), rng.integers(0, 5, 500).astype(float)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact_quantiles(df, ["x"], probs, accuracy=200)["x"]
    want = np.quantile(x, probs)
    assert np.allclose(got, want, rtol=0, atol=1e-12)
    # force the narrowing passes (brackets limited to 20 values)
    got2 = exact_quantiles(df, ["x"], probs, accuracy=50, max_bracket=20)["x"]
    assert np.allclose(got2, want, rtol=0, atol=1e-12)


def test_grouped_quantile_matches_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 2000).astype(str), "x": rng.normal(size=2000)})
    pdf.loc[pdf.g == "0", "x"] = 1.0  # one constant group
    df = spark.createDataFrame(pdf)
    got = {r["g"]: r["q"] for r in grouped_quantile(df, ["g"], "x", 0.5, accuracy=100).collect()}
    want = pdf.groupby("g")["x"].median().to_dict()
    for k in want:
        assert math.isclose(got[k], want[k], abs_tol=1e-12)
    # every group "hot": solved one by one with narrowing passes
    got2 = {r["g"]: r["q"] for r in grouped_quantile(df, ["g"], "x", 0.5, accuracy=50, max_bracket=8).collect()}
    for k in want:
        assert math.isclose(got2[k], want[k], abs_tol=1e-12)


def test_null_safe_corr(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 7.0, 5.0), (4.0, 8.0, 5.0)], "a double, b double, c double")
    r = {(x["a"], x["b"]): x["r"] for x in corr_long(df, ["a", "b", "c"]).collect()}
    assert math.isclose(r[("a", "b")], np.corrcoef([1, 3, 4], [2, 7, 8])[0, 1])
    assert r[("a", "c")] is None  # constant column: NULL, not an error


def test_running_totals(spark):
    pdf = pd.DataFrame({"k": np.arange(1000)[::-1], "v": np.arange(1000) % 7})
    out = running_totals(spark.createDataFrame(pdf).repartition(5), ["k"], ["v"], partitions=6).toPandas()
    out = out.sort_values("k")
    assert (out["cum_v"].to_numpy() == pdf.sort_values("k")["v"].cumsum().to_numpy()).all()
    assert (out["__rank"].to_numpy() == np.arange(1, 1001)).all()


def test_auc_equals_pair_counting(spark):
    y = [1, 0, 1, 1, 0, 0, 1, 0, 1]
    s = [0.9, 0.9, 0.8, 0.5, 0.5, 0.1, 0.5, 0.3, 0.2]
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(list(zip(y, s)), "y int, s double")
    assert math.isclose(mt.roc_auc(df, "y", "s").first()["auc"], want)


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_split_exact_and_partition_independent(spark, parts):
    rows = [(i, "a" if i % 3 else "b") for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, y string").repartition(parts)
    out = stratified_split(df, "y", "id", 0.2, 42).toPandas()
    counts = out.groupby("y").is_test.sum().to_dict()
    n = out.groupby("y").size().to_dict()
    assert counts == {k: int(0.2 * v + 0.5) for k, v in n.items()}
    base = stratified_split(spark.createDataFrame(rows, "id long, y string"), "y", "id", 0.2, 42).toPandas()
    assert set(out[out.is_test].id) == set(base[base.is_test].id)


def test_exact_first_n_small_class(spark):
    df = spark.createDataFrame([(i, "x") for i in range(10)], "id long, y string")
    flag = exact_first_n(df, "y", "id", {"x": 10}, 1, "t")
    assert df.filter(flag).count() == 10


def _brute_knn(pts, k):
    out = {}
    for i, p in enumerate(pts):
        d = sorted((math.dist(p, q), j) for j, q in enumerate(pts) if j != i)
        out[i] = [j for _, j in d[:k]]
    return out


def test_knn_join_equals_brute_force(spark, monkeypatch):
    import tessera.functions.neighbors as nb
    monkeypatch.setattr(nb, "TILE_ROWS", 64)  # force several blocks per side
    random.seed(1)
    pts = [(random.randint(0, 9) * 1.0, random.randint(0, 9) * 1.0) for _ in range(300)]  # many ties
    df = spark.createDataFrame([(i, list(p)) for i, p in enumerate(pts)], "id long, vec array<double>")
    nn = knn_join(df, df, 4).toPandas()
    got = {q: list(g.sort_values("rank").nid) for q, g in nn.groupby("qid")}
    assert got == _brute_knn(pts, 4)


def test_eps_pairs_equals_brute_force(spark):
    random.seed(2)
    pts = [(random.random() * 3, random.random() * 3, random.random()) for _ in range(200)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "id long, x double, y double, z double")
    got = {(r["a"], r["b"]) for r in eps_pairs(df, ["x", "y", "z"], 0.4).collect()}
    want = {(i, j) for i, j in itertools.product(range(200), repeat=2) if math.dist(pts[i], pts[j]) <= 0.4}
    assert got == want


def test_connected_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 6), (7, 7)], "a long, b long")
    cc = {r["id"]: r["component"] for r in connected_components(edges).collect()}
    assert cc == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 7: 7}


def test_components_of_a_long_path(spark):
    from tessera.functions.components import connected_components
    import random
    ids = list(range(1000))
    random.Random(3).shuffle(ids)
    e = spark.createDataFrame(list(zip(ids, ids[1:])) + [(5000, 5001), (7000, 7000), (None, 3)], "a long, b long")
    got = {r["id"]: r["component"] for r in connected_components(e).collect()}
    assert len(got) == 1003
    assert {got[i] for i in ids} == {0}
    assert got[5001] == got[5000] == 5000 and got[7000] == 7000
    assert connected_components(e.limit(0)).count() == 0


def test_knn_at_large_offsets(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    for offset in (0.0, 1e6, 1e8):
        x = rng.normal(size=(120, 3)) + offset
        df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vec array<double>")
        got = {}
        for r in knn_join(df, df, 5, metric="nan_euclidean").collect():
            got.setdefault(r["qid"], set()).add(r["nid"])
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
        np.fill_diagonal(d, np.inf)
        assert all(got[i] == set(np.lexsort((np.arange(120), np.round(d[i], 12)))[:5].tolist()) for i in range(120))


def test_typo_candidates_do_not_depend_on_the_number_of_values(spark):
    from tessera.operators.typos import TypoCorrection
    pair = [("axb", 1), ("ab", 5)]
    for extra in (0, 400):
        rows = [v for v, n in pair for _ in range(n)] + [f"zz{i:06d}qq{'k' * (i % 9)}" for i in range(extra)]
        df = spark.createDataFrame([(v,) for v in rows], "v string")
        got = {(r["wrong"], r["right"]) for r in TypoCorrection(["v"], fuzzy_threshold=0.7).fit(df).corrections().collect()}
        assert ("axb", "ab") in got


def test_grouped_quantile_keeps_null_keys(spark):
    from tessera.functions.stats import grouped_quantile
    df = spark.createDataFrame([(None, float(i)) for i in range(11)] + [("a", 1.0), ("a", 2.0)], "k string, x double")
    got = {r["k"]: r["q"] for r in grouped_quantile(df, ["k"], "x").collect()}
    assert got == {None: 5.0, "a": 1.5}


def test_wide_aggregates_are_cut_into_chunks(spark, monkeypatch):
    from tessera.functions import stats
    import numpy as np
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 7))
    cols = [f"c{i}" for i in range(7)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], cols)
    monkeypatch.setattr(stats, "CHUNK", 3)
    got = stats.exact_quantiles(df, cols, [0.25, 0.5])
    assert all(np.allclose(got[c], np.quantile(x[:, i], [0.25, 0.5])) for i, c in enumerate(cols))


def test_wide_correlations_in_one_scan(spark):
    """300 columns with nulls, an offset that dwarfs the spread, constants and a NaN."""
    from tessera.functions import stats
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 300)) + rng.normal(size=(120, 1)) + 1e6 * rng.integers(0, 3, 300)
    x[rng.random(x.shape) < .2] = np.nan
    x[:, 7] = 5.0
    cols = [f"c{i}" for i in range(300)]
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(4)
    out = stats.corr_long(df, cols, "all")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") <= 2  # the union of both orders reads one aggregate twice at most
    r = {(t["a"], t["b"]): t["r"] for t in out.collect()}
    want = pd.DataFrame(x, columns=cols).corr().to_numpy()
    assert len(r) == 300 * 300 and all(r[("c7", c)] is None for c in cols)
    assert all(abs(r[(a, b)] - want[i, j]) < 1e-7 for i, a in enumerate(cols) for j, b in enumerate(cols) if 7 not in (i, j))
    odd = spark.createDataFrame([(1.0, 2.0), (float("nan"), 3.0), (2.0, 4.0), (None, 9.0)], "a double, b double")
    assert np.isnan(stats.corr_long(odd, ["a", "b"]).first()["r"])
    part = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (9.0, None)], "a double, b double")
    assert stats.corr_long(part, ["a", "b"]).first()["r"] is None and stats.corr_long(part, ["a"], targets=["b"]).first()["r"] is None
