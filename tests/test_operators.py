"""Operator invariants on small literal frames (FIXTURES.md F6)."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import categories as ct
from tessera.operators import encode as en
from tessera.operators import impute as mv
from tessera.operators import outliers as od
from tessera.operators import resample as ib
from tessera.operators.neighbour_ops import DBSCANOutliers


@pytest.fixture()
def tiny_num(spark):
    rows = [(1, 1.0, 7.0, None), (2, 2.0, 7.0, None), (3, 2.0, 7.0, None), (4, 3.0, 7.0, None),
            (5, 100.0, 7.0, None), (6, None, 7.0, None), (7, -50.0, 7.0, None), (8, 2.0, 7.0, None)]
    return spark.createDataFrame(rows, "id long, x double, const double, allnull double")


@pytest.fixture()
def tiny_cat(spark):
    vals = ["a"] * 4 + ["b"] * 4 + ["c", None]
    return spark.createDataFrame([(i, v, "one", "Yes" if i % 2 else "yes") for i, v in enumerate(vals)],
                                 "id long, v string, single string, case string")


def test_iqr_bounds_and_capping_idempotent(spark, tiny_num):
    fit = od.IQROutliers(["x"]).fit(tiny_num)
    xs = np.array([1, 2, 2, 3, 100, -50, 2], dtype=float)
    q1, q3 = np.quantile(xs, [0.25, 0.75])
    assert math.isclose(fit.lower["x"], q1 - 1.5 * (q3 - q1))
    once = fit.cap(tiny_num)
    twice = fit.cap(once)
    assert once.orderBy("id").collect() == twice.orderBy("id").collect()
    assert once.filter("id = 6").first()["x"] is None  # null stays null
    flagged = {r["id"] for r in fit.transform(tiny_num).filter("is_outlier").collect()}
    assert flagged == {5, 7}


def test_mad_zero_flags_every_non_median(spark, tiny_num):
    fit = od.MADOutliers(["const"]).fit(tiny_num)
    assert fit.lower["const"] == fit.upper["const"] == 7.0
    assert od.MADOutliers(["const"], zero_mad="skip").fit(tiny_num).lower == {}


def test_numeric_fill_only_train_null_columns(spark, tiny_num):
    fit = mv.NumericFill("median", add_indicator=True, exclude=["id"]).fit(tiny_num)
    assert set(fit.values) == {"x", "allnull"}
    assert fit.values["x"] == 2.0 and fit.values["allnull"] is None
    out = fit.transform(tiny_num).filter("id = 6").first()
    assert out["x"] == 2.0 and out["x_missing"] == 1


def test_mode_fill_ties_smallest_and_group_unknown(spark, tiny_cat):
    fit = mv.CategoricalFill("mode", features=["v"]).fit(tiny_cat)
    assert fit.values == {"v": "a"}
    df = tiny_cat.withColumn("g", F.when(F.col("id") == 9, "z").otherwise("y"))
    g = mv.GroupCategoricalFill("g", ["v"]).fit(df)
    got = {r["id"]: r["v"] for r in g.transform(df).collect()}
    assert got[9] == "Unknown"  # group z has no value at all


def test_label_encode_unseen_and_null(spark, tiny_cat):
    fit = en.LabelEncode(["v"]).fit(tiny_cat)
    test = spark.createDataFrame([(1, "b"), (2, "zzz"), (3, None)], "id long, v string")
    got = {r["id"]: r["v"] for r in fit.transform(test).collect()}
    assert got == {1: 1, 2: -1, 3: 3}  # sorted: a, b, c, nan


def test_onehot_drop_first_and_if_binary(spark, tiny_cat):
    fit = en.OneHot(["v", "case"], drop="if_binary").fit(tiny_cat)
    assert fit.names() == ["v_a", "v_b", "v_c", "v_nan", "case_yes"]
    fit2 = en.OneHot(["v"], drop="first").fit(tiny_cat)
    assert fit2.names() == ["v_b", "v_c", "v_nan"]
    unseen = spark.createDataFrame([(1, "q")], "id long, v string")
    assert fit2.transform(unseen).first().asDict() == {"id": 1, "v_b": 0.0, "v_c": 0.0, "v_nan": 0.0}


def test_binary_encode_bits(spark, tiny_cat):
    fit = en.BinaryEncode(["v"]).fit(tiny_cat)
    assert fit.bits == {"v": 2}
    got = {r["id"]: (r["v_bit0"], r["v_bit1"]) for r in fit.transform(tiny_cat).collect()}
    assert got[0] == (0, 0) and got[4] == (1, 0) and got[8] == (0, 1) and got[9] == (1, 1)


def test_decode_encode_roundtrip(spark, tiny_cat):
    fit = en.EncodeTarget("v", out_col="code").fit(tiny_cat)
    back = fit.decode(fit.transform(tiny_cat), "code", "back")
    assert all(r["v"] == r["back"] for r in back.collect())


def test_rare_and_whitelist(spark, tiny_cat):
    fit = ct.CategoryOutliers(["v"], threshold=0.15, min_count=1, methods=["rare"]).fit(tiny_cat)
    assert {r["value"] for r in fit.report().collect()} == {"c"}
    g = fit.group_rare(tiny_cat)
    assert {r["v"] for r in g.collect()} == {"a", "b", "Other", None}


def test_fit_uses_train_only(spark, tiny_cat):
    fit = en.FrequencyEncode(["v"]).fit(tiny_cat)
    other = spark.createDataFrame([(1, "c")] * 50, "id long, v string")
    assert fit.transform(other).first()["v"] == pytest.approx(1 / 9)


def test_smote_counts_and_segments(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(x), float(y), 1 if i < 12 else 0) for i, (x, y) in enumerate(rng.normal(size=(60, 2)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    out = ib.smote(df, "y", "id", ["a", "b"], k_neighbors=3).toPandas()
    assert (out.y == 1).sum() == (out.y == 0).sum() == 48
    orig = {r[0]: np.array(r[1:3]) for r in rows if r[3] == 1}
    pts = np.array(list(orig.values()))
    for _, r in out[out.id >= 60].iterrows():  # every synthetic point lies on a minority segment
        p = np.array([r.a, r.b])
        ok = False
        for i in range(len(pts)):
            for j in range(len(pts)):
                d = pts[j] - pts[i]
                if i != j:
                    t = np.dot(p - pts[i], d) / np.dot(d, d)
                    if -1e-9 <= t <= 1 + 1e-9 and np.linalg.norm(pts[i] + t * d - p) < 1e-9:
                        ok = True
        assert ok


def test_undersample_exact(spark):
    df = spark.createDataFrame([(i, 1 if i < 30 else 0) for i in range(200)], "id long, y int")
    out = ib.undersample(df, "y", "id").groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in out} == {0: 30, 1: 30}


def test_dbscan_grid(spark):
    sq1 = [(x * 0.1, y * 0.1) for x in range(5) for y in range(5)]
    sq2 = [(5 + x * 0.1, 5 + y * 0.1) for x in range(5) for y in range(5)]
    iso = [(10.0, 0.0), (0.0, 10.0), (-10.0, 0.0), (20.0, 20.0), (2.5, 2.5)]
    pts = sq1 + sq2 + iso
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "id long, x double, y double")
    fit = DBSCANOutliers(["x", "y"], eps=0.25, min_samples=5, auto_eps=False, scale_data=False).fit(df)
    r = fit.result.toPandas().set_index("id")
    assert set(r[r.is_noise].index) == set(range(50, 55))
    assert r.loc[list(range(50)), "cluster"].nunique() == 2


def test_model_overrides_are_real_and_unknown_ones_raise(spark):
    from tessera.plans.models import PROFILES
    for name, factory in PROFILES.items():
        pipe = factory("y", ["a"], maxIter=7) if name not in ("RandomForest", "LogisticRegression") else factory("y", ["a"])
        assert pipe.getStages()[-1].getLabelCol() == "y"
        with pytest.raises(TypeError):
            factory("y", ["a"], no_such_parameter=1)
    assert PROFILES["LightGBM"]("y", ["a"], maxIter=7).getStages()[-1].getMaxIter() == 7
