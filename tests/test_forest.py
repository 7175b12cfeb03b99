"""Forests grown in tasks: one tree against a plain one, cut points, scores of held and other rows."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import forest as fo
from tessera.plans import models as ml


def plain_tree(X, y, w, cols, depth):
    """(share, None) of a leaf or (feature, bin, left, right) by trying every split; children of one prediction are merged."""
    n, n1 = w.sum(), (w * y).sum()
    gini = lambda m: 1 - ((w[m] * y[m]).sum() / w[m].sum()) ** 2 - ((w[m] * (1 - y[m])).sum() / w[m].sum()) ** 2
    best = (0.0,)
    for f in cols if depth else ():
        for b in range(X[f].max()):
            lo = X[f] <= b
            if w[lo].sum() and w[~lo].sum():
                g = gini(w > 0) - w[lo].sum() / n * gini(lo) - w[~lo].sum() / n * gini(~lo)
                best = (g, f, b) if g > best[0] + 1e-12 else best
    if len(best) == 1:
        return n1 / n, None
    f, b = best[1:]
    lo = X[f] <= b
    kids = [plain_tree(X[:, m], y[m], w[m], cols, depth - 1) for m in (lo & (w > 0), ~lo & (w > 0))]
    if all(len(c) == 2 for c in kids) and (kids[0][0] > 0.5) == (kids[1][0] > 0.5):
        return n1 / n, None
    return f, b, *kids


def plain_score(tree, x):
    while len(tree) > 2:
        tree = tree[2 + (x[tree[0]] > tree[1])]
    return tree[0]


@pytest.mark.parametrize("depth, cells", [(30, 1 << 21), (3, 1 << 21), (30, 256)])  # also a few nodes at a time
def test_a_tree_is_the_plain_one(monkeypatch, depth, cells):
    monkeypatch.setattr(fo, "CELLS", cells)
    monkeypatch.setattr(fo, "ROWS", 64)
    rng = np.random.default_rng(1)
    X = rng.integers(0, 9, (3, 150)).astype(np.uint8)
    y = ((X[0] > 4) ^ (rng.random(150) < 0.25)).astype(np.uint8)
    w = fo.bag(np.arange(150), 2, 42)
    tree, importance = fo.grow(X, y, w, [0, 1, 2], np.random.default_rng(0), 3, depth, 1)
    live = w > 0
    want = plain_tree(X[:, live], y[live].astype(float), w[live].astype(float), [0, 1, 2], depth)
    Z = rng.integers(0, 9, (3, 400)).astype(np.uint8)
    agree = np.abs(tree.scores(Z) / fo.UNIT - np.array([plain_score(want, x) for x in Z.T])) < 1e-9
    assert agree.all()
    assert importance.sum() == pytest.approx(1) and importance[0] == max(importance)
    again = fo.Tree.unpack(tree.pack())
    assert (again.scores(Z) == tree.scores(Z)).all()


def test_every_feature_is_drawn_as_often():
    drawn = fo._drawn(np.random.default_rng(0), 20_000, 11, 4)
    assert np.allclose(np.bincount(drawn.ravel(), minlength=11) / 20_000, 4 / 11, atol=0.02)
    assert all(len(set(d)) == 4 for d in drawn[:500].tolist())


def test_weights_are_poisson():
    w = np.stack([fo.bag(np.arange(20_000), t, 42) for t in range(5)])
    assert np.allclose(w.mean(1), 1, atol=0.03) and np.allclose(w.var(1), 1, atol=0.06)
    assert abs(np.corrcoef(w)[0, 1]) < 0.03


def test_cut_points(spark):
    df = spark.range(5000).selectExpr("array(cast(id % 3 as double), cast(id as double), cast('NaN' as double), -0.0D) x").repartition(3)
    few, many, none, one = fo.cut_points(df, 4)
    assert few.tolist() == [0.5, 1.5] and not len(none) and not len(one)
    assert len(many) == 31 and np.allclose(many, np.arange(1, 32) * 5000 / 32, atol=25)
    assert fo.binned(np.array([[0.0, np.nan], [0.5, 1.0]]), [few, many]).tolist() == [[0, 0], [31, 1 if 1.0 > many[0] else 0]]


def frame(spark, n):
    return spark.range(n).selectExpr("id", "cast(id * 7919 % 1000 < 200 + 500 * (id % 2) as int) y", "cast(id % 2 as double) a",
                                     "cast(id * 31 % 97 as double) b", "cast(if(id % 7 = 0, null, id * 17 % 13) as double) c")


def test_trees_stay_in_the_shared_folder(spark):
    df = frame(spark, 600)
    imp, model = ml.rf_importance(df, "y", ["a", "b", "c"], num_trees=7)
    assert isinstance(model, fo.Forest) and model.trees.count() == 7
    rows = {r["feature"]: r["importance"] for r in imp.collect()}
    assert sum(rows.values()) == pytest.approx(1)
    out = model.transform(df)
    assert out.columns == [*df.columns, "probability", "prediction"] and out.count() == 600
    got = ml.score_column(out).agg(F.avg(F.abs(F.col("score") - F.col("y"))).alias("far"), F.sum((F.col("prediction") == (F.col("score") > 0.5).cast("double")).cast("int")).alias("n")).first()
    assert got["far"] < 0.35 and got["n"] == 600


def test_held_rows_are_scored_as_others(spark):
    df = frame(spark, 500).withColumn("part", (F.col("id") % 3).cast("int"))
    _, table, cuts = fo.fit_forests(df, "y", ["a", "b", "c"], [fo.Grown((0, 1, 2), k) for k in range(3)], 6, 42, 30, part=F.col("part"), keep=True)
    held = {k: sorted((r["y"], round(r["score"], 9)) for r in fo.held_scores(table, 6).filter(F.col("forest") == k).collect()) for k in range(3)}
    assert [len(held[k]) for k in range(3)] == [167, 167, 166]
    one = fo.Forest(table.filter("tree >= 0 and forest = 1"), cuts, ["a", "b", "c"], 6)
    rows = ml.score_column(one.transform(df.filter("part = 1"))).select("y", "score").collect()
    assert sorted((r["y"], round(r["score"], 9)) for r in rows) == held[1]


def test_other_labels_are_refused(spark):
    with pytest.raises(Exception, match="labels of a forest are 0 and 1"):
        ml.rf_importance(spark.range(5).selectExpr("id", "cast(id as int) y", "cast(id as double) a"), "y", ["a"], num_trees=2)


def test_same_as_the_library(spark):
    """The same estimator as pyspark.ml's: importances within the noise of the draws."""
    df = frame(spark, 2000).na.fill(6.0).coalesce(1).cache()
    mine = {r["feature"]: r["importance"] for r in ml.rf_importance(df, "y", ["a", "b", "c"])[0].collect()}
    other = ml._fit(ml.plain_forest("y", ["a", "b", "c"]), df).stages[-1].featureImportances.toArray()
    assert np.allclose([mine[f] for f in ("a", "b", "c")], other, atol=0.05)
