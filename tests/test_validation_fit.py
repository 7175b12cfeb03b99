"""Boosted fits that watch a validation frame (ML8)."""
from pyspark.sql import functions as F

from tessera.plans import models as ml


def frame(spark, n, seed):
    x = spark.range(n).select("id", F.rand(seed).alias("a"), F.rand(seed + 1).alias("b"), F.rand(seed + 2).alias("noise"))
    return x.withColumn("y", ((F.col("a") + F.col("b") > 1) != (F.col("noise") < 0.3)).cast("int")).drop("noise")


def test_stops_at_the_best_iteration(spark):
    train, valid = frame(spark, 300, 1).cache(), frame(spark, 200, 9).cache()
    model, info = ml.train_model("GradientBoosting", train, "y", ["a", "b"], validation=valid, maxIter=40, maxDepth=5)
    trees = model.stages[-1]
    assert info["iterations"] == trees.getNumTrees == len(info["history"]) < 40  # noise: more trees would overfit
    assert info["best_loss"] == min(info["history"])
    assert set(info["validation"]) == {"accuracy", "precision", "recall", "f1", "auc"}


def test_categories_of_the_validation_part_are_unknown(spark):
    train = frame(spark, 200, 1).withColumn("c", F.when(F.col("a") > 0.5, "hi").otherwise("lo"))
    valid = frame(spark, 100, 5).withColumn("c", F.lit("unseen"))
    model, info = ml.train_model("CatBoost", train, "y", ["a", "b", "c"], validation=valid, categorical=["c"], max_iter=5)
    assert 1 <= info["iterations"] <= 5
    assert model.stages[0].labels == ["hi", "lo"] or set(model.stages[0].labels) == {"hi", "lo"}


def test_empty_validation_watches_nothing(spark):
    train = frame(spark, 100, 1)
    model, info = ml.train_model("GradientBoosting", train, "y", ["a", "b"], validation=train.filter("id < 0"), maxIter=3)
    assert model.stages[-1].getNumTrees == 3 and "history" not in info
