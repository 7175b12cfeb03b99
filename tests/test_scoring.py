"""Scoring of fitted models in a session in which something was observed before."""
import pytest
from pyspark.sql import functions as F

from tessera.plans import models as ml
from tessera.session import stage_observed


@pytest.mark.parametrize("name", ["RandomForest", "LogisticRegression"])
def test_models_score_after_an_observation(spark, name):
    _, seen = stage_observed(spark.range(3), F.count(F.lit(1)).alias("n"))
    assert seen["n"] == 3
    df = spark.range(60).selectExpr("id", "cast(id % 3 = 0 as int) y", "cast(id % 3 as double) a")
    model, _ = ml.train_model(name, df, "y", ["a"])
    assert ml.evaluate(model, df, "y")["auc"] == 1.0
