"""End-to-end configurations (split first, fit on train only, MT3 table)."""
import time
from functools import partial

import pytest

from conftest import SF_MID, SF_SMALL
from tessera.plans.workflow import FULL, PRODUCTION, Config, run
from tessera.session import concurrently
from tessera.sources.fixtures import planted

METRICS = {"accuracy", "precision", "recall", "f1", "auc"}
QUICK = ("Original", "RandomUnderSampler", "SMOTE", "SMOTETomek")


def test_production_workflow(spark):
    df = planted(spark, SF_MID).drop("is_test", "label")
    cfg = Config(mad_outliers=False, interactions=False, select_preset="fast", model_kw={"max_iter": 10})
    out = run(df, "planted", "id", cfg)
    rows = {r["metric"]: r for r in out["comparison"].collect()}
    assert set(rows) == METRICS
    assert out["processed"]["auc"] > 0.6  # the planted signal is found
    assert out["resampler"] in QUICK


def test_both_configurations_as_they_are(spark):
    df = planted(spark, SF_SMALL).drop("is_test", "label")
    for out in concurrently([partial(run, df, "planted", "id", cfg) for cfg in (FULL, PRODUCTION)]):
        assert {r["metric"] for r in out["comparison"].collect()} == METRICS
        assert out["features"] and out["resampler"] in QUICK


def test_concurrent_results_keep_their_order(spark):
    def task(i):
        time.sleep(0.05 * (3 - i))
        return spark.range(i).count()
    assert concurrently([partial(task, i) for i in range(4)]) == [0, 1, 2, 3]
    with pytest.raises(ZeroDivisionError):
        concurrently([partial(task, 1), lambda: 1 // 0])
