"""Presets over one frame: a step with the same features and parameters runs once, with the same result."""
import pytest

from tessera.plans import models as ml


def test_presets_share_their_steps(spark, monkeypatch):
    df = spark.range(300).selectExpr("id", "cast(id * 7919 % 1000 < 200 + 500 * (id % 2) as int) y", "cast(id % 2 as double) a",
                                     "cast(id * 31 % 97 as double) b", "cast(id * 17 % 13 as double) c", "cast(id % 2 + id % 50 / 100 as double) d")
    calls = []
    for name in ("select_by_rf", "permutation_importance", "fold_column", "_cv_aucs"):
        def seen(*a, _run=getattr(ml, name), _name=name, **kw):
            calls.append((_name, [tuple(s) for s in a[2]] if _name == "_cv_aucs" else None))
            return _run(*a, **kw)
        monkeypatch.setattr(ml, name, seen)
    feats, shared = ["a", "b", "c", "d"], {}
    tight = {"corr_threshold": 0.5}  # a and d are correlated: something is removed and validated
    first = ml.select_features_preset(df, "y", "id", "fast", features=feats, shared=shared, **tight)
    second = ml.select_features_preset(df, "y", "id", "accurate", features=feats, shared=shared, **tight)
    names = [n for n, _ in calls]
    assert names.count("select_by_rf") == 1 and names.count("fold_column") == 1 and names.count("permutation_importance") == 1
    grown = [s for n, sets in calls if n == "_cv_aucs" for s in sets]
    assert len(grown) == len(set(grown)) >= 2
    alone = ml.select_features_preset(df, "y", "id", "accurate", features=feats, **tight)
    assert alone["selected"] == second["selected"] and alone["importances"].keys() == second["importances"].keys()
    assert alone["validation"]["auc_all"] == pytest.approx(second["validation"]["auc_all"], abs=1e-12)
    assert "permutation" not in first["importances"]
