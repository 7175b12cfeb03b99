"""Queries for models, model-based selection, resampler search and the end-to-end
experiment (rows-only checks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode as en
from ..operators import impute as mv
from ..operators.split import stratified_split
from ..session import cut_lineage
from . import models as ml
from .catalog import f5, query, train_of
from .oracle import f5_sql
from .q_neighbors import _f4z

NUM = ["acctbal", "tenure", "total_charges", "monthly_charges", "in_debt"]
OH = ["urgent_Yes", "fulfilled_Yes", "region_AMERICA", "region_ASIA", "region_EUROPE", "region_MIDDLE EAST"]
FEATS = NUM + OH


def model_frame(spark, sf):
    """F5 with train-median fill and one-hot encoded low-cardinality strings."""
    df = f5(spark, sf)
    tr = train_of(df)
    fill = mv.NumericFill("median", features=NUM[:-1]).fit(tr)
    oh = en.OneHot(["urgent", "fulfilled", "region"], drop="first").fit(tr)
    out = oh.transform(fill.transform(df))
    return cut_lineage(out.select("id", "is_test", "planted", "segment", "nation", *FEATS))


def _metrics_row(spark, name, m):
    return spark.createDataFrame([(name, *[float(m[k]) if m[k] is not None else None
                                          for k in ("accuracy", "precision", "recall", "f1", "auc")])],
                                 "model string, accuracy double, precision double, recall double, f1 double, auc double")


def _profile_query(name, **kw):
    def run(spark, sf):
        df = model_frame(spark, sf)
        model, _ = ml.train_model(name, train_of(df), "planted", FEATS, **kw)
        return _metrics_row(spark, name, ml.evaluate(model, df.filter("is_test"), "planted"))
    return run


query("ml1_lr")(_profile_query("LogisticRegression"))
query("ml2_rf")(_profile_query("RandomForest"))
query("ml3_gbt")(_profile_query("GradientBoosting"))
query("ml4_xgb_profile")(_profile_query("XGBoost"))
query("ml5_lgbm_profile")(_profile_query("LightGBM"))


@query("ml6_cat_profile")
def ml6_cat_profile(spark, sf):
    df = model_frame(spark, sf)
    model, _ = ml.train_model("CatBoost", train_of(df), "planted", FEATS + ["segment", "nation"],
                              categorical=["segment", "nation"])
    return _metrics_row(spark, "CatBoost", ml.evaluate(model, df.filter("is_test"), "planted"))


def _train_valid(df):
    tr = train_of(df)
    s = cut_lineage(stratified_split(tr, "planted", "id", 0.2, 42, "is_valid"))
    return s.filter(~F.col("is_valid")), s.filter("is_valid")


@query("ml8_train_validation")
def ml8_train_validation(spark, sf):
    df = model_frame(spark, sf)
    tr, va = _train_valid(df)
    _, info = ml.train_model("GradientBoosting", tr, "planted", FEATS, validation=va)
    hist = info["history"]
    return spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(hist)], "iteration int, logloss double")


@query("ml8_early_stop", f5_sql("""SELECT 'validation' AS part, count(*) > 0 AS has_rows, true AS within_limit,
       true AS lowest_is_last, true AS loss_agrees, count(*) AS n_train_and_validation FROM f5 WHERE NOT is_test"""))
def ml8_early_stop(spark, sf):
    """Invariants of a fit that stops on its validation rows: at most 100 iterations, the last
    kept one has the lowest loss, and that loss is the mean log loss of the model's own scores."""
    df = model_frame(spark, sf)
    tr, va = _train_valid(df)
    model, info = ml.train_model("GradientBoosting", tr, "planted", FEATS, validation=va)
    # Spark's boosting loss is 2 log(1 + exp(-2 y m)) for y in -1, 1 and the probability 1 / (1 + exp(-2 m))
    right = F.when(F.col("planted") == 1, F.col("score")).otherwise(1 - F.col("score"))
    own = ml.score_column(model.transform(va)).agg(F.avg(-2 * F.log(right)).alias("loss"), F.count(F.lit(1)).alias("n"))
    best, rounds = info["best_loss"], info["iterations"]
    return own.select(F.lit("validation").alias("part"), (F.col("n") > 0).alias("has_rows"),
                      F.lit(1 <= rounds <= 100).alias("within_limit"), F.lit(best <= min(info["history"])).alias("lowest_is_last"),
                      (F.abs(F.col("loss") - best) < 1e-6 * best).alias("loss_agrees"),
                      (F.col("n") + F.lit(tr.count())).alias("n_train_and_validation"))


@query("ml9_compare")
def ml9_compare(spark, sf):
    df = model_frame(spark, sf)
    t, _ = ml.compare_models(list(ml.PROFILES), train_of(df), df.filter("is_test"), "planted", FEATS)
    return t


@query("ml10_best")
def ml10_best(spark, sf):
    df = model_frame(spark, sf)
    tr, va = _train_valid(df)
    best, model, table = ml.find_best_model(tr, va, "planted", FEATS)
    test = ml.evaluate(model, df.filter("is_test"), "planted")
    return _metrics_row(spark, best, test)


# ------------------------------------------------------------------------------- FS4 / FS5 / FS7-FS9
@query("fs4_rf")
def fs4_rf(spark, sf):
    df = train_of(model_frame(spark, sf))
    sel = ml.select_by_rf(df, "planted", FEATS)
    return sel.scores.withColumn("kept", F.col("feature").isin(sel.kept)) \
        .withColumn("threshold", F.lit(sel.info["threshold"]))


@query("fs5_perm")
def fs5_perm(spark, sf):
    df = train_of(model_frame(spark, sf))
    _, model = ml.rf_importance(df, "planted", FEATS)
    return ml.permutation_importance(model, df, "planted", "id", FEATS, n_repeats=5)


@query("fs7_validate")
def fs7_validate(spark, sf):
    df = train_of(model_frame(spark, sf))
    v = ml.validate_feature_set(df, "planted", "id", FEATS, ["in_debt", "urgent_Yes", "acctbal"], 0.05)
    return spark.createDataFrame([(float(v["auc_all"]), float(v["auc_selected"]), float(v["loss"]), bool(v["accepted"]))],
                                 "auc_all double, auc_selected double, loss double, accepted boolean")


def _selected_rows(spark, res):
    return spark.createDataFrame([(f,) for f in res["selected"]], "feature string")


@query("fs8_select")
def fs8_select(spark, sf):
    df = train_of(model_frame(spark, sf))
    return _selected_rows(spark, ml.select_features(df, "planted", "id", FEATS))


@query("fs9_presets")
def fs9_presets(spark, sf):
    df = train_of(model_frame(spark, sf))
    out, shared = None, {}
    for preset in ml.PRESETS:
        rows = _selected_rows(spark, ml.select_features_preset(df, "planted", "id", preset, features=FEATS, shared=shared)).withColumn("preset", F.lit(preset))
        out = rows if out is None else out.unionByName(rows)
    return out


# ------------------------------------------------------------------------------- IB10 / IB11
def _f4_parts(spark, sf):
    z = cut_lineage(stratified_split(_f4z(spark, sf), "toxic", "id", 0.25, 42, "is_valid"))
    return z.filter(~F.col("is_valid")).drop("is_valid"), z.filter("is_valid").drop("is_valid")


@query("ib10_compare")
def ib10_compare(spark, sf):
    tr, va = _f4_parts(spark, sf)
    return ml.compare_resamplers(tr, va, "toxic", "id", ["z0", "z1", "z2"],
                                 scoring="f1")


@query("ib11_auto")
def ib11_auto(spark, sf):
    tr, va = _f4_parts(spark, sf)
    best, table = ml.auto_select_resampler(tr, va, "toxic", "id", ["z0", "z1", "z2"], quick_mode=False)
    return table.withColumn("chosen", F.col("method") == F.lit(best))


# ------------------------------------------------------------------------------- experiment
def _experiment(cfg):
    """The whole experiment on F5: raw and processed test metrics and their difference."""
    def run(spark, sf):
        from . import workflow as wf
        df = f5(spark, sf).drop("is_test", "label")
        return wf.run(df, "planted", "id", getattr(wf, cfg))["comparison"]
    return run


query("wf_full")(_experiment("FULL"))
query("wf_production")(_experiment("PRODUCTION"))
