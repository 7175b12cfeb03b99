"""End-to-end experiment configurations: "full" and "production".

The train/test split comes first (stratified, exact); every later step is fitted on the
train part only, and model/resampler choices are made on a validation part cut from train
(never on test).  Each stage is optional through the configuration.  Returns the raw and
processed test metrics and their comparison table (MT3).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.kinds import categorical_columns, numeric_columns
from ..functions.metrics import compare_metrics
from ..operators import categories as ct
from ..operators import encode as en
from ..operators import outliers as od
from ..operators.features import DomainFeatures, Interactions
from ..operators.neighbour_ops import KNNImpute
from ..operators.resample import RESAMPLERS
from ..operators.split import stratified_split
from ..session import concurrently, cut_lineage
from . import models as ml


@dataclass
class Config:
    model: str = "CatBoost"
    mad_outliers: bool = True            # drop train rows, cap test (Entry A); off in production
    cap_exclude: tuple = ()
    categorical_outliers: bool = True
    knn_impute: bool = True
    domain: tuple | None = None          # columns of FE1: flag, flag, tenure, monthly, total
    interactions: bool = True
    select: bool = True
    select_preset: str | None = None     # None: the full selection (FS8)
    resample: bool = True
    quick_resample: bool = True
    test_size: float = 0.2
    seed: int = 42
    model_kw: dict = field(default_factory=dict)


DOMAIN = ("urgent", "fulfilled", "tenure", "monthly_charges", "total_charges")
FULL = Config(cap_exclude=DOMAIN[2:], domain=DOMAIN)
PRODUCTION = Config(mad_outliers=False, domain=DOMAIN)


def _metrics_frame(spark, m: dict) -> DataFrame:
    return spark.createDataFrame([tuple(float(m[k]) if m[k] is not None else None
                                        for k in ("accuracy", "precision", "recall", "f1", "auc"))],
                                 "accuracy double, precision double, recall double, f1 double, auc double")


def run(df: DataFrame, label: str, id_col: str, cfg: Config = PRODUCTION) -> dict:
    split = cut_lineage(stratified_split(df, label, id_col, cfg.test_size, cfg.seed))
    target = en.EncodeTarget(label, out_col="__y").fit(split.filter(~F.col("is_test")))
    data = target.transform(split).drop(label).withColumnRenamed("__y", label)
    train, test = data.filter(~F.col("is_test")).drop("is_test"), data.filter("is_test").drop("is_test")
    raw, out = concurrently([partial(raw_experiment, train, test, label, id_col, cfg),
                             partial(processed_experiment, train, test, label, id_col, cfg)])
    spark = df.sparkSession
    table = compare_metrics(_metrics_frame(spark, raw), _metrics_frame(spark, out["processed"]))
    return out | {"raw": raw, "comparison": table}


def raw_experiment(train: DataFrame, test: DataFrame, label: str, id_col: str, cfg: Config) -> dict:
    """Metrics on raw columns (native categorical splits); a missing number is placed below
    every observed value (the boosting library's default "Min" treatment)."""
    cats = categorical_columns(train, (label,))
    nums = numeric_columns(train, (label, id_col))
    lows = train.agg(*[(F.min(c) - F.lit(1.0)).alias(c) for c in nums]).first().asDict() if nums else {}
    model, _ = ml.train_model(cfg.model, train.fillna(lows), label, nums + cats, categorical=cats, **cfg.model_kw)
    return ml.evaluate(model, test.fillna(lows), label)


def processed_experiment(train: DataFrame, test: DataFrame, label: str, id_col: str, cfg: Config) -> dict:
    """Every configured stage fitted on the train part; metrics on the processed test part."""
    cats = categorical_columns(train, (label,))
    nums = numeric_columns(train, (label, id_col))
    if cfg.mad_outliers:
        b = od.MADOutliers(nums).fit(train)
        train, test = b.drop(train), b.cap(test, exclude=cfg.cap_exclude)
    if cfg.categorical_outliers and cats:
        f = ct.CategoricalTreatment("combined", cols=cats).fit(train)
        train, test = f.transform(train), f.transform(test)
    if cfg.knn_impute and nums:
        imp = KNNImpute(nums, id_col).fit(train)
        train, test = imp.transform(train), imp.transform(test)
    train, test = cut_lineage(train), cut_lineage(test)
    if cfg.domain:
        d = DomainFeatures(*cfg.domain).fit(train)
        train, test = d.transform(train), d.transform(test)
    if cfg.interactions:
        it = Interactions(exclude=(id_col, label), **Interactions.REFERENCE_LIMITS).fit(train)
        train, test = it.transform(train), it.transform(test)
    cats = categorical_columns(train, (label,))
    if cats:
        oh = en.OneHot(cats, drop="first").fit(train)
        train, test = oh.transform(train), oh.transform(test)
    train, test = cut_lineage(train), cut_lineage(test)
    feats = numeric_columns(train, (label, id_col))
    if cfg.select:
        pick = partial(ml.select_features_preset, preset=cfg.select_preset) if cfg.select_preset else ml.select_features
        sel = pick(train, label, id_col, features=feats)
        feats = sel["selected"]
    chosen = "Original"
    if cfg.resample:
        tv = cut_lineage(stratified_split(train, label, id_col, 0.2, cfg.seed, "is_valid"))
        tr, va = tv.filter(~F.col("is_valid")).drop("is_valid"), tv.filter("is_valid").drop("is_valid")
        chosen, _ = ml.auto_select_resampler(tr, va, label, id_col, feats, cfg.quick_resample, cfg.seed)
        train = cut_lineage(RESAMPLERS[chosen](train.select(id_col, label, *feats), label, id_col, feats))
    model, _ = ml.train_model(cfg.model, train, label, feats, categorical=[], **cfg.model_kw)
    return {"processed": ml.evaluate(model, test, label), "features": feats, "resampler": chosen}
