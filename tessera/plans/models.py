"""Models and model-based selection on ``pyspark.ml`` (ML1-ML10, FS4, FS5, FS7-FS9,
IB10, IB11).

Model profiles re-express the reference's estimators with Spark's distributed learners;
the external boosting engines become ``GBTClassifier`` profiles.  Metrics are the exact
aggregates of ``functions.metrics`` (AUC without binning).  Permutation importance moves
each row once for all features and repeats and ends in one grouped AUC.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.forest import Forest, Grown, fit_forests, held_scores
from ..functions.kinds import numeric_columns, q, sql_double, sql_name
from ..functions.metrics import classification_metrics, roc_auc, with_weights
from ..functions.prefix import running_totals
from ..functions.stats import medians
from ..operators.select import FittedSelection, HighMissing, LowVariance, MutualInfo, correlated_drops, filled_sql
from ..operators.split import fold_column, hash_key
from ..session import concurrently, cut_lineage, free, stage_table

FEATURES = "features"
WATCHED = "is_watched"  # validation rows of a boosted fit


FULL_DEPTH = 30  # Spark's ceiling: the forests of selection and resampling set no depth


def _with(estimator, overrides: dict):
    """The estimator with keyword overrides of its own parameters; unknown ones raise."""
    unknown = [k for k in overrides if not estimator.hasParam(k)]
    if unknown:
        raise TypeError(f"{type(estimator).__name__} has no parameters {unknown}")
    return estimator.setParams(**overrides) if overrides else estimator


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="keep")


#: Tree learners run a job per level; a task of such a job gets at least so many rows where the
#: table has them, and more than so many only when every core has a task.
ROWS_PER_TASK = 20_000
MOST_ROWS_PER_TASK = 1_000_000


def _fit_parts(n: int, cores: int) -> int:
    """Partitions of a fit.  Every task of a level sends statistics of all nodes, whatever its rows:
    more tasks than cores only add to what is shuffled."""
    return max(1, min(-(-n // ROWS_PER_TASK), max(cores, -(-n // MOST_ROWS_PER_TASK))))


def _fit(estimator, df: DataFrame, n_rows: int | None = None):
    """Fit on as many partitions as the rows fill, up to one a core."""
    n = df.count() if n_rows is None else n_rows
    parts = _fit_parts(n, df.sparkSession.sparkContext.defaultParallelism)
    return _without_summary(estimator.fit(df.coalesce(parts) if parts <= df.rdd.getNumPartitions() else df.repartition(parts)))


def _without_summary(model):
    """The fitted model without its training summary.  Scoring sends the model to the tasks, and the
    summary holds the session, which cannot be sent once anything in it was observed."""
    for stage in getattr(model, "stages", [model]):
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return model


# ----------------------------------------------------------------------------- ML1-ML6
def logistic(label: str, features: Sequence[str], n_rows: int | None = None, C: float = 1.0, **overrides):
    """ML1 — L2 logistic regression, C = 1, 1000 iterations, balanced weights."""
    reg = 1.0 / (C * n_rows) if n_rows else 0.0
    lr = LogisticRegression(featuresCol=FEATURES, labelCol=label, weightCol="weight", maxIter=1000,
                            regParam=reg, elasticNetParam=0.0, standardization=False)
    return Pipeline(stages=[_assembler(features), _with(lr, overrides)])


def random_forest(label: str, features: Sequence[str], num_trees: int = 100, max_depth: int = 10,
                  seed: int = 42, weighted: bool = True, min_leaf: int = 2, n_rows: int | None = None, **overrides):
    """ML2 — 100 trees, depth 10, at least 2 rows per leaf, balanced weights.  Rows keep the ids of
    their nodes: without, each level's tasks get a copy of all trees grown so far."""
    rf = RandomForestClassifier(featuresCol=FEATURES, labelCol=label, numTrees=num_trees, maxDepth=max_depth,
                                minInstancesPerNode=min_leaf, seed=seed, cacheNodeIds=True, **({"weightCol": "weight"} if weighted else {}))
    return Pipeline(stages=[_assembler(features), _with(rf, overrides)])


def plain_forest(label: str, features: Sequence[str], num_trees: int = 50, seed: int = 42,
                 max_depth: int = FULL_DEPTH, min_leaf: int = 1):
    """Unweighted forest of feature selection and resampler comparison: no depth or leaf
    bound of its own (``max_depth`` and ``min_leaf`` set one for very large tables)."""
    return random_forest(label, features, num_trees, max_depth, seed, weighted=False, min_leaf=min_leaf)


def gradient_boosting(label: str, features: Sequence[str], max_iter: int = 100, step: float = 0.1,
                      max_depth: int = 3, seed: int = 42, n_rows: int | None = None, **overrides):
    """ML3 — 100 rounds, learning rate 0.1, depth 3."""
    gbt = GBTClassifier(featuresCol=FEATURES, labelCol=label, maxIter=max_iter, stepSize=step,
                        maxDepth=max_depth, seed=seed)
    return Pipeline(stages=[_assembler(features), _with(gbt, overrides)])


def boosting_xgb(label: str, features: Sequence[str], seed: int = 42, n_rows: int | None = None, **overrides):
    """ML4 — "xgb" profile: 100 rounds, depth 6, lr 0.1, row and column subsample 0.8."""
    gbt = GBTClassifier(featuresCol=FEATURES, labelCol=label, maxIter=100, stepSize=0.1, maxDepth=6,
                        subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed)
    return Pipeline(stages=[_assembler(features), _with(gbt, overrides)])


def boosting_lgbm(label: str, features: Sequence[str], seed: int = 42, n_rows: int | None = None, **overrides):
    """ML5 — "lgbm" profile: 100 rounds, at most 32 leaves (depth 5), lr 0.1, row and column
    subsample 0.8."""
    gbt = GBTClassifier(featuresCol=FEATURES, labelCol=label, maxIter=100, stepSize=0.1, maxDepth=5,
                        subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed)
    return Pipeline(stages=[_assembler(features), _with(gbt, overrides)])


def boosting_cat(label: str, features: Sequence[str], categorical: Sequence[str] = (), cardinality: int = 0,
                 seed: int = 42, max_iter: int = 100, n_rows: int | None = None, **overrides):
    """ML6 — "cat" profile: 100 rounds, depth 6, lr 0.1, 128 bins, balanced weights, native
    categorical splits (string columns indexed with an 'unknown' slot).  ``cardinality``:
    the largest number of categories; ``train_model`` takes it from the fitted indexers."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep") for c in categorical]
    feats = [f for f in features if f not in categorical] + [f"{c}__idx" for c in categorical]
    gbt = GBTClassifier(featuresCol=FEATURES, labelCol=label, maxIter=max_iter, stepSize=0.1, maxDepth=6,
                        maxBins=max(128, cardinality + 2), weightCol="weight", seed=seed)
    return Pipeline(stages=[*idx, _assembler(feats), _with(gbt, overrides)])


PROFILES: dict[str, Callable] = {
    "LogisticRegression": logistic,
    "RandomForest": random_forest,
    "GradientBoosting": gradient_boosting,
    "XGBoost": boosting_xgb,
    "LightGBM": boosting_lgbm,
    "CatBoost": boosting_cat,
}
SKLEARN_LIKE = ["LogisticRegression", "RandomForest", "GradientBoosting"]
BOOSTING = ["XGBoost", "LightGBM", "CatBoost"]


# ----------------------------------------------------------------------------- ML8 / MT
def score_column(pred: DataFrame) -> DataFrame:
    return pred.withColumn("score", vector_to_array("probability")[1])


def evaluate(model: PipelineModel, df: DataFrame, label: str) -> dict:
    """MT1 + MT2 on a fitted model: accuracy, precision, recall, f1, auc."""
    return _metrics(score_column(model.transform(df)).select(q(label).alias("y"), "prediction", "score"))


def _metrics(scored: DataFrame) -> dict:
    p = cut_lineage(scored)
    m = classification_metrics(p, "y", "prediction").first().asDict()
    m["auc"] = roc_auc(p, "y", "score").first()["auc"]
    return {k: m[k] for k in ("accuracy", "precision", "recall", "f1", "auc")}


def train_model(name: str, train: DataFrame, label: str, features: Sequence[str], validation: DataFrame | None = None,
                **kw) -> tuple[PipelineModel, dict]:
    """ML8 — fit (balanced weights attached), with validation metrics where a validation frame is
    given.  Boosted profiles then watch its loss inside the fit: they stop when it rises and keep
    the trees up to the best iteration; ``info`` has the loss per kept iteration (``history``),
    their number (``iterations``) and the loss at the last of them (``best_loss``)."""
    tr = with_weights(train, label)
    n = tr.count()
    if PROFILES[name] is not boosting_cat:  # the only profile with native categorical splits
        kw = {k: v for k, v in kw.items() if k not in ("categorical", "cardinality")}
    elif kw.get("categorical") and not kw.get("cardinality"):
        cats = list(kw["categorical"])
        fitted = StringIndexer(inputCols=cats, outputCols=[f"{c}__n" for c in cats], handleInvalid="keep").fit(tr)
        kw = kw | {"cardinality": max(len(x) for x in fitted.labelsArray)}
    pipe = PROFILES[name](label, features, n_rows=n, **kw)
    boosted = validation is not None and isinstance(pipe.getStages()[-1], GBTClassifier) and not validation.isEmpty()
    if not boosted:
        model = _fit(pipe, tr, n)
        return model, {} if validation is None else {"validation": evaluate(model, validation, label)}
    watched = cut_lineage(validation.withColumn("weight", F.lit(1.0)))
    steps = _fit(Pipeline(stages=pipe.getStages()[:-1]), tr, n)  # indexers learn from the train part alone
    gbt = pipe.getStages()[-1].setParams(validationIndicatorCol=WATCHED, validationTol=0.0)
    rows = steps.transform(tr).withColumn(WATCHED, F.lit(False)).unionByName(
        steps.transform(watched).withColumn(WATCHED, F.lit(True)))
    trees = _fit(gbt, rows.select(q(label).cast("double").alias(label), FEATURES, "weight", WATCHED), n)
    model = PipelineModel(stages=[*steps.stages, trees])
    history = trees.evaluateEachIteration(steps.transform(watched).select(q(label).cast("double").alias(label), FEATURES, "weight"))
    return model, {"validation": evaluate(model, watched, label), "history": history,
                   "iterations": len(history), "best_loss": history[-1]}


def compare_models(names: Sequence[str], train: DataFrame, test: DataFrame, label: str,
                   features: Sequence[str], **kw) -> tuple[DataFrame, dict]:
    """ML9 — fit and evaluate each profile; table sorted by F1 desc (ties by name)."""
    spark = train.sparkSession

    def run(name: str):
        model, _ = train_model(name, train, label, features, **kw)
        return model, evaluate(model, test, label)
    done = concurrently([partial(run, nm) for nm in names], width=len(PROFILES))
    models = {nm: model for nm, (model, _) in zip(names, done)}
    rows = [(nm, *[float(m[k]) if m[k] is not None else None for k in ("accuracy", "precision", "recall", "f1", "auc")])
            for nm, (_, m) in zip(names, done)]
    t = spark.createDataFrame(rows, "model string, accuracy double, precision double, recall double, f1 double, auc double")
    return t.orderBy(F.desc("f1"), "model"), models


def find_best_model(train: DataFrame, validation: DataFrame, label: str, features: Sequence[str],
                    models_to_try: str | Sequence[str] = "all", **kw) -> tuple[str, PipelineModel, DataFrame]:
    """ML10 — choose by F1 on a VALIDATION frame; 'all' | 'sklearn' | 'boosting' | names."""
    if models_to_try == "all":
        names = list(PROFILES)
    elif models_to_try == "sklearn":
        names = SKLEARN_LIKE
    elif models_to_try == "boosting":
        names = BOOSTING
    elif isinstance(models_to_try, str):
        raise ValueError(f"unknown selector {models_to_try!r}")
    else:
        unknown = [m for m in models_to_try if m not in PROFILES]
        if unknown:
            raise ValueError(f"unknown models {unknown}")
        names = list(models_to_try)
    table, models = compare_models(names, train, validation, label, features, **kw)
    best = table.first()["model"]
    return best, models[best], table


# ----------------------------------------------------------------------------- FS4 / FS5
def rf_importance(df: DataFrame, label: str, features: Sequence[str], num_trees: int = 50,
                  seed: int = 42, max_depth: int = FULL_DEPTH) -> tuple[DataFrame, Forest]:
    """FS4 — impurity importances of a 50-tree forest: (feature, importance).  Its trees grow in tasks
    (``functions.forest``) and never reach the driver."""
    (imp,), table, cuts = fit_forests(df, label, features, [Grown(tuple(range(len(features))))], num_trees, seed, max_depth, keep=True)
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    return (df.sparkSession.createDataFrame(rows, "feature string, importance double"),
            Forest(table.filter("tree >= 0"), cuts, features, num_trees))


def select_by_rf(df: DataFrame, label: str, features: Sequence[str], threshold="auto") -> FittedSelection:
    imp, model = rf_importance(df, label, features)
    vals = {r["feature"]: r["importance"] for r in imp.collect()}
    mean = sum(vals.values()) / max(len(vals), 1)
    t = 0.3 * mean if threshold == "auto" else (mean if threshold == "mean" else float(threshold))
    kept = [f for f in features if vals[f] > t]
    return FittedSelection(kept, [f for f in features if f not in kept], imp, {"importance": vals, "threshold": t, "model": model})


def roc_auc_grouped(df: DataFrame, groups: Sequence[str], label: str, score: str) -> DataFrame:
    """Exact AUC per group: running negatives over (group..., score), rebased per group."""
    y = q(label).cast("int")
    return _auc_of_counts(df.groupBy(*groups, q(score).cast("double").alias("s"))
                          .agg(F.sum((y == 1).cast("long")).alias("pos"), F.sum((y == 0).cast("long")).alias("neg")), groups)


def _auc_of_counts(g: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Exact AUC per group of (group..., s, pos, neg), each score s of a group once."""
    r = running_totals(stage_table(g), [*groups, "s"], ["neg"])  # scores are computed once, a range shuffle reads twice
    base = r.groupBy(*groups).agg(F.min(F.col("cum_neg") - F.col("neg")).alias("base"))
    r = r.join(base, list(groups))
    below = F.col("cum_neg") - F.col("neg") - F.col("base")
    return (r.groupBy(*groups).agg(F.sum(F.col("pos") * (below + F.col("neg") * 0.5)).alias("num"),
                                   F.sum("pos").alias("P"), F.sum("neg").alias("N"))
            .select(*groups, F.try_divide(F.col("num"), F.col("P").cast("double") * F.col("N")).alias("auc")))


#: Doubles held by one block of the permutation (its rows times its features).
BLOCK_VALUES = 4_000_000


def permutation_importance(model: PipelineModel | Forest, df: DataFrame, label: str, id_col: str,
                           features: Sequence[str], n_repeats: int = 5, seed: int = 42) -> DataFrame:
    """FS5 — mean and std over repeats of the AUC drop when one feature is permuted:
    (feature, importance_mean, importance_std).

    Rows get a seeded random order; in repeat r a row takes the feature's value from the row
    r + 1 places further on (cyclic), which is a random derangement.  The order is cut into
    blocks and each block also gets the first few rows of the next one, so rows move once,
    whatever the number of repeats and features; copies for scoring arise inside the tasks as
    vectors and leave them only as (feature, repeat, score) counts of the grouped exact AUC."""
    if isinstance(model, Forest):
        order = model.features
    else:
        for stage in model.stages[:-2]:  # indexers of categorical columns
            df = stage.transform(df)
        order = model.stages[-2].getInputCols()
    width = len(order)
    x = F.expr("array(" + ", ".join(f"coalesce(cast({sql_name(c)} AS double), {sql_double(float('nan'))})" for c in order) + ")")
    base = df.select(hash_key(id_col, seed, "perm").alias("h"), q(id_col).alias("id"), q(label).cast("int").alias("y"), x.alias("x"))
    ranked = cut_lineage(running_totals(base, ["h", "id"], []).select("y", "x", (F.col("__rank") - 1).alias("place")))
    n = ranked.count()
    if n == 0:
        return df.sparkSession.createDataFrame([], "feature string, importance_mean double, importance_std double")
    shifts = [1 + r % max(n - 1, 1) for r in range(n_repeats)]
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    size = max(min(BLOCK_VALUES // max(width, 1), -(-n // tasks)), max(shifts))
    last = max(n // size, 1) - 1  # a short rest belongs to the last block
    block = F.least(F.floor(F.col("place") / F.lit(size)), F.lit(last))
    at = F.col("place") - block * F.lit(size)
    own = ranked.select("y", "x", block.alias("block"), F.col("place").alias("at"), F.lit(True).alias("own"))
    guests = (ranked.filter(at < F.lit(max(shifts)))
              .select("y", "x", F.when(block > 0, block - 1).otherwise(F.lit(last)).alias("block"),
                      F.when(block > 0, F.col("place")).otherwise(F.col("place") + F.lit(n)).alias("at"), F.lit(False).alias("own")))
    w = Window.partitionBy("block").orderBy("at")
    met = own.unionByName(guests).select("y", "x", "own", F.array(*[F.lead("x", s).over(w) for s in shifts]).alias("donors")).filter("own")
    names = F.array(*[F.lit(c) for c in features])
    if isinstance(model, Forest):
        counts = model.score_counts(met, n, features, n_repeats).groupBy("f", "rep", "s").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        aucs = cut_lineage(_auc_of_counts(counts, ["f", "rep"]))
        base_auc = F.lit(aucs.filter("f < 0").first()["auc"])
        return _drops(aucs.filter("f >= 0"), base_auc, names)
    places = {c: i for i, c in enumerate(order)}
    index = [places[c] if c in places else places[f"{c}__idx"] for c in features]
    combos = F.array(*[F.struct(F.lit(j).alias("f"), F.lit(i).alias("i"), F.lit(r).alias("rep"))
                       for j, i in enumerate(index) for r in range(n_repeats)])
    long = met.select("y", "x", "donors", F.inline(combos))
    i, value = F.col("i"), F.col("donors")[F.col("rep")][F.col("i")]
    swapped = F.concat(F.slice("x", F.lit(1), i), F.array(value), F.slice("x", i + 2, F.lit(width)))
    scored = score_column(model.stages[-1].transform(long.select("f", "rep", "y", array_to_vector(swapped).alias(FEATURES))))
    aucs = roc_auc_grouped(scored.select("f", "rep", "y", "score"), ["f", "rep"], "y", "score")
    plain = model.stages[-1].transform(ranked.select("y", array_to_vector("x").alias(FEATURES)))
    base_auc = F.lit(roc_auc(score_column(plain).select("y", "score"), "y", "score").first()["auc"])
    return _drops(aucs, base_auc, names)


def _drops(aucs: DataFrame, base_auc, names) -> DataFrame:
    return (aucs.groupBy("f").agg((base_auc - F.avg("auc")).alias("importance_mean"),
                                  F.stddev_pop(base_auc - F.col("auc")).alias("importance_std"))
            .select(names[F.col("f")].alias("feature"), "importance_mean", "importance_std"))


# ----------------------------------------------------------------------------- FS7-FS9
def _cv_aucs(folded: DataFrame, label: str, sets: Sequence[Sequence[str]], k: int, num_trees: int, seed: int) -> list[float]:
    """Mean AUC over the k folds of a forest over each feature set; all forests grow in one job."""
    features = list(dict.fromkeys(f for s in sets for f in s))
    place = {f: i for i, f in enumerate(features)}
    forests = [Grown(tuple(place[f] for f in s), i) for s in sets for i in range(k)]
    _, table, _ = fit_forests(folded, label, features, forests, num_trees, seed, FULL_DEPTH, part=F.col("fold"))
    found = {r["forest"]: r["auc"] for r in roc_auc_grouped(held_scores(table, num_trees), ["forest"], "y", "score").collect()}
    free(table)
    return [sum(found[j * k + i] for i in range(k)) / k for j in range(len(sets))]


def cv_auc(df: DataFrame, label: str, id_col: str, features: Sequence[str], k: int = 3,
           num_trees: int = 50, seed: int = 42) -> float:
    """Mean AUC over k stratified hash folds of a forest; ``df`` may hold its ``fold`` already."""
    folded = df if "fold" in df.columns else cut_lineage(fold_column(df, label, id_col, k, seed))
    return _cv_aucs(folded, label, [features], k, num_trees, seed)[0]


def validate_feature_set(df: DataFrame, label: str, id_col: str, all_features: Sequence[str],
                         selected: Sequence[str], quality_loss: float = 0.05, shared: dict | None = None) -> dict:
    """FS7 — 3-fold CV AUC of a 50-tree forest with all vs selected features; accepted when
    the relative loss is at most ``quality_loss``; skipped when nothing was removed.  ``shared``
    as in ``select_features``."""
    if set(selected) == set(all_features):
        return {"skipped": True, "accepted": True}
    shared = {} if shared is None else shared
    folded = _once(shared, "folds", lambda: cut_lineage(fold_column(df, label, id_col, 3, 42)))
    sets = [tuple(all_features), tuple(selected)]
    new = [f for f in sets if ("auc", f) not in shared]
    if new:
        shared.update(zip([("auc", f) for f in new], _cv_aucs(folded, label, new, 3, 50, 42)))
    a, s = [shared["auc", f] for f in sets]
    loss = (a - s) / a if a else 0.0
    return {"skipped": False, "auc_all": a, "auc_selected": s, "loss": loss, "accepted": loss <= quality_loss}


def _once(shared: dict, key, make: Callable):
    if key not in shared:
        shared[key] = make()
    return shared[key]


PRESETS = {
    "fast": {"use_permutation": False, "corr_threshold": 0.95, "max_features": 50, "quality_loss": 0.05},
    "accurate": {"use_permutation": True, "corr_threshold": 0.95, "max_features": None, "quality_loss": 0.0},
    "aggressive": {"use_permutation": False, "corr_threshold": 0.8, "max_features": 20, "quality_loss": 0.1},
}


def select_features(df: DataFrame, label: str, id_col: str, features: Sequence[str] | None = None,
                    variance_threshold: float = 0.0, missing_threshold: float = 0.9, mi_threshold: float = 0.001,
                    rf_threshold="auto", use_permutation: bool = True, corr_threshold: float = 0.95,
                    max_features: int | None = None, quality_loss: float | None = 0.05, validate: bool = True,
                    rank_by: str = "rf", use_mi: bool = True, use_rf: bool = True, remove_correlated: bool = True,
                    perm_threshold: float = 0.0, perm_repeats: int = 5, shared: dict | None = None) -> dict:
    """FS8 — low variance -> high missing -> median fill -> union of MI / forest / permutation
    picks -> correlated removal -> top ``max_features`` by the ``rank_by`` importance ->
    validation with fallback to all features (``quality_loss`` None: none).  Every step has a
    switch; with no picking step on, all features go on.  When nothing is left after the first
    two filters, or nothing is picked, the result says so and selects nothing.  The kept list
    is in schema order; importances are kept per method.  ``shared``: results of the
    steps so far over the same frame, label and id; a step with the same features and parameters is not
    run again."""
    shared = {} if shared is None else shared
    feats = list(features) if features is not None else numeric_columns(df, (label, id_col))
    f1 = _once(shared, ("variance", variance_threshold, *feats), lambda: LowVariance(variance_threshold, feats).fit(df))
    varied = f1.kept
    f2 = _once(shared, ("missing", missing_threshold, *varied), lambda: HighMissing(missing_threshold, varied).fit(df))
    feats = f2.kept
    result = {"selected": [], "importances": {}, "dropped_low_variance": f1.dropped, "dropped_missing": f2.dropped, "dropped_correlated": []}
    if not feats:
        return result | {"empty": "every feature has low variance or too many missing values"}

    def filled():
        med = medians(df, feats)
        return cut_lineage(df.selectExpr(sql_name(id_col), sql_name(label), *[f"{filled_sql(c, med[c])} AS {sql_name(c)}" for c in feats]))
    mine = shared.setdefault(("filled", *feats), {})  # what follows depends on these features
    data = _once(mine, "data", filled)
    picked, imps = set(), {}
    if use_mi:
        mi = _once(mine, ("mi", mi_threshold), lambda: MutualInfo(label, mi_threshold, feats).fit(data))
        picked |= set(mi.kept)
        imps["mi"] = mi.info["mi"]
    model = None
    if use_rf or use_permutation:
        rf = _once(mine, ("rf", rf_threshold), lambda: select_by_rf(data, label, feats, rf_threshold))
        model, imps["rf"] = rf.info["model"], rf.info["importance"]
        if use_rf:
            picked |= set(rf.kept)
    if use_permutation:
        perm = _once(mine, ("permutation", rf_threshold, perm_repeats), lambda: {r["feature"]: r["importance_mean"] for r in permutation_importance(
            model, data, label, id_col, feats, n_repeats=perm_repeats).collect()})
        imps["permutation"] = perm
        picked |= {f for f, v in perm.items() if v is not None and v > perm_threshold}
    cand = [f for f in feats if f in picked] if use_mi or use_rf or use_permutation else list(feats)
    if not cand:
        return result | {"importances": imps, "empty": "no feature was picked"}
    rank = imps.get(rank_by) or imps.get("rf") or imps.get("mi") or {}
    imp_df = df.sparkSession.createDataFrame([(f, float(rank.get(f, 0.0) or 0.0)) for f in cand],
                                             "feature string, importance double")
    drops = {r["feature"] for r in correlated_drops(data, cand, imp_df, corr_threshold).collect()} if remove_correlated and len(cand) > 1 else set()
    cand = [f for f in cand if f not in drops]
    if max_features is not None and len(cand) > max_features:
        top = sorted(cand, key=lambda f: (-(rank.get(f, 0.0) or 0.0), f))[:max_features]
        cand = [f for f in cand if f in top]
    result = {"selected": cand, "importances": imps, "dropped_low_variance": f1.dropped,
              "dropped_missing": f2.dropped, "dropped_correlated": sorted(drops)}
    if validate and quality_loss is not None and cand:
        v = validate_feature_set(data, label, id_col, feats, cand, quality_loss, mine)
        result["validation"] = v
        if not v["accepted"]:
            result["selected"] = feats
    return result


def select_features_preset(df: DataFrame, label: str, id_col: str, preset: str = "fast", **kw) -> dict:
    """FS9 — presets fast / accurate / aggressive."""
    if preset not in PRESETS:
        raise ValueError(f"unknown preset {preset!r}")
    args = dict(PRESETS[preset])
    args.update(kw)
    return select_features(df, label, id_col, **args)


# ----------------------------------------------------------------------------- IB10 / IB11
def compare_resamplers(train: DataFrame, validation: DataFrame, label: str, id_col: str,
                       features: Sequence[str], methods: Sequence[str] | None = None, scoring: str = "f1",
                       num_trees: int = 100, seed: int = 42) -> DataFrame:
    """IB10 — per method: resample the train part, fit a forest, report train size,
    class counts and validation metrics; sorted by ``scoring`` (then method name).
    A failing method is reported with its error and no metrics."""
    from ..operators.resample import RESAMPLERS
    spark = train.sparkSession

    def score(name: str) -> tuple:
        try:
            res = cut_lineage(RESAMPLERS[name](train, label, id_col, list(features)))
            counts = {r[0]: r[1] for r in res.groupBy(q(label)).count().collect()}
            rows = res.select(q(label), *map(q, features), F.lit(0).alias("held")).unionByName(validation.select(q(label), *map(q, features), F.lit(1).alias("held")))
            _, table, _ = fit_forests(rows, label, features, [Grown(tuple(range(len(features))), 1)], num_trees, seed, FULL_DEPTH, part=F.col("held"))
            ev = _metrics(held_scores(table, num_trees).select("y", (F.col("score") > 0.5).cast("double").alias("prediction"), "score"))
            free(table)
            return (name, sum(counts.values()), counts.get(1, 0), counts.get(0, 0),
                    *[float(ev[k]) if ev[k] is not None else None for k in ("f1", "recall", "precision", "auc")], None)
        except Exception as e:  # noqa: BLE001 - reported, as the reference does
            return (name, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}"[:200])
    rows = concurrently([partial(score, name) for name in (methods or list(RESAMPLERS))])
    t = spark.createDataFrame(rows, "method string, train_size long, n_pos long, n_neg long, f1 double, "
                                    "recall double, precision double, auc double, error string")
    return t.orderBy(F.desc_nulls_last("auc" if scoring == "roc_auc" else scoring), "method")


def auto_select_resampler(train: DataFrame, validation: DataFrame, label: str, id_col: str,
                          features: Sequence[str], quick_mode: bool = True, seed: int = 42) -> tuple[str, DataFrame]:
    """IB11 — 4 (quick) or 9 methods with a 50-tree forest; the highest F1 wins, the first
    listed on ties; "Original" returns the identity resampler."""
    from ..operators.resample import QUICK, RESAMPLERS
    methods = QUICK if quick_mode else list(RESAMPLERS)
    t = compare_resamplers(train, validation, label, id_col, features, methods, "f1", num_trees=50, seed=seed)
    scores = {r["method"]: r["f1"] for r in t.collect()}
    best, best_f1 = "Original", None
    for m in methods:
        f = scores.get(m)
        if f is not None and (best_f1 is None or f > best_f1):
            best, best_f1 = m, f
    return best, t
