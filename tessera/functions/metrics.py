"""Classification metrics (MT1-MT3) as aggregates.

MT1 is one aggregate of four conditional counts.  MT2 (ROC-AUC, ties count one half) is
computed exactly from per-score positive/negative counts and distributed running sums of
negatives — no global sort in one task and no binning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .kinds import q
from .prefix import running_totals


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    y, p = q(label).cast("int"), q(prediction).cast("int")
    return df.agg(F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
                  F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
                  F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"),
                  F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"))


def _safe(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """MT1 — one row: accuracy, precision, recall, f1 (zero denominators give 0)."""
    c = confusion_counts(df, label, prediction)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    prec = _safe(tp, tp + fp)
    rec = _safe(tp, tp + fn)
    return c.select("tp", "fp", "tn", "fn",
                    _safe(tp + tn, tp + fp + tn + fn).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"),
                    _safe(F.lit(2.0) * prec * rec, prec + rec).alias("f1"))


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """MT1 — (label, prediction, n)."""
    return df.groupBy(q(label).cast("int").alias("label"), q(prediction).cast("int").alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """MT2 — exact ROC-AUC = P(score+ > score-) + P(=)/2, one row ``auc``."""
    y = q(label).cast("int")
    g = (df.filter(q(score).isNotNull() & y.isNotNull())
         .groupBy(q(score).cast("double").alias("s"))
         .agg(F.sum((y == 1).cast("long")).alias("pos"), F.sum((y == 0).cast("long")).alias("neg")))
    r = running_totals(stage_table(g), ["s"], ["neg"])  # scores are computed once, a range shuffle reads twice
    below = F.col("cum_neg") - F.col("neg")
    part = r.agg(F.sum(F.col("pos") * (below + F.col("neg") * 0.5)).alias("num"),
                 F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return part.select(F.try_divide(F.col("num"), F.col("P").cast("double") * F.col("N")).alias("auc"))


def compare_metrics(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """MT3 — one row per metric: raw, processed, diff and direction (up/down/equal).
    Inputs are one-row metric tables with the same metric columns."""
    metrics = [c for c in raw.columns if c in processed.columns and c not in ("tp", "fp", "tn", "fn")]

    def longf(df, name):
        return df.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(name))
                                              for m in metrics])))
    j = longf(raw, "raw").join(longf(processed, "processed"), "metric")
    d = F.col("processed") - F.col("raw")
    return j.select("metric", "raw", "processed", d.alias("diff"),
                    F.when(d > 0, "up").when(d < 0, "down").otherwise("equal").alias("direction"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """ML7 — 'balanced' weights n / (k * n_c) per class: (label, n, weight)."""
    c = df.groupBy(q(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    tot = c.agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("k")).first()
    return c.withColumn("weight", F.lit(float(tot["t"])) / (F.lit(float(tot["k"])) * F.col("n")))


def with_weights(df: DataFrame, label: str, out_col: str = "weight") -> DataFrame:
    """Attach balanced weights through a small literal map (classes are few)."""
    w = {r["label"]: r["weight"] for r in class_weights(df, label).collect()}
    m = F.create_map(*[x for k, v in w.items() if k is not None for x in (F.lit(k), F.lit(v))])
    return df.withColumn(out_col, m[q(label)])
