"""Profiling / EDA (PR1-PR12) as aggregate DataFrames.

Every report is computed with one fused aggregate per kind of statistic and reshaped
into long form with ``inline`` over a one-row result, so a report over p columns costs
one scan (two when exact percentiles are asked for with other moments).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dictionary import long_values
from ..functions.kinds import categorical_columns, is_numeric, numeric_columns, q
from ..functions.stats import EXACT, corr_long, quantiles
from ..session import cached


def shape(df: DataFrame) -> DataFrame:
    """PR1 — (n_rows, n_columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def head(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """PR1 — first rows; an explicit order makes it deterministic (TakeOrdered, no full sort)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def kind_of(df: DataFrame, c: str) -> str:
    dt = df.schema[c].dataType
    return "numeric" if is_numeric(dt) else ("categorical" if c in categorical_columns(df) else "other")


def schema_info(df: DataFrame) -> DataFrame:
    """PR2 / PR11 — per column: position, kind, Spark type and non-null count (one scan)."""
    cols = df.columns
    wide = df.agg(*[F.count(q(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                              F.lit(kind_of(df, c)).alias("kind"),
                              F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                              F.col(f"c{i}").alias("n_non_null")) for i, c in enumerate(cols)])
    return wide.select(F.inline(rows))


def null_report(df: DataFrame) -> DataFrame:
    """PR3 / PR5 — per column: total, non-null, null and null % rounded to 2 places."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(q(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                              F.lit(kind_of(df, c)).alias("kind"),
                              F.col(f"c{i}").alias("n_non_null")) for i, c in enumerate(cols)])
    out = wide.select(F.col("__n").alias("n_total"), F.inline(rows))
    n_null = F.col("n_total") - F.col("n_non_null")
    return out.select("position", "column", "kind", "n_total", "n_non_null", n_null.alias("n_null"),
                      F.bround(F.try_divide(n_null * 100.0, F.col("n_total")), 2).alias("pct_null"))


def describe(df: DataFrame, cols: Sequence[str] | None = None, method: str = EXACT) -> DataFrame:
    """PR4 — count, mean, std (sample), min, 25/50/75 % (linear interpolation), max."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        x = q(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    # exact quartiles with bounded memory (two more passes for all columns together)
    with cached(df, cols) as d:
        qs = quantiles(d, cols, [0.25, 0.5, 0.75], method)

    def lit(v):
        return F.lit(v).cast("double")
    rows = F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"m{i}").alias("mean"),
        F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"), lit(qs[c][0]).alias("p25"),
        lit(qs[c][1]).alias("p50"), lit(qs[c][2]).alias("p75"), F.col(f"hi{i}").alias("max"))
        for i, c in enumerate(cols)])
    return wide.select(F.inline(rows))


def corr_pairs(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """PR6 — Pearson r of every numeric pair (strict upper triangle), sorted descending."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    return corr_long(df, cols, "upper").orderBy(F.desc_nulls_last("r"), "a", "b")


def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """PR7 — full matrix in long form (a, b, r), diagonal included."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    return corr_long(df, cols, "all")


def corr_with_target(df: DataFrame, target: str, cols: Sequence[str] | None = None) -> DataFrame:
    """PR8 — (feature, r) against the target column, the target itself removed."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    return corr_long(df, cols, targets=[target]).select(F.col("a").alias("feature"), "r")


def top_correlated(df: DataFrame, target: str, k: int = 5, cols: Sequence[str] | None = None) -> DataFrame:
    """PR9 — the k features with the largest |r| (ties by name), ordered by signed r."""
    r = corr_with_target(df, target, cols).filter(F.col("r").isNotNull())
    top = r.orderBy(F.desc(F.abs("r")), "feature").limit(k)
    return top.orderBy(F.desc("r"), "feature")


def histogram(df: DataFrame, cols: Sequence[str] | None = None, bins: int = 10) -> DataFrame:
    """PR10 — equal-width bin counts per numeric column (last bin closed), in long form
    (column, bin, lo, hi, n); all columns in one min/max pass and one grouped count."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    mm = df.agg(*[F.min(q(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(cols)],
                *[F.max(q(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    items = []
    for i, c in enumerate(cols):
        lo, hi = mm[f"lo{i}"], mm[f"hi{i}"]
        if lo is None:
            continue
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        x = q(c).cast("double")
        b = F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(bins)) + 1, F.lit(bins)).cast("int")
        items.append(F.struct(F.lit(c).alias("column"), b.alias("bin"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")))
    if not items:
        return df.sparkSession.createDataFrame([], "column string, bin int, lo double, hi double, n bigint")
    long = df.select(F.inline(F.array(*items))).filter(F.col("bin").isNotNull())
    return long.groupBy("column", "bin", "lo", "hi").agg(F.count(F.lit(1)).alias("n"))


def value_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """PR10 for strings — (column, value, n) for every categorical column in one shuffle."""
    cols = list(cols) if cols is not None else categorical_columns(df)
    return long_values(df, cols, keep_nulls=False).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
