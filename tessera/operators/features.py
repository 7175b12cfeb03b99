"""Feature generation (FE1-FE6).

Statistics come from the fit frame; new columns are plain expressions or broadcast
lookups of size-checked dictionary tables, so transform is one narrow projection.
Group statistics for several category columns are computed with ONE shuffle over the
long (column, value) view.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dictionary import Dictionary, long_values, lookup
from ..functions.kinds import categorical_columns, numeric_columns, q
from ..functions.stats import EXACT, grouped_quantile, medians, quantiles
from ..session import cached
from .base import Fitted, Op


def _clip(x: Column, lo: float, hi: float) -> Column:
    """Null-preserving clip (bare greatest/least would turn null into a bound)."""
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))


# --------------------------------------------------------------------------- FE1
@dataclass
class FittedDomain(Fitted):
    flag_a: str
    flag_b: str
    monthly: str
    total: str
    tenure_median: float | None

    def transform(self, df: DataFrame) -> DataFrame:
        ltv = F.lit(self.tenure_median).cast("double") * q(self.monthly).cast("double")
        ratio = F.lit(1.0) - F.try_divide(q(self.total).cast("double"), ltv + F.lit(1e-6))
        return (df.withColumn("is_single", ((q(self.flag_a) == "No") & (q(self.flag_b) == "No")).cast("int"))
                  .withColumn("predict_LTV", ltv)
                  .withColumn("LTV_ratio", _clip(ratio, -1.0, 1.0)))


class DomainFeatures(Op):
    """FE1 — ``is_single``, ``predict_LTV = median_train(tenure) * monthly``,
    ``LTV_ratio = clip(1 - total / (predict_LTV + 1e-6), -1, 1)``."""

    def __init__(self, flag_a: str, flag_b: str, tenure: str, monthly: str, total: str):
        self.flag_a, self.flag_b, self.tenure, self.monthly, self.total = flag_a, flag_b, tenure, monthly, total

    def fit(self, df: DataFrame) -> FittedDomain:
        med = medians(df, [self.tenure])[self.tenure]
        return FittedDomain(self.flag_a, self.flag_b, self.monthly, self.total, med)


# --------------------------------------------------------------------------- FE2
@dataclass
class FittedProducts(Fitted):
    terms: list[tuple[str, ...]]

    def transform(self, df: DataFrame) -> DataFrame:
        new = {}
        for t in self.terms:
            e = q(t[0]).cast("double")
            for c in t[1:]:
                e = e * q(c).cast("double")
            new["_".join(t)] = e
        return df.withColumns(new) if new else df


class PolyFeatures(Op):
    """FE2 — interaction-only products (no squares, no bias), names ``a_b``; in
    combinations order; ``max_columns`` / ``max_features`` bound the columns taken from the
    schema and the products (default: all)."""

    def __init__(self, cols: Sequence[str] | None = None, degree: int = 2,
                 max_features: int | None = None, exclude: Sequence[str] = (), max_columns: int | None = None):
        self.cols, self.degree, self.max_features, self.exclude, self.max_columns = cols, degree, max_features, exclude, max_columns

    def fit(self, df: DataFrame) -> FittedProducts:
        cols = list(self.cols) if self.cols is not None else numeric_columns(df, self.exclude)[:self.max_columns]
        terms = []
        for d in range(2, self.degree + 1):
            terms += list(itertools.combinations(cols, d))
        return FittedProducts(terms[: self.max_features])


# --------------------------------------------------------------------------- FE3
@dataclass
class FittedGroupStats(Fitted):
    cat_cols: list[str]
    num_cols: list[str]
    table: Dictionary | None
    overall: dict  # (num, 'mean'|'median') -> value

    def transform(self, df: DataFrame) -> DataFrame:
        if self.table is None:
            return df
        stat_names = [f"__{s}{j}" for j in range(len(self.num_cols)) for s in ("mean", "median")]
        bc = self.table.local
        for cat in self.cat_cols:
            t = self.table.for_column(cat)
            df = lookup(df, q(cat).cast("string"), t, "value", stat_names, broadcast=bc)
            new = {}
            for j, num in enumerate(self.num_cols):
                new[f"{num}_mean_{cat}"] = F.coalesce(F.col(f"__mean{j}"), F.lit(self.overall[(num, "mean")]).cast("double"))
                new[f"{num}_median_{cat}"] = F.coalesce(F.col(f"__median{j}"), F.lit(self.overall[(num, "median")]).cast("double"))
            df = df.withColumns(new).drop(*stat_names)
        return df


class GroupStats(Op):
    """FE3 — ``{num}_mean_{cat}``, ``{num}_median_{cat}`` from train groups; unseen or null
    category -> overall train mean / median.  ``max_cats`` / ``max_nums`` bound the string and
    numeric columns taken from the schema (default: all)."""

    def __init__(self, cat_cols: Sequence[str] | None = None, num_cols: Sequence[str] | None = None,
                 exclude: Sequence[str] = (), quantile_method: str = EXACT, max_cats: int | None = None,
                 max_nums: int | None = None):
        self.cat_cols, self.num_cols, self.exclude = cat_cols, num_cols, exclude
        self.max_cats, self.max_nums = max_cats, max_nums
        self.quantile_method = quantile_method

    def fit(self, df: DataFrame) -> FittedGroupStats:
        cats = list(self.cat_cols) if self.cat_cols is not None else categorical_columns(df, self.exclude)[:self.max_cats]
        nums = list(self.num_cols) if self.num_cols is not None else numeric_columns(df, self.exclude)[:self.max_nums]
        if not cats or not nums:
            return FittedGroupStats(cats, nums, None, {})
        with cached(df, cats + nums) as d:
            return self._fit(d, cats, nums)

    def _fit(self, df: DataFrame, cats: list, nums: list) -> FittedGroupStats:
        orow = df.agg(*[F.avg(q(n)).alias(f"mean{j}") for j, n in enumerate(nums)]).first()
        meds = quantiles(df, nums, [0.5], self.quantile_method)
        overall = {}
        for j, n in enumerate(nums):
            overall[(n, "mean")] = orow[f"mean{j}"]
            overall[(n, "median")] = meds[n][0]
        long = long_values(df, cats, [q(n).cast("double").alias(f"__n{j}") for j, n in enumerate(nums)],
                           keep_nulls=False)
        means = long.groupBy("column", "value").agg(*[F.avg(f"__n{j}").alias(f"__mean{j}") for j in range(len(nums))])
        items = F.array(*[F.struct(F.lit(j).alias("__t"), F.col(f"__n{j}").alias("__x")) for j in range(len(nums))])
        mlong = long.select("column", "value", F.inline(items))
        med = grouped_quantile(mlong, ["column", "value", "__t"], "__x", 0.5, self.quantile_method)
        medw = med.groupBy("column", "value").pivot("__t", list(range(len(nums)))).agg(F.first("q"))
        medw = medw.select("column", "value", *[F.col(str(j)).alias(f"__median{j}") for j in range(len(nums))])
        table = means.join(medw, ["column", "value"], "left")
        return FittedGroupStats(cats, nums, Dictionary.materialise(table), overall)


# --------------------------------------------------------------------------- FE4
@dataclass
class FittedCatPairs(Fitted):
    pairs: list[tuple[str, str]]
    rare: Dictionary | None
    unseen: str = "keep"
    seen: Dictionary | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.pairs:
            return df
        df = df.withColumns({f"{a}_{b}": pair_expr(a, b) for a, b in self.pairs})
        for a, b in self.pairs:
            name = f"{a}_{b}"
            t = self.rare.for_column(name).select("value", F.lit(True).alias("__rare"))
            df = lookup(df, q(name), t, "value", ["__rare"], broadcast=self.rare.local, sparse=True)
            hit = F.col("__rare").isNotNull()
            if self.unseen == "other":
                s = self.seen.for_column(name).select("value", F.lit(True).alias("__seen"))
                df = lookup(df, q(name), s, "value", ["__seen"], broadcast=self.seen.local)
                hit = hit | F.col("__seen").isNull()
            df = df.withColumn(name, F.when(hit, F.lit("Other")).otherwise(q(name))).drop("__rare", "__seen")
        return df


def pair_expr(a: str, b: str) -> Column:
    """``str(a) + '_' + str(b)`` with a missing value spelled ``nan`` (pandas astype(str))."""
    return F.concat_ws("_", F.coalesce(q(a).cast("string"), F.lit("nan")),
                       F.coalesce(q(b).cast("string"), F.lit("nan")))


class CatPairs(Op):
    """FE4 — concatenated category pairs; pairs whose train share is below ``min_freq``
    become ``'Other'``; unseen test pairs are kept (``unseen='keep'``) or grouped."""

    def __init__(self, cat_cols: Sequence[str] | None = None, max_combos: int | None = None,
                 min_freq: float = 0.02, unseen: str = "keep", exclude: Sequence[str] = (), max_cats: int | None = None):
        self.cat_cols, self.max_combos, self.min_freq = cat_cols, max_combos, min_freq
        self.unseen, self.exclude, self.max_cats = unseen, exclude, max_cats

    def fit(self, df: DataFrame) -> FittedCatPairs:
        cats = list(self.cat_cols) if self.cat_cols is not None else categorical_columns(df, self.exclude)[:self.max_cats]
        pairs = list(itertools.combinations(cats, 2))[: self.max_combos]
        if not pairs:
            return FittedCatPairs([], None)
        wide = df.select(*[pair_expr(a, b).alias(f"{a}_{b}") for a, b in pairs])
        names = [f"{a}_{b}" for a, b in pairs]
        counts = long_values(wide, names).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        total = df.count()  # every pair column has one value per row
        shares = counts.withColumn("share", F.col("n") / F.lit(float(max(total, 1))))
        rare = Dictionary.materialise(shares.filter(F.col("share") < self.min_freq).select("column", "value"))
        seen = Dictionary.materialise(counts.select("column", "value")) if self.unseen == "other" else None
        return FittedCatPairs(pairs, rare, self.unseen, seen)


# --------------------------------------------------------------------------- FE5
@dataclass
class FittedBinaryOps(Fitted):
    cols: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        new = {}
        for a, b in itertools.combinations(self.cols, 2):
            x, y = q(a).cast("int"), q(b).cast("int")
            new[f"{a}_and_{b}"] = x.bitwiseAND(y)
            new[f"{a}_or_{b}"] = x.bitwiseOR(y)
            new[f"{a}_xor_{b}"] = x.bitwiseXOR(y)
        return df.withColumns(new) if new else df


class BinaryOps(Op):
    """FE5 — AND/OR/XOR of 0/1 columns (numeric columns whose non-null values are all 0/1;
    default all; ``max_columns`` takes the first ones only).  A null input gives null."""

    def __init__(self, bin_cols: Sequence[str] | None = None, exclude: Sequence[str] = (), max_columns: int | None = None):
        self.bin_cols, self.exclude, self.max_columns = bin_cols, exclude, max_columns

    def fit(self, df: DataFrame) -> FittedBinaryOps:
        if self.bin_cols is not None:
            return FittedBinaryOps(list(self.bin_cols))
        nums = numeric_columns(df, self.exclude)
        if not nums:
            return FittedBinaryOps([])
        row = df.agg(*[F.coalesce(F.bool_and(F.when(q(c).isNotNull(), q(c).isin(0, 1))), F.lit(True)).alias(f"b{i}")
                       for i, c in enumerate(nums)]).first()
        return FittedBinaryOps([c for i, c in enumerate(nums) if row[f"b{i}"]][:self.max_columns])


# --------------------------------------------------------------------------- FE6
@dataclass
class FittedInteractions(Fitted):
    steps: list[Fitted]
    schema: T.StructType | None = None
    fill: int = 0

    def transform(self, df: DataFrame) -> DataFrame:
        for s in self.steps:
            df = s.transform(df)
        if self.schema is not None:
            from ..functions.kinds import align
            df = align(df, self.schema, self.fill)
        return df


class Interactions(Op):
    """FE6 — FE2 -> FE3 -> FE4 -> FE5 in sequence (each sees the earlier columns); other
    frames are aligned to the fitted schema with missing columns filled by 0.  ``poly``,
    ``groups``, ``cat_combo`` and ``binary`` are keyword arguments for the four steps;
    ``REFERENCE_LIMITS`` holds a preset that bounds the generated columns."""

    REFERENCE_LIMITS = {"poly": {"max_columns": 10, "max_features": 20}, "groups": {"max_cats": 3, "max_nums": 5},
                        "cat_combo": {"max_cats": 5, "max_combos": 10}, "binary": {"max_columns": 5}}

    def __init__(self, use_poly=True, use_groups=True, use_cat_combo=True, use_binary=True,
                 exclude: Sequence[str] = (), poly: dict | None = None, groups: dict | None = None,
                 cat_combo: dict | None = None, binary: dict | None = None):
        self.flags = (use_poly, use_groups, use_cat_combo, use_binary)
        self.exclude, self.options = exclude, [x or {} for x in (poly, groups, cat_combo, binary)]

    def fit(self, df: DataFrame) -> FittedInteractions:
        kinds = (PolyFeatures, GroupStats, CatPairs, BinaryOps)
        ops = [k(**({"exclude": self.exclude} | o)) for k, o in zip(kinds, self.options)]
        steps, cur = [], df
        for use, op in zip(self.flags, ops):
            if not use:
                continue
            f = op.fit(cur)
            steps.append(f)
            cur = f.transform(cur)
        return FittedInteractions(steps, cur.schema)
