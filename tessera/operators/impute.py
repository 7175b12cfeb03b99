"""Missing-value imputation (MV1, MV3-MV7; MV2 lives in ``neighbors_ops``).

All statistics come from the fit frame only.  Global statistics are literals; group
statistics are a dictionary table keyed by the group value, joined back with a
size-checked broadcast.  Transform is ``coalesce(value, group_stat, overall_stat)``.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dictionary import Dictionary, category_counts, lookup
from ..functions.kinds import INTEGRAL_TYPES, categorical_columns, numeric_columns, q
from ..functions.stats import EXACT, _pct, grouped_quantiles_wide, quantiles
from ..session import cached
from .base import Fitted, Op

UNKNOWN = "Unknown"


def _cols_with_nulls(df: DataFrame, cols: Sequence[str]) -> list[str]:
    if not cols:
        return []
    row = df.agg(*[F.max(q(c).isNull().cast("int")).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[f"n{i}"] == 1]


def _numeric_fill(df: DataFrame, c: str, value) -> "F.Column":
    """coalesce(c, value); integral columns become double (pandas upcasts a column with NaN)."""
    dt = df.schema[c].dataType
    if isinstance(dt, INTEGRAL_TYPES):
        return F.coalesce(q(c).cast("double"), F.lit(value).cast("double"))
    return F.coalesce(q(c), F.lit(value).cast(dt))


@dataclass
class FittedFill(Fitted):
    """Literal fill values per column, optional ``{col}_missing`` indicators."""

    values: dict
    indicators: list[str] = field(default_factory=list)
    numeric: bool = True

    def transform(self, df: DataFrame) -> DataFrame:
        ind = {f"{c}_missing": q(c).isNull().cast("int") for c in self.indicators if c in df.columns}
        fills = {}
        for c, v in self.values.items():
            if c not in df.columns or v is None:
                continue
            fills[c] = _numeric_fill(df, c, v) if self.numeric else F.coalesce(q(c), F.lit(v))
        return df.withColumns({**ind, **fills})


class NumericFill(Op):
    """MV1 — fill numeric nulls with the train median / mean / a constant.

    Only columns that have nulls in the fit frame are touched (``columns_with_nulls='train'``,
    as the reference); ``'any'`` fills every selected numeric column.
    """

    def __init__(self, strategy: str = "median", constant: float = 0.0,
                 features: Sequence[str] | None = None, add_indicator: bool = False,
                 columns_with_nulls: str = "train", exclude: Sequence[str] = (),
                 quantile_method: str = EXACT):
        if strategy not in ("median", "mean", "constant"):
            raise ValueError(f"unknown strategy {strategy!r}; use 'median', 'mean' or 'constant'")
        self.strategy, self.constant, self.features = strategy, constant, features
        self.add_indicator, self.columns_with_nulls = add_indicator, columns_with_nulls
        self.exclude, self.quantile_method = exclude, quantile_method

    def fit(self, df: DataFrame) -> FittedFill:
        num = numeric_columns(df, self.exclude)
        if self.features is None:
            cols = num
        else:
            cols = []
            for c in self.features:
                if c in num:
                    cols.append(c)
                else:
                    warnings.warn(f"column {c!r} is absent or not numeric; skipped")
        with cached(df, cols) as d:
            return self._fit(d, cols)

    def _fit(self, df: DataFrame, cols: list) -> FittedFill:
        if self.columns_with_nulls == "train":
            cols = _cols_with_nulls(df, cols)
        if not cols:
            return FittedFill({}, [])
        if self.strategy == "constant":
            values = {c: self.constant for c in cols}
        elif self.strategy == "median":
            qs = quantiles(df, cols, [0.5], self.quantile_method)
            values = {c: qs[c][0] for c in cols}
        else:
            row = df.agg(*[F.avg(q(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
            values = {c: row[f"s{i}"] for i, c in enumerate(cols)}
        return FittedFill(values, cols if self.add_indicator else [])


@dataclass
class FittedGroupFill(Fitted):
    group_col: str
    targets: list[str]
    table: Dictionary | None
    overall: dict
    numeric: bool = True
    indicators: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.targets:
            return df
        ind = {f"{c}_missing": q(c).isNull().cast("int") for c in self.indicators if c in df.columns}
        df = df.withColumns(ind) if ind else df
        stat_cols = [f"__g{i}" for i in range(len(self.targets))]
        t = self.table.df
        out = lookup(df, q(self.group_col).cast("string"), t, "__key", stat_cols,
                     broadcast=self.table.local)
        fills = {}
        for i, c in enumerate(self.targets):
            if c not in df.columns:
                continue
            g = F.col(stat_cols[i])
            o = F.lit(self.overall[c])
            if self.numeric:
                dt = df.schema[c].dataType
                base = q(c).cast("double") if isinstance(dt, INTEGRAL_TYPES) else q(c)
                fills[c] = F.coalesce(base, g.cast(base_type(dt)), o.cast(base_type(dt)))
            else:
                fills[c] = F.coalesce(q(c), g, o)
        return out.withColumns(fills).drop(*stat_cols)


def base_type(dt):
    return T.DoubleType() if isinstance(dt, INTEGRAL_TYPES) else dt


class GroupNumericFill(Op):
    """MV3 — fill numeric nulls with the train statistic of the row's group.

    Unseen, null or all-null groups fall back to the overall train statistic.
    """

    def __init__(self, group_col: str, target_cols: Sequence[str] | None = None,
                 stat: str = "median", quantile_method: str = EXACT):
        if stat not in ("median", "mean"):
            raise ValueError("stat must be 'median' or 'mean'")
        self.group_col, self.target_cols, self.stat = group_col, target_cols, stat
        self.quantile_method = quantile_method

    def _agg(self, c: str):
        return _pct(q(c), [0.5], self.quantile_method, 10000)[0] if self.stat == "median" else F.avg(q(c))

    def fit(self, df: DataFrame) -> FittedGroupFill:
        if self.target_cols is None:
            targets = _cols_with_nulls(df, numeric_columns(df, [self.group_col]))
        else:
            targets = [c for c in self.target_cols if c in df.columns and c != self.group_col]
        if not targets:
            return FittedGroupFill(self.group_col, [], None, {})
        with cached(df, [self.group_col] + targets) as d:
            return self._fit(d, targets)

    def _fit(self, df: DataFrame, targets: list) -> FittedGroupFill:
        if self.stat == "median":
            qs = quantiles(df, targets, [0.5], self.quantile_method)
            overall = {c: qs[c][0] for c in targets}
            table = grouped_quantiles_wide(df, q(self.group_col).cast("string"), targets, 0.5, self.quantile_method)
        else:
            overall_row = df.agg(*[self._agg(c).alias(f"o{i}") for i, c in enumerate(targets)]).first()
            overall = {c: overall_row[f"o{i}"] for i, c in enumerate(targets)}
            table = (df.filter(q(self.group_col).isNotNull())
                     .groupBy(q(self.group_col).cast("string").alias("__key"))
                     .agg(*[self._agg(c).cast("double").alias(f"__g{i}") for i, c in enumerate(targets)]))
        return FittedGroupFill(self.group_col, targets, Dictionary.materialise(table), overall)


class CategoricalFill(Op):
    """MV4 (strategy='mode') and MV5 (strategy='constant') for string columns.

    Mode ties go to the smallest value; an all-null column is filled with ``'Unknown'``.
    """

    def __init__(self, strategy: str = "mode", constant: str = UNKNOWN,
                 features: Sequence[str] | None = None, add_indicator: bool = False,
                 exclude: Sequence[str] = ()):
        if strategy not in ("mode", "constant"):
            raise ValueError(f"unknown strategy {strategy!r}")
        self.strategy, self.constant, self.features = strategy, constant, features
        self.add_indicator, self.exclude = add_indicator, exclude

    def fit(self, df: DataFrame) -> FittedFill:
        cats = categorical_columns(df, self.exclude)
        cols = cats if self.features is None else [c for c in self.features if c in cats]
        cols = _cols_with_nulls(df, cols)
        if not cols:
            return FittedFill({}, [], numeric=False)
        if self.strategy == "constant":
            values = {c: self.constant for c in cols}
        else:
            values = _modes(df, cols)
        return FittedFill(values, cols if self.add_indicator else [], numeric=False)


def _modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """Most frequent value per column (ties: the smallest), ``'Unknown'`` where all are null;
    from one count of (column, value), so no task holds the values of a column."""
    counts = category_counts(df, cols, keep_nulls=False)
    first = F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("m")
    found = {r["column"]: r["m"]["value"] for r in counts.groupBy("column").agg(first).collect()}
    return {c: found.get(c, UNKNOWN) for c in cols}


class GroupCategoricalFill(Op):
    """MV6 — fill string nulls with the train mode of the row's group.

    A train group whose values are all null gets ``'Unknown'`` (not the overall mode);
    an unseen or null group gets the overall train mode.  The group column is never a target.
    """

    def __init__(self, group_col: str, target_cols: Sequence[str] | None = None,
                 add_indicator: bool = False):
        self.group_col, self.target_cols, self.add_indicator = group_col, target_cols, add_indicator

    def fit(self, df: DataFrame) -> FittedGroupFill:
        if self.group_col not in df.columns:
            return FittedGroupFill(self.group_col, [], None, {}, numeric=False)
        if self.target_cols is None:
            targets = _cols_with_nulls(df, categorical_columns(df, [self.group_col]))
        else:
            targets = [c for c in self.target_cols if c in df.columns and c != self.group_col]
        indicators = list(targets) if self.add_indicator else []
        targets = _cols_with_nulls(df, targets)
        if not targets:
            return FittedGroupFill(self.group_col, [], None, {}, numeric=False, indicators=indicators)
        overall = _modes(df, targets)
        # count (group, column, value) first, so no task holds the values of a group
        items = F.array(*[F.struct(F.lit(i).alias("__t"), q(c).cast("string").alias("__v")) for i, c in enumerate(targets)])
        long = df.filter(q(self.group_col).isNotNull()).select(q(self.group_col).cast("string").alias("__key"), F.inline(items))
        counts = long.groupBy("__key", "__t", "__v").agg(F.count(F.lit(1)).alias("n"))
        first = F.min(F.struct(F.col("__v").isNull().alias("none"), (-F.col("n")).alias("n"), "__v")).alias("m")
        best = counts.groupBy("__key", "__t").agg(first).select("__key", "__t", F.coalesce("m.__v", F.lit(UNKNOWN)).alias("__v"))
        wide = best.groupBy("__key").pivot("__t", list(range(len(targets)))).agg(F.first("__v"))
        table = wide.select("__key", *[F.col(str(i)).alias(f"__g{i}") for i in range(len(targets))])
        return FittedGroupFill(self.group_col, targets, Dictionary.materialise(table), overall,
                               numeric=False, indicators=indicators)


def categorical_missing(strategy: str = "mode", group_by: str | None = None, **kw) -> Op:
    """MV7 — dispatcher over MV4 / MV5 / MV6."""
    if strategy == "mode":
        return CategoricalFill("mode", **kw)
    if strategy == "constant":
        return CategoricalFill("constant", **kw)
    if strategy == "group":
        if not group_by:
            raise ValueError("strategy='group' needs group_by")
        return GroupCategoricalFill(group_by, **kw)
    raise ValueError(f"unknown strategy {strategy!r}; use 'mode', 'constant' or 'group'")
