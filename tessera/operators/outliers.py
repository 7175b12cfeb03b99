"""Numeric outliers: detection (OD1, OD2) and treatment (OT1-OT3).

Bounds are per-column literals from ONE aggregate over the fit frame (IQR: one pass of
exact percentiles; MAD: two passes).  Flags, filtering and capping are expressions on the
bounds, so transform is a single narrow projection that also runs on streams.
Neighbour-based detectors (OD3-OD5) live in ``neighbour_outliers``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.kinds import numeric_columns, q
from ..functions.stats import EXACT, mad_bounds, quantiles
from ..session import cached
from .base import Fitted, Op


@dataclass
class Bounds(Fitted):
    """Per-column [lower, upper]; strict comparison; null is never out."""

    lower: dict
    upper: dict
    flag_col: str = "is_outlier"

    def column_flag(self, c: str) -> Column:
        return F.coalesce((q(c) < F.lit(self.lower[c])) | (q(c) > F.lit(self.upper[c])), F.lit(False))

    def mask(self) -> Column:
        out = F.lit(False)
        for c in self.lower:
            out = out | self.column_flag(c)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the OR-combined flag column."""
        return df.withColumn(self.flag_col, self.mask())

    # OT1
    def drop(self, df: DataFrame) -> DataFrame:
        return df.filter(~self.mask())

    # OT2
    def cap(self, df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
        """Clip to the fit bounds; null stays null; excluded/unknown columns untouched."""
        new = {}
        for c in self.lower:
            if c in exclude or c not in df.columns:
                continue
            clipped = F.least(F.greatest(q(c), F.lit(self.lower[c]).cast(df.schema[c].dataType)),
                              F.lit(self.upper[c]).cast(df.schema[c].dataType))
            if df.schema[c].dataType.typeName() in ("integer", "long", "short", "byte"):
                clipped = F.least(F.greatest(q(c).cast("double"), F.lit(self.lower[c])), F.lit(self.upper[c]))
            new[c] = F.when(q(c).isNull(), q(c)).otherwise(clipped)
        return df.withColumns(new) if new else df

    # OT3
    def flags(self, df: DataFrame, prefix: str = "outlier_") -> DataFrame:
        return df.withColumns({f"{prefix}{c}": self.column_flag(c).cast("int") for c in self.lower if c in df.columns})

    def report(self, spark) -> DataFrame:
        rows = [(c, float(self.lower[c]), float(self.upper[c])) for c in self.lower]
        return spark.createDataFrame(rows, "column string, lower double, upper double")


class IQROutliers(Op):
    """OD1 — bounds Q1 - k*IQR, Q3 + k*IQR (k = 1.5) from exact interpolated quartiles."""

    def __init__(self, cols: Sequence[str] | None = None, k: float = 1.5, exclude: Sequence[str] = (),
                 quantile_method: str = EXACT):
        self.cols, self.k, self.exclude, self.quantile_method = cols, k, exclude, quantile_method

    def fit(self, df: DataFrame) -> Bounds:
        cols = list(self.cols) if self.cols is not None else numeric_columns(df, self.exclude)
        with cached(df, cols) as d:
            qs = quantiles(d, cols, [0.25, 0.75], self.quantile_method)
        lo, hi = {}, {}
        for c in cols:
            q1, q3 = qs[c]
            if q1 is None:
                continue
            iqr = q3 - q1
            lo[c], hi[c] = q1 - self.k * iqr, q3 + self.k * iqr
        return Bounds(lo, hi)


class MADOutliers(Op):
    """OD2 — bounds median -/+ k * MAD with MAD = median(|x - median|), unscaled.

    ``zero_mad='flag'`` keeps the reference rule (MAD = 0 flags every non-median value);
    ``'skip'`` leaves such columns out."""

    def __init__(self, cols: Sequence[str] | None = None, k: float = 3.0, exclude: Sequence[str] = (),
                 zero_mad: str = "flag", quantile_method: str = EXACT):
        self.cols, self.k, self.exclude, self.zero_mad = cols, k, exclude, zero_mad
        self.quantile_method = quantile_method

    def fit(self, df: DataFrame) -> Bounds:
        cols = list(self.cols) if self.cols is not None else numeric_columns(df, self.exclude)
        with cached(df, cols) as d:
            lo, hi = mad_bounds(d, cols, self.k, self.quantile_method)
        if self.zero_mad == "skip":
            for c in [c for c in lo if lo[c] == hi[c]]:
                lo.pop(c)
                hi.pop(c)
        return Bounds(lo, hi)
