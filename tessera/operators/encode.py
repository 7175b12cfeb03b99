"""Categorical encodings (EN1-EN9) and if-binary one-hot (PR12).

Fitted state is a dictionary table ``(column, value, …)`` built in one shuffle over the
long view of all selected string columns.  Code/share/mean lookups are joins against the
size-checked dictionary (broadcast when small, shuffle otherwise).  One-hot needs the
category list on the driver because it defines output columns, so it is guarded by
``max_categories`` per column.

Some reference rules differ between the fit frame and other frames (a null in the fit
frame stays null for target encoding but becomes the global mean elsewhere).  Transforms
take ``fit_rows`` — a boolean column marking rows of the fit frame — to apply both rules
in one projection; by default all rows are treated as "other".
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dictionary import Dictionary, category_counts, long_values, lookup
from ..functions.kinds import categorical_columns, q
from ..functions.prefix import running_totals
from .base import Fitted, Op

NAN = "nan"  # pandas' text for a missing value after astype(str)


def _cols(df: DataFrame, columns, exclude=()) -> list[str]:
    cats = categorical_columns(df, exclude)
    return cats if columns is None else [c for c in columns if c in df.columns]


def _codes_table(df: DataFrame, cols: Sequence[str], null_as: str | None) -> DataFrame:
    """(column, value, code): 0-based rank of the value in sorted order per column."""
    src = df.select(*[(F.coalesce(q(c).cast("string"), F.lit(null_as)) if null_as is not None else q(c).cast("string")).alias(c)
                      for c in cols])
    vals = long_values(src, cols, keep_nulls=False).distinct()
    # global position in (column, value) order by range partitioning + running offsets,
    # rebased per column: no column's distinct values are ranked inside one task
    ranked = running_totals(vals.withColumn("__one", F.lit(1)), ["column", "value"], ["__one"])
    base = ranked.groupBy("column").agg(F.min("__rank").alias("__base"))
    return (ranked.join(F.broadcast(base), "column")
            .select("column", "value", (F.col("__rank") - F.col("__base")).cast("int").alias("code")))


def _lk(df, key, table: Dictionary, column, values):
    t = table.for_column(column)
    return lookup(df, key, t, "value", values, broadcast=table.local)


# --------------------------------------------------------------------------- EN1
@dataclass
class FittedLabel(Fitted):
    cols: list[str]
    table: Dictionary | None
    unknown: int = -1

    def transform(self, df: DataFrame) -> DataFrame:
        for c in self.cols:
            key = F.coalesce(q(c).cast("string"), F.lit(NAN))
            df = _lk(df, key, self.table, c, ["code"])
            df = df.withColumn(c, F.coalesce(F.col("code"), F.lit(self.unknown)).cast("int")).drop("code")
        return df

    def mapping(self) -> DataFrame:
        return self.table.df


class LabelEncode(Op):
    """EN1 — codes 0..n-1 in sorted string order on the fit frame; null is the category
    ``'nan'``; unseen -> -1."""

    def __init__(self, columns: Sequence[str] | None = None, exclude: Sequence[str] = ()):
        self.columns, self.exclude = columns, exclude

    def fit(self, df: DataFrame) -> FittedLabel:
        cols = _cols(df, self.columns, self.exclude)
        if not cols:
            return FittedLabel([], None)
        return FittedLabel(cols, Dictionary.materialise(_codes_table(df, cols, NAN)))


# --------------------------------------------------------------------------- EN2 / PR12
@dataclass
class FittedOneHot(Fitted):
    categories: dict[str, list]          # column -> sorted categories (None = missing, last)
    dropped: dict[str, object | None]    # column -> dropped category (or sentinel absent)
    handle_unknown: str = "ignore"

    def names(self) -> list[str]:
        out = []
        for c, cats in self.categories.items():
            for v in cats:
                if c in self.dropped and v == self.dropped[c]:
                    continue
                out.append(f"{c}_{NAN if v is None else v}")
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        keep = [x for x in df.columns if x not in self.categories]
        new = []
        for c, cats in self.categories.items():
            for v in cats:
                if c in self.dropped and v == self.dropped[c]:
                    continue
                hit = q(c).isNull() if v is None else (q(c) == F.lit(v))
                new.append(F.coalesce(hit, F.lit(False)).cast("double").alias(f"{c}_{NAN if v is None else v}"))
        out = df.select(*[q(x) for x in keep], *new)
        if self.handle_unknown == "error":
            known = None
            for c, cats in self.categories.items():
                ok = F.lit(False)
                for v in cats:
                    ok = ok | (q(c).isNull() if v is None else F.coalesce(q(c) == F.lit(v), F.lit(False)))
                known = ok if known is None else (known & ok)
            checked = df.filter(F.when(known, F.lit(True)).otherwise(
                F.raise_error(F.lit("unknown category in one-hot input")).cast("boolean")))
            out = checked.select(*[q(x) for x in keep], *new)
        return out


class OneHot(Op):
    """EN2 — ``{col}_{value}`` 0/1 doubles in sorted order, missing is its own category
    (sorted last); ``drop`` = 'first' | 'if_binary' (PR12) | None; unseen -> all zero.  The
    categories become columns, so ``max_categories`` can guard their number (default: none);
    ``SparseOneHot`` has no such columns."""

    def __init__(self, columns: Sequence[str] | None = None, drop: str | None = "first",
                 handle_unknown: str = "ignore", max_categories: int | None = None,
                 exclude: Sequence[str] = ()):
        self.columns, self.drop, self.handle_unknown = columns, drop, handle_unknown
        self.max_categories, self.exclude = max_categories, exclude

    def fit(self, df: DataFrame) -> FittedOneHot:
        cols = _cols(df, self.columns, self.exclude)
        if not cols:
            return FittedOneHot({}, {})
        counts = category_counts(df, cols).select("column", "value")
        # guard: the category lists become output columns, so they must be small
        too_many = (counts.groupBy("column").count().filter(F.col("count") > self.max_categories)
                    .limit(1).collect()) if self.max_categories is not None else []
        if too_many:
            raise ValueError(f"column {too_many[0]['column']!r} has more than {self.max_categories} "
                             "categories; use SparseOneHot")
        cats = {c: [] for c in cols}
        for r in counts.collect():
            cats[r["column"]].append(r["value"])
        for c in cols:
            cats[c] = sorted([v for v in cats[c] if v is not None]) + ([None] if None in cats[c] else [])
        dropped = {}
        for c in cols:
            if self.drop == "first" and cats[c]:
                dropped[c] = cats[c][0]
            elif self.drop == "if_binary" and len(cats[c]) == 2:
                dropped[c] = cats[c][0]
        return FittedOneHot(cats, dropped, self.handle_unknown)


@dataclass
class FittedSparseOneHot(Fitted):
    cols: list[str]
    table: Dictionary | None  # (column, value, slot)
    size: int
    out_col: str = "onehot"

    def transform(self, df: DataFrame) -> DataFrame:
        slots = []
        for i, c in enumerate(self.cols):
            df = _lk(df, F.coalesce(q(c).cast("string"), F.lit(NAN)), self.table, c, ["slot"])
            slots.append(f"__slot{i}")
            df = df.withColumnRenamed("slot", slots[-1])
        hot = F.array_sort(F.array_compact(F.array(*[F.col(s) for s in slots])))
        return df.withColumn(self.out_col, hot).drop(*slots)


class SparseOneHot(Op):
    """EN2, sparse — ``out_col`` lists the positions of the ones in a vector of ``size`` slots
    (columns in order, values in sorted order, missing spelled ``nan``); an unseen value has no
    slot.  The dictionary is a table, so there is no bound on the categories."""

    def __init__(self, columns: Sequence[str] | None = None, out_col: str = "onehot", exclude: Sequence[str] = ()):
        self.columns, self.out_col, self.exclude = columns, out_col, exclude

    def fit(self, df: DataFrame) -> FittedSparseOneHot:
        cols = _cols(df, self.columns, self.exclude)
        if not cols:
            return FittedSparseOneHot([], None, 0, self.out_col)
        codes = _codes_table(df, cols, NAN)
        sizes = {r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
        start, at = {}, 0
        for c in cols:
            start[c], at = at, at + sizes.get(c, 0)
        first = F.lit(0)
        for c in cols:
            first = F.when(F.col("column") == c, F.lit(start[c])).otherwise(first)
        table = Dictionary.materialise(codes.select("column", "value", (first + F.col("code")).cast("int").alias("slot")))
        return FittedSparseOneHot(cols, table, at, self.out_col)


# --------------------------------------------------------------------------- EN3
@dataclass
class FittedFrequency(Fitted):
    cols: list[str]
    table: Dictionary | None
    unseen: dict
    fit_null: dict

    def transform(self, df: DataFrame, fit_rows: Column | None = None) -> DataFrame:
        fr = fit_rows if fit_rows is not None else F.lit(False)
        for c in self.cols:
            df = _lk(df, q(c).cast("string"), self.table, c, ["freq"])
            v = F.when(fr & q(c).isNull(), F.lit(self.fit_null[c])).otherwise(
                F.coalesce(F.col("freq"), F.lit(self.unseen[c])))
            df = df.withColumn(c, v.cast("double")).drop("freq")
        return df


class FrequencyEncode(Op):
    """EN3 — share of the category among non-null fit rows (or its count); unseen or
    null elsewhere -> mean/zero/min/max over categories; a fit-frame null -> mean share
    (0 for counts)."""

    def __init__(self, columns: Sequence[str] | None = None, normalize: bool = True,
                 unseen_value: str = "mean", exclude: Sequence[str] = ()):
        self.columns, self.normalize, self.unseen_value, self.exclude = columns, normalize, unseen_value, exclude

    def fit(self, df: DataFrame) -> FittedFrequency:
        cols = _cols(df, self.columns, self.exclude)
        if not cols:
            return FittedFrequency([], None, {}, {})
        counts = category_counts(df, cols, keep_nulls=False)
        tot = counts.groupBy("column").agg(F.sum("n").alias("tot"))
        freq = counts.join(tot, "column").select(
            "column", "value", (F.col("n") / F.col("tot") if self.normalize else F.col("n").cast("double")).alias("freq"))
        table = Dictionary.materialise(freq)
        st = {r["column"]: r for r in table.df.groupBy("column").agg(
            F.avg("freq").alias("mean"), F.min("freq").alias("min"), F.max("freq").alias("max")).collect()}
        unseen, fit_null = {}, {}
        for c in cols:
            s = st.get(c)
            mean = s["mean"] if s else None
            unseen[c] = 0.0 if self.unseen_value == "zero" else (
                s[self.unseen_value] if s and self.unseen_value in ("min", "max") else mean)
            fit_null[c] = mean if self.normalize else 0.0
        return FittedFrequency(cols, table, unseen, fit_null)


# --------------------------------------------------------------------------- EN4
@dataclass
class FittedTarget(Fitted):
    cols: list[str]
    table: Dictionary | None
    global_mean: float | None
    noise_level: float = 0.0
    seed: int = 42

    def transform(self, df: DataFrame, fit_rows: Column | None = None) -> DataFrame:
        fr = fit_rows if fit_rows is not None else F.lit(False)
        for i, c in enumerate(self.cols):
            df = _lk(df, q(c).cast("string"), self.table, c, ["enc"])
            other = F.coalesce(F.col("enc"), F.lit(self.global_mean))
            v = F.when(fr, F.col("enc") + (F.randn(self.seed + i) * self.noise_level if self.noise_level > 0 else F.lit(0.0)))\
                .otherwise(other)
            df = df.withColumn(c, v.cast("double")).drop("enc")
        return df


class TargetEncode(Op):
    """EN4 — smoothed mean ``(mean*n + g*s) / (n + s)``; categories with n < leaf get g;
    unseen or null outside the fit frame -> g; a null inside the fit frame stays null;
    optional seeded Gaussian noise on fit rows."""

    def __init__(self, label: str, columns: Sequence[str] | None = None, smoothing: float = 1.0,
                 min_samples_leaf: int = 1, noise_level: float = 0.0, seed: int = 42,
                 exclude: Sequence[str] = ()):
        self.label, self.columns, self.smoothing = label, columns, smoothing
        self.min_samples_leaf, self.noise_level, self.seed = min_samples_leaf, noise_level, seed
        self.exclude = tuple(exclude) + (label,)

    def fit(self, df: DataFrame) -> FittedTarget:
        cols = _cols(df, self.columns, self.exclude)
        g = df.agg(F.avg(q(self.label).cast("double")).alias("g")).first()["g"]
        if not cols:
            return FittedTarget([], None, g)
        st = category_counts(df, cols, label=self.label, keep_nulls=False)
        mean = F.col("label_sum") / F.col("label_n")
        s = F.lit(float(self.smoothing))
        sm = (mean * F.col("label_n") + F.lit(g) * s) / (F.col("label_n") + s)
        enc = F.when(F.col("label_n") < self.min_samples_leaf, F.lit(g)).otherwise(sm)
        table = Dictionary.materialise(st.select("column", "value", enc.alias("enc")))
        return FittedTarget(cols, table, g, self.noise_level, self.seed)


# --------------------------------------------------------------------------- EN5
@dataclass
class FittedOrdinal(Fitted):
    cols: list[str]
    table: Dictionary | None
    unknown_value: float = -1.0

    def transform(self, df: DataFrame) -> DataFrame:
        for c in self.cols:
            df = _lk(df, q(c).cast("string"), self.table, c, ["code"])
            df = df.withColumn(c, F.coalesce(F.col("code").cast("double"), F.lit(float(self.unknown_value)))).drop("code")
        return df


class OrdinalEncode(Op):
    """EN5 — position in the given order (default: sorted non-null fit values); unseen or
    null -> ``unknown_value``; doubles."""

    def __init__(self, columns_mapping: dict[str, Sequence[str]] | None = None, unknown_value: float = -1,
                 exclude: Sequence[str] = ()):
        self.columns_mapping, self.unknown_value, self.exclude = columns_mapping, unknown_value, exclude

    def fit(self, df: DataFrame) -> FittedOrdinal:
        spark = df.sparkSession
        if self.columns_mapping is None:
            cols = _cols(df, None, self.exclude)
            if not cols:
                return FittedOrdinal([], None)
            return FittedOrdinal(cols, Dictionary.materialise(_codes_table(df, cols, None)), self.unknown_value)
        cols = [c for c in self.columns_mapping if c in df.columns]
        rows = [(c, str(v), i) for c in cols for i, v in enumerate(self.columns_mapping[c])]
        t = spark.createDataFrame(rows, "column string, value string, code int")
        return FittedOrdinal(cols, Dictionary.materialise(t), self.unknown_value)


# --------------------------------------------------------------------------- EN6
@dataclass
class FittedBits(Fitted):
    bits: dict[str, int]
    table: Dictionary | None

    def transform(self, df: DataFrame) -> DataFrame:
        for c, nb in self.bits.items():
            key = F.coalesce(q(c).cast("string"), F.lit(NAN))
            df = _lk(df, key, self.table, c, ["code"])
            code = F.coalesce(F.col("code"), F.lit(None))
            new = {f"{c}_bit{i}": F.coalesce(F.shiftright(code, i).bitwiseAND(F.lit(1)), F.lit(0)).cast("int")
                   for i in range(nb)}
            df = df.withColumns(new).drop("code", c) if new else df.drop("code", c)
        return df


class BinaryEncode(Op):
    """EN6 — label code (null = 'nan') split into ceil(log2(n_categories)) bit columns
    ``{col}_bit{i}``, least significant first; the source column is dropped; an unseen
    value gives zeros in its row only."""

    def __init__(self, columns: Sequence[str] | None = None, exclude: Sequence[str] = ()):
        self.columns, self.exclude = columns, exclude

    def fit(self, df: DataFrame) -> FittedBits:
        cols = _cols(df, self.columns, self.exclude)
        if not cols:
            return FittedBits({}, None)
        table = Dictionary.materialise(_codes_table(df, cols, NAN))
        n = {r["column"]: r["n"] for r in table.df.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
        bits = {c: int(math.ceil(math.log2(n[c]))) if n.get(c, 0) > 1 else 0 for c in cols}
        return FittedBits(bits, table)


# --------------------------------------------------------------------------- EN7
@dataclass
class FittedDispatch(Fitted):
    parts: list = field(default_factory=list)

    def transform(self, df: DataFrame, fit_rows: Column | None = None) -> DataFrame:
        for p in self.parts:
            df = p.transform(df, fit_rows) if isinstance(p, (FittedFrequency, FittedTarget)) else p.transform(df)
        return df


class Encode(Op):
    """EN7 — dispatcher: 'label' | 'onehot' | 'frequency' | 'target' | 'ordinal' | 'binary'.
    'onehot' routes columns with at most ``onehot_threshold`` distinct fit values to
    one-hot and the rest to frequency encoding."""

    METHODS = ("label", "onehot", "frequency", "target", "ordinal", "binary")

    def __init__(self, method: str = "onehot", label: str | None = None, columns=None,
                 onehot_threshold: int = 10, exclude: Sequence[str] = (), **kw):
        if method not in self.METHODS:
            raise ValueError(f"unknown method {method!r}; choose one of {self.METHODS}")
        if method == "target" and not label:
            raise ValueError("target encoding needs the label column")
        self.method, self.label, self.columns = method, label, columns
        self.onehot_threshold, self.kw = onehot_threshold, kw
        self.exclude = tuple(exclude) + ((label,) if label else ())

    def fit(self, df: DataFrame) -> FittedDispatch:
        cols = _cols(df, self.columns, self.exclude)
        if not cols:
            return FittedDispatch([])
        m = self.method
        if m == "label":
            return FittedDispatch([LabelEncode(cols).fit(df)])
        if m == "frequency":
            return FittedDispatch([FrequencyEncode(cols, **self.kw).fit(df)])
        if m == "target":
            return FittedDispatch([TargetEncode(self.label, cols, **self.kw).fit(df)])
        if m == "ordinal":
            return FittedDispatch([OrdinalEncode(None, exclude=[c for c in df.columns if c not in cols]).fit(df)])
        if m == "binary":
            return FittedDispatch([BinaryEncode(cols).fit(df)])
        nd = df.agg(*[F.count_distinct(q(c)).alias(f"d{i}") for i, c in enumerate(cols)]).first()
        low = [c for i, c in enumerate(cols) if nd[f"d{i}"] <= self.onehot_threshold]
        high = [c for c in cols if c not in low]
        parts = []
        if high:
            parts.append(FrequencyEncode(high).fit(df))
        if low:
            parts.append(OneHot(low, **self.kw).fit(df))
        return FittedDispatch(parts)


# --------------------------------------------------------------------------- EN8 / EN9
@dataclass
class FittedTarget01(Fitted):
    label: str
    classes: list[str]
    out_col: str | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        code = F.lit(-1)
        for i, v in reversed(list(enumerate(self.classes))):
            code = F.when(q(self.label).cast("string") == F.lit(v), F.lit(i)).otherwise(code)
        return df.withColumn(self.out_col or self.label, code.cast("int"))

    def decode(self, df: DataFrame, col: str | None = None, out_col: str | None = None) -> DataFrame:
        c = col or self.out_col or self.label
        v = F.lit(None).cast("string")
        for i, cls in enumerate(self.classes):
            v = F.when(q(c) == F.lit(i), F.lit(cls)).otherwise(v)
        return df.withColumn(out_col or c, v)


class EncodeTarget(Op):
    """EN8 — label classes in sorted order -> 0..k-1 (unseen -> -1); EN9 via ``decode``.
    The class list is bounded by ``max_classes`` (it becomes a CASE expression)."""

    def __init__(self, label: str, out_col: str | None = None, max_classes: int = 1000):
        self.label, self.out_col, self.max_classes = label, out_col, max_classes

    def fit(self, df: DataFrame) -> FittedTarget01:
        vals = (df.select(q(self.label).cast("string").alias("v")).filter(F.col("v").isNotNull())
                .distinct().limit(self.max_classes + 1).collect())
        if len(vals) > self.max_classes:
            raise ValueError("too many label classes")
        return FittedTarget01(self.label, sorted(r["v"] for r in vals), self.out_col)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """EN8 report — (class, n, share)."""
    total = df.count()
    c = df.groupBy(q(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.lit(float(total)))
