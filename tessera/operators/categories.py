"""Categorical outliers: detection (CD1-CD4) and treatment (CT1-CT3, CT5, CT6).

Fit builds ONE dictionary table over the distinct fit values of all string columns —
``(column, value, n, rare, string_anomaly, unexpected)`` — with one shuffle (partial
aggregation map-side, so a hot category is cheap).  Every detector and treatment is a
broadcast lookup of that table (or a literal map) plus expressions.

The string rules use Unicode classes like Python's ``re``: ``(?U)\\d`` and
``(?U)[^\\w\\s]``; length counts code points.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dictionary import Dictionary, category_counts, lookup, top_k_per_group
from ..functions.kinds import categorical_columns, q
from ..session import cached
from .base import Fitted, Op, count_hits

METHODS = ("rare", "string", "unexpected")
FLAG_NAMES = {"rare": "rare_categories", "string": "string_anomalies", "unexpected": "unexpected_values"}


#: Decimal digits of any script, and the superscript, subscript and circled digits.
DIGITS = r"[\p{Nd}\u00B2\u00B3\u00B9\u2070\u2074-\u2079\u2080-\u2089\u2460-\u2468]"


def string_anomaly(v: Column, min_length: int = 1, max_length: int = 50, allow_digits: bool = False,
                   allow_special_chars: bool = True) -> Column:
    """CD2 rule on a string expression (null -> false)."""
    bad = (F.length(v) < min_length) | (F.length(v) > max_length)
    if not allow_digits:
        bad = bad | v.rlike(DIGITS)
    if not allow_special_chars:
        bad = bad | v.rlike(r"(?U)[^\w\s]")
    return F.coalesce(bad, F.lit(False))


@dataclass
class FittedCategoryOutliers(Fitted):
    cols: list[str]
    table: Dictionary | None
    methods: tuple
    total: int
    flag_col: str = "is_outlier"

    # -- per column flag lookups -------------------------------------------------------
    def _with_flags(self, df: DataFrame, c: str, prefix: str = "__") -> DataFrame:
        t = self.table.for_column(c).select(
            "value", *[F.col(m).alias(f"{prefix}{m}") for m in ("rare", "string", "unexpected")])
        return lookup(df, q(c).cast("string"), t, "value", [f"{prefix}{m}" for m in ("rare", "string", "unexpected")],
                      broadcast=self.table.local)

    def _drop(self, df: DataFrame, prefix: str = "__") -> DataFrame:
        return df.drop(*[f"{prefix}{m}" for m in ("rare", "string", "unexpected")])

    def detect(self, df: DataFrame, methods: Sequence[str] | None = None) -> DataFrame:
        """Add ``is_outlier`` (OR over columns and methods) plus per-method row flags."""
        methods = tuple(methods or self.methods)
        per = {m: F.lit(False) for m in methods}
        for i, c in enumerate(self.cols):
            p = f"__{i}_"
            df = self._with_flags(df, c, p)
            for m in methods:
                per[m] = per[m] | F.coalesce(F.col(f"{p}{m}"), F.lit(False))
        out = df.withColumns({f"is_{m}": per[m] for m in methods})
        any_ = F.lit(False)
        for m in methods:
            any_ = any_ | F.col(f"is_{m}")
        out = out.withColumn(self.flag_col, any_)
        return out.drop(*[f"__{i}_{m}" for i in range(len(self.cols)) for m in ("rare", "string", "unexpected")])

    def transform(self, df: DataFrame) -> DataFrame:
        return self.detect(df)

    def report(self) -> DataFrame:
        """Per (column, value): count, share of fit rows and which rules flag it."""
        t = self.table.df
        return t.filter(F.col("rare") | F.col("string") | F.col("unexpected")).select(
            "column", "value", "n", (F.col("n") * 100.0 / F.lit(self.total)).alias("pct"),
            "rare", "string", "unexpected")

    def combined_share(self) -> DataFrame:
        """Per column with flagged values: their number, the fit rows that hold one and their
        share in percent (rows counted once however many rules flag them)."""
        return self.report().groupBy("column").agg(
            F.count(F.lit(1)).alias("n_values"), F.sum("n").alias("n_rows"),
            (F.sum("n") * 100.0 / F.lit(self.total)).alias("pct"))

    def summary(self, df: DataFrame) -> DataFrame:
        d = self.detect(df)
        return d.agg(F.sum(F.col(self.flag_col).cast("long")).alias("total_outliers"),
                     (F.avg(F.col(self.flag_col).cast("double")) * 100).alias("percentage"))

    # -- CT1 --------------------------------------------------------------------------
    def group_rare(self, df: DataFrame, replacement: str = "Other", case_insensitive: bool = False,
                   counts: Observation | None = None) -> DataFrame:
        """``counts`` gathers the replaced rows per column during the next action."""
        hits = {c: f"__hit_{i}" for i, c in enumerate(self.cols)}
        for c, h in hits.items():
            t = self.table.for_column(c).filter("rare")
            if case_insensitive:
                t = t.select(F.lower("value").alias("value")).distinct()
                key = F.lower(q(c).cast("string"))
            else:
                t = t.select("value")
                key = q(c).cast("string")
            df = lookup(df, key, t.withColumn(h, F.lit(True)), "value", [h],
                        broadcast=self.table.local, sparse=True)
            df = df.withColumn(c, F.when(F.col(h), F.lit(replacement)).otherwise(q(c)))
        return count_hits(df, hits, counts)

    # -- CT2 --------------------------------------------------------------------------
    def mode_table(self, fallback: str = "Unknown") -> dict:
        """Most frequent unflagged fit value per column (ties -> smallest)."""
        t = self.table.df
        flagged = F.col("rare") | F.col("string") | F.col("unexpected")
        best = top_k_per_group(t.filter(~flagged), "column", [F.desc("n"), F.asc("value")], 1, ["value"])
        modes = {r["column"]: r["value"] for r in best.collect()}  # one row per column
        return {c: modes.get(c, fallback) for c in self.cols}

    def replace_with_mode(self, df: DataFrame, fallback: str = "Unknown",
                          counts: Observation | None = None) -> DataFrame:
        """``counts`` gathers the replaced rows per column during the next action."""
        modes = self.mode_table(fallback)
        hits = {c: f"__hit_{i}" for i, c in enumerate(self.cols)}
        for c, h in hits.items():
            has_flagged = self.table.for_column(c).filter(F.col("rare") | F.col("string") | F.col("unexpected"))
            t = has_flagged.select("value", F.lit(True).alias(h))
            df = lookup(df, q(c).cast("string"), t, "value", [h], broadcast=self.table.local, sparse=True)
            df = df.withColumn(c, F.when(F.col(h), F.lit(modes[c])).otherwise(q(c)))
        return count_hits(df, hits, counts)

    # -- CT3 --------------------------------------------------------------------------
    def flag_columns(self, df: DataFrame, prefix: str = "outlier_") -> DataFrame:
        """``{prefix}{col}_{method}`` = value in that method's set (string anomalies are
        added to every method's set); only non-empty sets give a column."""
        t = self.table.df
        present = {(r["column"], m) for r in t.filter(F.col("rare") | F.col("string") | F.col("unexpected"))
                   .groupBy("column").agg(*[F.max(F.col(m).cast("int")).alias(m) for m in METHODS]).collect()
                   for m in METHODS if r[m]}
        names = []
        for i, c in enumerate(self.cols):
            p = f"__{i}_"
            df = self._with_flags(df, c, p)
            for m in METHODS:
                if m not in self.methods or (c, m) not in present:
                    continue
                s = F.col(f"{p}{m}") | (F.col(f"{p}string") if m != "string" and "string" in self.methods else F.lit(False))
                name = f"{prefix}{c}_{FLAG_NAMES[m]}"
                names.append(name)
                df = df.withColumn(name, F.coalesce(s, F.lit(False)).cast("int"))
            df = self._drop(df, p)
        return df


class CategoryOutliers(Op):
    """CD1-CD4 — rare (share < threshold or count < min_count; share over all fit rows,
    nulls included in the total, never rare), string anomalies, and values outside a
    whitelist (given per column, or the top ``top_k`` fit values by count, ties by value)."""

    def __init__(self, cols: Sequence[str] | None = None, methods: Sequence[str] | None = None,
                 threshold: float = 0.01, min_count: int = 5, min_length: int = 1, max_length: int = 100,
                 allow_digits: bool = False, allow_special_chars: bool = True,
                 whitelist: dict[str, Sequence[str]] | None = None, top_k: int = 20,
                 exclude: Sequence[str] = ()):
        self.cols, self.methods = cols, tuple(methods or METHODS)
        self.threshold, self.min_count = threshold, min_count
        self.min_length, self.max_length = min_length, max_length
        self.allow_digits, self.allow_special_chars = allow_digits, allow_special_chars
        self.whitelist, self.top_k, self.exclude = whitelist, top_k, exclude

    def fit(self, df: DataFrame) -> FittedCategoryOutliers:
        cols = list(self.cols) if self.cols is not None else categorical_columns(df, self.exclude)
        if not cols:
            return FittedCategoryOutliers([], None, self.methods, df.count())
        with cached(df, cols) as d:
            return self._fit(d, cols)

    def _fit(self, df: DataFrame, cols: list) -> FittedCategoryOutliers:
        total = df.count()
        counts = category_counts(df, cols, keep_nulls=False)
        v = F.col("value")
        rare = ((F.col("n") / F.lit(float(max(total, 1)))) < self.threshold) | (F.col("n") < self.min_count)
        anom = string_anomaly(v, self.min_length, self.max_length, self.allow_digits, self.allow_special_chars)
        if self.whitelist is not None:
            rows = [(c, str(x)) for c, xs in self.whitelist.items() for x in xs]
            allowed = df.sparkSession.createDataFrame(rows, "column string, value string").withColumn("__ok", F.lit(True))
            listed = F.array(*[F.lit(c) for c in self.whitelist]) if self.whitelist else F.array().cast("array<string>")
            t = counts.join(F.broadcast(allowed), ["column", "value"], "left")
            unexpected = F.array_contains(listed, F.col("column")) & F.col("__ok").isNull()
        else:
            top = top_k_per_group(counts, "column", [F.desc("n"), F.asc("value")], self.top_k, ["value"]) \
                .select("column", "value", F.lit(True).alias("__ok"))
            t = counts.join(top, ["column", "value"], "left")
            unexpected = F.col("__ok").isNull()
        m = self.methods
        table = t.select("column", "value", "n",
                         (rare if "rare" in m else F.lit(False)).alias("rare"),
                         (anom if "string" in m else F.lit(False)).alias("string"),
                         (unexpected if "unexpected" in m else F.lit(False)).alias("unexpected"))
        return FittedCategoryOutliers(cols, Dictionary.materialise(table), self.methods, total)


def rare_categories(**kw) -> CategoryOutliers:
    return CategoryOutliers(methods=["rare"], **kw)


def string_anomalies(max_length: int = 50, **kw) -> CategoryOutliers:
    return CategoryOutliers(methods=["string"], max_length=max_length, **kw)


def unexpected_values(**kw) -> CategoryOutliers:
    return CategoryOutliers(methods=["unexpected"], **kw)


# ------------------------------------------------------------------------------- CT5
@dataclass
class FittedCorrections(Fitted):
    """Apply ``{col: {wrong: right}}`` simultaneously (a value is mapped at most once)."""

    mapping: dict[str, dict[str, str]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        new = {}
        for c, m in self.mapping.items():
            if c not in df.columns or not m:
                continue
            lit_map = F.create_map(*[x for k, v in m.items() for x in (F.lit(k), F.lit(v))])
            new[c] = F.coalesce(lit_map[q(c)], q(c))
        return df.withColumns(new) if new else df

    def counts(self, df: DataFrame) -> DataFrame:
        """(column, wrong, right, n) rows affected per mapping entry."""
        rows = [(c, k, v) for c, m in self.mapping.items() for k, v in m.items()]
        t = df.sparkSession.createDataFrame(rows, "column string, wrong string, right string")
        cols = [c for c in self.mapping if c in df.columns]
        cnt = category_counts(df.select(*cols), cols, keep_nulls=False)
        return (t.join(cnt.withColumnRenamed("value", "wrong"), ["column", "wrong"], "left")
                .select("column", "wrong", "right", F.coalesce("n", F.lit(0)).alias("n")))


def corrections(mapping: dict[str, dict[str, str]]) -> FittedCorrections:
    return FittedCorrections(mapping)


# ------------------------------------------------------------------------------- CT6
@dataclass
class FittedCategoricalTreatment(Fitted):
    steps: list

    def transform(self, df: DataFrame) -> DataFrame:
        for kind, f, kw in self.steps:
            if kind == "group":
                df = f.group_rare(df, **kw)
            elif kind == "mode":
                df = f.replace_with_mode(df, **kw)
            elif kind == "flag":
                df = f.flag_columns(df, **kw)
            else:
                df = f.transform(df)
        return df


class CategoricalTreatment(Op):
    """CT6 — strategy 'group' | 'mode' | 'flag' | 'correct' | 'combined'
    (combined = correct typos -> re-detect on the corrected frame -> flags of that detection
    -> group rare, so ``replacement`` itself is never flagged)."""

    def __init__(self, strategy: str = "group", cols: Sequence[str] | None = None, replacement: str = "Other",
                 add_flags: bool = False, typo_kw: dict | None = None, exclude: Sequence[str] = (), **detect_kw):
        if strategy not in ("group", "mode", "flag", "correct", "combined"):
            raise ValueError(f"unknown strategy {strategy!r}")
        self.strategy, self.cols, self.replacement = strategy, cols, replacement
        self.add_flags, self.typo_kw, self.exclude, self.detect_kw = add_flags, typo_kw or {}, exclude, detect_kw

    def _detector(self, **over) -> CategoryOutliers:
        kw = dict(self.detect_kw)
        kw.update(over)
        return CategoryOutliers(self.cols, exclude=self.exclude, **kw)

    def fit(self, df: DataFrame) -> FittedCategoricalTreatment:
        s = self.strategy
        if s == "group":
            f = self._detector(methods=["rare"]).fit(df)
            return FittedCategoricalTreatment([("group", f, {"replacement": self.replacement})])
        if s == "mode":
            return FittedCategoricalTreatment([("mode", self._detector().fit(df), {})])
        if s == "flag":
            return FittedCategoricalTreatment([("flag", self._detector().fit(df), {})])
        from .typos import TypoCorrection
        typo = TypoCorrection(self.cols, exclude=self.exclude, **self.typo_kw).fit(df)
        if s == "correct":
            return FittedCategoricalTreatment([("apply", typo, {})])
        fixed = typo.transform(df)
        again = self._detector(methods=["rare"]).fit(fixed)
        flags = [("flag", self._detector().fit(fixed), {})] if self.add_flags else []
        return FittedCategoricalTreatment([("apply", typo, {}), *flags, ("group", again, {"replacement": self.replacement})])
