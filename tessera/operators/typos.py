"""Automatic typo correction (CT4) as a Spark job over the distinct values of each column.

1. Distinct fit values per column with counts (one shuffle for all columns).
2. Normalised form for comparison only: whitespace runs collapsed, trimmed, lower-cased.
3. Candidate pairs inside a column, by a rule that never depends on how many values there
   are.  Single metric: the ratio is above t only if the lengths satisfy min/max >
   t / (2 - t); values are keyed by length, and each probes the few lengths that can match
   (lossless for every t).  Pairs then pass a built-in screen before any Python: the indel
   distance is at least the Levenshtein distance, so pairs with ``levenshtein`` above
   (1 - t) * (len1 + len2) cannot be accepted.  Multi metric: a partial or token-sort ratio
   can be high at any lengths and distance, so all values of a column meet.
4. Scores in an Arrow pandas UDF: indel ratio 200 * LCS / (len1 + len2) with a
   bit-parallel LCS; optionally also partial and token-sort ratios (multi-metric mean of
   each scorer's best, target from the plain ratio).
5. Best partner per value (ties: more frequent, then smaller string); accepted when the
   score is strictly above ``100 * fuzzy_threshold``.
6. Every accepted pair maps the less frequent value to the more frequent one (ties: the
   smaller string is kept), so two close values never swap; chains are followed to their
   root by pointer jumping over the (small) correction table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.dictionary import Dictionary, category_counts, lookup
from ..functions.kinds import categorical_columns, q
from ..session import cut_lineage, ship_package
from .base import Fitted, Op, count_hits


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence (bit-parallel, Hyyro 2004)."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def indel_ratio(a: str, b: str) -> float:
    n = len(a) + len(b)
    return 100.0 if n == 0 else 200.0 * lcs_length(a, b) / n


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string against every same-length window of the longer."""
    s, l = (a, b) if len(a) <= len(b) else (b, a)
    m = len(s)
    if m == 0:
        return 100.0 if len(l) == 0 else 0.0
    best = 0.0
    for i in range(-(m - 1), len(l)):
        w = l[max(i, 0): i + m]
        if w:
            best = max(best, indel_ratio(s, w))
            if best == 100.0:
                break
    return best


def token_sort_ratio(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def normalise(c: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))


@F.pandas_udf(DoubleType())
def _ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([indel_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(DoubleType())
def _partial_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([partial_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(DoubleType())
def _token_sort_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_sort_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


@dataclass
class FittedTypos(Fitted):
    cols: list[str]
    table: Dictionary | None  # (column, value=wrong, right)

    def transform(self, df: DataFrame, counts: Observation | None = None) -> DataFrame:
        """``counts`` gathers the corrected rows per column during the next action."""
        if self.table is None:
            return df
        hits = {c: f"__hit_{i}" for i, c in enumerate(self.cols)}
        for c, h in hits.items():
            t = self.table.for_column(c)
            df = lookup(df, q(c).cast("string"), t, "value", ["right"], broadcast=self.table.local, sparse=True)
            df = df.withColumn(c, F.coalesce(F.col("right"), q(c))).withColumn(h, F.col("right").isNotNull()).drop("right")
        return count_hits(df, hits, counts)

    def corrections(self) -> DataFrame:
        return self.table.df.withColumnRenamed("value", "wrong")


class TypoCorrection(Op):
    def __init__(self, cols: Sequence[str] | None = None, fuzzy_threshold: float = 0.8, normalize: bool = True,
                 use_multiple_metrics: bool = False, exclude: Sequence[str] = ()):
        self.cols, self.t, self.normalize, self.multi = cols, fuzzy_threshold, normalize, use_multiple_metrics
        self.exclude = exclude

    def candidates(self, vals: DataFrame) -> DataFrame:
        """(column, a, b, na, nb, xa, xb) candidate pairs, a != b; no pair that could be
        accepted is left out."""
        A = vals.select("column", F.col("value").alias("a"), F.col("n").alias("na"), F.col("x").alias("xa"), F.length("x").alias("la"))
        B = vals.select("column", F.col("value").alias("b"), F.col("n").alias("nb"), F.col("x").alias("xb"), F.length("x").alias("lb"))
        cols = ["column", "a", "b", "na", "nb", "xa", "xb"]
        if self.multi:
            return A.join(B, "column").filter(F.col("a") != F.col("b")).select(*cols)
        bound = F.lit(self.t / (2.0 - self.t))
        low, high = F.floor(F.col("la") * bound).cast("int"), F.ceil(F.col("la") / F.greatest(bound, F.lit(1e-9))).cast("int")
        longest = vals.agg(F.max(F.length("x"))).first()[0] or 0
        probe = A.withColumn("lb", F.explode(F.sequence(low, F.least(F.greatest(low, high), F.greatest(low, F.lit(longest))))))
        pairs = probe.join(B, ["column", "lb"]).filter(F.col("a") != F.col("b"))
        most = F.floor(F.lit(1.0 - self.t) * (F.col("la") + F.col("lb")) + 1e-9).cast("int")
        return pairs.filter((F.col("xa") == F.col("xb")) | (F.levenshtein("xa", "xb") <= most)).select(*cols)

    def fit(self, df: DataFrame) -> FittedTypos:
        cols = list(self.cols) if self.cols is not None else categorical_columns(df, self.exclude)
        if not cols:
            return FittedTypos([], None)
        ship_package(df.sparkSession)
        counts = category_counts(df, cols, keep_nulls=False)
        x = normalise(F.col("value")) if self.normalize else F.col("value")
        vals = cut_lineage(counts.select("column", "value", "n", x.alias("x")))
        cand = self.candidates(vals).withColumn("ratio", _ratio_udf("xa", "xb"))
        by_a = Window.partitionBy("column", "a").orderBy(F.desc("ratio"), F.desc("nb"), F.asc("b"))
        best = cand.withColumn("rk", F.row_number().over(by_a))
        if self.multi:
            cand = cand.withColumn("partial", _partial_udf("xa", "xb")).withColumn("tsort", _token_sort_udf("xa", "xb"))
            best = cand.withColumn("rk", F.row_number().over(by_a))
            wa = Window.partitionBy("column", "a")
            best = best.withColumn("score", (F.max("ratio").over(wa) + F.max("partial").over(wa)
                                             + F.max("tsort").over(wa)) / 3.0)
        else:
            best = best.withColumn("score", F.col("ratio"))
        acc = best.filter((F.col("rk") == 1) & (F.col("score") > F.lit(100.0 * self.t)))
        # direct every accepted pair from the less to the more frequent value
        a_wins = (F.col("na") > F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
        edges = acc.select("column",
                           F.when(a_wins, F.col("b")).otherwise(F.col("a")).alias("src"),
                           F.when(a_wins, F.col("a")).otherwise(F.col("b")).alias("dst"),
                           F.when(a_wins, F.col("na")).otherwise(F.col("nb")).alias("ndst")).distinct()
        w = Window.partitionBy("column", "src").orderBy(F.desc("ndst"), F.asc("dst"))
        m = edges.withColumn("rk", F.row_number().over(w)).filter("rk = 1").select("column", "src", "dst")
        m = cut_lineage(m)
        # pointer jumping: dst <- dst(dst) until no value points to a value that moves on
        while True:
            nxt = (m.alias("x").join(m.alias("y"), (F.col("x.column") == F.col("y.column")) & (F.col("x.dst") == F.col("y.src")), "left")
                   .select(F.col("x.column").alias("column"), F.col("x.src").alias("src"),
                           F.coalesce(F.col("y.dst"), F.col("x.dst")).alias("dst")))
            nxt = cut_lineage(nxt)
            moved = nxt.join(m, ["column", "src", "dst"], "left_anti").limit(1).count()
            m = nxt
            if moved == 0:
                break
        table = Dictionary.materialise(m.select("column", F.col("src").alias("value"), F.col("dst").alias("right")))
        return FittedTypos(cols, table)
