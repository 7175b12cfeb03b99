"""Feature selection (FS1-FS9).

Statistics for all candidate features come from one aggregate (variance, null share) or
one grouped count over the long (feature, bin, label) view (mutual information), so the
cost is one or two scans regardless of the number of features.  Model-based rankers use
``pyspark.ml`` (see ``plans.models``) on an assembled vector.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.kinds import numeric_columns, q, sql_double, sql_name
from ..functions.prefix import running_totals
from ..functions.stats import CHUNK, EXACT, corr_long, medians, quantiles
from ..session import cached, stage_table
from .base import Fitted, Op


@dataclass
class FittedSelection(Fitted):
    """Keeps ``kept`` (in schema order) and drops ``dropped``; ``scores`` is a DataFrame."""

    kept: list[str]
    dropped: list[str]
    scores: DataFrame | None = None
    info: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*[c for c in self.dropped if c in df.columns])


def _features(df: DataFrame, features, exclude) -> list[str]:
    return list(features) if features is not None else numeric_columns(df, exclude)


def filled_sql(column: str, value: float | None) -> str:
    """SQL text: the column as double, nulls filled with ``value``."""
    return f"coalesce(cast({sql_name(column)} AS double), {sql_double(value)})"


class LowVariance(Op):
    """FS1 — population variance after median fill must exceed ``threshold``; constant
    columns (max = min) are always dropped."""

    def __init__(self, threshold: float = 0.0, features=None, exclude: Sequence[str] = ()):
        self.threshold, self.features, self.exclude = threshold, features, exclude

    def scores(self, df: DataFrame) -> DataFrame:
        """(feature, variance, constant, kept) — one row per feature, computed from the
        projected fit frame persisted across its three passes."""
        cols = _features(df, self.features, self.exclude)
        with cached(df, cols) as d:
            med = medians(d, cols)
            rows = []
            for b in range(0, len(cols), CHUNK):  # an aggregate of all columns would outgrow codegen
                part = cols[b:b + CHUNK]
                filled = [filled_sql(c, med[c]) for c in part]
                w = d.selectExpr(*[f"var_pop({x}) AS v{i}" for i, x in enumerate(filled)],
                                 *[f"max({x}) = min({x}) AS k{i}" for i, x in enumerate(filled)]).first()
                for i, c in enumerate(part):
                    v, k = w[f"v{i}"], w[f"k{i}"]
                    rows.append((c, v, k, bool(v is not None and v > self.threshold and k is False)))
        return df.sparkSession.createDataFrame(rows, "feature string, variance double, constant boolean, kept boolean")

    def fit(self, df: DataFrame) -> FittedSelection:
        s = self.scores(df)
        rows = s.collect()  # one row per feature
        return FittedSelection([r["feature"] for r in rows if r["kept"]],
                               [r["feature"] for r in rows if not r["kept"]], s)


class HighMissing(Op):
    """FS2 — drop features whose null share exceeds ``threshold``."""

    def __init__(self, threshold: float = 0.9, features=None, exclude: Sequence[str] = ()):
        self.threshold, self.features, self.exclude = threshold, features, exclude

    def scores(self, df: DataFrame) -> DataFrame:
        cols = list(self.features) if self.features is not None else [c for c in df.columns if c not in self.exclude]
        wide = df.selectExpr("array(" + ", ".join(f"avg(cast({sql_name(c)} IS NULL AS double))" for c in cols) + ") AS shares")
        names = F.array(*[F.lit(c) for c in cols])
        rows = wide.select(F.posexplode("shares").alias("i", "null_share"))
        return rows.select(names[F.col("i")].alias("feature"), "null_share", (~(F.col("null_share") > F.lit(self.threshold))).alias("kept"))

    def fit(self, df: DataFrame) -> FittedSelection:
        s = self.scores(df)
        rows = s.collect()
        return FittedSelection([r["feature"] for r in rows if r["kept"]],
                               [r["feature"] for r in rows if not r["kept"]], s)


def digamma(n: Column) -> Column:
    """Digamma function of a positive integer: ten steps of the recurrence, then the asymptotic
    series (exact to about 1e-13)."""
    x = n.cast("double")
    big = x + F.lit(10.0)
    steps = F.lit(0.0)
    for i in range(10):
        steps = steps + F.lit(1.0) / (x + F.lit(float(i)))
    inv2 = F.lit(1.0) / (big * big)
    return F.log(big) - F.lit(0.5) / big - inv2 * (F.lit(1 / 12) - inv2 * (F.lit(1 / 120) - inv2 * F.lit(1 / 252))) - steps


#: A neighbour exactly at the radius is outside; this share of the radius covers rounding.
INSIDE = 1.0 - 1e-12


def neighbour_information(df: DataFrame, label: str, features: Sequence[str], k: int = 3) -> DataFrame:
    """(feature, mi): mutual information in nats between numeric features (no nulls) and a class,
    from the distance to the k-th neighbour of the same class (Ross, 2014).

    psi(n) + mean psi(k_i) - mean psi(n_class) - mean psi(m_i), at least 0: m_i counts the rows
    nearer than the k-th neighbour of the own class, the row itself included.  Where that
    distance is 0 (repeated values) k_i and m_i count the equal rows, as the estimator for
    mixed data does (Gao et al., 2017).  Classes of one row take no part.

    Nothing is sorted in one task: the neighbours of a row lie within k places in the order
    (feature, class, value), which is numbered over ranges; a row is sent to the places around
    it and each place keeps 2k + 1 rows.  The counts are two searches per row in the order
    (feature, value), running totals over the union of rows and searches."""
    items = F.expr("array(" + ", ".join(f"named_struct('f', {i}, 'x', cast({sql_name(c)} AS double))" for i, c in enumerate(features)) + ")")
    y = q(label).cast("string").alias("y")
    sizes = df.select(y).filter("y is not null").groupBy("y").agg(F.count(F.lit(1)).alias("ny")).filter("ny > 1")
    long = df.select(y, F.monotonically_increasing_id().alias("uid"), F.inline(items)).join(F.broadcast(sizes), "y")
    long = long.filter(F.col("x").isNotNull() & ~F.isnan("x"))
    placed = stage_table(running_totals(long, ["f", "y", "x", "uid"], []).withColumnRenamed("__rank", "place"))

    around = placed.select("f", "y", "x", "place", F.explode(F.sequence(F.lit(-k), F.lit(k))).alias("d"))
    met = around.groupBy((F.col("place") + F.col("d")).alias("place")).agg(F.collect_list(F.struct("d", "f", "y", "x")).alias("met"))
    near = placed.join(met, "place")
    same = F.filter("met", lambda e: (e["f"] == F.col("f")) & (e["y"] == F.col("y")) & (e["d"] != 0))
    dist = F.array_sort(F.transform(same, lambda e: F.abs(e["x"] - F.col("x"))))
    kk = F.least(F.lit(k).cast("long"), F.col("ny") - 1)
    near = stage_table(near.select("f", "y", "x", "ny", "place", kk.alias("k"), F.element_at(dist, kk.cast("int")).alias("r")))

    # ends of each search; of equal values, rows stand between the searches "below" and "up to"
    r = F.col("r") * F.lit(INSIDE)
    none = F.lit(0).cast("long")
    searches = near.select("f", "place", F.inline(F.array(
        F.struct(F.when(F.col("r") > 0, F.col("x") - r).otherwise(F.col("x")).alias("v"), F.when(F.col("r") > 0, 2).otherwise(0).alias("kind"), F.lit(-1).alias("sign")),
        F.struct(F.when(F.col("r") > 0, F.col("x") + r).otherwise(F.col("x")).alias("v"), F.when(F.col("r") > 0, 0).otherwise(2).alias("kind"), F.lit(1).alias("sign")))))
    events = (near.select("f", F.col("x").alias("v"), F.lit(1).alias("kind"), "place", F.lit(0).alias("sign"), F.lit(1).cast("long").alias("one"))
              .unionByName(searches.withColumn("one", none)))
    totals = running_totals(events, ["f", "v", "kind", "place", "sign"], ["one"])
    m = totals.filter("sign != 0").groupBy("place").agg(F.sum(F.col("sign") * F.col("cum_one")).alias("m"))
    rows = near.join(m, "place")
    apart = rows.filter("r > 0").select("f", F.lit(1).cast("long").alias("c"), (digamma(F.col("k")) - digamma(F.col("ny")) - digamma(F.col("m"))).alias("t"))
    equal = (rows.filter("r = 0").groupBy("f", "y", "x").agg(F.count(F.lit(1)).alias("c"), F.first("ny").alias("ny"), F.first("m").alias("m"))
             .select("f", "c", (F.col("c") * (digamma(F.col("c") - 1) - digamma(F.col("ny")) - digamma(F.col("m")))).alias("t")))
    got = apart.unionByName(equal).groupBy("f").agg(F.sum("c").alias("n"), F.sum("t").alias("t")).withColumn("mean", F.col("t") / F.col("n"))
    names = F.array(*[F.lit(c) for c in features])
    return got.select(names[F.col("f")].alias("feature"), F.greatest(F.lit(0.0), digamma(F.col("n")) + F.col("mean")).alias("mi"))


class MutualInfo(Op):
    """FS3 — mutual information (nats) between each feature and the class, keep MI >
    threshold; nulls are filled with the median first.  Estimators: 'neighbours'
    (``neighbour_information``; numeric features) and 'binned': a feature with at
    most ``max_exact`` distinct values is used as is, otherwise it is cut at its exact
    ``bins``-quantiles; MI = sum p(x,y) ln(p(x,y) / (p(x) p(y))) from one grouped count of
    (feature, bin, label) over the long view of all features."""

    def __init__(self, label: str, threshold: float = 0.001, features=None, bins: int = 10,
                 max_exact: int = 32, exclude: Sequence[str] = (), quantile_method: str = EXACT,
                 estimator: str = "neighbours", n_neighbors: int = 3):
        if estimator not in ("neighbours", "binned"):
            raise ValueError(f"unknown estimator {estimator!r}")
        self.label, self.threshold, self.features, self.bins = label, threshold, features, bins
        self.max_exact, self.exclude, self.quantile_method = max_exact, tuple(exclude) + (label,), quantile_method
        self.estimator, self.n_neighbors = estimator, n_neighbors

    def binned(self, df: DataFrame) -> DataFrame:
        cols = _features(df, self.features, self.exclude)
        probs = [i / self.bins for i in range(1, self.bins)]
        # sketch distinct counts first (bounded state); exact counts only for the columns the
        # sketch places near or below max_exact; exact deciles in two bounded passes
        dist = df.agg(*[F.approx_count_distinct(q(c), 0.05).alias(f"a{i}") for i, c in enumerate(cols)]).first()
        small = [c for i, c in enumerate(cols) if dist[f"a{i}"] <= 2 * self.max_exact]
        exact_d = df.agg(*[F.count_distinct(q(c)).alias(c) for c in small]).first().asDict() if small else {}
        qs = quantiles(df, cols, probs + [0.5], self.quantile_method)  # deciles and the median, 2 passes
        med = {c: qs[c][-1] for c in cols}
        qs = {c: qs[c][:-1] for c in cols}
        stats = {}
        for i, c in enumerate(cols):
            stats[f"d{i}"] = exact_d.get(c, self.max_exact + 1)
            stats[f"e{i}"] = qs[c]
        items = []
        for i, c in enumerate(cols):
            x = F.coalesce(q(c).cast("double"), F.lit(med[c]))
            if stats[f"d{i}"] <= self.max_exact or stats[f"e{i}"][0] is None:
                b = x
            else:
                edges = sorted(set(stats[f"e{i}"]))
                b = F.lit(0.0)
                for e in edges:
                    b = b + F.when(x > F.lit(e), 1.0).otherwise(0.0)
            items.append(F.struct(F.lit(c).alias("feature"), b.alias("bin")))
        return df.select(q(self.label).cast("string").alias("y"), F.inline(F.array(*items)))

    def scores(self, df: DataFrame) -> DataFrame:
        """(feature, mi, kept) — the projected fit frame is persisted across the passes; the
        contingency table (features x bins x classes) is small and joined locally."""
        cols = _features(df, self.features, self.exclude)
        if self.estimator == "neighbours":
            with cached(df, cols + [self.label]) as d:
                gaps = [c for c, n in zip(cols, d.selectExpr(*[f"count_if({sql_name(c)} IS NULL)" for c in cols]).first()) if n] if cols else []
                med = medians(d, gaps, self.quantile_method) if gaps else {}
                filled = d.selectExpr(sql_name(self.label), *[f"{filled_sql(c, med.get(c))} AS {sql_name(c)}" for c in cols])
                rows = neighbour_information(filled, self.label, cols, self.n_neighbors).collect() if cols else []  # one row per feature
            mi = {r["feature"]: r["mi"] for r in rows}
            out = [(c, mi.get(c), bool(mi.get(c) is not None and mi[c] > self.threshold)) for c in cols]
            return df.sparkSession.createDataFrame(out, "feature string, mi double, kept boolean")
        with cached(df, cols + [self.label]) as d:
            long = self.binned(d)
            joint = long.groupBy("feature", "bin", "y").agg(F.count(F.lit(1)).alias("nxy"))
            n = F.sum("nxy").over(Window.partitionBy("feature"))
            nx = F.sum("nxy").over(Window.partitionBy("feature", "bin"))
            ny = F.sum("nxy").over(Window.partitionBy("feature", "y"))
            t = joint.select("feature", "nxy", n.cast("double").alias("n"), nx.alias("nx"), ny.alias("ny"))
            term = (F.col("nxy") / F.col("n")) * F.log((F.col("nxy") * F.col("n")) / (F.col("nx") * F.col("ny")))
            rows = t.groupBy("feature").agg(F.sum(term).alias("mi")).collect()  # one row per feature
        mi = {r["feature"]: r["mi"] for r in rows}
        out = [(c, mi.get(c), bool(mi.get(c) is not None and mi[c] > self.threshold)) for c in cols]
        return df.sparkSession.createDataFrame(out, "feature string, mi double, kept boolean")

    def fit(self, df: DataFrame) -> FittedSelection:
        cols = _features(df, self.features, self.exclude)
        s = self.scores(df)
        rows = {r["feature"]: r for r in s.collect()}
        return FittedSelection([c for c in cols if rows[c]["kept"]], [c for c in cols if not rows[c]["kept"]], s,
                               {"mi": {c: rows[c]["mi"] for c in cols}})


def correlated_drops(df: DataFrame, features: Sequence[str], importance: DataFrame, threshold: float = 0.95) -> DataFrame:
    """FS6 — for every pair (earlier i, later j) with |r| > threshold, judged on its own
    (already dropped columns included): drop j if imp_j < imp_i, else drop i (so ties and
    missing importances drop the earlier one).  ``importance`` is (feature, importance);
    unknown importance = 0; an undefined r never matches.  Returns distinct (feature)."""
    pairs = corr_long(df, list(features), "upper").filter(F.abs("r") > F.lit(threshold))
    imp = importance.select(F.col("feature"), F.col("importance").cast("double"))
    ia = imp.select(F.col("feature").alias("a"), F.col("importance").alias("ia"))
    ib = imp.select(F.col("feature").alias("b"), F.col("importance").alias("ib"))
    j = pairs.join(F.broadcast(ia), "a", "left").join(F.broadcast(ib), "b", "left")
    loser = F.when(F.coalesce("ib", F.lit(0.0)) < F.coalesce("ia", F.lit(0.0)), F.col("b")).otherwise(F.col("a"))
    return j.select(loser.alias("feature")).distinct()


class CorrelatedRemoval(Op):
    """FS6 as an operator: importances are given as a dict or DataFrame."""

    def __init__(self, importance: dict | DataFrame | None = None, threshold: float = 0.95,
                 features=None, exclude: Sequence[str] = ()):
        self.importance, self.threshold, self.features, self.exclude = importance, threshold, features, exclude

    def fit(self, df: DataFrame) -> FittedSelection:
        cols = _features(df, self.features, self.exclude)
        imp = self.importance
        if imp is None or isinstance(imp, dict):
            rows = [(k, float(v)) for k, v in (imp or {}).items()]
            imp = df.sparkSession.createDataFrame(rows, "feature string, importance double")
        dropped = {r["feature"] for r in correlated_drops(df, cols, imp, self.threshold).collect()}
        return FittedSelection([c for c in cols if c not in dropped], [c for c in cols if c in dropped])
