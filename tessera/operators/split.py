"""Seeded, exact, stratified hold-out split (IO4), k folds, and exact per-class cuts (IB2).

Row order is a seeded hash: ``h = md5(seed || '|' || id)``.  The test part of class c is
its ``floor(frac * n_c + 0.5)`` rows with the smallest ``(h, id)``.  Nothing is sorted
globally and no class is gathered into one task:

1. count rows per (class, hash bucket) — the bucket is the first ``digits`` hex chars
   of h, so this is a small aggregate (classes x 16^digits rows at most);
2. a running sum over the buckets of each class (a window over that small table)
   finds the boundary bucket and how many of its rows are still needed;
3. inside the boundary bucket only (about n_c / 16^digits rows) the needed row is
   ranked, giving one threshold (h, id) per class;
4. membership is then a pure expression: ``bucket < b or (bucket = b and (h, id) <= t)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.kinds import q


def hash_key(id_col: str, seed: int | str = 42, purpose: str = "") -> Column:
    pre = f"{seed}|{purpose + '|' if purpose else ''}"
    return F.md5(F.concat(F.lit(pre), q(id_col).cast("string")))


def exact_first_n(df: DataFrame, by: str | None, id_col: str, counts: dict | Column,
                  seed: int | str = 42, purpose: str = "", digits: int = 4) -> Column:
    """Boolean column: the row is among the first ``counts[class]`` rows of its class in
    seeded hash order.  ``counts`` maps class value -> wanted rows (None key = no class)."""
    h = hash_key(id_col, seed, purpose)
    b = F.substring(h, 1, digits)
    cls = q(by).cast("string") if by else F.lit("")
    tmp = df.select(cls.alias("__c"), b.alias("__b"), h.alias("__h"), q(id_col).alias("__id"))
    want = {("" if by is None else (None if k is None else str(k))): int(v) for k, v in counts.items()}
    per = tmp.groupBy("__c", "__b").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("__c").orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    cum = per.withColumn("cum", F.sum("n").over(w)).withColumn("before", F.col("cum") - F.col("n"))
    want_map = F.create_map(*[x for k, v in want.items() if k is not None for x in (F.lit(k), F.lit(v))]) \
        if any(k is not None for k in want) else None
    wanted = want_map[F.col("__c")] if want_map is not None else F.lit(None)
    bound = (cum.withColumn("want", wanted)
             .filter((F.col("want") > F.col("before")) & (F.col("want") <= F.col("cum")))
             .select("__c", "__b", (F.col("want") - F.col("before")).alias("k")))
    bounds = bound.collect()  # at most one row per class
    thresholds = {}
    if bounds:
        cond = None
        for r in bounds:
            c = (F.col("__c") == r["__c"]) & (F.col("__b") == r["__b"])
            cond = c if cond is None else (cond | c)
        inside = tmp.filter(cond)
        rw = Window.partitionBy("__c").orderBy("__h", "__id")
        ks = F.create_map(*[x for r in bounds for x in (F.lit(r["__c"]), F.lit(r["k"]))])
        picked = (inside.withColumn("rn", F.row_number().over(rw))
                  .filter(F.col("rn") == ks[F.col("__c")])
                  .select("__c", "__b", "__h", "__id").collect())
        thresholds = {r["__c"]: (r["__b"], r["__h"], r["__id"]) for r in picked}
    # classes whose wanted count covers them entirely
    totals = {r["__c"]: r["n"] for r in tmp.groupBy("__c").agg(F.count(F.lit(1)).alias("n")).collect()} \
        if len(thresholds) < len([k for k in want if k is not None]) else {}
    out = F.lit(False)
    for k, v in want.items():
        if k is None:
            continue
        in_c = cls == F.lit(k)
        if k in thresholds:
            bb, hh, ii = thresholds[k]
            cond = (b < F.lit(bb)) | ((b == F.lit(bb)) & ((h < F.lit(hh)) | ((h == F.lit(hh)) & (q(id_col) <= F.lit(ii)))))
            out = F.when(in_c, cond).otherwise(out)
        elif v > 0 and totals.get(k, 0) <= v:
            out = F.when(in_c, F.lit(True)).otherwise(out)
        else:
            out = F.when(in_c, F.lit(False)).otherwise(out)
    return F.coalesce(out, F.lit(False))


def stratified_split(df: DataFrame, label: str, id_col: str, test_size: float = 0.2,
                     seed: int | str = 42, out_col: str = "is_test") -> DataFrame:
    """Add ``out_col``: exactly floor(test_size * n_c + 0.5) rows of every class c."""
    counts = {r[0]: r[1] for r in df.groupBy(q(label).cast("string")).count().collect()}
    want = {k: int(test_size * n + 0.5) for k, n in counts.items()}
    return df.withColumn(out_col, exact_first_n(df, label, id_col, want, seed, "split"))


def fold_column(df: DataFrame, label: str, id_col: str, k: int = 3, seed: int | str = 42,
                out_col: str = "fold") -> DataFrame:
    """Stratified fold number 0..k-1 with exact class shares: fold j of class c holds its
    rows ranked in [floor(j*n_c/k + .5), floor((j+1)*n_c/k + .5)) in seeded hash order.
    Built from k-1 exact cuts (no class is ranked as a whole in one task)."""
    counts = {r[0]: r[1] for r in df.groupBy(q(label).cast("string")).count().collect()}
    fold = F.lit(0)
    for j in range(1, k):
        want = {c: int(j * n / k + 0.5) for c, n in counts.items()}
        fold = fold + F.when(exact_first_n(df, label, id_col, want, seed, "fold"), 0).otherwise(1)
    return df.withColumn(out_col, fold.cast("int"))
