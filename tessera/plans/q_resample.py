"""Queries for the synthetic-row resamplers (IB5-IB9).  The synthetic rows themselves get
rows-only checks; ``ib5_counts`` and ``ib6_counts`` hold class counts and distinct ids against
SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import resample as ib
from .catalog import query
from .oracle import F4
from .q_neighbors import _f4z

Z = ["z0", "z1", "z2"]


def _run(fn, **kw):
    def run(spark, sf):
        z = _f4z(spark, sf)
        return fn(z, "toxic", "id", Z, **kw).select("id", "toxic", *Z)
    return run


query("ib5_smote")(_run(ib.smote, k_neighbors=5))
query("ib6_borderline_smote")(_run(ib.borderline_smote, kind="borderline-1"))
query("ib6_borderline_smote2")(_run(ib.borderline_smote, kind="borderline-2"))


def _counts(*fns):
    """Class counts after resampling: every variant brings the classes to the same size."""
    def run(spark, sf):
        z = _f4z(spark, sf)
        out = None
        for name, fn, kw in fns:
            c = fn(z, "toxic", "id", Z, **kw).groupBy("toxic").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids")).withColumn("method", F.lit(name))
            out = c if out is None else out.unionByName(c)
        return out.select("method", "toxic", "n", "ids")
    return run


_BALANCED = "WITH " + F4 + """,
big AS (SELECT max(n) AS n FROM (SELECT count(*) AS n FROM f4 GROUP BY toxic))
SELECT m.method, t.toxic, big.n AS n, big.n AS ids
FROM (VALUES {}) m(method), (SELECT DISTINCT toxic FROM f4) t, big"""
query("ib5_counts", _BALANCED.format("('smote')"))(_counts(("smote", ib.smote, {"k_neighbors": 5})))
query("ib6_counts", _BALANCED.format("('borderline-1'), ('borderline-2')"))(
    _counts(*[(k, ib.borderline_smote, {"kind": k}) for k in ("borderline-1", "borderline-2")]))
query("ib7_adasyn")(_run(ib.adasyn))
query("ib8_smote_enn")(_run(ib.smote_enn))
query("ib9_smote_tomek")(_run(ib.smote_tomek))
