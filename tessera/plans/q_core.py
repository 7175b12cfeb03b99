"""Queries for imputation (MV) and feature generation (FE)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as fe
from ..operators import impute as mv
from .catalog import f1, f3, query, r6, train_of
from .oracle import f1_sql, f3_sql

F1_NUM = ["acctbal", "tenure", "total_charges", "monthly_charges"]


# ------------------------------------------------------------------------------- MV1
def _mv1(strategy, **kw):
    def run(spark, sf):
        df = f1(spark, sf)
        fit = mv.NumericFill(strategy, exclude=["id", "in_debt"], add_indicator=True, **kw).fit(train_of(df))
        out = fit.transform(df)
        # an indicator exists only for columns with nulls in the fit frame (reference rule)
        inds = [F.col(f"{c}_missing") if f"{c}_missing" in out.columns else F.lit(None).cast("int").alias(f"{c}_missing")
                for c in F1_NUM]
        return out.select("id", "is_test", *[r6(c) for c in F1_NUM], *inds)
    return run


def _mv1_sql(stat: str | None) -> str:
    has = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) > 0 AS h_{c}" for c in F1_NUM)
    fills = ", ".join(f"{stat}({c}) AS s_{c}" for c in F1_NUM) if stat else ", ".join(f"-1.0 AS s_{c}" for c in F1_NUM)
    cols = ", ".join(f"sig(CASE WHEN h.h_{c} THEN coalesce(CAST(f1.{c} AS DOUBLE), s.s_{c}) ELSE f1.{c} END) AS {c}"
                     for c in F1_NUM)
    inds = ", ".join(f"CASE WHEN h.h_{c} THEN CAST({c} IS NULL AS INTEGER) END AS {c}_missing" for c in F1_NUM)
    src = " FROM tr" if stat else ""
    return f1_sql(f"SELECT id, is_test, {cols}, {inds} FROM f1, s, h",
                  f"s AS (SELECT {fills}{src}), h AS (SELECT {has} FROM tr)")


query("mv1_median", _mv1_sql("median"))(_mv1("median"))
query("mv1_mean", _mv1_sql("avg"))(_mv1("mean"))
query("mv1_constant", _mv1_sql(None))(_mv1("constant", constant=-1.0))


# ------------------------------------------------------------------------------- MV3
@query("mv3_group", f3_sql(
    """SELECT f3.id, f3.is_test, sig(coalesce(f3.value, g.m, o.m)) AS value
       FROM f3 LEFT JOIN g ON CAST(f3.user_group AS VARCHAR) = g.k, o""",
    """g AS (SELECT CAST(user_group AS VARCHAR) AS k, median(value) AS m FROM tr3
             WHERE user_group IS NOT NULL GROUP BY 1),
       o AS (SELECT median(value) AS m FROM tr3)"""))
def mv3_group(spark, sf):
    df = f3(spark, sf)
    fit = mv.GroupNumericFill("user_group", ["value"], "median").fit(train_of(df))
    return fit.transform(df).select("id", "is_test", r6("value"))


@query("mv3_group_mean", f1_sql(
    """SELECT f1.id, f1.is_test, sig(coalesce(f1.acctbal, g.a, o.a)) AS acctbal,
              sig(coalesce(CAST(f1.tenure AS DOUBLE), g.t, o.t)) AS tenure
       FROM f1 LEFT JOIN g ON f1.region = g.k, o""",
    """g AS (SELECT region AS k, avg(acctbal) AS a, avg(tenure) AS t FROM tr GROUP BY 1),
       o AS (SELECT avg(acctbal) AS a, avg(tenure) AS t FROM tr)"""))
def mv3_group_mean(spark, sf):
    df = f1(spark, sf)
    fit = mv.GroupNumericFill("region", ["acctbal", "tenure"], "mean").fit(train_of(df))
    return fit.transform(df).select("id", "is_test", r6("acctbal"), r6("tenure"))


# ------------------------------------------------------------------------------- MV4/5
_MODE_SEG = """m AS (SELECT segment AS v FROM tr WHERE segment IS NOT NULL
                   GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1)"""


@query("mv4_mode", f1_sql(
    "SELECT id, is_test, coalesce(segment, m.v) AS segment, CAST(segment IS NULL AS INTEGER) AS segment_missing FROM f1, m",
    _MODE_SEG))
def mv4_mode(spark, sf):
    df = f1(spark, sf)
    fit = mv.CategoricalFill("mode", add_indicator=True, exclude=["label"]).fit(train_of(df))
    return fit.transform(df).select("id", "is_test", "segment", "segment_missing")


@query("mv5_constant", f1_sql("SELECT id, is_test, coalesce(segment, 'Unknown') AS segment FROM f1"))
def mv5_constant(spark, sf):
    df = f1(spark, sf)
    fit = mv.CategoricalFill("constant", exclude=["label"]).fit(train_of(df))
    return fit.transform(df).select("id", "is_test", "segment")


# ------------------------------------------------------------------------------- MV6/7
_GROUP_MODE = """
gv AS (SELECT {g} AS k, {c} AS v, count(*) AS n FROM {t} WHERE {g} IS NOT NULL AND {c} IS NOT NULL GROUP BY 1, 2),
gr AS (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY n DESC, v) AS rn FROM gv),
gk AS (SELECT DISTINCT {g} AS k FROM {t} WHERE {g} IS NOT NULL),
gm AS (SELECT gk.k, coalesce(gr.v, 'Unknown') AS v FROM gk LEFT JOIN gr ON gk.k = gr.k AND gr.rn = 1),
om AS (SELECT coalesce((SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1), 'Unknown') AS v)
"""


@query("mv6_group_mode", f1_sql(
    "SELECT f1.id, f1.is_test, coalesce(f1.segment, gm.v, om.v) AS segment FROM f1 LEFT JOIN gm ON f1.nation = gm.k, om",
    _GROUP_MODE.format(g="nation", c="segment", t="tr")))
def mv6_group_mode(spark, sf):
    df = f1(spark, sf)
    fit = mv.GroupCategoricalFill("nation", ["segment"]).fit(train_of(df))
    return fit.transform(df).select("id", "is_test", "segment")


@query("mv7_dispatch", f3_sql(
    """SELECT f3.id, f3.is_test, 'group' AS strategy, coalesce(f3.event_type, gm.v, om.v) AS event_type
       FROM f3 LEFT JOIN gm ON CAST(f3.user_group AS VARCHAR) = gm.k, om
       UNION ALL SELECT id, is_test, 'mode', coalesce(event_type, om.v) FROM f3, om
       UNION ALL SELECT id, is_test, 'constant', coalesce(event_type, 'Unknown') FROM f3""",
    _GROUP_MODE.format(g="CAST(user_group AS VARCHAR)", c="event_type", t="tr3")))
def mv7_dispatch(spark, sf):
    df = f3(spark, sf)
    train = train_of(df).drop("raw_number")
    out = None
    for strategy in ("mode", "constant", "group"):
        fit = mv.categorical_missing(strategy, group_by="user_group").fit(train)
        rows = fit.transform(df).select("id", "is_test", F.lit(strategy).alias("strategy"), "event_type")
        out = rows if out is None else out.unionByName(rows)
    return out


# ------------------------------------------------------------------------------- FE1
@query("fe1_domain", f1_sql(
    """SELECT id, is_test,
              CAST(urgent = 'No' AND fulfilled = 'No' AS INTEGER) AS is_single,
              sig(m.t * monthly_charges) AS predict_LTV,
              sig(CASE WHEN total_charges IS NULL OR monthly_charges IS NULL THEN NULL
                       ELSE greatest(-1.0, least(1.0, 1 - total_charges / (m.t * monthly_charges + 1e-6))) END) AS LTV_ratio
       FROM f1, m""",
    "m AS (SELECT median(tenure) AS t FROM tr)"))
def fe1_domain(spark, sf):
    df = f1(spark, sf)
    fit = fe.DomainFeatures("urgent", "fulfilled", "tenure", "monthly_charges", "total_charges").fit(train_of(df))
    return fit.transform(df).select("id", "is_test", "is_single", r6("predict_LTV"), r6("LTV_ratio"))


# ------------------------------------------------------------------------------- FE2
_POLY = ["acctbal", "tenure", "total_charges", "monthly_charges"]


@query("fe2_poly", f1_sql(
    "SELECT id, is_test, " + ", ".join(
        f"sig({a} * {b}) AS {a}_{b}" for i, a in enumerate(_POLY) for b in _POLY[i + 1:]) + " FROM f1"))
def fe2_poly(spark, sf):
    df = f1(spark, sf)
    fit = fe.PolyFeatures(_POLY).fit(train_of(df))
    names = ["_".join(t) for t in fit.terms]
    return fit.transform(df).select("id", "is_test", *[r6(n) for n in names])


# ------------------------------------------------------------------------------- FE3
def _fe3_sql():
    cats, nums = ["segment", "region"], ["acctbal", "total_charges"]
    ctes = ["o AS (SELECT " + ", ".join(f"avg({n}) AS mean_{n}, median({n}) AS med_{n}" for n in nums) + " FROM tr)"]
    joins, cols = [], []
    for c in cats:
        ctes.append(f"g_{c} AS (SELECT {c} AS k, " + ", ".join(
            f"avg({n}) AS mean_{n}, median({n}) AS med_{n}" for n in nums) + f" FROM tr WHERE {c} IS NOT NULL GROUP BY 1)")
        joins.append(f"LEFT JOIN g_{c} ON f1.{c} = g_{c}.k")
        for n in nums:
            cols.append(f"sig(coalesce(g_{c}.mean_{n}, o.mean_{n})) AS {n}_mean_{c}")
            cols.append(f"sig(coalesce(g_{c}.med_{n}, o.med_{n})) AS {n}_median_{c}")
    return f1_sql("SELECT f1.id, f1.is_test, " + ", ".join(cols) + " FROM f1 " + " ".join(joins) + " CROSS JOIN o",
                  ",\n".join(ctes))


@query("fe3_group_stats", _fe3_sql())
def fe3_group_stats(spark, sf):
    df = f1(spark, sf)
    fit = fe.GroupStats(["segment", "region"], ["acctbal", "total_charges"]).fit(train_of(df))
    out = fit.transform(df)
    new = [f"{n}_{s}_{c}" for c in ["segment", "region"] for n in ["acctbal", "total_charges"] for s in ("mean", "median")]
    return out.select("id", "is_test", *[r6(c) for c in new])


# ------------------------------------------------------------------------------- FE4
@query("fe4_cat_pairs", f1_sql(
    """SELECT p.id, p.is_test,
              CASE WHEN r1.v IS NOT NULL THEN 'Other' ELSE p.segment_region END AS segment_region,
              CASE WHEN r2.v IS NOT NULL THEN 'Other' ELSE p.segment_urgent END AS segment_urgent,
              CASE WHEN r3.v IS NOT NULL THEN 'Other' ELSE p.region_urgent END AS region_urgent
       FROM p
       LEFT JOIN (SELECT v FROM sh WHERE c = 1 AND share < 0.02) r1 ON p.segment_region = r1.v
       LEFT JOIN (SELECT v FROM sh WHERE c = 2 AND share < 0.02) r2 ON p.segment_urgent = r2.v
       LEFT JOIN (SELECT v FROM sh WHERE c = 3 AND share < 0.02) r3 ON p.region_urgent = r3.v""",
    """p AS (SELECT id, is_test,
                    coalesce(segment, 'nan') || '_' || coalesce(region, 'nan') AS segment_region,
                    coalesce(segment, 'nan') || '_' || coalesce(urgent, 'nan') AS segment_urgent,
                    coalesce(region, 'nan') || '_' || coalesce(urgent, 'nan') AS region_urgent FROM f1),
       pt AS (SELECT * FROM p WHERE NOT is_test),
       sh AS (SELECT 1 AS c, segment_region AS v, count(*) / (SELECT count(*) FROM pt) AS share FROM pt GROUP BY 2
              UNION ALL SELECT 2, segment_urgent, count(*) / (SELECT count(*) FROM pt) FROM pt GROUP BY 2
              UNION ALL SELECT 3, region_urgent, count(*) / (SELECT count(*) FROM pt) FROM pt GROUP BY 2)"""))
def fe4_cat_pairs(spark, sf):
    df = f1(spark, sf)
    fit = fe.CatPairs(["segment", "region", "urgent"]).fit(train_of(df))
    return fit.transform(df).select("id", "is_test", "segment_region", "segment_urgent", "region_urgent")


# ------------------------------------------------------------------------------- FE5
@query("fe5_binary_ops", f1_sql(
    """SELECT id, is_test, in_debt & u AS in_debt_and_u, in_debt | u AS in_debt_or_u, xor(in_debt, u) AS in_debt_xor_u
       FROM (SELECT id, is_test, in_debt, CASE WHEN urgent = 'Yes' THEN 1 ELSE 0 END AS u FROM f1)"""))
def fe5_binary_ops(spark, sf):
    df = f1(spark, sf).withColumn("u", F.when(F.col("urgent") == "Yes", 1).otherwise(0))
    fit = fe.BinaryOps(exclude=["id"]).fit(train_of(df))
    return fit.transform(df).select("id", "is_test", "in_debt_and_u", "in_debt_or_u", "in_debt_xor_u")


# ------------------------------------------------------------------------------- FE6
@query("fe6_align")
def fe6_align(spark, sf):
    df = f1(spark, sf).drop("label")
    fit = fe.Interactions(exclude=["id"], **fe.Interactions.REFERENCE_LIMITS).fit(train_of(df))
    return fit.transform(df)
