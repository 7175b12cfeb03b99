"""Queries for numeric (OD/OT) and categorical (CD/CT) outliers."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..operators import categories as ct
from ..operators import outliers as od
from ..sources.readers import table
from .catalog import ORACLES, f1, f3, query, r6, train_of
from .oracle import f1_sql, f3_sql

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _iqr_flag_sql(cols, b="b"):
    return " OR ".join(f"coalesce({c} < {b}.lo_{c} OR {c} > {b}.hi_{c}, false)" for c in cols)


def _iqr_bounds_sql(cols, src):
    parts = []
    for c in cols:
        parts.append(f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo_{c}")
        parts.append(f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi_{c}")
    return f"SELECT {', '.join(parts)} FROM {src}"


@query("od1_iqr", f"""WITH b AS ({_iqr_bounds_sql(['value'], 'events')})
SELECT event_id, value, {_iqr_flag_sql(['value'])} AS is_outlier FROM events, b""")
def od1_iqr(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "value")
    return od.IQROutliers(["value"]).fit(ev).transform(ev)


@query("od1_iqr_lineitem", f"""WITH b AS ({_iqr_bounds_sql(LI_NUM, 'lineitem')})
SELECT l_orderkey, l_linenumber, {_iqr_flag_sql(LI_NUM)} AS is_outlier FROM lineitem, b""")
def od1_iqr_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    fit = od.IQROutliers(LI_NUM).fit(li)
    return fit.transform(li).select("l_orderkey", "l_linenumber", "is_outlier")


@query("od1_bounds", "\nUNION ALL ".join(
    f"""SELECT '{c}' AS column, sig(quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))) AS lower,
               sig(quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))) AS upper FROM lineitem"""
    for c in LI_NUM))
def od1_bounds(spark, sf):
    fit = od.IQROutliers(LI_NUM).fit(table(spark, sf, "lineitem"))
    return fit.report(spark).select("column", r6("lower"), r6("upper"))


def _mad_sql(cols, src):
    med = ", ".join(f"median({c}) AS m_{c}" for c in cols)
    mad = ", ".join(f"median(abs({c} - m.m_{c})) AS d_{c}" for c in cols)
    bounds = ", ".join(f"m.m_{c} - 3.0 * d.d_{c} AS lo_{c}, m.m_{c} + 3.0 * d.d_{c} AS hi_{c}" for c in cols)
    return (f"m AS (SELECT {med} FROM {src}), d AS (SELECT {mad} FROM {src}, m), "
            f"b AS (SELECT {bounds} FROM m, d)")


@query("od2_mad", f"""WITH {_mad_sql(['value'], 'events')}
SELECT event_id, value, {_iqr_flag_sql(['value'])} AS is_outlier FROM events, b""")
def od2_mad(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "value")
    return od.MADOutliers(["value"]).fit(ev).transform(ev)


@query("od2_mad_lineitem", f"""WITH {_mad_sql(LI_NUM, 'lineitem')}
SELECT l_orderkey, l_linenumber, {_iqr_flag_sql(LI_NUM)} AS is_outlier FROM lineitem, b""")
def od2_mad_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    fit = od.MADOutliers(LI_NUM).fit(li)
    return fit.transform(li).select("l_orderkey", "l_linenumber", "is_outlier")


_F3B = f"b AS ({_iqr_bounds_sql(['value'], 'tr3')})"


@query("ot1_drop", f3_sql(f"SELECT id, value FROM tr3, b WHERE NOT ({_iqr_flag_sql(['value'])})", _F3B))
def ot1_drop(spark, sf):
    df = f3(spark, sf)
    tr = train_of(df)
    return od.IQROutliers(["value"]).fit(tr).drop(tr).select("id", "value")


@query("ot2_cap", f3_sql(
    "SELECT id, is_test, CASE WHEN value IS NULL THEN NULL ELSE least(greatest(value, b.lo_value), b.hi_value) END AS value FROM f3, b",
    _F3B))
def ot2_cap(spark, sf):
    df = f3(spark, sf)
    fit = od.IQROutliers(["value"]).fit(train_of(df))
    return fit.cap(df).select("id", "is_test", "value")


@query("ot3_flags", f3_sql(
    f"SELECT id, is_test, CAST({_iqr_flag_sql(['value'])} AS INTEGER) AS outlier_value FROM f3, b", _F3B))
def ot3_flags(spark, sf):
    df = f3(spark, sf)
    fit = od.IQROutliers(["value"]).fit(train_of(df))
    return fit.flags(df).select("id", "is_test", "outlier_value")


# ------------------------------------------------------------------------------- CD
_CATS = ["segment", "nation", "region"]


def _counts_sql(cols=_CATS, src="tr"):
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS col, {c} AS v, count(*) AS n FROM {src} WHERE {c} IS NOT NULL GROUP BY 2" for c in cols)


def _row_flag(flagset: str, cols=_CATS, src="f1"):
    return " OR ".join(
        f"coalesce({src}.{c} IN (SELECT v FROM {flagset} WHERE col = '{c}'), false)" for c in cols)


_RARE = """tot AS (SELECT count(*) AS t FROM tr),
c AS ({counts}),
rare AS (SELECT col, v FROM c, tot WHERE n / t < {th} OR n < 5)"""

_ANOM = """anom AS (SELECT col, v FROM c WHERE length(v) < 1 OR length(v) > {ml}
                    OR regexp_matches(v, '[0-9]') {special})"""

_UNEXP = """unexp AS (SELECT col, v FROM (SELECT col, v, row_number() OVER (PARTITION BY col ORDER BY n DESC, v) AS rk FROM c)
                      WHERE rk > 20)"""


@query("cd1_rare", f1_sql(f"SELECT id, is_test, {_row_flag('rare')} AS is_rare FROM f1",
                          _RARE.format(counts=_counts_sql(), th=0.01)))
def cd1_rare(spark, sf):
    df = f1(spark, sf)
    fit = ct.rare_categories(cols=_CATS, threshold=0.01, min_count=5).fit(train_of(df))
    return fit.detect(df).select("id", "is_test", "is_rare")


@query("cd1_rare_report", """
WITH c AS (SELECT p_name AS v, count(*) AS n FROM part GROUP BY 1), t AS (SELECT count(*) AS t FROM part)
SELECT 'p_name' AS column, v AS value, n, sig(n * 100.0 / t) AS pct FROM c, t WHERE n / t < 0.015 OR n < 5""")
def cd1_rare_report(spark, sf):
    p = table(spark, sf, "part").select("p_name")
    fit = ct.rare_categories(cols=["p_name"], threshold=0.015).fit(p)
    return fit.report().select("column", "value", "n", r6("pct"))


@query("cd1_combined_share", """
WITH c AS (SELECT p_name AS v, count(*) AS n FROM part GROUP BY 1), t AS (SELECT count(*) AS t FROM part)
SELECT 'p_name' AS column, count(*) AS n_values, CAST(sum(n) AS BIGINT) AS n_rows, sig(sum(n) * 100.0 / any_value(t)) AS pct
FROM c, t WHERE n / t < 0.015 OR n < 5 HAVING count(*) > 0""")
def cd1_combined_share(spark, sf):
    p = table(spark, sf, "part").select("p_name")
    fit = ct.rare_categories(cols=["p_name"], threshold=0.015).fit(p)
    return fit.combined_share().select("column", "n_values", "n_rows", r6("pct"))


@query("cd2_string", f1_sql(
    f"SELECT id, is_test, {_row_flag('anom')} AS is_string FROM f1",
    "c AS (" + _counts_sql() + "),\n" + _ANOM.format(ml=8, special="OR regexp_matches(v, '[^A-Za-z0-9_\\s]')")))
def cd2_string(spark, sf):
    df = f1(spark, sf)
    fit = ct.string_anomalies(cols=_CATS, max_length=8, allow_special_chars=False).fit(train_of(df))
    return fit.detect(df).select("id", "is_test", "is_string")


@query("cd2_string_orders", """
WITH c AS (SELECT DISTINCT o_orderpriority AS v FROM orders),
     anom AS (SELECT v FROM c WHERE length(v) > 10 OR regexp_matches(v, '[0-9]') OR regexp_matches(v, '[^A-Za-z0-9_\\s]'))
SELECT o_orderkey, coalesce(o_orderpriority IN (SELECT v FROM anom), false) AS is_string FROM orders""")
def cd2_string_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    fit = ct.string_anomalies(cols=["o_orderpriority"], max_length=10, allow_special_chars=False).fit(o)
    return fit.detect(o).select("o_orderkey", "is_string")


@query("cd3_unexpected", f1_sql(f"SELECT id, is_test, {_row_flag('unexp')} AS is_unexpected FROM f1",
                                "c AS (" + _counts_sql() + "),\n" + _UNEXP))
def cd3_unexpected(spark, sf):
    df = f1(spark, sf)
    fit = ct.unexpected_values(cols=_CATS).fit(train_of(df))
    return fit.detect(df).select("id", "is_test", "is_unexpected")


@query("cd3_whitelist", f1_sql(
    "SELECT id, is_test, coalesce(region NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE'), false) AS is_unexpected FROM f1"))
def cd3_whitelist(spark, sf):
    df = f1(spark, sf)
    wl = {"region": ["AFRICA", "AMERICA", "ASIA", "EUROPE"]}
    fit = ct.unexpected_values(cols=_CATS, whitelist=wl).fit(train_of(df))
    return fit.detect(df).select("id", "is_test", "is_unexpected")


_ALL = (_RARE.format(counts=_counts_sql(), th=0.01) + ",\n" + _ANOM.format(ml=100, special="") + ",\n" + _UNEXP)


@query("cd4_combined", f1_sql(
    f"SELECT id, is_test, ({_row_flag('rare')}) OR ({_row_flag('anom')}) OR ({_row_flag('unexp')}) AS is_outlier FROM f1",
    _ALL))
def cd4_combined(spark, sf):
    df = f1(spark, sf)
    fit = ct.CategoryOutliers(_CATS).fit(train_of(df))
    return fit.detect(df).select("id", "is_test", "is_outlier")


# ------------------------------------------------------------------------------- CT
def _replace_sql(flagset: str, repl: str):
    return ", ".join(
        f"CASE WHEN coalesce({c} IN (SELECT v FROM {flagset} WHERE col = '{c}'), false) THEN {repl.format(c=c)} ELSE {c} END AS {c}"
        for c in _CATS)


@query("ct1_group", f1_sql(f"SELECT id, is_test, {_replace_sql('rare', chr(39) + 'Other' + chr(39))} FROM f1",
                           _RARE.format(counts=_counts_sql(), th=0.01)))
def ct1_group(spark, sf):
    df = f1(spark, sf)
    fit = ct.rare_categories(cols=_CATS).fit(train_of(df))
    return fit.group_rare(df).select("id", "is_test", *_CATS)


@query("ct2_mode", f1_sql(
    f"SELECT id, is_test, {_replace_sql('flagged', 'coalesce((SELECT v FROM modes WHERE col = ' + chr(39) + '{c}' + chr(39) + '), ' + chr(39) + 'Unknown' + chr(39) + ')')} FROM f1",
    _ALL + """,
flagged AS (SELECT col, v FROM rare UNION SELECT col, v FROM anom UNION SELECT col, v FROM unexp),
modes AS (SELECT col, v FROM (SELECT c.col, c.v, row_number() OVER (PARTITION BY c.col ORDER BY c.n DESC, c.v) AS rk
                               FROM c LEFT JOIN flagged f ON c.col = f.col AND c.v = f.v WHERE f.v IS NULL) WHERE rk = 1)"""))
def ct2_mode(spark, sf):
    df = f1(spark, sf)
    fit = ct.CategoryOutliers(_CATS).fit(train_of(df))
    return fit.replace_with_mode(df).select("id", "is_test", *_CATS)


def _affected_sql(flagset: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IN (SELECT v FROM {flagset} WHERE col = '{c}')) AS n_rows FROM f1"
        for c in _CATS)


def _affected(spark, treat, df):
    """(column, n_rows): rows that ``treat(df, counts)`` changes, observed while its result is
    written out (to the no-op sink here)."""
    counts = Observation()
    treat(df, counts).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(list(counts.get.items()), "column string, n_rows long")


@query("ct1_affected", f1_sql(_affected_sql("rare"), _RARE.format(counts=_counts_sql(), th=0.01)))
def ct1_affected(spark, sf):
    df = f1(spark, sf)
    fit = ct.rare_categories(cols=_CATS).fit(train_of(df))
    return _affected(spark, lambda d, n: fit.group_rare(d, counts=n), df)


@query("ct2_affected", f1_sql(_affected_sql("flagged"), _ALL + """,
flagged AS (SELECT col, v FROM rare UNION SELECT col, v FROM anom UNION SELECT col, v FROM unexp)"""))
def ct2_affected(spark, sf):
    df = f1(spark, sf)
    fit = ct.CategoryOutliers(_CATS).fit(train_of(df))
    return _affected(spark, lambda d, n: fit.replace_with_mode(d, counts=n), df)


@query("ct3_flags", f1_sql(
    """SELECT f1.id, f1.is_test, 'outlier_' || s.col || '_' || s.m AS flag,
              CAST(coalesce(CASE s.col WHEN 'segment' THEN f1.segment WHEN 'nation' THEN f1.nation ELSE f1.region END
                   IN (SELECT v FROM sets WHERE sets.col = s.col AND sets.m = s.m), false) AS INTEGER) AS value
       FROM f1, (SELECT DISTINCT col, 'rare_categories' AS m FROM rare UNION SELECT DISTINCT col, 'string_anomalies' FROM anom
                 UNION SELECT DISTINCT col, 'unexpected_values' FROM unexp) s""",
    _ALL + """,
sets AS (SELECT col, v, 'rare_categories' AS m FROM rare UNION SELECT col, v, 'rare_categories' FROM anom
         UNION SELECT col, v, 'string_anomalies' FROM anom
         UNION SELECT col, v, 'unexpected_values' FROM unexp UNION SELECT col, v, 'unexpected_values' FROM anom)"""))
def ct3_flags(spark, sf):
    df = f1(spark, sf)
    fit = ct.CategoryOutliers(_CATS).fit(train_of(df))
    out = fit.flag_columns(df.select("id", "is_test", *_CATS))
    flags = [c for c in out.columns if c.startswith("outlier_")]
    return out.unpivot(["id", "is_test"], flags, "flag", "value").withColumn("value", F.coalesce("value", F.lit(0)))


_FIX = {"segment": {"AUTOMOBILES": "AUTOMOBILE", "BUILDINGS": "BUILDING", "FURNITURES": "FURNITURE",
                    "HOUSEHOLDS": "HOUSEHOLD", "MACHINERYS": "MACHINERY"}}


@query("ct5_dict", f1_sql(
    "SELECT id, CASE WHEN segment IN ('AUTOMOBILES', 'BUILDINGS', 'FURNITURES', 'HOUSEHOLDS', 'MACHINERYS') "
    "THEN substr(segment, 1, length(segment) - 1) ELSE segment END AS segment FROM f1"))
def ct5_dict(spark, sf):
    return ct.corrections(_FIX).transform(f1(spark, sf)).select("id", "segment")


@query("ct5_counts", f1_sql(
    """SELECT 'segment' AS column, w AS wrong, substr(w, 1, length(w) - 1) AS "right",
              (SELECT count(*) FROM f1 WHERE segment = w) AS n
       FROM (SELECT unnest(['AUTOMOBILES', 'BUILDINGS', 'FURNITURES', 'HOUSEHOLDS', 'MACHINERYS']) AS w)"""))
def ct5_counts(spark, sf):
    return ct.corrections(_FIX).counts(f1(spark, sf))


@query("ct6_group_strategy", f1_sql(f"SELECT id, is_test, {_replace_sql('rare', chr(39) + 'Other' + chr(39))} FROM f1",
                                    _RARE.format(counts=_counts_sql(), th=0.02)))
def ct6_group_strategy(spark, sf):
    df = f1(spark, sf)
    fit = ct.CategoricalTreatment("group", cols=_CATS, threshold=0.02).fit(train_of(df))
    return fit.transform(df).select("id", "is_test", *_CATS)


# ------------------------------------------------------------------------------- CT4 / CT6 combined
@query("ct4_typos")
def ct4_typos(spark, sf):
    from ..operators.typos import TypoCorrection
    df = f1(spark, sf)
    return TypoCorrection(["segment", "nation", "region"]).fit(train_of(df)).corrections()


@query("ct4_affected")
def ct4_affected(spark, sf):
    """Rows per column that the typo corrections change, observed during the transform."""
    from ..operators.typos import TypoCorrection
    df = f1(spark, sf)
    fit = TypoCorrection(["segment", "nation", "region"]).fit(train_of(df))
    return _affected(spark, fit.transform, df)


@query("ct4_typos_multi")
def ct4_typos_multi(spark, sf):
    from ..operators.typos import TypoCorrection
    p = table(spark, sf, "part").select("p_name", "p_type")
    return TypoCorrection(["p_name", "p_type"], use_multiple_metrics=True).fit(p).corrections()


@query("ct6_combined")
def ct6_combined(spark, sf):
    df = f1(spark, sf)
    fit = ct.CategoricalTreatment("combined", cols=_CATS, add_flags=True).fit(train_of(df))
    return fit.transform(df.select("id", "is_test", *_CATS))


@query("ct6_mode_strategy", ORACLES["ct2_mode"])
def ct6_mode_strategy(spark, sf):
    """CT6 dispatcher, strategy 'mode' (same result as CT2 through the dispatcher)."""
    df = f1(spark, sf)
    fit = ct.CategoricalTreatment("mode", cols=_CATS).fit(train_of(df))
    return fit.transform(df).select("id", "is_test", *_CATS)


@query("ct6_correct_strategy")
def ct6_correct_strategy(spark, sf):
    """CT6 dispatcher, strategy 'correct' (automatic typo correction applied to all rows)."""
    df = f1(spark, sf)
    fit = ct.CategoricalTreatment("correct", cols=_CATS).fit(train_of(df))
    return fit.transform(df.select("id", "is_test", *_CATS))
