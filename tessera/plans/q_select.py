"""Queries for feature selection (FS1-FS3, FS6), metrics (MT, ML7) and class balance (IB1, IB2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metrics as mt
from ..operators import resample as ib
from ..operators import select as fs
from ..operators.profile import corr_with_target
from ..sources import fixtures as fx
from .catalog import f1, f5, query, r6, train_of
from .oracle import F4, f1_sql, f5_sql

F5_NUM = ["acctbal", "tenure", "total_charges", "monthly_charges", "in_debt"]


@query("fs1_variance", f5_sql("\nUNION ALL ".join(
    f"""SELECT '{c}' AS feature, sig(var_pop(coalesce({c}, m))) AS variance,
               var_pop(coalesce({c}, m)) > 0.1 AND max(coalesce({c}, m)) <> min(coalesce({c}, m)) AS kept
        FROM tr5, (SELECT median({c}) AS m FROM tr5)""" for c in F5_NUM)))
def fs1_variance(spark, sf):
    tr = train_of(f5(spark, sf))
    return fs.LowVariance(0.1, F5_NUM).scores(tr).select("feature", r6("variance"), "kept")


_F1_ALL = ["segment", "nation", "region", "urgent", "fulfilled", "acctbal", "tenure", "total_charges",
           "monthly_charges", "in_debt"]


@query("fs2_missing", f1_sql("\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, sig(avg(CAST({c} IS NULL AS DOUBLE))) AS null_share, "
    f"NOT (avg(CAST({c} IS NULL AS DOUBLE)) > 0.07) AS kept FROM tr" for c in _F1_ALL)))
def fs2_missing(spark, sf):
    tr = train_of(f1(spark, sf))
    return fs.HighMissing(0.07, _F1_ALL).scores(tr).select("feature", r6("null_share"), "kept")


def _mi_sql():
    parts = []
    for c in F5_NUM:
        parts.append(f"""SELECT '{c}' AS feature, y,
            CASE WHEN d <= 32 THEN v ELSE CAST(len(list_filter(e, lambda x: v > x)) AS DOUBLE) END AS bin
            FROM (SELECT planted AS y, coalesce({c}, st.m) AS v, st.d, st.e FROM tr5,
                  (SELECT count(DISTINCT {c}) AS d, median({c}) AS m,
                          list_distinct(quantile_cont({c}, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9])) AS e FROM tr5) st)""")
    return " UNION ALL ".join(parts)


@query("fs3_mi_binned", f5_sql(
    """SELECT j.feature, sig(sum(j.nxy / n.n * ln(j.nxy * n.n / (px.nx * py.ny)))) AS mi,
              sum(j.nxy / n.n * ln(j.nxy * n.n / (px.nx * py.ny))) > 0.001 AS kept
       FROM j JOIN px ON j.feature = px.feature AND j.bin = px.bin
              JOIN py ON j.feature = py.feature AND j.y = py.y, n
       GROUP BY j.feature""",
    f"""l AS ({_mi_sql()}),
        j AS (SELECT feature, bin, y, count(*) AS nxy FROM l GROUP BY ALL),
        px AS (SELECT feature, bin, sum(nxy) AS nx FROM j GROUP BY ALL),
        py AS (SELECT feature, y, sum(nxy) AS ny FROM j GROUP BY ALL),
        n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM tr5)"""))
def fs3_mi_binned(spark, sf):
    tr = train_of(f5(spark, sf))
    return fs.MutualInfo("planted", features=F5_NUM, estimator="binned").scores(tr).select("feature", r6("mi"), "kept")


def _psi(n: str) -> str:
    """Digamma of a positive integer: recurrence and asymptotic series."""
    steps = " + ".join(f"1.0 / ({n} + {i})" for i in range(10))
    b = f"(CAST({n} AS DOUBLE) + 10)"
    return f"(ln({b}) - 0.5 / {b} - 1 / ({b} * {b}) * (1.0 / 12 - 1 / ({b} * {b}) * (1.0 / 120 - 1 / ({b} * {b}) / 252)) - ({steps}))"


_FS3_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, id, planted AS y, CAST(coalesce({c}, (SELECT median({c}) FROM tr5)) AS DOUBLE) AS x FROM tr5" for c in F5_NUM)


@query("fs3_mi", f5_sql(
    f"""SELECT feature, sig(greatest(0, {_psi('count(*)')} + avg({_psi('k')}) - avg({_psi('ny')}) - avg({_psi('m')}))) AS mi,
               greatest(0, {_psi('count(*)')} + avg({_psi('k')}) - avg({_psi('ny')}) - avg({_psi('m')})) > 0.001 AS kept
        FROM e GROUP BY feature""",
    f"""u AS ({_FS3_ROWS}),
        s AS (SELECT feature, y, count(*) AS ny FROM u GROUP BY ALL HAVING count(*) > 1),
        d AS (SELECT a.feature, a.id, a.y, a.x, s.ny, abs(b.x - a.x) AS r,
                     row_number() OVER (PARTITION BY a.feature, a.id ORDER BY abs(b.x - a.x)) AS i
              FROM u a JOIN s ON a.feature = s.feature AND a.y = s.y JOIN u b ON a.feature = b.feature AND a.y = b.y AND a.id <> b.id),
        g AS (SELECT * FROM d WHERE i = least(3, ny - 1)),
        e AS (SELECT g.feature, g.id, g.ny, count(*) AS m,
                     CASE WHEN g.r > 0 THEN least(3, g.ny - 1) ELSE count(*) FILTER (b.y = g.y) - 1 END AS k
              FROM g JOIN u b ON g.feature = b.feature
                AND CASE WHEN g.r > 0 THEN b.x > g.x - g.r * (1 - 1e-12) AND b.x < g.x + g.r * (1 - 1e-12) ELSE b.x = g.x END
              GROUP BY g.feature, g.id, g.ny, g.r)"""))
def fs3_mi(spark, sf):
    tr = train_of(f5(spark, sf))
    return fs.MutualInfo("planted", features=F5_NUM).scores(tr).select("feature", r6("mi"), "kept")


def _fs6_sql():
    pairs = []
    for i, a in enumerate(F5_NUM):
        for b in F5_NUM[i + 1:]:
            pairs.append(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM tr5")
    imps = " UNION ALL ".join(f"SELECT '{c}' AS feature, abs(corr({c}, planted)) AS imp FROM tr5" for c in F5_NUM)
    return (f"p AS ({' UNION ALL '.join(pairs)}), imp AS ({imps})")


@query("fs6_corr_drop", f5_sql(
    """SELECT DISTINCT CASE WHEN coalesce(ib.imp, 0) < coalesce(ia.imp, 0) THEN p.b ELSE p.a END AS feature
       FROM p LEFT JOIN imp ia ON p.a = ia.feature LEFT JOIN imp ib ON p.b = ib.feature
       WHERE abs(p.r) > 0.5""", _fs6_sql()))
def fs6_corr_drop(spark, sf):
    tr = train_of(f5(spark, sf))
    imp = corr_with_target(tr, "planted", F5_NUM + ["planted"]).select("feature", F.abs("r").alias("importance"))
    return fs.correlated_drops(tr, F5_NUM, imp, 0.5)


# ------------------------------------------------------------------------------- MT / ML7
_SCORE = "-coalesce(acctbal, 0.0)"


def _f5_scored(spark, sf):
    return f5(spark, sf).withColumn("score", -F.coalesce("acctbal", F.lit(0.0))) \
        .withColumn("pred", F.col("in_debt")) \
        .withColumn("pred2", ((F.col("in_debt") == 1) | (F.col("urgent") == "No")).cast("int"))


def _metrics_sql(pred: str) -> str:
    return f"""SELECT tp, fp, tn, fn,
        sig(CASE WHEN tp + fp + tn + fn = 0 THEN 0 ELSE (tp + tn) / (tp + fp + tn + fn) END) AS accuracy,
        sig(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END) AS precision,
        sig(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END) AS recall,
        sig(CASE WHEN tp = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END) AS f1
      FROM (SELECT CAST(sum(CASE WHEN planted = 1 AND {pred} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
                   CAST(sum(CASE WHEN planted = 0 AND {pred} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
                   CAST(sum(CASE WHEN planted = 0 AND {pred} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
                   CAST(sum(CASE WHEN planted = 1 AND {pred} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn FROM f5)"""


@query("mt1_metrics", f5_sql(_metrics_sql("in_debt")))
def mt1_metrics(spark, sf):
    m = mt.classification_metrics(_f5_scored(spark, sf), "planted", "pred")
    return m.select("tp", "fp", "tn", "fn", *[r6(c) for c in ("accuracy", "precision", "recall", "f1")])


@query("mt1_confusion", f5_sql("SELECT planted AS label, in_debt AS prediction, count(*) AS n FROM f5 GROUP BY ALL"))
def mt1_confusion(spark, sf):
    return mt.confusion_matrix(_f5_scored(spark, sf), "planted", "pred")


@query("mt2_auc", f5_sql(
    """SELECT sig((sum(CASE WHEN planted = 1 THEN rk END) - np * (np + 1) / 2.0) / (np * nn)) AS auc
       FROM (SELECT planted, avg(rn) OVER (PARTITION BY s) AS rk,
                    sum(planted) OVER () AS np, sum(1 - planted) OVER () AS nn
             FROM (SELECT planted, s, row_number() OVER (ORDER BY s) AS rn
                   FROM (SELECT planted, """ + _SCORE + """ AS s FROM f5)))
       GROUP BY np, nn"""))
def mt2_auc(spark, sf):
    return mt.roc_auc(_f5_scored(spark, sf), "planted", "score").select(r6("auc"))


def _mt3_sql():
    raw = _metrics_sql("in_debt")
    pro = _metrics_sql("CASE WHEN in_debt = 1 OR urgent = 'No' THEN 1 ELSE 0 END")
    rows = []
    for m in ("accuracy", "precision", "recall", "f1"):
        rows.append(f"""SELECT '{m}' AS metric, r.{m} AS raw, p.{m} AS processed, sig(p.{m} - r.{m}) AS diff,
                        CASE WHEN p.{m} > r.{m} THEN 'up' WHEN p.{m} < r.{m} THEN 'down' ELSE 'equal' END AS direction
                        FROM r, p""")
    return f5_sql(" UNION ALL ".join(rows), f"r AS ({raw}), p AS ({pro})")


@query("mt3_diff", _mt3_sql())
def mt3_diff(spark, sf):
    df = _f5_scored(spark, sf)
    cols = [r6(c) for c in ("accuracy", "precision", "recall", "f1")]
    raw = mt.classification_metrics(df, "planted", "pred").select(*cols)
    pro = mt.classification_metrics(df, "planted", "pred2").select(*cols)
    c = mt.compare_metrics(raw, pro)
    return c.select("metric", "raw", "processed", r6("diff"), "direction")


@query("ml7_weights", f1_sql(
    "SELECT label, count(*) AS n, sig((SELECT count(*) FROM f1) / (2.0 * count(*))) AS weight FROM f1 GROUP BY label"))
def ml7_weights(spark, sf):
    return mt.class_weights(f1(spark, sf), "label").select("label", "n", r6("weight"))


# ------------------------------------------------------------------------------- IB1 / IB2
def _f4_split(spark, sf):
    return fx.with_split(fx.doc_labels(spark, sf))


@query("ib1_balance", "WITH " + F4 + """,
s AS (SELECT *, md5(concat('split|', CAST(id AS VARCHAR))) < '33' AS is_test FROM f4),
a AS (SELECT toxic AS class, count(*) FILTER (WHERE NOT is_test) AS n_train, count(*) FILTER (WHERE is_test) AS n_test FROM s GROUP BY 1),
t AS (SELECT sum(n_train) AS tr, sum(n_test) AS te, max(n_train) AS mx, min(n_train) AS mn FROM a)
SELECT class, n_train, n_test, sig(n_train * 100.0 / tr) AS pct_train, sig(n_test * 100.0 / te) AS pct_test,
       sig(abs(n_train * 100.0 / tr - n_test * 100.0 / te)) AS gap, sig(mx / mn) AS ratio,
       CASE WHEN mx / mn > 10 THEN 'strong' WHEN mx / mn > 3 THEN 'moderate' ELSE 'mild' END AS severity
FROM a, t""")
def ib1_balance(spark, sf):
    df = _f4_split(spark, sf)
    r = ib.balance_report(train_of(df), df.filter("is_test"), "toxic")
    return r.select("class", "n_train", "n_test", *[r6(c) for c in ("pct_train", "pct_test", "gap", "ratio")], "severity")


@query("ib2_under", f1_sql(
    """SELECT id, label FROM (
         SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5(concat('42|under|', CAST(id AS VARCHAR))), id) AS rn
         FROM tr) WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM tr GROUP BY label))"""))
def ib2_under(spark, sf):
    tr = train_of(f1(spark, sf))
    return ib.undersample(tr, "label", "id").select("id", "label")
