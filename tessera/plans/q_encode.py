"""Queries for categorical encodings (EN1-EN9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode as en
from ..sources.readers import table
from .catalog import f1, f5, query, r6, train_of
from .oracle import f1_sql, f5_sql

_LABEL_CODES = """d AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
        FROM (SELECT DISTINCT coalesce({c}, 'nan') AS v FROM tr))"""


@query("en1_label", f1_sql(
    """SELECT f1.id, f1.is_test, coalesce(d.code, -1) AS segment, coalesce(d2.code, -1) AS nation
       FROM f1 LEFT JOIN d ON coalesce(f1.segment, 'nan') = d.v
               LEFT JOIN d2 ON coalesce(f1.nation, 'nan') = d2.v""",
    _LABEL_CODES.format(c="segment") + ",\n" + _LABEL_CODES.format(c="nation").replace("d AS", "d2 AS", 1)))
def en1_label(spark, sf):
    df = f1(spark, sf)
    fit = en.LabelEncode(["segment", "nation"]).fit(train_of(df))
    return fit.transform(df).select("id", "is_test", "segment", "nation")


@query("en2_onehot", f1_sql(
    """SELECT f1.id, f1.is_test, 'segment_' || coalesce(c.v, 'nan') AS feature,
              CASE WHEN (c.v IS NULL AND f1.segment IS NULL) OR f1.segment = c.v THEN 1.0 ELSE 0.0 END AS value
       FROM f1, (SELECT v FROM cats WHERE rn > 1) c""",
    """cats AS (SELECT v, row_number() OVER (ORDER BY v IS NULL, v) AS rn FROM (SELECT DISTINCT segment AS v FROM tr))"""))
def en2_onehot(spark, sf):
    df = f1(spark, sf).select("id", "is_test", "segment")
    fit = en.OneHot(["segment"], drop="first").fit(train_of(df))
    out = fit.transform(df)
    return out.unpivot(["id", "is_test"], fit.names(), "feature", "value")


@query("en2_sparse", f1_sql(
    """SELECT f1.id, CAST(s.slot AS INTEGER) AS slot FROM f1 JOIN s
       ON (s.c = 'segment' AND s.v = coalesce(f1.segment, 'nan')) OR (s.c = 'nation' AND s.v = coalesce(f1.nation, 'nan'))""",
    """v AS (SELECT DISTINCT 'segment' AS c, coalesce(segment, 'nan') AS v FROM tr
             UNION SELECT DISTINCT 'nation', coalesce(nation, 'nan') FROM tr),
       s AS (SELECT c, v, row_number() OVER (ORDER BY c DESC, v) - 1 AS slot FROM v)"""))
def en2_sparse(spark, sf):
    df = f1(spark, sf).select("id", "is_test", "segment", "nation")
    fit = en.SparseOneHot(["segment", "nation"]).fit(train_of(df))
    return fit.transform(df).select("id", F.explode("onehot").alias("slot"))


@query("en3_frequency", f1_sql(
    """SELECT id, is_test,
              sig(CASE WHEN NOT is_test AND segment IS NULL THEN m.mf ELSE coalesce(fq.f, m.mf) END) AS segment
       FROM f1 LEFT JOIN fq ON f1.segment = fq.v, m""",
    """c AS (SELECT segment AS v, count(*) AS n FROM tr WHERE segment IS NOT NULL GROUP BY 1),
       fq AS (SELECT v, n / (SELECT sum(n) FROM c) AS f FROM c),
       m AS (SELECT avg(f) AS mf FROM fq)"""))
def en3_frequency(spark, sf):
    df = f1(spark, sf).select("id", "is_test", "segment")
    fit = en.FrequencyEncode(["segment"]).fit(train_of(df))
    return fit.transform(df, fit_rows=~F.col("is_test")).select("id", "is_test", r6("segment"))


@query("en3_counts_min", f1_sql(
    """SELECT id, is_test,
              sig(CASE WHEN NOT is_test AND nation IS NULL THEN 0.0 ELSE coalesce(c.n, m.mn) END) AS nation
       FROM f1 LEFT JOIN c ON f1.nation = c.v, m""",
    """c AS (SELECT nation AS v, count(*) AS n FROM tr WHERE nation IS NOT NULL GROUP BY 1),
       m AS (SELECT min(n) AS mn FROM c)"""))
def en3_counts_min(spark, sf):
    df = f1(spark, sf).select("id", "is_test", "nation")
    fit = en.FrequencyEncode(["nation"], normalize=False, unseen_value="min").fit(train_of(df))
    return fit.transform(df, fit_rows=~F.col("is_test")).select("id", "is_test", r6("nation"))


@query("en4_target", f5_sql(
    """SELECT id, is_test,
              sig(CASE WHEN NOT is_test THEN e.enc ELSE coalesce(e.enc, g.g) END) AS segment,
              sig(CASE WHEN NOT is_test THEN e2.enc ELSE coalesce(e2.enc, g.g) END) AS nation
       FROM f5 LEFT JOIN e ON f5.segment = e.v LEFT JOIN e2 ON f5.nation = e2.v, g""",
    """g AS (SELECT avg(planted) AS g FROM tr5),
       st AS (SELECT segment AS v, avg(planted) AS m, count(planted) AS n FROM tr5 WHERE segment IS NOT NULL GROUP BY 1),
       e AS (SELECT v, CASE WHEN n < 20 THEN g.g ELSE (m * n + g.g * 1.0) / (n + 1.0) END AS enc FROM st, g),
       st2 AS (SELECT nation AS v, avg(planted) AS m, count(planted) AS n FROM tr5 WHERE nation IS NOT NULL GROUP BY 1),
       e2 AS (SELECT v, CASE WHEN n < 20 THEN g.g ELSE (m * n + g.g * 1.0) / (n + 1.0) END AS enc FROM st2, g)"""))
def en4_target(spark, sf):
    df = f5(spark, sf)
    fit = en.TargetEncode("planted", ["segment", "nation"], smoothing=1.0, min_samples_leaf=20).fit(train_of(df))
    return fit.transform(df, fit_rows=~F.col("is_test")).select("id", "is_test", r6("segment"), r6("nation"))


_PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("en5_ordinal", """
WITH st AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS DOUBLE) AS code
            FROM (SELECT DISTINCT o_orderstatus AS v FROM orders WHERE o_orderstatus IS NOT NULL))
SELECT o_orderkey,
       CASE o_orderpriority WHEN '1-URGENT' THEN 0.0 WHEN '2-HIGH' THEN 1.0 WHEN '3-MEDIUM' THEN 2.0
            WHEN '4-NOT SPECIFIED' THEN 3.0 WHEN '5-LOW' THEN 4.0 ELSE -1.0 END AS o_orderpriority,
       coalesce(st.code, -1.0) AS o_orderstatus
FROM orders LEFT JOIN st ON orders.o_orderstatus = st.v""")
def en5_ordinal(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    given = en.OrdinalEncode({"o_orderpriority": _PRIORITY}).fit(o)
    auto = en.OrdinalEncode(None, exclude=["o_orderpriority"]).fit(o)
    return auto.transform(given.transform(o))


@query("en6_binary", f1_sql(
    """SELECT f1.id, f1.is_test, 'segment_bit' || CAST(b.i AS VARCHAR) AS feature,
              CAST(coalesce((d.code >> b.i) & 1, 0) AS INTEGER) AS value
       FROM f1 LEFT JOIN d ON coalesce(f1.segment, 'nan') = d.v,
            (SELECT range AS i FROM range(0, 64)) b, nb
       WHERE b.i < nb.bits""",
    _LABEL_CODES.format(c="segment") + """,
       nb AS (SELECT CAST(ceil(log2(count(*))) AS INTEGER) AS bits FROM d)"""))
def en6_binary(spark, sf):
    df = f1(spark, sf).select("id", "is_test", "segment")
    fit = en.BinaryEncode(["segment"]).fit(train_of(df))
    names = [f"segment_bit{i}" for i in range(fit.bits["segment"])]
    return fit.transform(df).unpivot(["id", "is_test"], names, "feature", "value")


_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("en7_dispatch", f5_sql(
    """SELECT id, is_test, 'onehot' AS method, 'nation' AS feature, sig(coalesce(fq.f, m.mf)) AS value
       FROM f5 LEFT JOIN fq ON f5.nation = fq.v, m
       """ + "\n".join(
        f"UNION ALL SELECT id, is_test, 'onehot', 'region_{r}', CASE WHEN region = '{r}' THEN 1.0 ELSE 0.0 END FROM f5"
        for r in _REGIONS[1:]) + """
       UNION ALL SELECT id, is_test, 'frequency', 'segment', sig(coalesce(sq.f, sm.mf))
       FROM f5 LEFT JOIN sq ON f5.segment = sq.v, sm
       UNION ALL SELECT id, is_test, 'label', 'segment', CAST(coalesce(d.code, -1) AS DOUBLE)
       FROM f5 LEFT JOIN d ON coalesce(f5.segment, 'nan') = d.v
       UNION ALL SELECT id, is_test, 'ordinal', 'segment', coalesce(o.code, -1.0) FROM f5 LEFT JOIN o ON f5.segment = o.v
       UNION ALL SELECT id, is_test, 'target', 'segment', sig(coalesce(e.enc, g.g)) FROM f5 LEFT JOIN e ON f5.segment = e.v, g
       UNION ALL SELECT id, is_test, 'binary', 'segment_bit' || CAST(b.i AS VARCHAR), CAST(coalesce((d.code >> b.i) & 1, 0) AS DOUBLE)
       FROM f5 LEFT JOIN d ON coalesce(f5.segment, 'nan') = d.v, (SELECT range AS i FROM range(0, 64)) b, nb WHERE b.i < nb.bits""",
    """c AS (SELECT nation AS v, count(*) AS n FROM tr5 WHERE nation IS NOT NULL GROUP BY 1),
       fq AS (SELECT v, n / (SELECT sum(n) FROM c) AS f FROM c),
       m AS (SELECT avg(f) AS mf FROM fq),
       sc AS (SELECT segment AS v, count(*) AS n FROM tr5 WHERE segment IS NOT NULL GROUP BY 1),
       sq AS (SELECT v, n / (SELECT sum(n) FROM sc) AS f FROM sc),
       sm AS (SELECT avg(f) AS mf FROM sq),
       """ + _LABEL_CODES.format(c="segment").replace("FROM tr", "FROM tr5") + """,
       o AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS DOUBLE) AS code FROM sc),
       g AS (SELECT avg(planted) AS g FROM tr5),
       st AS (SELECT segment AS v, avg(planted) AS m, count(planted) AS n FROM tr5 WHERE segment IS NOT NULL GROUP BY 1),
       e AS (SELECT v, CASE WHEN n < 20 THEN g.g ELSE (m * n + g.g * 1.0) / (n + 1.0) END AS enc FROM st, g),
       nb AS (SELECT CAST(ceil(log2(count(*))) AS INTEGER) AS bits FROM d)"""))
def en7_dispatch(spark, sf):
    """All six methods: one-hot with its route to frequencies on nation and region, the others
    on segment."""
    df = f5(spark, sf).select("id", "is_test", "planted", "nation", "region", "segment")
    train = train_of(df)
    out = None
    for method in en.Encode.METHODS:
        cols = ["nation", "region"] if method == "onehot" else ["segment"]
        kw = {"smoothing": 1.0, "min_samples_leaf": 20} if method == "target" else {}
        fit = en.Encode(method, label="planted", columns=cols, onehot_threshold=10, **kw).fit(train)
        got = fit.transform(df.select("id", "is_test", "planted", *cols)).drop("planted")
        names = [c for c in got.columns if c not in ("id", "is_test")]
        got = got.select("id", "is_test", *[F.col(f"`{c}`").cast("double").alias(c) for c in names])
        rows = got.unpivot(["id", "is_test"], [F.col(f"`{c}`") for c in names], "feature", "value")
        rows = rows.select("id", "is_test", F.lit(method).alias("method"), "feature", r6("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("en8_target_codes", f1_sql(
    """SELECT id, CAST(coalesce((SELECT count(DISTINCT t.label) FROM tr t WHERE t.label < f1.label), -1) AS INTEGER) AS label
       FROM f1"""))
def en8_target_codes(spark, sf):
    df = f1(spark, sf)
    fit = en.EncodeTarget("label").fit(train_of(df))
    return fit.transform(df).select("id", "label")


@query("en8_distribution", f1_sql(
    "SELECT label AS class, count(*) AS n, sig(count(*) / (SELECT count(*) FROM tr)) AS share FROM tr GROUP BY 1"))
def en8_distribution(spark, sf):
    return en.class_distribution(train_of(f1(spark, sf)), "label").select("class", "n", r6("share"))


@query("en9_decode", f1_sql("SELECT id, label, label AS label_decoded FROM f1"))
def en9_decode(spark, sf):
    df = f1(spark, sf)
    fit = en.EncodeTarget("label", out_col="code").fit(train_of(df))
    return fit.decode(fit.transform(df), "code", "label_decoded").select("id", "label", "label_decoded")
