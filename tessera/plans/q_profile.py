"""Queries for sources/splits (IO) and profiling (PR)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode as en
from ..operators import profile as pr
from ..operators.split import stratified_split
from ..sources import fixtures as fx
from ..sources.readers import coerce_numeric, read_csv, table
from .catalog import f1, f5, query, r6
from .oracle import f1_sql, f3_sql, f5_sql

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
F1_NUM = ["acctbal", "tenure", "total_charges", "monthly_charges", "in_debt"]

ORDERS_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                 "o_orderpriority string")


@query("io1_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def io1_scan(spark, sf):
    # declared schema: no inference pass; only the declared columns are read
    return spark.read.schema(ORDERS_SCHEMA).parquet(f"{sf}/orders.parquet")


@query("io1_csv", "SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice, "
                  "o_orderpriority FROM orders")
def io1_csv(spark, sf):
    """Orders written as CSV with blank cells (in the shared folder) and scanned back under a
    declared schema."""
    import uuid

    from ..session import ensure_checkpoint_dir
    orders = spark.read.schema(ORDERS_SCHEMA).parquet(f"{sf}/orders.parquet")
    path = f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    price = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))
    orders.withColumn("o_totalprice", price).write.option("header", True).csv(path)
    return read_csv(spark, path, ORDERS_SCHEMA)


@query("io2_coerce", f3_sql("SELECT id, TRY_CAST(trim(raw_number) AS DOUBLE) AS raw_number FROM f3"))
def io2_coerce(spark, sf):
    df = fx.events_dirty(spark, sf)
    return coerce_numeric(df, ["raw_number"]).select("id", "raw_number")


@query("io3_project", "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def io3_project(spark, sf):
    return table(spark, sf, "customer").drop("c_name")


@query("io4_split", f1_sql(
    """SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5(concat('42|split|', CAST(id AS VARCHAR))), id)
                 <= floor(0.2 * count(*) OVER (PARTITION BY label) + 0.5) AS is_test
       FROM f1"""))
def io4_split(spark, sf):
    df = fx.customer_features(spark, sf).select("id", "label")
    return stratified_split(df, "label", "id", 0.2, 42)


# ------------------------------------------------------------------------------- PR
@query("pr1_shape", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def pr1_shape(spark, sf):
    return pr.shape(table(spark, sf, "lineitem"))


@query("pr1_head", """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
                      ORDER BY l_orderkey, l_linenumber, l_quantity, l_returnflag LIMIT 5""")
def pr1_head(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return pr.head(li, 5, ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"])


_F1_COLS = ["id", "segment", "nation", "region", "urgent", "fulfilled", "acctbal", "tenure",
            "total_charges", "monthly_charges", "in_debt", "label"]
_KIND = {"segment": "categorical", "nation": "categorical", "region": "categorical", "urgent": "categorical",
         "fulfilled": "categorical", "label": "categorical"}


def _per_column_sql(expr: str) -> str:
    parts = []
    for i, c in enumerate(_F1_COLS):
        parts.append(f"SELECT {i} AS position, '{c}' AS column, '{_KIND.get(c, 'numeric')}' AS kind, "
                     + expr.format(c=c) + " FROM f1")
    return "\nUNION ALL ".join(parts)


@query("pr2_schema", f1_sql(_per_column_sql("count({c}) AS n_non_null")))
def pr2_schema(spark, sf):
    return pr.schema_info(f1(spark, sf).select(*_F1_COLS)).drop("dtype")


@query("pr3_nulls", f1_sql(_per_column_sql("count(*) - count({c}) AS n_null")))
def pr3_nulls(spark, sf):
    return pr.null_report(f1(spark, sf).select(*_F1_COLS)).select("position", "column", "kind", "n_null")


@query("pr5_missing", f1_sql(_per_column_sql(
    "count(*) AS n_total, count({c}) AS n_non_null, count(*) - count({c}) AS n_null, "
    "round_even(100.0 * (count(*) - count({c})) / count(*), 2) AS pct_null")))
def pr5_missing(spark, sf):
    return pr.null_report(f1(spark, sf).select(*_F1_COLS))


@query("pr4_describe", "\nUNION ALL ".join(
    f"""SELECT '{c}' AS column, count({c}) AS count, sig(avg({c})) AS mean, sig(stddev_samp({c})) AS std,
               sig(min({c})) AS min, sig(quantile_cont({c}, 0.25)) AS p25, sig(quantile_cont({c}, 0.5)) AS p50,
               sig(quantile_cont({c}, 0.75)) AS p75, sig(max({c})) AS max FROM lineitem""" for c in LI_NUM))
def pr4_describe(spark, sf):
    d = pr.describe(table(spark, sf, "lineitem"), LI_NUM)
    return d.select("column", "count", *[r6(c) for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]])


def _pairs_sql(cols, src, upper=True):
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if (upper and j <= i):
                continue
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, sig(corr({a}, {b})) AS r FROM {src}")
    return "\nUNION ALL ".join(parts)


@query("pr6_corr_pairs", f1_sql(_pairs_sql(F1_NUM, "f1")))
def pr6_corr_pairs(spark, sf):
    return pr.corr_pairs(f1(spark, sf), F1_NUM).select("a", "b", r6("r"))


_PR7 = F1_NUM + ["urgent_Yes", "fulfilled_Yes"]


@query("pr7_corr_matrix", f1_sql(
    _pairs_sql(_PR7, "oh", upper=False),
    """oh AS (SELECT *, CASE WHEN urgent = 'Yes' THEN 1.0 ELSE 0.0 END AS urgent_Yes,
                        CASE WHEN fulfilled = 'Yes' THEN 1.0 ELSE 0.0 END AS fulfilled_Yes FROM f1)"""))
def pr7_corr_matrix(spark, sf):
    df = f1(spark, sf)
    oh = en.OneHot(["urgent", "fulfilled"], drop="if_binary").fit(df).transform(df)
    return pr.corr_matrix(oh, _PR7).select("a", "b", r6("r"))


_F5_NUM = ["acctbal", "tenure", "total_charges", "monthly_charges", "in_debt"]


@query("pr8_corr_target", f5_sql("\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, sig(corr({c}, planted)) AS r FROM f5" for c in _F5_NUM)))
def pr8_corr_target(spark, sf):
    return pr.corr_with_target(f5(spark, sf), "planted", _F5_NUM + ["planted"]).select("feature", r6("r"))


@query("pr9_top_corr", f5_sql(
    "SELECT feature, sig(r) AS r FROM c WHERE r IS NOT NULL ORDER BY abs(r) DESC, feature LIMIT 3",
    "c AS (" + "\nUNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, planted) AS r FROM f5" for c in _F5_NUM) + ")"))
def pr9_top_corr(spark, sf):
    return pr.top_correlated(f5(spark, sf), "planted", 3, _F5_NUM + ["planted"]).select("feature", r6("r"))


@query("pr10_histogram", """
WITH mm AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
SELECT 'value' AS column, CAST(least(floor((value - lo) / (hi - lo) * 10) + 1, 10) AS INTEGER) AS bin, count(*) AS n
FROM events, mm GROUP BY 2""")
def pr10_histogram(spark, sf):
    return pr.histogram(table(spark, sf, "events"), ["value"]).select("column", "bin", "n")


@query("pr10_value_counts", """
SELECT 'l_returnflag' AS column, l_returnflag AS value, count(*) AS n FROM lineitem GROUP BY 2
UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY 2""")
def pr10_value_counts(spark, sf):
    return pr.value_counts(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("pr12_onehot_if_binary", f1_sql(
    """SELECT id, CASE WHEN urgent = 'Yes' THEN 1.0 ELSE 0.0 END AS urgent_Yes,
              CASE WHEN fulfilled = 'Yes' THEN 1.0 ELSE 0.0 END AS fulfilled_Yes,
              """ + ", ".join(f"CASE WHEN region = '{r}' THEN 1.0 ELSE 0.0 END AS \"region_{r}\""
                              for r in ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]) + " FROM f1"))
def pr12_onehot_if_binary(spark, sf):
    df = f1(spark, sf).select("id", "urgent", "fulfilled", "region")
    return en.OneHot(["urgent", "fulfilled", "region"], drop="if_binary").fit(df).transform(df)
