"""Test fixtures F1, F3, F4, F5 (see FIXTURES.md), built from the driver's tables.

The driver's tables hold no nulls, rare values or typos; those are injected by fixed
arithmetic on keys (every row is kept).  Train/test membership is a seeded md5 cut of
the id: ``md5('split|' || id) < '33'`` marks about 20 % as test, so the same split is
expressible in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import table

CUTOFF = "2000-08-01 00:00:00"
# Fixed value: fraction boundary of the test cut on the first two md5 hex digits.
TEST_PREFIX = "33"


def test_flag(id_col: str = "id") -> Column:
    return F.md5(F.concat(F.lit("split|"), F.col(id_col).cast("string"))) < F.lit(TEST_PREFIX)


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one row per customer, features from orders before the cut-off, churn label after."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus")
    cutoff = F.lit(CUTOFF).cast("timestamp_ntz")
    pre = (orders.filter(F.col("o_orderdate") < cutoff)
           .groupBy("o_custkey")
           .agg(F.sum("o_totalprice").alias("total_charges_raw"),
                F.min("o_orderdate").alias("first_order"),
                F.max(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).alias("urgent_i"),
                F.max(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("fulfilled_i")))
    post = (orders.filter(F.col("o_orderdate") >= cutoff)
            .select(F.col("o_custkey").alias("post_key")).distinct())
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    k = F.col("c_custkey")
    months = F.year("first_order") * 12 + F.month("first_order")
    df = (cust
          .join(nation, cust.c_nationkey == nation.n_nationkey)
          .join(region, nation.n_regionkey == region.r_regionkey)
          .join(pre, k == pre.o_custkey, "left")
          .join(post, k == post.post_key, "left"))
    return df.select(
        k.alias("id"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
         .when(test_flag("c_custkey") & (k % 41 == 5), F.lit("UNSEEN"))
         .when(k % 331 == 1, F.lit("SHIPYARD"))
         .when(k % 97 == 2, F.concat("c_mktsegment", F.lit("S")))
         .otherwise(F.col("c_mktsegment")).alias("segment"),
        F.col("n_name").alias("nation"),
        F.col("r_name").alias("region"),
        F.when(F.col("urgent_i") == 1, "Yes").otherwise("No").alias("urgent"),
        F.when(F.col("fulfilled_i") == 1, "Yes").otherwise("No").alias("fulfilled"),
        F.when(k % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal")).alias("acctbal"),
        (F.lit(24008) - months).cast("bigint").alias("tenure"),
        F.when(k % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("total_charges_raw")).alias("total_charges"),
        (F.col("total_charges_raw") / (F.lit(24009) - months)).alias("monthly_charges"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("in_debt"),
        F.when(F.col("post_key").isNull(), "Yes").otherwise("No").alias("label"),
        test_flag("c_custkey").alias("is_test"),
    )


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 plus a 0/1 label with known signal from in_debt and urgent."""
    f1 = customer_features(spark, sf_dir)
    # integer form of u < 0.10 + 0.50*in_debt + 0.20*[urgent='No'] (exact, no float ties)
    u = (F.col("id") * 7919) % 1000
    p = F.lit(100) + F.lit(500) * F.col("in_debt") + F.when(F.col("urgent") == "No", 200).otherwise(0)
    return f1.withColumn("planted", F.when(u < p, 1).otherwise(0))


def events_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with injected nulls and a blank-containing numeric string."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select(
        k.alias("id"),
        F.when(k % 9 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("value"),
        F.when(k % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("event_type")).alias("event_type"),
        F.when(k % 23 == 0, F.lit(" ")).otherwise((k % 50).cast("string")).alias("raw_number"),
        F.when(k % 10 == 3, F.lit(None).cast("bigint")).otherwise(F.col("user_id") % 7).alias("user_group"),
    )


def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labelled documents with three numeric text features (natural imbalance)."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    t = F.col("text")
    return d.join(lab, "doc_id").select(
        F.col("doc_id").alias("id"), "lang", "source",
        F.col("n_chars").cast("double").alias("n_chars"),
        (F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit("")))).cast("double").alias("n_spaces"),
        (F.length(t) - F.length(F.replace(t, F.lit("."), F.lit("")))).cast("double").alias("n_dots"),
        "toxic", "quality")


def with_split(df: DataFrame, id_col: str = "id") -> DataFrame:
    return df if "is_test" in df.columns else df.withColumn("is_test", test_flag(id_col))
