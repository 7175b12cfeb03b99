"""Dictionaries are sized in rows and bytes; large ones give the same lookups by shuffle."""
import pytest
from pyspark.sql import functions as F

from tessera.functions import dictionary as dc
from tessera.operators import categories as ct
from tessera.operators import encode as en
from tessera.operators import features as fe
from tessera.operators.typos import TypoCorrection


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_values_are_not_broadcast(spark):
    """20,000 values of 10 KB: few rows, far too many bytes."""
    df = spark.range(20_000).select(F.concat(F.lpad(F.col("id").cast("string"), 10, "0"), F.repeat(F.lit("x"), 10_000)).alias("value"),
                                    F.col("id").alias("code"))
    d = dc.Dictionary.materialise(df)
    assert not d.local and d.size == 20_000 and d.size_bytes == 20_000 * 10_018
    rows = spark.range(40_000).select("id", F.concat(F.lpad(F.col("id").cast("string"), 10, "0"), F.repeat(F.lit("x"), 10_000)).alias("v"))
    got = dc.lookup(rows, F.col("v"), d.df, "value", ["code"], broadcast=d.local).select("id", "code")
    assert "BroadcastHashJoin" not in plan(got)
    assert got.filter(F.col("code").eqNullSafe(F.when(F.col("id") < 20_000, F.col("id")))).count() == 40_000


def test_small_dictionary_is_local(spark):
    d = dc.Dictionary.materialise(spark.createDataFrame([("a", None), (None, 2)], "value string, n int"))
    assert d.local and d.size == 2 and d.size_bytes == 1 + 16
    assert dc.Dictionary.materialise(spark.createDataFrame([], "value string")).size == 0


def test_filter_loses_no_member(spark, monkeypatch):
    monkeypatch.setattr(dc, "FILTER_WORDS", 16)
    keys = spark.range(300).select((F.col("id") * 7).cast("string").alias("k"))
    df = spark.range(2_200).select(F.when(F.col("id") < 2_100, F.col("id").cast("string")).alias("k"))
    out = dc.possible_members(df, keys, "k", "maybe")
    member = F.coalesce(F.col("k").cast("int") % 7 == 0, F.lit(False))
    assert out.count() == 2_200
    assert out.filter(member & ~F.col("maybe")).count() == 0
    assert out.filter(F.col("k").isNull() & F.col("maybe")).count() == 0
    assert 300 <= out.filter("maybe").count() < 2_100


ROWS = [(i, ["aaa", "aab", "bbb", "ccc", None, f"v{i}"][min(i % 7, 5)], "pq"[i % 2]) for i in range(200)]


@pytest.mark.parametrize("build", [
    lambda: ct.CategoricalTreatment("group", cols=["c", "e"]), lambda: ct.CategoricalTreatment("mode", cols=["c", "e"]),
    lambda: ct.CategoricalTreatment("flag", cols=["c", "e"]), lambda: TypoCorrection(["c"], fuzzy_threshold=0.6),
    lambda: en.LabelEncode(["c", "e"]), lambda: fe.CatPairs(["c", "e"], min_freq=0.05)])
def test_large_dictionaries_change_nothing(spark, monkeypatch, build):
    df = spark.createDataFrame(ROWS, "id long, c string, e string")
    want = build().fit(df).transform(df).orderBy("id")
    rows = [r.asDict() for r in want.collect()]
    monkeypatch.setattr(dc, "LOCAL_ROWS", 1)
    got = build().fit(df).transform(df).orderBy("id").select(*want.columns)
    assert [r.asDict() for r in got.collect()] == rows
