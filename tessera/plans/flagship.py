"""Flagship query: F1 -> MV3 group-median fill -> FE3 group statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.features import GroupStats
from ..operators.impute import GroupNumericFill
from .catalog import f1, r6, train_of


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = f1(spark, sf_dir)
    fill = GroupNumericFill("region", ["acctbal", "total_charges", "tenure"], "median").fit(train_of(df))
    filled = fill.transform(df)
    stats = GroupStats(["segment", "region"], ["acctbal", "total_charges"]).fit(train_of(filled))
    out = stats.transform(filled)
    new = [f"{n}_{s}_{c}" for c in ["segment", "region"] for n in ["acctbal", "total_charges"] for s in ("mean", "median")]
    return out.select("id", "is_test", "segment", "region", r6("acctbal"), r6("total_charges"), r6("tenure"),
                      *[r6(c) for c in new])
