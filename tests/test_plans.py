"""Plan-shape checks: no cartesian products or nested-loop joins in any registered query
plan, filters and projections reach the Parquet scan, and results do not depend on the
number of shuffle partitions."""
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

HEAVY = ("op", "pipeline", "wf", "ml", "fs4", "fs5", "fs7", "fs8", "fs9", "ib10", "ib11", "ct4", "ct6_combined")
NAMES = sorted(n for n in entry.queries() if not n.startswith(HEAVY))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scan_is_pruned_and_filtered(spark):
    df = entry.queries()["ot1_drop"](spark, SF_SMALL)
    scan = [line for line in _plan(df).split("\n") if "FileScan parquet" in line]
    assert scan and all("props" not in s and "ts:" not in s for s in scan)  # unused columns never read


@pytest.mark.parametrize("name", ["cd4_combined", "io4_split", "mv3_group", "en1_label"])
def test_partition_count_independent(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    res = []
    for p in ("1", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", p)
        res.append(sorted(map(tuple, entry.queries()[name](spark, SF_SMALL).collect()), key=str))
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert res[0] == res[1]
