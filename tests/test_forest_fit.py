"""Forests keep node ids with the rows and fit on as many partitions as the rows fill."""
import pytest

from tessera.plans import models as ml


class Seen:
    def fit(self, df):
        return df.rdd.getNumPartitions()


@pytest.mark.parametrize("rows, have, cores, parts", [
    (9, 3, 8, 1), (75, 1, 8, 8), (75, 1, 4, 4), (45, 1, 8, 5), (75, 12, 4, 4), (300, 1, 2, 3)])
def test_partitions_of_a_fit(spark, monkeypatch, rows, have, cores, parts):
    monkeypatch.setattr(ml, "ROWS_PER_TASK", 10)
    monkeypatch.setattr(ml, "MOST_ROWS_PER_TASK", 100)
    assert ml._fit_parts(rows, cores) == parts
    if cores == spark.sparkContext.defaultParallelism:
        assert ml._fit(Seen(), spark.range(rows).repartition(have)) == parts


def test_forests_keep_node_ids_and_result(spark):
    df = spark.range(400).selectExpr("id", "cast(id * 7919 % 1000 < 300 + 400 * (id % 2) as int) y", "cast(id % 2 as double) a",
                                     "cast(id * 31 % 97 as double) b").coalesce(1)
    pipe = ml.plain_forest("y", ["a", "b"], 5)
    assert pipe.getStages()[-1].getCacheNodeIds()
    with_ids = ml._fit(pipe, df).stages[-1]
    without = ml._fit(pipe.copy({pipe.getStages()[-1].cacheNodeIds: False}), df).stages[-1]
    assert with_ids.toDebugString == without.toDebugString
