"""Synthetic rows: whole counts, gapless ids, points on segments, no hot seed."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import resample as rs


def rows_of(n_min, n_maj, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, 1 if i < n_min else 0, *map(float, rng.normal(size=2))) for i in range(n_min + n_maj)]


def on_segment(p, pts):
    """Whether p lies on a segment between two of the points."""
    for a in pts:
        for b in pts:
            d = b - a
            if not d.any():
                continue
            t = float(np.dot(p - a, d) / np.dot(d, d))
            if -1e-9 <= t <= 1 + 1e-9 and np.allclose(a + t * d, p, atol=1e-9):
                return True
    return False


@pytest.mark.parametrize("make", [rs.smote, rs.adasyn])
def test_points_between_minority_rows(spark, monkeypatch, make):
    monkeypatch.setattr(rs, "COPIES_PER_PIECE", 3)  # seeds are cut into several pieces
    data = rows_of(6, 40)
    df = spark.createDataFrame(data, "id long, y int, a double, b double")
    out = make(df, "y", "id", ["a", "b"]).collect()
    new = [r for r in out if r["id"] >= len(data)]
    assert sorted(r["id"] for r in new) == list(range(len(data), len(data) + len(new)))
    assert {r["y"] for r in new} == {1}
    if make is rs.smote:
        assert len(new) == 34
    pts = [np.array(r[2:]) for r in data if r[1] == 1]
    assert all(on_segment(np.array([r["a"], r["b"]]), pts) for r in new)


def test_few_seeds_many_copies(spark):
    """Ten seeds make a million rows, spread over the tasks."""
    seeds = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(10)], "id long, vec array<double>")
    partners = seeds.select(F.col("id").alias("qid"), F.lit(1).alias("rank"), F.transform("vec", lambda x: x + 1).alias("pvec"))
    copies = seeds.select("id", F.lit(100_000).alias("n_copies"))
    out = rs._synthesise(seeds, partners, copies, ["a", "b"], "y", 1, 50, 7)
    got = out.withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).collect()
    assert sum(r["n"] for r in got) == 1_000_000
    assert min(r["lo"] for r in got) == 50 and max(r["hi"] for r in got) == 1_000_049
    assert max(r["n"] for r in got) < 500_000
    assert out.select("id").distinct().count() == 1_000_000


def test_seeds_without_partners(spark):
    seeds = spark.createDataFrame([(1, [0.0])], "id long, vec array<double>")
    none = spark.createDataFrame([], "qid long, rank int, pvec array<double>")
    out = rs._synthesise(seeds, none, seeds.select("id", F.lit(3).alias("n_copies")), ["a"], "y", 1, 5, 7)
    assert out.count() == 0
