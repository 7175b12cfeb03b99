"""Counts of treated rows gathered while the treatment runs."""
import pytest
from pyspark.sql import Observation

from tessera.functions import dictionary as dc
from tessera.operators import categories as ct
from tessera.operators.typos import TypoCorrection

ROWS = [(i, "Norway" if i % 10 else "Norwya", "a" if i % 50 else None) for i in range(100)] + [(100, None, "zz9")]


@pytest.mark.parametrize("limit", [dc.LOCAL_ROWS, 1])
def test_counts_equal_changed_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(dc, "LOCAL_ROWS", limit)
    df = spark.createDataFrame(ROWS, "id long, c string, e string")
    det = ct.CategoryOutliers(["c", "e"], threshold=0.2).fit(df)
    typos = TypoCorrection(["c", "e"]).fit(df)
    for treat in (det.group_rare, det.replace_with_mode, typos.transform):
        counts = Observation()
        out = {r["id"]: r for r in treat(df, counts=counts).collect()}
        assert set(next(iter(out.values())).asDict()) == {"id", "c", "e"}
        changed = {c: sum(out[r[0]][c] != r[k] for r in ROWS) for k, c in ((1, "c"), (2, "e"))}
        assert counts.get == changed
    assert changed["c"] == 10


def test_combined_share_counts_rows_once(spark):
    df = spark.createDataFrame(ROWS, "id long, c string, e string")
    got = {r["column"]: (r["n_values"], r["n_rows"]) for r in ct.CategoryOutliers(["c", "e"], threshold=0.2).fit(df).combined_share().collect()}
    assert got == {"c": (1, 10), "e": (1, 1)}
