"""The registry of the training-data queries."""
import re

import __spark_entry__ as entry
import corpus_pipeline

from .conftest import SF


def test_one_query_per_operator():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and 4 <= len(corpus_pipeline.STAGES) <= 5


def test_sharding_stays_in_the_engine(spark):
    plan = entry.queries()["op1_sharding"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
