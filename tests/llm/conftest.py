import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session
    yield build_session(4, shuffle_partitions=8, extra={"spark.driver.memory": "8g"})


DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, uid long, term string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts (or (doc_id, text) pairs), with extra columns whose names clash
    with those the operators use inside."""
    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7, 8, "x") for i, t in rows], DOCS).repartition(3)
    return make


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
