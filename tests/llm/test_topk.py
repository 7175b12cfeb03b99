import math
import random

import duckdb
import numpy as np

from .conftest import SF
from tessera.llm import topk
from tessera.llm.topk import ORACLE, op5_topk, top_k


def brute(rows, k=5):
    v = [(i, [math.floor(256 * x) for x in e]) for i, e in rows
         if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for a, (i, x) in enumerate(v):
        if i is not None and i % 50 == 0:
            s = sorted((-sum(p * q for p, q in zip(x, y)), j is not None, j or 0) for b, (j, y) in enumerate(v) if b != a)[:k]
            out += [(i, r + 1, j if known else None, -n) for r, (n, known, j) in enumerate(s)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_matches_brute_force_and_sql(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"]) for r in e.collect()])
    assert rows_of(op5_topk(spark, "/root/testdata/sf0.01")) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert rows_of(op5_topk(spark, SF)) == sorted(con.execute(ORACLE).fetchall(), key=str)


def test_blocks_and_edges(spark, monkeypatch):
    monkeypatch.setattr(topk, "INDEX_BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, .2) for _ in range(8)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 8) for i in range(60)]  # ties
    rows += [(50, [0.5] * 8), (50, [0.5] * 8), (None, [1.0] * 8), (2000, None), (2001, [None] * 8), (2002, [float("nan")] * 8),
             (2003, [float("inf")] * 8), (2050, [1.0, 2.0]), (2100, []), (2101, [0.0] * 8)]
    df = spark.createDataFrame([(i, e, 1, 2) for i, e in rows], "vec_id long, embedding array<float>, id int, uid int").repartition(4)
    as_float = [(i, None if e is None else [None if x is None else float(np.float32(x)) for x in e]) for i, e in rows]
    from pyspark.sql import functions as F
    q = F.col("id") % 50 == 0
    assert rows_of(top_k(df, q)) == brute(as_float)
    assert rows_of(top_k(df.limit(0), q)) == []
    few = df.filter("vec_id in (50, 1000, 2101)")
    assert rows_of(top_k(few, q)) == brute([r for r in as_float if r[0] in (50, 1000, 2101)])


def test_large_components(spark):
    big = [(0, [3.0, 1.0, 0.0]), (1, [1e6, -5.0, 2.0]), (2, [-1e6, 1e5, 0.5]), (50, [1e6, 1.0, 1e6])]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    from pyspark.sql import functions as F
    q = F.col("id") % 50 == 0
    assert rows_of(top_k(df, q)) == brute(big)
    import pytest
    with pytest.raises(OverflowError):
        top_k(spark.createDataFrame([*big, (3, [1e10, 0.0, 0.0])], df.schema), q)
