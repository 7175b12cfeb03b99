"""Exact top-k inner-product search over an impact-ordered index, score at a time.

Vectors become integers floor(scale * x).  The index is a table with one row per block of
vectors: its postings (vector, dimension, impact) in descending quantised impact, cut into
``SEGMENTS`` segments, and for every vector the norm of what is left after each segment.

A block of queries meets a block of the index in one task.  Segments are processed in
descending impact; each adds its postings' products to the accumulators of all queries of the
block.  What a vector can still gain is at most (norm left) * (norm of the query), so each
accumulator is an interval.  Processing stops only when the intervals prove that few vectors
besides the possible members remain (``FEW`` of the block's pairs at most), or after the last
segment; every vector that may be a member is then scored exactly in integers.

Each pair of blocks returns at most k rows a query; a window keeps the k best of a query.
Queries are a stated set that meets all rows in blocks; nothing is broadcast or collected.

Vectors that are null or hold null or non-finite components take no part; rows without id are
candidates, no queries (inside, the least long stands for it).  Vectors of different lengths are padded with zeros.  Rows with equal ids stay separate
(a query skips its own row only); ties go to the smaller id, a missing id is the smallest.
Components and scores are 64-bit integers: where a product of the vectors could pass them
(the largest sum of squares is 2^62 or more) the search raises an error instead of wrapping.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package, stage_table
from .bitmap import LEAST_ID

INDEX_BLOCK = 8192
QUERY_BLOCK = 512
SEGMENTS = 6
FEW = 0.02


def _integers(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, v) of the rows that take part."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    whole = vectors.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LEAST_ID)).alias("id"), v.alias("v")).filter(
        "v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")
    return whole.select("id", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def _check_range(vectors: DataFrame, vec_col: str, scale: int) -> None:
    """An error unless all inner products fit: |x . y| is at most the largest sum of squares."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    sane = F.filter(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    most = vectors.select(F.aggregate(sane, F.lit(0.0), lambda t, x: t + F.pow(F.abs(x) * scale + 1, F.lit(2.0))).alias("s")).agg(F.max("s")).first()[0]
    if most is not None and not most < 2.0 ** 62:
        raise OverflowError("inner products of these vectors do not fit 64-bit integers; use a smaller scale")


def _matrix(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _indexed(width: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(pdf.v.tolist(), width)
        mag = np.abs(x).ravel()
        order = np.argsort(-mag, kind="stable")
        order = order[mag[order] > 0]  # zero impacts add nothing
        step = max(1, -(-int(mag.max(initial=0)) // SEGMENTS))
        level = (mag[order] - 1) // step  # quantised impact; equal within a segment
        cuts = np.flatnonzero(np.diff(level)) + 1
        bounds = np.concatenate([[0], cuts, [len(order)]]).astype(np.int64)
        left = (x.astype(np.float64) ** 2).sum(1)
        norms = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            take = order[a:b]
            left = left - np.bincount(take // max(1, width), weights=mag[take].astype(np.float64) ** 2, minlength=len(x))
            norms.append(np.sqrt(np.maximum(left, 0)))
        return pd.DataFrame({
            "block": [pdf.block.iloc[0]], "ids": [pdf.id.to_numpy(np.int64).tobytes()], "uids": [pdf.uid.to_numpy(np.int64).tobytes()],
            "bounds": [bounds.tobytes()], "places": [order.astype(np.int64).tobytes()],
            "impacts": [x.ravel()[order].tobytes()], "norms": [np.array(norms).tobytes()]})
    return run


INDEX = "block int, ids binary, uids binary, bounds binary, places binary, impacts binary, norms binary"


def _searched(k: int, width: int):
    def best(scores, ids, uids):
        o = np.lexsort((uids, ids, -scores))[:k]
        return scores[o], ids[o]

    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        cols = ["query_uid", "query_id", "vec_id", "score"]
        if not len(index) or not len(queries):
            return pd.DataFrame(columns=cols).astype("int64")
        row = index.iloc[0]
        ids, uids, bounds, places, impacts = (np.frombuffer(row[c], np.int64) for c in ("ids", "uids", "bounds", "places", "impacts"))
        n = len(ids)
        norms = np.frombuffer(row["norms"], np.float64).reshape(-1, n)
        whole = np.zeros(n * width, np.int64)
        whole[places] = impacts
        whole = whole.reshape(n, width)
        q = _matrix(queries.v.tolist(), width)
        own = queries.uid.to_numpy(np.int64)
        qn = np.sqrt((q.astype(np.float64) ** 2).sum(1))
        acc = np.zeros((len(q), n))
        self_at = uids[None, :] == own[:, None]
        possible = ~self_at
        for s, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            seg = np.zeros(n * width)
            seg[places[a:b]] = impacts[a:b]
            acc += q.astype(np.float64) @ seg.reshape(n, width).T
            gain = norms[s][None, :] * qn[:, None]
            slack = 1e-6 + 1e-9 * (np.abs(acc) + gain)
            low = np.where(self_at, -np.inf, acc - gain - slack)
            if n > k:
                sure = np.partition(low, n - k, axis=1)[:, n - k]  # k vectors score at least this
                possible = (acc + gain + slack >= sure[:, None]) & ~self_at
                if possible.sum() <= max(FEW * possible.size, k * len(q)):
                    break
        out = []
        for i in range(len(q)):
            at = np.flatnonzero(possible[i])
            scores, found = best(whole[at] @ q[i], ids[at], uids[at])
            out.append(pd.DataFrame({"query_uid": own[i], "query_id": queries.id.iloc[i], "vec_id": found, "score": scores}))
        return pd.concat(out)[cols].astype("int64")
    return run


def build_index(vectors: DataFrame, width: int) -> tuple[DataFrame, int]:
    """Stored index of (uid, id, v) rows, one row per block, and the number of blocks."""
    ship_package(vectors.sparkSession)
    blocks = max(1, -(-vectors.count() // INDEX_BLOCK))
    cut = vectors.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int"))
    return stage_table(cut.groupBy("block").applyInPandas(_indexed(width), INDEX)), blocks


def top_k(vectors: DataFrame, is_query, *, k: int = 5, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best rows of every query row.
    ``is_query``: condition on the column ``id``."""
    _check_range(vectors, vec_col, scale)
    rows = stage_table(_integers(vectors, id_col, vec_col, scale).withColumn("uid", F.monotonically_increasing_id()))
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    index, blocks = build_index(rows, width)
    queries = rows.filter((F.col("id") != LEAST_ID) & is_query)
    parts = max(1, -(-queries.count() // QUERY_BLOCK))
    some = queries.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(parts)).cast("int"))
    q = some.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    x = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    found = (x.groupBy("block", "part").cogroup(q.groupBy("block", "part"))
             .applyInPandas(_searched(k, width), "query_uid long, query_id long, vec_id long, score long"))
    w = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.when(F.col("vec_id") != LEAST_ID, F.col("vec_id")).alias("vec_id"), "score")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS FIRST) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
