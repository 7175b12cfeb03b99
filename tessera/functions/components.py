"""Connected components by alternating large-star and small-star rounds.

Each round rewires edges towards the smallest neighbour; the loop ends only when a whole
round leaves the edge set unchanged, so the result does not depend on the diameter of the
graph.  A round is one scan, two windows by vertex and one distinct, without joins: its plan,
which the driver holds for each of many rounds, stays small.  Nothing is gathered on the driver
except one (count, checksum) row per round, observed while the round is written.  Every round
is written as a table in the shared checkpoint folder, which cuts the lineage and survives
lost executors.  Without edges there is no round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import free, stage_observed


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex onto the smallest of the vertex and its neighbours;
    for edges a > b."""
    ends = F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    und = e.select(F.inline(ends))
    low = und.withColumn("m", F.least("a", F.min("b").over(Window.partitionBy("a"))))
    return low.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours onto the smallest of these; for edges a > b."""
    low = e.withColumn("m", F.min("b").over(Window.partitionBy("a")))
    onto = F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
    return low.select(F.inline(onto)).filter(F.col("a") != F.col("b"))


def connected_components(edges: DataFrame) -> DataFrame:
    """Component label (smallest member id) of every vertex of an undirected edge list
    (a, b) of long ids.  Self-loops keep their vertex; null ends are ignored; no edges give
    an empty result.  Returns (id, component)."""
    e = (edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
         .filter(F.col("a").isNotNull() & F.col("b").isNotNull()))
    proper = F.col("a") != F.col("b")
    sums = [F.count(F.when(proper, 1)).alias("n"), F.sum(F.when(proper, F.xxhash64("a", "b").cast("decimal(38,0)"))).alias("hash")]
    e, before = stage_observed(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), *sums)
    loops = e.filter(~proper).select(F.col("a").alias("id"), F.col("a").alias("component"))
    cur = e.filter(proper)
    while before["n"]:
        nxt, now = stage_observed(_small_star(_large_star(cur)).distinct(), *sums)
        free(cur)
        cur = nxt
        if now == before:
            break
        before = now
    if not before["n"]:
        return loops
    out = cur.select(F.col("a").alias("id"), F.col("b").alias("component"))
    out = out.unionAll(cur.select(F.col("b").alias("id"), F.col("b").alias("component")))
    out = out.unionAll(loops)
    return out.groupBy("id").agg(F.min("component").alias("component"))
