"""Sharding by minimax contiguous partition, with DataFrame operations only.

Rows with equal texts form one atomic group (null counts as empty).  Groups are ordered by
the SHA-256 of their text, which spreads neighbours of the corpus over the shards, and are
never split.  The smallest shard capacity with which a greedy left-to-right fill needs at most
``shards`` shards is found by binary search; the shards are cut there.

* The running total of group sizes is distributed: groups fall into 4,096 slices by the first
  hash digits, each slice has its own running sum, and the slice totals (at most 4,096 rows)
  give the offsets.
* The search reads a summary of the running totals, not the totals: the smallest and largest
  total in each of ``BUCKETS`` equal buckets.  A greedy check over the summary gives a lower
  and an upper answer; where they differ the next summary looks only at the stretches in
  which the cuts can lie, in finer buckets, until the answer is exact.  The driver holds at
  most ``BUCKETS`` + 16 rows a round.
* A row finds its shard by comparing its hash with the 15 cuts: no join, no skew.  Slots
  come from per-(shard, bucket of ids) counts, so a shard is numbered by many tasks.

A null text has no bytes and size 1; equal rows get slots of their own; an empty table gives
an empty result.  Rows without id are numbered like any other.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage_table

SLICE_DIGITS = 3
BUCKETS = 1 << 16  # the search narrows for any number of buckets over shards ** 3
SLOT_BUCKETS = 256


def running_sizes(groups: DataFrame) -> DataFrame:
    """(key, size, total): the running total of ``size`` in the order of ``key`` (hex)."""
    cut = groups.withColumn("slice", F.substring("key", 1, SLICE_DIGITS))
    inside = Window.partitionBy("slice").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumn("run", F.sum("size").over(inside))
    sums = cut.groupBy("slice").agg(F.sum("size").alias("sum"))
    before = sums.select("slice", (F.sum("sum").over(Window.orderBy("slice")) - F.col("sum")).alias("before"))  # at most 16 ** SLICE_DIGITS rows
    return local.join(F.broadcast(before), "slice").select("key", "size", (F.col("run") + F.col("before")).alias("total"))


class Summary:
    """Known facts on the running totals: disjoint ascending buckets (smallest, largest)."""

    def __init__(self, buckets: list[tuple[int, int]]):
        self.low = [0] + [b[0] for b in buckets]
        self.high = [0] + [b[1] for b in buckets]

    def reach(self, x: int) -> tuple[int, int]:
        """Bounds on the largest running total that is at most x; the lower one is a total."""
        i = bisect.bisect_right(self.low, x) - 1
        return (self.high[i], self.high[i]) if self.high[i] <= x else (self.low[i], x)

    def fill(self, capacity: int, shards: int) -> tuple[list[int], list[int]]:
        """Ends of the greedy shards: what is sure to be reached, and what may be."""
        sure, may = [0], [0]
        for _ in range(shards):
            sure.append(self.reach(sure[-1] + capacity)[0])
            may.append(self.reach(may[-1] + capacity)[1])
        return sure[1:], may[1:]


def _summary(totals: DataFrame, stretches: list[tuple[int, int]]) -> Summary:
    """Buckets of the running totals inside the stretches [from, to]."""
    each = max(1, BUCKETS // len(stretches))
    t, bucket = F.col("total"), None
    for i, (a, b) in enumerate(stretches):
        width = (b - a) // each + 1
        place = F.lit(i * each) + F.floor((t - a) / F.lit(width))
        bucket = F.when(t.between(a, b), place) if bucket is None else bucket.when(t.between(a, b), place)
    rows = (totals.withColumn("bucket", bucket.cast("long")).filter("bucket is not null")
            .groupBy("bucket").agg(F.min("total").alias("low"), F.max("total").alias("high")).collect())
    return Summary(sorted((r["low"], r["high"]) for r in rows))


def _united(parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(parts):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _first(low: int, high: int, holds) -> int:
    """Smallest x in (low, high] for which ``holds``; ``holds(high)`` is known."""
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if holds(mid) else (mid, high)
    return high


def minimax_cuts(totals: DataFrame, shards: int) -> tuple[int, list[int]]:
    """(smallest feasible capacity, running totals at which the shards end)."""
    row = totals.agg(F.max("total"), F.max("size")).first()
    if row[0] is None:
        return 0, []
    whole, largest = int(row[0]), int(row[1])
    least = max(-(-whole // shards), largest)
    low, high = least - 1, whole  # infeasible or out of range; feasible
    stretches = [(1, whole)]
    while True:
        known = _summary(totals, stretches)
        new_high = _first(low, high, lambda c: known.fill(c, shards)[0][-1] >= whole)
        new_low = _first(low, new_high, lambda c: known.fill(c, shards)[1][-1] >= whole) - 1
        low, high = new_low, new_high
        if high - low == 1:
            ends = [e for e in known.fill(high, shards)[0]]
            return high, sorted(set(ends))
        sure, may = known.fill(low + 1, shards)[0], known.fill(high, shards)[1]
        last = [0, *may[:-1]]
        stretches = _united([(s, min(whole, max(m, l + high))) for s, m, l in zip(sure, may, last)])


def shard(documents: DataFrame, *, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under the law "bytes")."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = stage_table(documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text.cast("binary"), 256).alias("key"))
        .withColumn("row", F.monotonically_increasing_id()))
    totals = stage_table(running_sizes(rows.groupBy("key").agg(F.sum("size").alias("size"))))
    _, ends = minimax_cuts(totals, shards)
    cuts = sorted(r["key"] for r in totals.filter(F.col("total").isin(ends[:-1])).select("key").collect()) if len(ends) > 1 else []
    place = F.lit(0)
    for c in cuts:
        place = place + (F.col("key") > F.lit(c)).cast("int")
    out = rows.withColumns({"shard": place.cast("int"), "part": F.pmod(F.xxhash64(F.coalesce("doc_id", "row")), F.lit(SLOT_BUCKETS)).cast("int")})
    count = out.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = count.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))  # at most shards * SLOT_BUCKETS rows
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "row")
    out = out.withColumn("i", F.row_number().over(inside)).join(F.broadcast(before), ["shard", "part"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      (F.col("i") - 1 + F.col("before")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
