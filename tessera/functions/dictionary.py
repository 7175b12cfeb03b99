"""Dictionary tables: per-(column, category) statistics and lookups back onto rows.

A dictionary is the fitted state of every categorical operator.  It is computed from a
long (column, value) view of the selected string columns, so k columns cost ONE shuffle
(partial aggregation happens map-side, so a hot category costs nothing extra).

Materialisation is size-checked in rows and bytes, counted before anything moves: a
dictionary within ``LOCAL_ROWS`` and ``LOCAL_BYTES`` is collected and rebuilt as a local
relation, which Spark broadcasts; a larger one is checkpointed into the shared checkpoint
folder and joined by shuffle (AQE splits skewed partitions).  Where few rows can match such a
table, a membership filter of fixed size keeps the others out of the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cached, cut_lineage
from .kinds import q

# what a dictionary may hold to pass through the driver and be broadcast
LOCAL_ROWS = 200_000
LOCAL_BYTES = 32 << 20
FILTER_WORDS = 1 << 20  # 64-bit words of a membership filter (16 MB broadcast at most)


def long_values(df: DataFrame, cols: Sequence[str], extra: Sequence[str | Column] = (),
                keep_nulls: bool = True) -> DataFrame:
    """(…extra, column, value) with value cast to string; one row per (row, column)."""
    items = F.array(*[F.struct(F.lit(c).alias("column"), q(c).cast("string").alias("value"))
                      for c in cols])
    out = df.select(*extra, F.inline(items))
    return out if keep_nulls else out.filter(F.col("value").isNotNull())


def category_counts(df: DataFrame, cols: Sequence[str], label: str | None = None,
                    keep_nulls: bool = True) -> DataFrame:
    """(column, value, n[, label_sum, label_n]) for all columns in one aggregation."""
    extra = [q(label).cast("double").alias("__y")] if label else []
    long = long_values(df, cols, extra, keep_nulls)
    aggs = [F.count(F.lit(1)).alias("n")]
    if label:
        aggs += [F.sum("__y").alias("label_sum"), F.count("__y").alias("label_n")]
    return long.groupBy("column", "value").agg(*aggs)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: strings by their UTF-8 length, others 8 each."""
    sizes = [F.coalesce(F.octet_length(q(f.name)), F.lit(0)) if f.dataType.simpleString() == "string" else F.lit(8)
             for f in df.schema.fields]
    return reduce(lambda x, y: x + y, sizes, F.lit(0)).cast("long")


class Dictionary:
    """A materialised dictionary table of known size; ``local``: small enough to broadcast."""

    def __init__(self, df: DataFrame, local: bool, size: int, size_bytes: int):
        self.df, self.local, self.size, self.size_bytes = df, local, size, size_bytes

    @classmethod
    def materialise(cls, df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> "Dictionary":
        max_rows, max_bytes = max_rows or LOCAL_ROWS, max_bytes or LOCAL_BYTES
        with cached(df) as d:
            size, size_bytes = d.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(d)), F.lit(0))).first()
            if size <= max_rows and size_bytes <= max_bytes:
                local = df.sparkSession.createDataFrame(d.collect(), schema=df.schema)
                return cls(local, True, size, size_bytes)
            return cls(cut_lineage(d), False, size, size_bytes)

    def rows(self) -> list:
        if not self.local:
            raise ValueError("dictionary is too large to bring to the driver")
        return self.df.collect()

    def for_column(self, column: str) -> DataFrame:
        return self.df.filter(F.col("column") == column).drop("column")


def lookup(df: DataFrame, key: Column, table: DataFrame, table_key: str,
           values: Sequence[str], broadcast: bool = True, sparse: bool = False) -> DataFrame:
    """Left many-to-one lookup of ``values`` from ``table`` by ``key`` (null key -> no match).
    ``sparse``: few rows are expected to match, so a table that is not broadcast is preceded by
    a membership filter; rows that fail it take no part in the shuffle."""
    k = "__lk"
    t = table.select(F.col(table_key).alias(k), *[F.col(v) for v in values])
    keyed = df.withColumn(k, key)
    if broadcast:
        return keyed.join(F.broadcast(t), on=k, how="left").drop(k)
    if not sparse:
        return keyed.join(t, on=k, how="left").drop(k)
    types = dict(t.dtypes)
    tested = possible_members(keyed, t, k, "__maybe")
    rest = tested.filter(~F.col("__maybe")).withColumns({v: F.lit(None).cast(types[v]) for v in values})
    met = tested.filter("__maybe").join(t, on=k, how="left")
    return met.unionByName(rest).drop(k, "__maybe")


def possible_members(df: DataFrame, table: DataFrame, key: str, out: str) -> DataFrame:
    """``df`` with a boolean ``out``: false only if ``key`` is not in ``table``.  The filter is
    one hash bit a key in at most ``FILTER_WORDS`` words, so its broadcast has a fixed bound."""
    word = F.pmod(F.xxhash64(key), F.lit(FILTER_WORDS)).alias("__w")
    bit = F.pmod(F.xxhash64(F.lit(1), key), F.lit(64)).cast("int")
    words = (table.filter(F.col(key).isNotNull()).select(word, F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("__b"))
             .groupBy("__w").agg(F.bit_or("__b").alias("__b")))
    hit = F.call_function("shiftrightunsigned", F.col("__b"), bit).bitwiseAND(F.lit(1)) == 1
    return (df.withColumn("__w", word).join(F.broadcast(words), "__w", "left")
            .withColumn(out, F.coalesce(hit & F.col(key).isNotNull(), F.lit(False))).drop("__w", "__b"))


def top_k_per_group(df: DataFrame, group: str, order: Sequence[Column], k: int,
                    tie_cols: Sequence[str] = (), buckets: int = 64) -> DataFrame:
    """Exact top-k rows per group without putting a whole group in one task.

    Rows are first ranked inside (group, hash bucket) — parallel, since a big group is
    spread over ``buckets`` tasks — keeping k per bucket; the survivors (at most
    k * buckets per group) are ranked once more per group.  The global top-k is contained
    in the union of per-bucket top-k, so the result is exact.  Adds ``rank`` (1-based).
    """
    from pyspark.sql import Window
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in tie_cols] or [F.lit(0)]), F.lit(buckets))
    w1 = Window.partitionBy(group, "__bk").orderBy(*order)
    first = (df.withColumn("__bk", spread).withColumn("__r", F.row_number().over(w1))
             .filter(F.col("__r") <= k).drop("__r", "__bk"))
    w2 = Window.partitionBy(group).orderBy(*order)
    return first.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= k)
