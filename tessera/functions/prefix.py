"""Distributed running totals over a global order, without a single-partition window.

Rows are range-partitioned on the order key; each partition computes its local running
sum (a window per partition id, so partitions run in parallel); the per-partition totals
(one row per partition) give the offsets that turn local sums into global ones.  The
range-partitioned table is checkpointed so partition ids are stable between the two uses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def running_totals(df: DataFrame, order: Sequence[str], cols: Sequence[str], partitions: int | None = None,
                   prefix: str = "cum_") -> DataFrame:
    """Add ``{prefix}{c}`` = sum of ``c`` over all rows up to and including this one in
    ``order`` (order must be a total order, e.g. pre-aggregated distinct keys), plus
    ``__rank`` = 1-based global row position."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = df.repartitionByRange(n, *order).withColumn("__pid", F.spark_partition_id())
    r = cut_lineage(r)
    w = Window.partitionBy("__pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = r.withColumns({f"__l_{c}": F.sum(c).over(w) for c in cols}).withColumn("__lrank", F.row_number().over(w))
    # one row per partition: its offsets are the running totals of the partitions before it
    sums = r.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(f"__s_{c}") for c in cols])
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = sums.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__on"),
                       *[F.coalesce(F.sum(f"__s_{c}").over(before), F.lit(0)).alias(f"__o_{c}") for c in cols])
    out = local.join(F.broadcast(offs), "__pid")
    out = out.withColumns({f"{prefix}{c}": F.col(f"__l_{c}") + F.col(f"__o_{c}") for c in cols})
    out = out.withColumn("__rank", F.col("__lrank") + F.col("__on"))
    return out.drop("__pid", "__lrank", "__on", *[f"__l_{c}" for c in cols], *[f"__o_{c}" for c in cols])
