"""Structured Streaming: apply fitted operators to a stream.

``fit`` is a batch job; nearly every ``Fitted.transform`` is stateless (expressions plus joins
with small static dictionary tables), so the same fitted chain scores a streaming
DataFrame micro-batch by micro-batch.  Transforms that aggregate or rank inside (kNN
imputation) run on each micro-batch as a frame of its own (``start_batches``).  Stream-static left joins against the broadcast
dictionaries are supported by Structured Streaming; no state store is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.base import Fitted


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A file source with a declared schema (no inference on a stream)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def transform_stream(stream: DataFrame, steps: Sequence[Fitted]) -> DataFrame:
    """Apply fitted operators in order (all lazy, all stateless)."""
    for s in steps:
        stream = s.transform(stream)
    return stream


def start(stream: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet",
          once: bool = True, query_name: str | None = None) -> StreamingQuery:
    """Write the scored stream; ``fmt='memory'`` uses ``sink`` as the table name.
    The checkpoint folder must be on shared storage on a cluster (exactly-once restart)."""
    w = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w
    if fmt == "memory":
        return w.format("memory").queryName(query_name or sink).start()
    return w.format(fmt).option("path", sink).start()


def start_batches(stream: DataFrame, steps: Sequence[Fitted], path: str, checkpoint: str) -> StreamingQuery:
    """Score each micro-batch as a static frame and write it as Parquet into a folder of its own
    (``batch=<id>``): a batch that is run again after a failure replaces its rows."""
    def score(batch: DataFrame, batch_id: int) -> None:
        transform_stream(batch, steps).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return (stream.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
