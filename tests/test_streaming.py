"""Fitted transforms applied unchanged to a Structured Streaming source."""
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import encode as en
from tessera.operators import impute as mv
from tessera.operators import outliers as od
from tessera.streaming.apply import file_stream, start, transform_stream


def test_stream_scoring_equals_batch(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = tempfile.mkdtemp(prefix="tessera-stream-src-")
    ck = tempfile.mkdtemp(prefix="tessera-stream-ck-")
    ev.write.mode("overwrite").parquet(os.path.join(src, "events"))
    steps = [od.IQROutliers(["value"]).fit(ev), mv.NumericFill("median", features=["value"], columns_with_nulls="any").fit(ev),
             en.LabelEncode(["event_type"]).fit(ev)]
    stream = file_stream(spark, os.path.join(src, "events"), ev.schema)
    q = start(transform_stream(stream, steps), "scored_events", ck, fmt="memory")
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM scored_events").orderBy("event_id").collect()
    want = transform_stream(ev, steps).orderBy("event_id").collect()
    assert [r.asDict() for r in got] == [r.asDict() for r in want]
