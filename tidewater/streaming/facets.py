"""Live facet counts: event-time windows with a watermark, so window state is
dropped once the watermark passes the window end (bounded state)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def live_facets(stream: DataFrame, field: str, ts: str = "event_timestamp",
                window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """``window_start, window_end, <field>, doc_count`` per event-time window; emits
    each window once in append mode after the watermark closes it."""
    t = F.col(ts).cast("timestamp")              # watermarks need an LTZ timestamp
    g = (stream.withColumn("_event_time", t).withWatermark("_event_time", delay)
               .groupBy(F.window("_event_time", window).alias("w"), F.col(field))
               .agg(F.count(F.lit(1)).alias("doc_count")))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), field, "doc_count")
