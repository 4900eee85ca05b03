"""Message stream sources.

``read_messages`` returns a streaming DataFrame with ``key`` and ``value`` columns.
``kafka`` needs the Kafka connector on the classpath (not bundled with PySpark);
``topic`` is the library's own replayable topic (:mod:`tidewater.sources.topic`), with the
same start and loss policies; ``text`` (one JSON envelope per line) and ``parquet``
(key/value columns) folders serve backfills."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources.topic import register


def read_messages(spark: SparkSession, fmt: str = "kafka", *, path: str | None = None,
                  topic: str | None = None, bootstrap_servers: str | None = None,
                  starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                  max_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    r = spark.readStream
    if fmt == "kafka":
        r = (r.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic).option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        for k, v in (options or {}).items():
            r = r.option(k, v)
        return r.load().select("key", "value")
    if fmt == "topic":
        r = (r.format(register(spark)).option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
        if max_per_trigger:
            raise ValueError("a topic's trigger reads all that is new; max_per_trigger is for files and Kafka")
        return r.options(**(options or {})).load(path).select("key", "value")
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if fmt == "text":
        return r.text(path).select(F.lit(None).cast("binary").alias("key"), "value")
    if fmt == "parquet":
        return r.schema("key string, value string").parquet(path)
    raise ValueError(f"unsupported message format {fmt!r}")


def paced_source(spark: SparkSession, rows_per_batch: int = 10, interval_ms: int = 2000,
                 start_ms: int = 0) -> DataFrame:
    """Deterministic paced generator: exactly ``rows_per_batch`` consecutive ids per
    micro-batch; ``record_id`` from 0 and ``batch_number`` from 1."""
    df = (spark.readStream.format("rate-micro-batch")
          .option("rowsPerBatch", rows_per_batch)
          .option("advanceMillisPerBatch", interval_ms)
          .option("startTimestamp", start_ms)
          .load())
    return df.select(F.col("value").alias("record_id"),
                     (F.floor(F.col("value") / rows_per_batch) + 1).cast("int").alias("batch_number"),
                     F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))
