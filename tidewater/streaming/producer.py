"""Paced synthetic message producer: rate source -> copula sample keyed on the
record id -> JSON envelope -> message sink, one micro-batch per interval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.config import Config
from tidewater.functions.envelope import to_envelope
from tidewater.operators.synth import CopulaModel, copula_sample
from tidewater.sinks.writers import write_messages
from tidewater.sources.messages import paced_source


def synth_messages(spark: SparkSession, model: CopulaModel, rows_per_batch: int = 10,
                   interval_ms: int = 2000, seed: int = 42) -> DataFrame:
    ids = paced_source(spark, rows_per_batch, interval_ms)
    rows = copula_sample(model, ids, "record_id", seed, keep=["timestamp"])
    data = [m.name for m in model.columns]
    return to_envelope(rows, record_id="record_id", timestamp="timestamp", data=data,
                       batch_size=rows_per_batch)


def run_producer(spark: SparkSession, cfg: Config, model: CopulaModel, rows_per_batch: int = 10,
                 interval_ms: int = 2000, seed: int = 42, max_batches: int | None = None) -> StreamingQuery:
    """Start the producer; messages go to Kafka (``cfg.source_format == 'kafka'``;
    at least once: consumers de-duplicate by key), to a ``topic`` (each batch once)
    or to message files under ``cfg.source_path``.  With ``max_batches`` the first so many
    batches of ids are sent and later ones are empty; :func:`produce` also ends the query."""
    msgs = synth_messages(spark, model, rows_per_batch, interval_ms, seed)
    if max_batches is not None:
        msgs = msgs.where(F.col("key").cast("long") < F.lit(max_batches * rows_per_batch))

    def send(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        if cfg.source_format == "topic":                    # a replayed batch keeps its name and counts once
            write_messages(batch, "topic", path=cfg.source_path, txn=f"{cfg.topic}-{batch_id}")
        elif cfg.source_format == "kafka":
            write_messages(batch, "kafka", topic=cfg.topic, bootstrap_servers=cfg.bootstrap_servers)
        else:
            # one folder per batch id: a replayed batch rewrites the same folder
            (batch.select("value").write.mode("overwrite")
                  .text(f"{cfg.source_path}/batch_id={batch_id}"))

    w = (msgs.writeStream.foreachBatch(send).option("checkpointLocation", cfg.checkpoint_path)
         .trigger(processingTime=f"{max(interval_ms, 1) / 1000} seconds"))
    return w.start()


def produce(spark: SparkSession, cfg: Config, model: CopulaModel, max_batches: int, rows_per_batch: int = 10,
            interval_ms: int = 2000, seed: int = 42) -> int:
    """Send ``max_batches`` batches and stop; returns how many rows were sent."""
    q = run_producer(spark, cfg, model, rows_per_batch, interval_ms, seed, max_batches)
    want, sent = max_batches * rows_per_batch, 0
    try:
        while q.isActive and sent < want:
            q.awaitTermination(max(interval_ms, 200) / 2000)
            done = {p["batchId"]: p["numInputRows"] for p in q.recentProgress}
            sent = min(want, rows_per_batch * (max(done, default=-1) + 1))
        if q.exception():
            raise RuntimeError(str(q.exception()))
    finally:
        q.stop()
    return sent
