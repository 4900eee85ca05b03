"""Streaming ingest: messages -> parse -> quarantine -> dedupe of well-formed rows ->
foreachBatch writing the serving table and the date/hour lake.

No message is lost: malformed rows go to ``quarantine`` under ``dead_letter_path``, which is
required, and never take part in the de-duplication.  With ``dedupe_within``, repeats of a record
id and rows later than the watermark go to ``rejected`` there, by outcome and batch (see
:mod:`tidewater.streaming.dedupe`).  So sent = lake + quarantine + rejected.

Per micro-batch the batch is persisted once and unpersisted in ``finally`` (one read
and one parse per batch, not one per action), empty batches are skipped with
``isEmpty()``, and both sinks write idempotently keyed on the batch id.  With
``serving_key`` they are tables of snapshots (:mod:`tidewater.sinks.tables`): one serving row per
key, and batches merged every ``compact_every`` ones.  ``rollups`` (:mod:`tidewater.streaming.rollups`)
get the partial aggregates of each batch.  With a ``gate`` (:mod:`tidewater.streaming.gate`) a batch is
judged while its lake rows are written; one that fails stops the query or is set aside, and reaches
no table.  With
``on_error="raise"`` a failing sink fails the query before the checkpoint commits,
so a restart replays the batch; ``"isolate"`` writes the failed batch to a
dead-letter folder and carries on."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.config import Config
from tidewater.functions.parse import parse_messages, split_quarantine
from tidewater.schemas import FEATURES, INT_FIELDS
from tidewater.session import session_conf
from tidewater.sinks.tables import compact, write_batch
from tidewater.sinks.writers import write_lake, write_serving
from tidewater.sources.messages import read_messages
from tidewater.streaming.dedupe import GOOD, mark_repeats, state_conf
from tidewater.streaming.gate import Gate, gated_write
from tidewater.streaming.rollups import Rollup

log = logging.getLogger(__name__)

# A stateful query turns adaptive execution off for its session.  The sinks' writes are batch queries on
# rows that are there already, and without it their rebalance is ignored: every task of the state's
# shuffle would write a file into every hour.
SINK_CONF = {"spark.sql.adaptive.enabled": "true"}


def processed_stream(spark: SparkSession, cfg: Config, fields: Sequence[str] = FEATURES,
                     int_fields: Sequence[str] = INT_FIELDS, max_per_trigger: int | None = None,
                     dedupe_within: str | None = None) -> DataFrame:
    raw = read_messages(spark, cfg.source_format, path=cfg.source_path, topic=cfg.topic,
                        bootstrap_servers=cfg.bootstrap_servers, starting_offsets=cfg.starting_offsets,
                        fail_on_data_loss=cfg.fail_on_data_loss, max_per_trigger=max_per_trigger)
    parsed = parse_messages(raw, fields=fields, int_fields=int_fields, keep_raw=True)
    if not dedupe_within:
        return parsed
    # malformed rows have no id or time to compare, so all of them pass by
    good, bad = split_quarantine(parsed)
    marked = mark_repeats(good, "record_id", "event_timestamp", dedupe_within)
    return marked.unionByName(bad.withColumn("outcome", F.lit(None).cast("string")))


def dual_sink(cfg: Config, serving_cols: Sequence[str] | None = None,
              serving_transform: Callable[[DataFrame], DataFrame] | None = None,
              rollups: Sequence[Rollup] = (), gate: Gate | None = None) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function writing both sinks (and dead letters)."""
    if gate and not cfg.serving_key:
        raise ValueError("a gate needs cfg.serving_key: the lake must be a table of snapshots")

    def _to_table(df: DataFrame, path: str, batch_id: int, partition_cols: Sequence[str], key: str | None) -> None:
        if not (gate and partition_cols):                   # the gate has put the lake's batch there
            write_batch(df, path, batch_id, partition_cols)
        if cfg.compact_every and batch_id % cfg.compact_every == cfg.compact_every - 1:
            compact(df.sparkSession, path, partition_cols, key, ["event_timestamp"] if key else ())

    def write(batch: DataFrame, batch_id: int) -> None:
        with session_conf(batch.sparkSession, SINK_CONF):
            write_sinks(batch, batch_id)

    def write_sinks(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if b.isEmpty():
                return
            good, bad = split_quarantine(b)
            if "outcome" in b.columns:
                rejected = good.where(F.col("outcome") != GOOD)
                good = good.where(F.col("outcome") == GOOD).drop("outcome")
                if not rejected.isEmpty():
                    (rejected.select("raw_value", "record_id", "event_timestamp", "outcome", F.lit(batch_id).cast("long").alias("batch_id"))
                     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                     .partitionBy("outcome", "batch_id").parquet(f"{cfg.dead_letter_path}/rejected"))
            good = good.drop("raw_value")
            serving = good.drop("processed_at", "date", "hour")
            if serving_cols:
                serving = serving.select(*serving_cols)
            if serving_transform:
                serving = serving_transform(serving)
            if cfg.serving_key:
                sinks = [("serving", lambda: _to_table(serving, cfg.serving_path, batch_id, (), cfg.serving_key)),
                         ("lake", lambda: _to_table(good, cfg.lake_path, batch_id, ("date", "hour"), None))]
            else:
                sinks = [
                    ("serving", lambda: write_serving(serving, cfg.serving_path, cfg.serving_format,
                                                      cfg.serving_options, batch_id)),
                    ("lake", lambda: write_lake(good, cfg.lake_path, batch_id=batch_id)),
                ]
            sinks += [(f"rollup-{i}", lambda r=r: r.add(good, batch_id)) for i, r in enumerate(rollups)]
            if gate and not gated_write(good, cfg.lake_path, batch_id, gate, ("date", "hour"))["is_valid"]:
                sinks = []                                  # set aside
            for name, fn in sinks:
                try:
                    fn()
                except Exception:
                    if cfg.on_error == "raise":
                        raise
                    log.exception("sink %s failed for batch %s; batch sent to dead letters", name, batch_id)
                    (b.select(F.lit(name).alias("failed_sink"), "raw_value")
                      .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                      .parquet(f"{cfg.dead_letter_path}/failed/sink={name}/batch_id={batch_id}"))
            q = bad.select("raw_value", "batch_number", "record_id")
            if not q.isEmpty():
                (q.withColumn("batch_id", F.lit(batch_id).cast("long"))
                  .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                  .partitionBy("batch_id").parquet(f"{cfg.dead_letter_path}/quarantine"))
        finally:
            b.unpersist()

    return write


def run_ingest(spark: SparkSession, cfg: Config, *, fields: Sequence[str] = FEATURES,
               int_fields: Sequence[str] = INT_FIELDS, available_now: bool = False,
               max_per_trigger: int | None = None, dedupe_within: str | None = None,
               serving_cols: Sequence[str] | None = None,
               serving_transform: Callable[[DataFrame], DataFrame] | None = None,
               rollups: Sequence[Rollup] = (), gate: Gate | None = None,
               query_name: str | None = None) -> StreamingQuery:
    """Start the ingest query (processing-time trigger, or ``availableNow`` for
    backfills/tests).  Each query has its own checkpoint folder."""
    if not cfg.checkpoint_path:
        raise ValueError("cfg.checkpoint_path is required (one per streaming query)")
    if not cfg.dead_letter_path:
        raise ValueError("cfg.dead_letter_path is required: malformed messages are kept there")
    stream = processed_stream(spark, cfg, fields, int_fields, max_per_trigger, dedupe_within)
    w = (stream.writeStream.foreachBatch(dual_sink(cfg, serving_cols, serving_transform, rollups, gate))
         .option("checkpointLocation", cfg.checkpoint_path).outputMode("append"))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=f"{cfg.trigger_seconds} seconds")
    with state_conf(spark, bool(dedupe_within)):                                 # the query keeps the settings it starts with
        return w.start()
