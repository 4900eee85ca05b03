"""Batch writers used directly and from the streaming ``foreachBatch`` sink.

Idempotency: when a ``batch_id`` is given it becomes the innermost partition column
and the write uses dynamic partition overwrite, so replaying a micro-batch after a
failure replaces exactly that batch's files instead of appending duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import session_conf
from tidewater.sources.topic import send

# AQE coalesces a rebalance shuffle down to this floor per task.  The rebalance on
# the partition columns already fixes one writer per hour (a hot hour is split), so
# a lower floor only spreads the hours of a small micro-batch over more writer tasks
# instead of one task writing every hour's file in turn; large batches are far above it.
LAKE_WRITE_CONF = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k"}


def _idempotent(df: DataFrame, partition_cols: Sequence[str], batch_id: int | None):
    cols = list(partition_cols)
    if batch_id is not None:
        df = df.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
        cols.append("batch_id")
    return df, cols


def write_lake(df: DataFrame, path: str, partition_cols: Sequence[str] = ("date", "hour"),
               batch_id: int | None = None, compression: str = "snappy",
               mode: str = "append") -> None:
    """Date/hour-partitioned Parquet.  ``rebalance`` on the partition columns lets AQE
    split a hot hour over several tasks and merge small ones, instead of one writer
    task per batch (or per hour)."""
    df, cols = _idempotent(df, partition_cols, batch_id)
    df = df.hint("rebalance", *cols) if cols else df
    w = df.write.format("parquet").option("compression", compression)
    if batch_id is not None:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode(mode)
    with session_conf(df.sparkSession, LAKE_WRITE_CONF):
        (w.partitionBy(*cols) if cols else w).save(path)


def write_serving(df: DataFrame, path: str | None, fmt: str = "parquet",
                  options: dict | None = None, batch_id: int | None = None) -> None:
    """Serving-table append.  File formats get the idempotent batch partition; a
    connector format (e.g. a search index) gets its options, and should be given a
    document id option so a replay overwrites instead of duplicating."""
    w_df = df
    if fmt in ("parquet", "orc", "json") and batch_id is not None:
        w_df, cols = _idempotent(df, [], batch_id)
        w = (w_df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*cols))
    else:
        w = w_df.write.format(fmt).mode("append")
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path) if path else w.save()


def write_messages(df: DataFrame, fmt: str = "kafka", *, path: str | None = None,
                   topic: str | None = None, bootstrap_servers: str | None = None,
                   num_files: int | None = None, order_by: str | None = None,
                   options: dict | None = None, txn: str | None = None) -> None:
    """Message sink for ``key``/``value`` rows.  Kafka producer settings pass through
    as ``kafka.*`` options (acks, retries, compression, in-flight limit).  A ``topic`` takes
    each ``txn`` once, so a repeated send adds nothing."""
    if fmt == "topic":
        send(df, path, txn)
        return
    if fmt == "kafka":
        w = (df.select("key", "value").write.format("kafka")
             .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic))
        for k, v in (options or {"kafka.acks": "all", "kafka.retries": "3",
                                 "kafka.compression.type": "gzip",
                                 "kafka.max.in.flight.requests.per.connection": "1"}).items():
            w = w.option(k, v)
        w.save()
        return
    if num_files and order_by:      # contiguous id ranges per file, like a time-ordered topic
        out = df.repartitionByRange(num_files, order_by)
    else:
        out = df.repartition(num_files) if num_files else df
    if fmt == "text":
        out.select("value").write.mode("append").text(path)
    elif fmt == "parquet":
        out.select("key", "value").write.mode("append").parquet(path)
    else:
        raise ValueError(f"unsupported message format {fmt!r}")


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", str(header).lower()).csv(path)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_serving_table(spark: SparkSession, name: str, schema: T.StructType,
                         location: str | None = None, if_exists: str = "keep",
                         partition_cols: Sequence[str] = ()) -> bool:
    """Create a typed serving table; an existing one is kept or dropped and recreated.
    Returns True when a table was created."""
    if spark.catalog.tableExists(name):
        if if_exists == "keep":
            return False
        if if_exists != "recreate":
            raise ValueError("if_exists must be 'keep' or 'recreate'")
        spark.sql(f"DROP TABLE {name}")
    sql = f"CREATE TABLE {name} ({_ddl(schema)}) USING parquet"
    if partition_cols:
        sql += f" PARTITIONED BY ({', '.join(partition_cols)})"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)
    return True


def sample_rows(df: DataFrame, cols: Sequence[str] = ("record_id", "age", "sex", "target"),
                order: str = "record_id", n: int = 1) -> DataFrame:
    """First ``n`` rows by ``order`` (a deterministic ``show(1)``)."""
    return df.select(*cols).orderBy(order).limit(n)
