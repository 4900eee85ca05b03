"""De-duplication of a stream that keeps what it rejects.

The first row of a key passes; its event time is held until the watermark is ``within`` past it.
State is kept by bucket of keys (``BUCKETS``), read and written once for all rows of a bucket in a
micro-batch: every access is a round trip to the state store, so one for each key costs far more
than the rows.  Times that have ended are dropped when their bucket is next written, or by a timer
when its newest has ended, so state is bounded by the keys of two such spans.
A further row of a key that is held is a ``duplicate``; any other row older than the watermark is
``late``.  Every row comes out once, with its ``outcome``, so
sent = good + duplicate + late.

Spark drops rows behind the watermark before a stateful operator that can see the watermarked
column.  Here the operator gets the event time as a plain number of milliseconds and compares it
with the watermark itself, so nothing is dropped."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewater.session import session_conf

GOOD, DUPLICATE, LATE = "good", "duplicate", "late"

#: transformWithState keeps its state in RocksDB (bundled with Spark).
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass":
              "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


BUCKETS = 4096                # of keys; a bucket's held keys are one value of state
LEAST_PARTITIONS = 32         # of state, where the session has as many


class KeepFirst(StatefulProcessor):
    def __init__(self, within_ms: int, columns: Sequence[str], key: str, held: T.StructType):
        self.within_ms, self.columns, self.key, self.held = within_ms, list(columns), key, held

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", self.held)

    def _read(self, watermark: int) -> tuple[dict, int]:
        """The event times held, by key, and how many there were with those that have ended."""
        keys, times = self.seen.get() or ((), ())
        return {k: t for k, t in zip(keys, times) if t + self.within_ms > watermark}, len(keys)

    def _write(self, held: dict) -> None:
        self.seen.update((list(held), list(held.values())))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        (held, _), make, new = self._read(watermark), Row(*self.columns, "outcome"), []
        for row in rows:
            if row[self.key] in held:
                outcome = DUPLICATE
            elif row["_event_ms"] < watermark:
                outcome = LATE
            else:
                outcome = GOOD
                held[row[self.key]] = row["_event_ms"]
                new.append(row["_event_ms"])
            yield make(*[row[c] for c in self.columns], outcome)
        if new:
            self._write(held)
            self.handle.registerTimer(max(new) + self.within_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held, before = self._read(timerValues.getCurrentWatermarkInMs())
        if not held:
            self.seen.clear()
        elif len(held) < before:
            self._write(held)
        return iter(())

    def close(self) -> None:
        pass


def milliseconds(spark: SparkSession, interval: str) -> int:
    """Length of an interval such as ``10 minutes``."""
    return int(spark.sql(f"SELECT unix_millis(timestamp_millis(0) + INTERVAL {interval})").first()[0])


def mark_repeats(rows: DataFrame, key: str, event_time: str, within: str) -> DataFrame:
    """Streaming ``rows`` (key and event time not null) with ``outcome``.  Start the query inside
    :func:`state_conf`."""
    columns = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField("outcome", T.StringType())])
    timed = (rows.withColumn("_event_time", F.col(event_time).cast("timestamp")).withWatermark("_event_time", within)
             .withColumn("_event_ms", F.unix_millis("_event_time")).drop("_event_time")
             .withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS))))
    held = T.StructType([T.StructField("keys", T.ArrayType(rows.schema[key].dataType)), T.StructField("times", T.ArrayType(T.LongType()))])
    return timed.groupBy("_bucket").transformWithState(
        KeepFirst(milliseconds(rows.sparkSession, within), columns, key, held), schema, "append", "EventTime")


def state_partitions(spark: SparkSession) -> int:
    """Opening a partition of state and its Python worker takes longer than many thousand rows, so no more
    than two for each core; a query keeps the number it was first started with."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(2 * spark.sparkContext.defaultParallelism, LEAST_PARTITIONS))


def state_conf(spark: SparkSession, stateful: bool = True):
    own = {"spark.sql.shuffle.partitions": str(state_partitions(spark))} if stateful else {}
    return session_conf(spark, {**STATE_CONF, **own})
