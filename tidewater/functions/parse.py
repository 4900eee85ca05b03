"""Message parsing: binary/string value -> JSON envelope -> flat typed row.

ANSI-safe: integer payload fields use ``try_cast`` (NaN / overflow -> NULL, never a
failed query), the event time uses ``try_cast`` to ``timestamp_ntz`` (bad text ->
NULL).  Rows whose event time or record id is NULL are quarantined rather than
written to a ``__HIVE_DEFAULT_PARTITION__`` lake partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.schemas import FEATURES, INT_FIELDS, envelope_schema, payload_schema


def parse_messages(df: DataFrame, *, fields: Sequence[str] = FEATURES,
                   int_fields: Sequence[str] = INT_FIELDS, value_col: str = "value",
                   with_metadata: bool = True, keep_raw: bool = False) -> DataFrame:
    """Parse envelopes into ``batch_number, record_id, event_timestamp, <fields>``
    plus ``processed_at, date, hour`` when ``with_metadata``."""
    env = envelope_schema(payload_schema(list(fields)))
    raw = F.col(value_col).cast("string")
    m = F.from_json(raw, env)
    parsed = df.select(m.alias("m"), *([raw.alias("raw_value")] if keep_raw else []))
    cols = [
        F.col("m.batch_number").alias("batch_number"),
        F.col("m.record_id").alias("record_id"),
        F.col("m.timestamp").try_cast(T.TimestampNTZType()).alias("event_timestamp"),
    ]
    for f in fields:
        c = F.col(f"m.data.{f}")
        cols.append((c.try_cast("int") if f in int_fields else c).alias(f))
    out = parsed.select(*cols, *(["raw_value"] if keep_raw else []))
    if with_metadata:
        out = (out.withColumn("processed_at", F.current_timestamp())
                  .withColumn("date", F.to_date("event_timestamp"))
                  .withColumn("hour", F.hour("event_timestamp")))
    return out


def is_quarantined() -> Column:
    """Malformed message (all envelope fields NULL), missing id, or unparseable time."""
    return F.col("event_timestamp").isNull() | F.col("record_id").isNull()


def split_quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows); both are lazy filters over the same input."""
    q = is_quarantined()
    return parsed.where(~q), parsed.where(q)
