"""Message envelope construction: ``{batch_number, record_id, timestamp, data{...}}``
as a JSON value plus a string key.  Pure column expressions, so building messages
for a whole table is one map-only stage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def iso_timestamp(c: Column | str) -> Column:
    """Naive ISO-8601 text with a 6-digit fraction."""
    return F.date_format(c, ISO_FORMAT)


def message_key(record_id: Column | str) -> Column:
    return F.col(record_id).cast("string") if isinstance(record_id, str) else record_id.cast("string")


def batch_number(record_id: Column | str, batch_size: int) -> Column:
    """Producer batches of ``batch_size`` consecutive ids, numbered from 1."""
    rid = F.col(record_id) if isinstance(record_id, str) else record_id
    return (F.floor(rid / F.lit(batch_size)) + 1).cast("int")


def _data_struct(data: Sequence[str] | Mapping[str, Column]) -> Column:
    items = data.items() if isinstance(data, Mapping) else [(c, F.col(c)) for c in data]
    return F.struct(*[e.cast("float").alias(n) for n, e in items])


def to_envelope(df: DataFrame, *, record_id: str = "record_id", timestamp: str = "timestamp",
                data: Sequence[str] | Mapping[str, Column] = (), batch_size: int = 10,
                keep_nulls: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Encode each row as a message: ``key`` (string record id) and ``value`` (JSON).

    ``data`` names the payload columns (or maps names to expressions); numbers are
    sent as floats like the reference producer.  ``to_json`` drops NULL fields unless
    ``keep_nulls``.  ``keep`` passes extra columns through (e.g. for partitioning).
    """
    env = F.struct(
        batch_number(record_id, batch_size).alias("batch_number"),
        F.col(record_id).cast("long").alias("record_id"),
        iso_timestamp(F.col(timestamp)).alias("timestamp"),
        _data_struct(data).alias("data"),
    )
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return df.select(
        message_key(F.col(record_id)).alias("key"),
        F.to_json(env, opts).alias("value"),
        *keep,
    )
