"""Job configuration: one frozen dataclass read from the environment.

No credential has a default; object-store keys must come from the environment or
the cluster's own credential chain."""

from __future__ import annotations

import os
from dataclasses import dataclass, field


def _env(name: str, default: str | None = None) -> str | None:
    v = os.environ.get(name)
    return v if v not in (None, "") else default


@dataclass(frozen=True)
class Config:
    # message source / sink
    source_format: str = "kafka"            # "kafka", or "text" / "parquet" files for tests
    bootstrap_servers: str | None = None
    topic: str = "events-stream"
    source_path: str | None = None          # folder of message files when not kafka
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False
    # sinks
    lake_path: str | None = None            # partitioned Parquet lake
    serving_path: str | None = None         # serving table location
    serving_format: str = "parquet"         # a search-index connector format may be named here
    serving_options: dict = field(default_factory=dict)
    serving_key: str | None = None          # one serving row per key; lake and serving then are tables of snapshots
    compact_every: int = 0                  # merge their batches after so many (0: by a job of its own)
    dead_letter_path: str | None = None     # required: malformed messages and failed batches
    checkpoint_path: str | None = None      # one per streaming query
    trigger_seconds: int = 5
    on_error: str = "raise"                 # "raise" | "isolate"
    # model registry
    model_root: str | None = None
    model_name: str = "model"
    # object store credentials: no defaults
    s3_endpoint: str | None = None
    s3_access_key: str | None = None
    s3_secret_key: str | None = None

    @staticmethod
    def from_env(prefix: str = "TIDEWATER_") -> "Config":
        g = lambda k, d=None: _env(prefix + k, d)
        return Config(
            source_format=g("SOURCE_FORMAT", "kafka"),
            bootstrap_servers=g("BOOTSTRAP_SERVERS"),
            topic=g("TOPIC", "events-stream"),
            source_path=g("SOURCE_PATH"),
            starting_offsets=g("STARTING_OFFSETS", "latest"),
            fail_on_data_loss=g("FAIL_ON_DATA_LOSS", "false").lower() == "true",
            lake_path=g("LAKE_PATH"),
            serving_path=g("SERVING_PATH"),
            serving_format=g("SERVING_FORMAT", "parquet"),
            serving_key=g("SERVING_KEY"),
            compact_every=int(g("COMPACT_EVERY", "0")),
            dead_letter_path=g("DEAD_LETTER_PATH"),
            checkpoint_path=g("CHECKPOINT_PATH"),
            trigger_seconds=int(g("TRIGGER_SECONDS", "5")),
            on_error=g("ON_ERROR", "raise"),
            model_root=g("MODEL_ROOT"),
            model_name=g("MODEL_NAME", "model"),
            s3_endpoint=g("S3_ENDPOINT"),
            s3_access_key=g("S3_ACCESS_KEY"),
            s3_secret_key=g("S3_SECRET_KEY"),
        )

    def spark_conf(self) -> dict[str, str]:
        """Object-store settings for the session, only those that are set."""
        out = {}
        if self.s3_endpoint:
            out["spark.hadoop.fs.s3a.endpoint"] = self.s3_endpoint
            out["spark.hadoop.fs.s3a.path.style.access"] = "true"
        if self.s3_access_key:
            out["spark.hadoop.fs.s3a.access.key"] = self.s3_access_key
        if self.s3_secret_key:
            out["spark.hadoop.fs.s3a.secret.key"] = self.s3_secret_key
        return out
