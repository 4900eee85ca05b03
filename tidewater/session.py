"""Session construction and shared-folder helpers.

Work folders (checkpoints, stream topics, lake output) live under the folder the
cluster names in ``spark.checkpoint.dir``; a machine-local default is only set when
the session has none (tests, local runs)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

LOCAL_FALLBACK_DIR = "/tmp/tidewater-checkpoints"


def get_session(app: str = "tidewater", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Cap of whole-stage-codegen methods at HotSpot's JIT limit (Spark's documented setting
# for HotSpot).  Wide per-row arithmetic (copula scores over many columns) otherwise fuses
# into one method too large to be JIT-compiled and runs interpreted, several times slower.
JIT_SIZED_CODEGEN = {"spark.sql.codegen.hugeMethodLimit": "8000"}


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply SQL settings for the actions run inside the block, then restore them.
    For eager writes only (a lazily returned DataFrame plans after the block)."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# Shuffle files of a query go when it ends, instead of when the driver's garbage collector
# happens upon them.  For queries that end in a table or a few rows: what runs again
# makes its shuffle again.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
    return d.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession, default: str = LOCAL_FALLBACK_DIR) -> str:
    """Use the session's checkpoint folder; set ``default`` only where none is set and all
    tasks run on this machine (``local[*]``).  A cluster must name a shared folder."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.conf.set("spark.checkpoint.dir", default)
        d = default
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for one run of one job."""
    ensure_checkpoint_dir(spark)
    return f"{checkpoint_root(spark)}/tidewater/{name}-{uuid.uuid4().hex[:12]}"


def delete_dir(spark: SparkSession, path: str) -> None:
    """Delete a work folder whose rows are no longer read."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
