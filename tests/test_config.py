import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewater.config import Config
from tidewater.plans.jobs import await_or_stop


def test_config_from_the_environment(monkeypatch):
    for name, value in {"SOURCE_FORMAT": "topic", "FAIL_ON_DATA_LOSS": "TRUE", "TRIGGER_SECONDS": "9", "SERVING_KEY": "record_id",
                        "COMPACT_EVERY": "12", "LAKE_PATH": ""}.items():
        monkeypatch.setenv(f"TW_TEST_{name}", value)
    cfg = Config.from_env("TW_TEST_")
    assert (cfg.source_format, cfg.fail_on_data_loss, cfg.trigger_seconds) == ("topic", True, 9)
    assert (cfg.serving_key, cfg.compact_every, cfg.lake_path, cfg.topic) == ("record_id", 12, None, "events-stream")
    assert cfg.s3_access_key is None and cfg.spark_conf() == {}


def _start(spark, tmp, name, broken=False):
    rows = spark.readStream.format("rate").load().withColumn("v", F.raise_error(F.lit("broken")) if broken else F.col("value"))
    return rows.writeStream.format("noop").option("checkpointLocation", f"{tmp}/{name}").start()


def test_a_query_is_stopped_after_its_time(spark, tmp):
    q = _start(spark, tmp, "fine")
    begin = time.time()
    await_or_stop(q, 1)
    assert not q.isActive and time.time() - begin < 30


def test_a_failing_query_raises(spark, tmp):
    with pytest.raises(StreamingQueryException, match="broken"):
        await_or_stop(_start(spark, tmp, "broken", True), 60)


def test_uri_joins_parts(spark):
    from tidewater.functions.scalar import uri
    df = spark.createDataFrame([("m", 3)], "name string, version int")
    assert df.select(uri("s3://models", F.col("name"), F.col("version").cast("string"), "model").alias("u")).first().u == "s3://models/m/3/model"
