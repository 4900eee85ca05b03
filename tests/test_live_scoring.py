import pytest
from pyspark.sql import functions as F

from tidewater.operators import model as M
from tidewater.operators import registry
from tidewater.streaming.scoring import read_scored, run_live_scoring

METRICS = {"train_accuracy": 0.5, "test_accuracy": 0.5, "eval_accuracy": 0.5, "eval_f1_score": 0.5}


def forest(spark, flip):
    rows = spark.range(200).select(F.col("id").cast("double").alias("x"), ((F.col("id") >= 100) != F.lit(flip)).cast("int").alias("target"))
    return M.train_forest(rows, ["x"], num_trees=1, max_depth=2)


def test_model_changes_under_a_running_stream(spark, tmp, monkeypatch):
    def put(lo, hi):
        spark.range(lo, hi).select(F.col("id").cast("double").alias("x")).coalesce(1).write.mode("append").parquet(f"{tmp}/in")

    root = f"{tmp}/models"
    a = registry.register_model(spark, forest(spark, False), root, "m", METRICS, {})
    put(0, 50)
    q = run_live_scoring(spark.readStream.schema("x double").parquet(f"{tmp}/in"), root, "m", f"{tmp}/out", f"{tmp}/ckpt", keep=["x"], trigger_seconds=1)
    try:
        q.processAllAvailable()
        b_model = forest(spark, True)
        # saved, but not registered yet: must not be used
        b_model.write().save(f"{root}/models/m/v_half-0/model")
        put(50, 60)
        q.processAllAvailable()
        b = registry.register_model(spark, b_model, root, "m", METRICS, {})
        registry.register_model(spark, b_model, root, "other", METRICS, {})
        put(60, 90)
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r["x"]: r for r in read_scored(spark, f"{tmp}/out").collect()}
    assert len(got) == 90
    for x, r in got.items():
        assert r["model_folder"] == registry.model_folder((a if x < 60 else b)["model_uri"])
        assert r["prediction"] == (0.0 if x < 60 else 1.0)


def test_no_model_fails_the_query(spark, tmp):
    root = f"{tmp}/models"
    registry.register_model(spark, forest(spark, False), root, "m", METRICS, {})
    with pytest.raises(Exception):
        registry.latest_registered_uri(spark, root, "unknown")
    assert registry.latest_registered_uri(spark, root, "m", "eval_accuracy") == registry.latest_registered_uri(spark, root, "m")
