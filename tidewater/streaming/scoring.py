"""Scoring of a stream whose model may change while it runs.

Each micro-batch looks up the newest registered model and is scored by that one alone; every row names
it.  A model counts from the moment its registry row is there, so one that is still being saved is
never loaded.  A replayed batch replaces its rows as a whole, so no batch mixes two models."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.operators.registry import latest_registered_uri, load_model, model_folder
from tidewater.operators.score import score


def live_scorer(root: str, name: str, out_path: str, by: str = "mtime", keep: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function; scored rows carry ``model_folder`` and ``batch_id``."""
    held: dict = {}                          # the model in use

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        uri = latest_registered_uri(spark, root, name, by)
        if uri not in held:
            loaded = load_model(spark, root, name, uri)
            held.clear()
            held[uri] = loaded
        model, prepared = held[uri]
        scored = score(prepared.apply(batch) if prepared else batch, model, keep)
        scored.withColumn("model_folder", F.lit(model_folder(uri))).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    return write


def run_live_scoring(stream: DataFrame, root: str, name: str, out_path: str, checkpoint: str, by: str = "mtime",
                     keep: Sequence[str] = (), trigger_seconds: int = 5) -> StreamingQuery:
    """Starts the query over raw rows (prepared as each model's training rows were)."""
    return (stream.writeStream.foreachBatch(live_scorer(root, name, out_path, by, keep))
            .option("checkpointLocation", checkpoint).trigger(processingTime=f"{trigger_seconds} seconds").start())


def read_scored(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.option("basePath", out_path).parquet(f"{out_path}/batch_id=*")
