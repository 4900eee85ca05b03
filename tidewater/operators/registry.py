"""Model registry: versioned model folders plus a registry table of metadata.

Layout under ``root``::

    models/<name>/<version>/model/     MLlib PipelineModel
    registry/                          Parquet table, one row per registered version

The latest model is found by listing model folders (newest modification time) or
by the best recorded metric."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.scalar import version_string
from tidewater.operators.prep import Preparation
from tidewater.schemas import REGISTRY
from tidewater.sources.files import list_objects


def register_model(spark: SparkSession, model: PipelineModel, root: str, name: str,
                   metrics: dict, hyperparameters: dict, model_type: str = "RandomForestClassifier",
                   framework: str = "pyspark.ml", dataset: str | None = None,
                   preparation: Preparation | None = None) -> dict:
    """Save the model under a new version and append its metadata row, which also holds the
    fitted preparation of raw rows as JSON.

    Version: ``v_<yyyyMMdd_HHmmss>_acc_<eval accuracy>`` with dots as underscores,
    computed by Spark from the registration time.  Models registered in the same second with
    the same accuracy share a version, so each is saved in a folder of its own."""
    known = REGISTRY["hyperparameters"].dataType.names
    unknown = set(hyperparameters) - set(known)
    if unknown:
        raise ValueError(f"hyperparameters without a registry field: {sorted(unknown)}")
    meta = spark.range(1).select(
        F.current_timestamp().alias("ts"), F.lit(float(metrics["eval_accuracy"])).alias("acc"))
    meta = meta.select(version_string("ts", "acc").alias("model_version"),
                       F.date_format("ts", "yyyyMMdd_HHmmss").alias("timestamp")).first()
    version = meta["model_version"]
    model_uri = f"{root.rstrip('/')}/models/{name}/{version}-{uuid.uuid4().hex[:8]}/model"
    model.write().save(model_uri)
    row = {
        "name": name, "model_version": version, "timestamp": meta["timestamp"],
        "hyperparameters": {k: hyperparameters.get(k) for k in known},
        "metrics": {k: float(metrics[k]) for k in ("train_accuracy", "test_accuracy",
                                                    "eval_accuracy", "eval_f1_score")},
        "model_type": model_type, "framework": framework, "dataset": dataset or name,
        "model_uri": model_uri, "preparation": preparation.to_json() if preparation else None,
    }
    spark.createDataFrame([row], REGISTRY).write.mode("append").parquet(f"{root.rstrip('/')}/registry")
    return row


def registry_table(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(REGISTRY).parquet(f"{root.rstrip('/')}/registry")


def latest_model_uri(spark: SparkSession, root: str, name: str, by: str = "mtime") -> DataFrame:
    """One row ``model_uri, modified`` (``by='mtime'``) or the registry row with the
    best ``eval_accuracy`` (``by='eval_accuracy'``), among the models called ``name``."""
    if by == "mtime":
        files = list_objects(spark, f"{root.rstrip('/')}/models/{name}", "part-*")
        files = files.where(F.col("path").contains("/model/metadata/"))
        models = files.select(F.regexp_extract("path", r"^(.*/model)/metadata/", 1).alias("model_uri"),
                              F.col("modificationTime").alias("modified"))
        return (models.groupBy("model_uri").agg(F.max("modified").alias("modified"))
                      .orderBy(F.desc("modified"), F.desc("model_uri")).limit(1))
    reg = registry_table(spark, root).where(F.col("name") == name)
    return (reg.select("model_uri", F.col(f"metrics.{by}").alias(by))
               .orderBy(F.desc(by), F.desc("model_uri")).limit(1))


def model_folder(uri: str) -> str:
    """The folder that a model has to itself."""
    return uri.rstrip("/").split("/")[-2]


def latest_registered_uri(spark: SparkSession, root: str, name: str, by: str = "mtime") -> str:
    """URI of the latest model that has its registry row, which is written once the model is saved
    whole; for readers that run while models are registered."""
    if by != "mtime":
        rows = latest_model_uri(spark, root, name, by).collect()
    else:
        files = list_objects(spark, f"{root.rstrip('/')}/models/{name}", "part-*").where(F.col("path").contains("/model/metadata/"))
        saved = files.groupBy(F.regexp_extract("path", r"([^/]+)/model/metadata/", 1).alias("folder")) \
            .agg(F.max("modificationTime").alias("modified"))
        reg = registry_table(spark, root).where(F.col("name") == name) \
            .select("model_uri", F.regexp_extract("model_uri", "([^/]+)/model/?$", 1).alias("folder"))
        rows = reg.join(saved, "folder").orderBy(F.desc("modified"), F.desc("model_uri")).limit(1).collect()
    if not rows:
        raise FileNotFoundError(f"no model registered under {root}/models/{name}")
    return rows[0]["model_uri"]


def load_model(spark: SparkSession, root: str, name: str, uri: str) -> tuple[PipelineModel, Preparation | None]:
    """A registered model and the preparation saved with it."""
    saved = registry_table(spark, root).where((F.col("name") == name) & F.col("model_uri").contains(f"/{model_folder(uri)}/")) \
        .select("preparation").first()
    prepared = Preparation.from_json(saved["preparation"]) if saved and saved["preparation"] else None
    return PipelineModel.load(uri.replace("file:", "", 1) if uri.startswith("file:") else uri), prepared


def load_latest(spark: SparkSession, root: str, name: str, by: str = "mtime"
                ) -> tuple[PipelineModel, Preparation | None]:
    """The latest model called ``name`` and the preparation saved with it."""
    rows = latest_model_uri(spark, root, name, by).collect()
    if not rows:
        raise FileNotFoundError(f"no model registered under {root}/models/{name}")
    return load_model(spark, root, name, rows[0]["model_uri"])
