"""Job entry points: ingest (J1), training (J2), serving report (J3), producer (J4),
scoring (J5).  Plain function chains over the operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import model as M
from tidewater.operators import prep, quality, split
from tidewater.operators.registry import load_latest, register_model
from tidewater.operators.score import score
from tidewater.operators.serving import serving_report  # noqa: F401  (J3)
from tidewater.schemas import CLIP_COLUMNS, FEATURES, LABEL
from tidewater.streaming.ingest import run_ingest  # noqa: F401  (J1)


@dataclass
class TrainSpec:
    features: Sequence[str] = tuple(FEATURES[:-1])
    label: str = LABEL
    clip_cols: Sequence[str] = tuple(CLIP_COLUMNS)
    k: float = 3.0
    product: tuple[str, str] = ("age", "thalach")
    ratio: tuple[str, str] = ("chol", "thalach")
    derived: tuple[str, str] = ("age_x_thalach", "bmi_proxy")
    test_frac: float = 0.2
    seed: int = 42
    num_trees: int = 100
    max_depth: int = 10
    min_instances_per_node: int = 2
    min_records: int = 100
    min_features: int = 10
    min_class: int = 30


def run_training(spark: SparkSession, raw: DataFrame, spec: TrainSpec = TrainSpec(),
                 model_root: str | None = None, name: str = "model") -> dict:
    """curate -> exact stratified split -> scale by the training side -> quality gate ->
    forest -> evaluate -> register.

    Returns a dict with the model, its preparation, metrics, importances (DataFrame) and,
    when ``model_root`` is given, the registry row."""
    with prep.steps(spark) as keep:
        ks, prepared = prep.curate(
            raw, features=spec.features, label=spec.label, clip_cols=spec.clip_cols, k=spec.k, product=spec.product,
            ratio=spec.ratio, derived=spec.derived, return_preparation=True,
            fit_on=lambda t: split.split_exact(split.unique_key(t), spec.label, "row_key", spec.test_frac, spec.seed,
                                               keep_key=False))
        ks = keep(ks)
    feat_cols = prepared.feature_columns
    quality.quality_gate(ks.select(*feat_cols, spec.label), label=spec.label, min_records=spec.min_records,
                         min_features=spec.min_features, min_class=spec.min_class)
    mdl = M.train_forest(ks.where(~F.col("is_test")), feat_cols, spec.label, spec.num_trees, spec.max_depth,
                         spec.min_instances_per_node, spec.seed)
    metrics = M.evaluate_flagged(mdl, ks, "is_test", spec.label)
    out = {"model": mdl, "metrics": metrics, "preparation": prepared, "table": ks,
           "importance": M.feature_importance(spark, mdl, feat_cols, 5)}
    if model_root:
        out["registry"] = register_model(
            spark, mdl, model_root, name, metrics,
            {"n_estimators": spec.num_trees, "max_depth": spec.max_depth,
             "min_instances_per_node": spec.min_instances_per_node, "seed": spec.seed,
             "test_frac": spec.test_frac}, preparation=prepared)
    return out


def run_scoring(spark: SparkSession, raw: DataFrame, model_root: str, name: str,
                by: str = "mtime", keep: Sequence[str] = ()) -> DataFrame:
    """Prepare raw rows (batch or streaming) as the training rows were, and score them with
    the latest registered model."""
    model, prepared = load_latest(spark, model_root, name, by)
    return score(prepared.apply(raw) if prepared else raw, model, keep)


def await_or_stop(query, timeout: float | None = None) -> None:
    """Block on a streaming query; stop it cleanly on interrupt or timeout and re-raise
    a query failure (the checkpoint is then not advanced past the failed batch)."""
    try:
        finished = query.awaitTermination(timeout) if timeout else query.awaitTermination()
        if timeout and not finished:
            query.stop()
    except KeyboardInterrupt:
        query.stop()
