"""Batch and streaming scoring with a fitted pipeline (stateless transform, so the
same call works on a streaming DataFrame)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def score(df: DataFrame, model: PipelineModel, keep: Sequence[str] = ()) -> DataFrame:
    """Append ``prediction`` and the positive-class probability (binary models)."""
    out = model.transform(df)
    cols = list(keep) + ["prediction"]
    if "probability" in out.columns:
        from pyspark.ml.functions import vector_to_array
        out = out.withColumn("probability_1", F.element_at(vector_to_array("probability"), -1))
        cols.append("probability_1")
    return out.select(*cols)
