"""Classification metrics from a confusion table.

The confusion table (one row per (label, prediction) pair) is built with a
partially aggregated ``groupBy``; every metric is then derived from that table, so
evaluation is one scan of the predictions however large they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return (df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
              .agg(F.count(F.lit(1)).alias("count")))


def classification_metrics(conf: DataFrame) -> DataFrame:
    """One row: ``n, accuracy, weighted_f1`` (support-weighted F1, zero_division=0).

    Each confusion row is counted for its label and for its prediction; one aggregate by
    class then holds support, predicted and hits, so the predictions are scanned once."""
    n = F.col("count")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(0)
    per = (conf.select(F.explode(F.array(
        F.struct(F.col("label").alias("cls"), n.alias("support"), F.lit(0).cast("long").alias("predicted"), hit.alias("tp")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("long").alias("support"), n.alias("predicted"),
                 F.lit(0).cast("long").alias("tp")))).alias("r"))
        .groupBy("r.cls").agg(F.sum("r.support").alias("support"), F.sum("r.predicted").alias("predicted"),
                              F.sum("r.tp").alias("tp")))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), F.col("support") + F.col("predicted")), F.lit(0.0))
    return per.agg(
        F.sum("support").cast("long").alias("n"),
        F.try_divide(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.try_divide(F.sum(F.col("support") * f1), F.sum("support")).alias("weighted_f1"),
    )


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction") -> dict:
    row = classification_metrics(confusion(df, label, prediction)).first()
    return {"n": row["n"], "accuracy": row["accuracy"], "weighted_f1": row["weighted_f1"]}


def mean_log_loss(pred: DataFrame, label: str = "label", probability: str = "probability",
                  eps: float = 1e-15) -> DataFrame:
    """One row ``log_loss``: mean of ``-log p(true class)`` over a prediction frame
    with an MLlib probability vector and 0-based numeric labels."""
    from pyspark.ml.functions import vector_to_array
    p = F.element_at(vector_to_array(F.col(probability)), F.col(label).cast("int") + 1)
    p = F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))
    return pred.agg(F.avg(-F.log(p)).alias("log_loss"))
