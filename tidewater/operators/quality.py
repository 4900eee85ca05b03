"""Data-quality gate: record/feature counts, missing cells, class balance.

One scan: ``groupBy(label)`` with per-column missing counts, then a global
aggregate over the (one row per class) result, so the gate is a single shuffle of
a few rows regardless of input size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.prep import missing
from tidewater.schemas import LABEL


class QualityError(Exception):
    """Raised by :func:`quality_gate` when a check fails; carries the JSON report."""


def quality_report(df: DataFrame, label: str = LABEL, min_records: int = 100,
                   min_features: int = 10, min_class: int = 30,
                   feature_cols: Sequence[str] | None = None) -> DataFrame:
    """One-row report: ``total_records, total_features, missing_cells,
    min_class_count`` and the checks ``min_records, min_features, no_missing,
    balanced_target, is_valid``.

    ``balanced_target``: the smallest non-missing class has at least ``min_class``
    rows (a single class passes; an empty table fails)."""
    cols = list(df.columns)
    n_features = len(feature_cols) if feature_cols is not None else len(cols) - 1
    miss = None
    for c in cols:
        m = F.sum(missing(df, c).cast("long"))
        miss = m if miss is None else miss + m
    per_class = df.groupBy(F.col(label).alias("_cls")).agg(
        F.count(F.lit(1)).alias("_n"), miss.alias("_miss"))
    rep = per_class.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_records"),
        F.lit(n_features).cast("int").alias("total_features"),
        F.coalesce(F.sum("_miss"), F.lit(0)).cast("long").alias("missing_cells"),
        F.min(F.when(F.col("_cls").isNotNull() & ~F.isnan(F.col("_cls").cast("double")),
                     F.col("_n"))).alias("min_class_count"),
    )
    rep = rep.select(
        "*",
        (F.col("total_records") >= min_records).alias("min_records"),
        (F.col("total_features") >= min_features).alias("min_features"),
        (F.col("missing_cells") == 0).alias("no_missing"),
        F.coalesce(F.col("min_class_count") >= min_class, F.lit(False)).alias("balanced_target"),
    )
    return rep.withColumn("is_valid", F.col("min_records") & F.col("min_features")
                          & F.col("no_missing") & F.col("balanced_target"))


def report_json(report: DataFrame) -> DataFrame:
    """The report as one JSON document per row (nested ``checks``)."""
    return report.select(F.to_json(F.struct(
        "total_records", "total_features",
        F.struct("min_records", "min_features", "no_missing", "balanced_target").alias("checks"),
        "is_valid")).alias("report"))


def quality_gate(df: DataFrame, raise_on_fail: bool = True, **kw) -> dict:
    """Evaluate the report (one small job) and raise :class:`QualityError` if invalid."""
    rep = quality_report(df, **kw)
    row = rep.first().asDict()
    if raise_on_fail and not row["is_valid"]:
        raise QualityError(report_json(rep).first()["report"])
    return row
