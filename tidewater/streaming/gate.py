"""Quality gate inside a stream, judged from metrics that the write itself collects.

``gated_write`` writes a batch to ``staged/``; the tasks that write it also count rows, missing cells and
the rows of each class (``observe``), so there is no second pass.  A batch that passes is moved to
``batches/`` and is part of the table from then on.  One that fails goes to ``set_aside/`` or, with
``on_fail="raise"``, stays in ``staged/`` and fails the query; a restart writes it anew.  Every
judged batch leaves one row under ``quality/``, the same as
:func:`tidewater.operators.quality.quality_report` gives for its rows.

Classes are named beforehand (observed metrics can't group); a row of any other class, which is
counted too, fails the balance check.  Rows without a class are counted as missing cells only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.prep import missing
from tidewater.operators.quality import QualityError
from tidewater.sinks.tables import move_batch, write_batch

REPORT = ("batch_id long, total_records long, total_features int, missing_cells long, min_class_count long, other_class_count long, "
          "min_records boolean, min_features boolean, no_missing boolean, balanced_target boolean, is_valid boolean")


@dataclass(frozen=True)
class Gate:
    label: str
    classes: Sequence
    features: Sequence[str]                 # columns checked for missing cells, with the label
    min_records: int = 100
    min_features: int = 10
    min_class: int = 30
    on_fail: str = "set_aside"              # or "raise"

    def metrics(self, rows: DataFrame) -> list[Column]:
        cells = [missing(rows, c).cast("long") for c in dict.fromkeys([*self.features, self.label])]
        label = F.col(self.label)
        known = [F.coalesce(label == F.lit(c), F.lit(False)) for c in self.classes]
        other = ~missing(rows, self.label)
        for k in known:
            other = other & ~k
        return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(sum(cells[1:], cells[0])), F.lit(0)).alias("missing"),
                F.count_if(other).alias("other"), *[F.count_if(k).alias(f"class_{i}") for i, k in enumerate(known)]]

    def judge(self, seen: dict, batch_id: int) -> dict:
        sizes = [n for n in [*(seen[f"class_{i}"] for i in range(len(self.classes))), seen["other"]] if n]
        smallest = min(sizes, default=None)
        features = len([f for f in self.features if f != self.label])
        checks = {"min_records": seen["rows"] >= self.min_records, "min_features": features >= self.min_features,
                  "no_missing": seen["missing"] == 0,
                  "balanced_target": smallest is not None and smallest >= self.min_class and not seen["other"]}
        return {"batch_id": batch_id, "total_records": seen["rows"], "total_features": features, "missing_cells": seen["missing"],
                "min_class_count": smallest, "other_class_count": seen["other"], **checks, "is_valid": all(checks.values())}


def gated_write(rows: DataFrame, path: str, batch_id: int, gate: Gate, partition_cols: Sequence[str] = ()) -> dict:
    """Writes the batch to the table at ``path`` if it passes; the report as a dict."""
    spark = rows.sparkSession
    seen = Observation(f"gate-{batch_id}")
    write_batch(rows, path, batch_id, partition_cols, folder="staged", observed=(seen, gate.metrics(rows)))
    report = gate.judge(seen.get, batch_id)
    spark.createDataFrame([tuple(report.values())], REPORT).drop("batch_id").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/quality/batch_id={batch_id}")
    if not report["is_valid"] and gate.on_fail == "raise":
        raise QualityError(f"batch {batch_id} fails the gate: {report}")
    move_batch(spark, path, batch_id, "staged", "batches" if report["is_valid"] else "set_aside")
    return report


def reports(spark: SparkSession, path: str) -> DataFrame:
    """One row per judged batch."""
    return spark.read.schema(REPORT).parquet(f"{path}/quality")


def set_aside(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(f"{path}/set_aside")
