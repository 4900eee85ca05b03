"""Row numbers without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import work_dir


def numbered(df: DataFrame, by: Sequence[Column | str], out: str = "pos", within: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``out``: 0, 1, ... in the order ``by``, or inside each group of ``within``.

    Rows are range-partitioned by (within, by) and written out with their place in their
    partition; what comes before a partition is added from one small row per (partition, group).
    A group of any size is spread over as many partitions as it fills.  Rows that are equal in
    all of ``within`` and ``by`` share a partition: give ``by`` a column that tells them apart."""
    spark = df.sparkSession
    order = [F.col(c) if isinstance(c, str) else c for c in (*within, *by)]
    parts = (df.repartitionByRange(*order).sortWithinPartitions(*order)
             .withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    path = work_dir(spark, "numbered")
    parts.write.parquet(path)
    parts = spark.read.schema(parts.schema).parquet(path)
    w = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy("_part", *within).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    shift = counts.select(F.col("_part").alias("_p"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(within)],
                          (F.col("_first") - F.coalesce(F.sum("_n").over(w), F.lit(0))).alias("_shift"))
    on = parts["_part"] == shift["_p"]
    for i, c in enumerate(within):
        on = on & parts[c].eqNullSafe(shift[f"_g{i}"])
    return parts.join(shift, on).withColumn(out, F.col("_row") - F.col("_shift")).select(*df.columns, out)
