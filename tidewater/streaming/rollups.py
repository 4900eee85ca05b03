"""Aggregates kept up to date by a stream: facets with an average, and quantile sketches.

Each micro-batch leaves its partial aggregates in a table of :mod:`tidewater.sinks.tables`, so a replayed
batch replaces what it left and adds nothing, also after it was merged.  Reading merges the partials;
compaction replaces many batches' partials by their merged rows.  The cost of a batch follows the
batch, and neither old rows nor old batches are read again.

A facet's partials are counts and sums, one row per value.  A quantile's are KLL sketches of fixed
size: ranks are off by ``rank_error(k)`` at most (99 % confidence), whatever the number of rows and
of merges; smallest and greatest values are exact."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.operators.prep import missing
from tidewater.sinks import tables

TOTAL = "_all"                # facet name of the row over all rows
SKETCH_K = 400                # size of a sketch: about 0.7 % of rank


@dataclass(frozen=True)
class Rollup:
    """``partial`` makes the rows a batch leaves, ``merge`` reduces such rows (of merged ones too);
    batches are merged after every ``compact_every`` of them (0: by a job that calls ``compact``)."""
    path: str
    partial: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    compact_every: int = 0

    def add(self, batch: DataFrame, batch_id: int) -> None:
        tables.write_batch(self.partial(batch), self.path, batch_id)
        if self.compact_every and batch_id % self.compact_every == self.compact_every - 1:
            self.compact(batch.sparkSession)

    def compact(self, spark: SparkSession) -> bool:
        return tables.compact(spark, self.path, reduce=self.merge)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.merge(tables.read_table(spark, self.path))


# ------------------------------------------------------------------ facets

def facet_rollup(path: str, facets: Sequence[str], metric: str | None = None, compact_every: int = 0) -> Rollup:
    """Rows ``facet, <typed value of each facet>, doc_count[, metric_sum, metric_count]``: one per value of a
    facet, and one (facet ``_all``) for the total."""
    facets = list(facets)
    top = (1 << len(facets)) - 1

    def partial(rows: DataFrame) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias("doc_count")]
        if metric:
            aggs += [F.sum(F.col(metric).cast("double")).alias("metric_sum"), F.count(metric).alias("metric_count")]
        g = rows.groupingSets([[f] for f in facets] + [[]], *facets).agg(*aggs, F.grouping_id().alias("_gid"))
        name = F.lit(TOTAL)
        for i, f in enumerate(facets):                      # one facet's bit is off where it alone is grouped
            name = F.when(F.col("_gid") == top ^ (1 << (len(facets) - 1 - i)), F.lit(f)).otherwise(name)
        has_value = F.coalesce(*[F.col(f).cast("string") for f in facets]).isNotNull()
        return g.withColumn("facet", name).where((F.col("facet") == TOTAL) | has_value).drop("_gid")

    def merge(rows: DataFrame) -> DataFrame:
        sums = [F.sum(c).alias(c) for c in ("doc_count", "metric_sum", "metric_count") if c in rows.columns]
        return rows.groupBy("facet", *facets).agg(*sums)

    return Rollup(path, partial, merge, compact_every)


def read_facets(spark: SparkSession, rollup: Rollup, facets: Sequence[str], metric: str | None = None, size: int = 10) -> DataFrame:
    """The rows of :func:`tidewater.operators.serving.multi_facet` over all batches so far."""
    merged = rollup.read(spark)
    order = [F.desc("doc_count"), *[F.asc_nulls_first(f) for f in facets]]
    merged = merged.withColumn("rank", F.row_number().over(Window.partitionBy("facet").orderBy(*order))).where(F.col("rank") <= size)
    average = [F.try_divide("metric_sum", "metric_count").alias(f"avg_{metric}")] if metric else []
    return merged.select("facet", F.coalesce(*[F.col(f).cast("string") for f in facets]).alias("key"), "doc_count", *average, "rank")


# ------------------------------------------------------------------ quantiles

def rank_error(k: int = SKETCH_K) -> float:
    """Published error of a KLL sketch's single-sided rank at 99 % confidence."""
    return 2.296 / k ** 0.9723


def quantile_rollup(path: str, cols: Sequence[str], by: Sequence[str] = (), k: int = SKETCH_K, compact_every: int = 0) -> Rollup:
    """Rows ``<by>, column, n, sketch``; missing cells (NULL, NaN) are in no sketch."""
    by = list(by)

    def partial(rows: DataFrame) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.when(~missing(rows, c), F.col(c).cast("double")).alias("v")) for c in cols])
        long = rows.select(*by, F.inline(cells)).where(F.col("v").isNotNull())
        return long.groupBy(*by, "column").agg(F.count("v").alias("n"), F.kll_sketch_agg_double("v", F.lit(k)).alias("sketch"))

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*by, "column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))

    return Rollup(path, partial, merge, compact_every)


def at_rank(rank: float) -> Column:
    """The value at a rank (0: the smallest, 1: the greatest) of the rows of :func:`quantile_rollup`."""
    return F.kll_sketch_get_quantile_double("sketch", F.lit(float(rank)))
