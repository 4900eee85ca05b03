"""Mixing sources to target weights along a time-varying curriculum (operator 7).

Each source has a weight schedule over training time 0..1, piecewise linear.  Its integral
is the source's overall weight; weights share the budget of words, a source's target stops
at ``MAX_REPEATS`` times its size and the excess is shared again by weight.  A source's
cumulative word demand at time t is its target times the integral so far over the whole
integral.  Its documents, in a seeded hash order and once more for each repeat, are laid
along that demand; inverting it at the middle of a document gives the document's training
position.  Copies are sorted by position (range partitioning).

DataFrame and SQL functions only.  A source of any size is spread over many tasks: the
running size inside a source comes from range partitions, not from one window per source.

Defined results: a null text has size 0; a null source is a source of its own, last in
order; documents of size 0 are never taken; repeated rows are laid out one by one; ties in
the hash order fall by id and size; an empty table gives no rows; other columns stay with
their row.  If all sizes are 0 all targets are 0.  Texts of any length count whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._frames import WORDS, ordered, read, stage, unused

MAX_REPEATS = 3
#: Knots (time, weight) of the schedules; sources take them in turn.  The integrals are 5, 2, 1:
#: the first kind leads early and fades, the second is steady, the third comes in late.
SCHEDULES = (((0.0, 8.0), (1.0, 2.0)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 0.0), (0.5, 1.0), (1.0, 2.0)))
SEED = 17


def integral(knots) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))


def time_of(share: Column, knots) -> Column:
    """The time at which a schedule has spent ``share`` (0 to 1) of its integral."""
    need = share * integral(knots)
    out, spent = F.lit(knots[-1][0]), integral(knots)
    for (t0, w0), (t1, w1) in reversed(list(zip(knots, knots[1:]))):
        end, spent = spent, spent - (t1 - t0) * (w0 + w1) / 2
        rest = F.greatest(need - spent, F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0)))
        inside = F.when(rest <= 0, F.lit(t0)).otherwise(F.lit(t0) + 2 * rest / (F.lit(w0) + root))
        out = F.when(need <= end, inside).otherwise(out)
    return out


def targets(sources: DataFrame, schedules=SCHEDULES, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """sources: (source, source_size).  Adds kind (schedule), target, start (words of earlier
    sources).  A level L with sum(min(weight * L, cap)) = budget is found by rounds of one
    aggregate each: sources above their cap leave with it, the rest share what remains."""
    table = ordered(sources, [F.asc_nulls_last("source")], "source_size", "mix-sources") \
        .withColumn("kind", ((F.col("pos") - 1) % len(schedules)).cast("int"))
    weight = reduce(lambda c, k: F.when(F.col("kind") == k, F.lit(integral(schedules[k]))).otherwise(c),
                    range(len(schedules)), F.lit(0.0))
    table = stage(table.select("source", "source_size", "kind", F.col("before").alias("start"), weight.alias("weight"),
                               (F.col("source_size") * max_repeats).cast("double").alias("cap")), "mix-weights")
    budget = float(table.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        got = table.agg(F.sum(F.when(F.col("cap") <= F.col("weight") * level, F.col("cap")).otherwise(0.0)),
                        F.sum(F.when(F.col("cap") > F.col("weight") * level, F.col("weight")))).first()
        if not got[1]:
            break
        now = (budget - got[0]) / got[1]
        if now <= level:
            break
        level = now
    return table.withColumn("target", F.least("cap", F.col("weight") * level))


def plan(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
         schedules=SCHEDULES, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per row of ``docs``: row (a number), id, key (hash of id and text), size,
    source_size, target, positions (array of training times, one per copy taken)."""
    sizes = stage(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("key")), "mix-sizes")
    table = stage(targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), schedules, max_repeats), "mix-targets")
    laid = ordered(sizes.withColumn("draw", F.xxhash64(F.lit(SEED), "key")),
                   [F.asc_nulls_last("source"), F.asc("draw"), F.asc("id"), F.asc("size")], "size", "mix-laid")
    table = table.withColumnRenamed("source", "its")
    rows = laid.join(table, F.col("source").eqNullSafe(F.col("its")))
    copies = F.transform(F.sequence(F.lit(0), F.lit(max_repeats - 1)),
                         lambda e: e * F.col("source_size") + F.col("before") - F.col("start") + F.col("size") / 2)
    copies = F.filter(copies, lambda c: (c < F.col("target")) & (F.col("size") > 0))
    times = F.transform(copies, lambda c: reduce(
        lambda out, k: F.when(F.col("kind") == k, time_of(c / F.col("target"), schedules[k])).otherwise(out),
        range(len(schedules)), F.lit(0.0)))
    return rows.select(F.col("pos").alias("row"), "id", "key", "size", "source_size", "target", times.alias("positions"))


def schedule(planned: DataFrame) -> DataFrame:
    """All copies in training order: row, id, size, position, pos (1, 2, ...), before (words)."""
    copies = planned.select("row", "id", "size", F.explode("positions").alias("position"))
    return ordered(copies, [F.asc("position"), F.asc("row")], "size", "mix-order")


def op7_mix_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = stage(plan(read(spark, sf_dir, "documents")), "mix-plan")
    first = schedule(planned).groupBy("row").agg(
        F.count("*").alias("copies"), F.min("position").alias("first_position"), F.min("before").alias("first_word"))
    return planned.join(first, "row", "left").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.coalesce("copies", F.lit(0))).cast("long").alias("taken"), "first_position", "first_word")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        schedules=SCHEDULES, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``docs``, each row as often as the mix takes it, sorted by training position; all columns."""
    names = docs.columns
    key, n, at, position = (unused(names, x) for x in ("key", "n", "at", "position"))
    same = Window.partitionBy(key).orderBy(key)  # equal rows only; any of them is as good
    planned = plan(docs, id_col, source_col, text_col, schedules, max_repeats) \
        .select(F.col("key").alias(key), F.col("positions").alias(at))
    planned = planned.withColumn(n, F.row_number().over(same))
    rows = docs.withColumn(key, F.xxhash64(F.col(id_col), F.col(text_col))).withColumn(n, F.row_number().over(same))
    out = rows.join(planned, [key, n]).withColumn(position, F.explode(at))
    return out.repartitionByRange(position, key).sortWithinPartitions(position, key).select(*names)
