import math
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators.quality import QualityError, quality_report
from tidewater.operators.serving import multi_facet
from tidewater.sinks import tables
from tidewater.streaming import rollups as R
from tidewater.streaming.gate import Gate, gated_write, reports, set_aside

FACETS = ["kind", "size"]


def make(spark, seed, n=300):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None, "c"]), rng.choice([1, 2, 9, 10, None]),
             rng.choice([None, float("nan"), rng.gauss(0, 5)]) if rng.random() < 0.1 else rng.gauss(3, 2)) for _ in range(n)]
    return spark.createDataFrame(rows, "kind string, size int, v double")


def ranked(df):
    return sorted((r["facet"], r["rank"], r["key"], r["doc_count"], round(r["avg_w"], 6)) for r in df.collect())


def test_facets_after_each_batch_equal_the_batch_facets(spark, tmp):
    roll, seen = R.facet_rollup(tmp, FACETS, "w", compact_every=2), None
    for b in range(5):
        rows = make(spark, b).withColumn("w", F.coalesce(F.nanvl("v", F.lit(0.0)), F.lit(1.0)))
        seen = rows if seen is None else seen.union(rows)
        for again in ([b, 0] if b == 3 else [b]):                       # batch 0 comes again after it was merged
            first = make(spark, again).withColumn("w", F.coalesce(F.nanvl("v", F.lit(0.0)), F.lit(1.0)))
            roll.add(first, again)
        assert ranked(R.read_facets(spark, roll, FACETS, "w", size=3)) == ranked(multi_facet(seen, FACETS, "w", size=3))
    merged = tables._generation(spark, tmp, [g["name"] for g in tables.snapshot(spark, tmp)["generations"]])
    assert merged.groupBy("_batch", "facet", *FACETS).count().where("count > 1").isEmpty()      # reduced, not piled up


def test_batch_without_any_value(spark, tmp):
    roll = R.facet_rollup(tmp, FACETS, "v")
    roll.add(spark.createDataFrame([(None, None, None)] * 3, "kind string, size int, v double"), 0)
    got = R.read_facets(spark, roll, FACETS, "v").collect()
    assert [(r["facet"], r["key"], r["doc_count"], r["avg_v"]) for r in got] == [("_all", None, 3, None)]


def test_merged_sketches_keep_their_rank_error(spark, tmp):
    roll, values = R.quantile_rollup(tmp, ["v"], k=200, compact_every=2), []
    for b in range(6):
        rows = make(spark, 10 + b, 2000)
        values += [r["v"] for r in rows.collect() if r["v"] is not None and not math.isnan(r["v"])]
        roll.add(rows, b)
    values.sort()
    ranks = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    row = roll.read(spark).select("n", *[R.at_rank(q).alias(f"q{i}") for i, q in enumerate(ranks)]).collect()
    assert len(row) == 1 and row[0]["n"] == len(values)
    assert row[0]["q0"] == values[0] and row[0]["q6"] == values[-1]
    for i, q in enumerate(ranks):
        assert abs(sum(v <= row[0][f"q{i}"] for v in values) / len(values) - q) <= R.rank_error(200) + 1 / len(values)


def test_sketches_by_group_and_column_without_values(spark, tmp):
    rows = spark.createDataFrame([("a", 1.0, None), ("b", 5.0, None), ("b", 7.0, None)], "g string, x double, y double")
    roll = R.quantile_rollup(tmp, ["x", "y"], by=["g"])
    roll.add(rows, 0)
    got = roll.read(spark).select("g", "column", "n", R.at_rank(1).alias("top")).collect()
    assert sorted(tuple(r) for r in got) == [("a", "x", 1, 1.0), ("b", "x", 2, 7.0)]


GATE = Gate("size", [0, 1], ["kind", "v"], min_records=4, min_features=2, min_class=2)


def rows_of(spark, sizes, missing=False):
    return spark.createDataFrame([("a", s, None if missing and i == 0 else 1.0) for i, s in enumerate(sizes)], "kind string, size int, v double")


def test_gate_passes_or_sets_aside_and_reports(spark, tmp):
    batches = [rows_of(spark, [0, 0, 1, 1]), rows_of(spark, [0, 0, 1, 1], missing=True), rows_of(spark, [0, 0, 0, 1]),
               rows_of(spark, [0]), rows_of(spark, [0, 0, 7, 7]), rows_of(spark, [0, 0, None, 1, 1]), rows_of(spark, [1, 1, 1, 1]), rows_of(spark, [])]
    for b, rows in enumerate(batches):
        gated_write(rows, tmp, b, GATE, ["kind"])
    gated_write(batches[0], tmp, 0, GATE, ["kind"])                     # replayed
    got = {r["batch_id"]: r for r in reports(spark, tmp).collect()}
    assert [got[b]["is_valid"] for b in range(8)] == [True, False, False, False, False, False, True, False]
    for b, rows in enumerate(batches):
        want = quality_report(rows, "size", 4, 2, 2).first().asDict()
        if b == 4:                                                      # a class that was not named
            assert got[b]["other_class_count"] == 2
            want["balanced_target"], want["is_valid"] = False, False
        assert {k: got[b][k] for k in want} == want
    assert tables.read_table(spark, tmp).count() == 8
    assert set_aside(spark, tmp).count() == 4 + 4 + 1 + 4 + 5
    assert not tables._names(spark, f"{tmp}/staged")


def test_gate_that_raises_leaves_nothing_in_the_table(spark, tmp):
    gate = Gate("size", [0, 1], ["kind", "v"], min_records=4, min_features=2, min_class=2, on_fail="raise")
    gated_write(rows_of(spark, [0, 0, 1, 1]), tmp, 0, gate)
    with pytest.raises(QualityError):
        gated_write(rows_of(spark, [0, 1]), tmp, 1, gate)
    assert tables.read_table(spark, tmp).count() == 4
    gated_write(rows_of(spark, [0, 1, 0, 1]), tmp, 1, gate)             # the batch comes again, mended
    assert tables.read_table(spark, tmp).count() == 8
