import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidewater.operators import model as M
from tidewater.operators import prep, split
from tidewater.plans.jobs import TrainSpec, run_training
from tidewater.operators.score import score


def test_forest_of_two_classes_predicts_after_an_observation(spark, tmp):
    seen = Observation("rows")
    spark.range(10).observe(seen, F.count("*").alias("n")).write.parquet(f"{tmp}/observed")
    assert seen.get == {"n": 10}
    df = spark.range(300).select((F.col("id") % 2).alias("target"), (F.col("id") % 2 + 0.25).alias("a"),
                                 (F.col("id") % 7).cast("double").alias("b"), (F.col("id") % 5 == 0).alias("is_test"))
    model = M.train_forest(df.where(~F.col("is_test")), ["a", "b"], num_trees=5, max_depth=3)
    got = M.evaluate_flagged(model, df)
    assert got == M.evaluate_split(model, df.where(~F.col("is_test")), df.where("is_test"))
    assert (got["train_rows"], got["test_rows"], got["eval_accuracy"]) == (240, 60, 1.0)
    assert score(df, model, ["target"]).where("prediction = target").count() == 300
    assert M.feature_importance(spark, model, ["a", "b"]).first().feature == "a"


def test_large_forest_is_trained_on_distinct_binned_rows(spark, tmp, monkeypatch):
    df = spark.range(4000).select((F.col("id") % 9).cast("double").alias("a"), (F.col("id") % 101).cast("double").alias("b"),
                                  (F.col("id") % 13 != 0).cast("int").alias("c"), (F.col("id") % 7 == 0).alias("is_test"))
    df = df.withColumn("target", ((F.col("a") > 3) & (F.col("b") < 60)).cast("int"))
    read = []
    merged = M._merged_forest

    def watched(rf, bins, binned):
        read.append(binned.distinct().count())
        return merged(rf, bins, binned)
    monkeypatch.setattr(M, "_merged_forest", watched)
    train, test = df.where("not is_test"), df.where("is_test")
    cols = ["a", "b", "c"]
    model = M.train_forest(train, cols, num_trees=12, max_depth=6, merge_from=1000)
    assert len(read) == 1 and read[0] < 1000
    assert [type(s) for s in model.stages][:1] == [Bucketizer] and model.stages[-1].getNumTrees == 12
    plain = M.train_forest(train, cols, num_trees=12, max_depth=6)
    assert len(read) == 1 and len(plain.stages) == 2
    got, old = M.evaluate_flagged(model, df), M.evaluate_flagged(plain, df)
    assert got == M.evaluate_split(model, train, test) and old == M.evaluate_split(plain, train, test)
    assert got["train_rows"] == old["train_rows"] == train.count()
    assert got["eval_accuracy"] > 0.97 and abs(got["eval_accuracy"] - old["eval_accuracy"]) < 0.03
    gap = np.abs(model.stages[-1].featureImportances.toArray() - plain.stages[-1].featureImportances.toArray())
    assert gap.max() < 0.2
    model.write().save(f"{tmp}/model")
    for bad in (None, float("nan"), float("inf")):
        broken = train.withColumn("b", F.when(F.col("b") != 5, F.col("b")).otherwise(F.lit(bad).cast("double")))
        for merge_from in (1000, 10 ** 9):
            with pytest.raises(Exception, match="MUST NOT be NaN or Infinity"):
                M.train_forest(broken, cols, num_trees=2, max_depth=2, merge_from=merge_from)
    scored = [score(df, m, ["a", "b"]).distinct().orderBy("a", "b", "probability_1").collect() for m in (model, PipelineModel.load(f"{tmp}/model"))]
    assert scored[0] == scored[1] and len(scored[0]) >= 909


def test_leaves_of_a_merged_forest_hold_the_least_number_of_drawn_rows(spark):
    rows = [(float(i % 10), int(i % 10 == 0)) for i in range(200)] + [(10.0, 1)]
    df = spark.createDataFrame(rows, "a double, target int")
    for least in (2, 30):
        trees = M.train_forest(df, ["a"], num_trees=20, max_depth=4, min_instances_per_node=least, merge_from=0).stages[-1].trees
        leaves = [n for t in trees for n in _leaves(t._java_obj.rootNode())]
        assert min(leaves) >= least and max(leaves) > 30
        assert least == 30 or min(leaves) < 30
    assert 150 < np.mean([sum(_leaves(t._java_obj.rootNode())) for t in trees]) < 250        # 201 rows, drawn as often


def _leaves(node):
    if node.getClass().getSimpleName() == "LeafNode":
        return [sum(node.impurityStats().stats())]
    return _leaves(node.leftChild()) + _leaves(node.rightChild())


def test_binned_rows_are_drawn_as_often_as_their_rows(spark):
    df = spark.range(4).select(F.col("id").cast("double").alias("_bin_a"), F.lit(0.0).alias("label"), F.pow(10, "id").cast("long").alias("_n"))
    names = [f"_draws_{t}" for t in range(200)]
    got = {r["_bin_a"]: np.array(r[2:], float) for r in df.mapInPandas(M._draws(names, 0.5, 7), "`_bin_a` double, label double, " + ", ".join(f"{n} long" for n in names)).collect()}
    for i in range(4):
        mean = 0.5 * 10 ** i
        assert abs(got[i].mean() - mean) < 5 * (mean / 200) ** 0.5 and 0.6 * mean < got[i].var() < 1.6 * mean


def test_bins_are_the_values_or_equally_full(spark):
    df = spark.range(1000).select((F.col("id") % 3).cast("double").alias("few"), F.col("id").cast("int").alias("many"),
                                  F.when(F.col("id") % 2 == 0, float("nan")).alias("none"), F.when(F.col("id") < 5, float("inf")).otherwise(-1.0).alias("ends"))
    bins = M._binning(df, ["few", "many", "none", "ends"], 8)
    few, many, none, ends = (s[1:-1] for s in bins.getSplitsArray())
    assert few == [0.5, 1.5] and len(many) == 7 and len(none) == len(ends) == 1
    n = bins.transform(df).groupBy("_bin_many").count().collect()
    assert len(n) == 8 and all(115 <= r["count"] <= 135 for r in n)
    assert {r[0] for r in bins.transform(df).select("_bin_none").distinct().collect()} == {None, 2.0}


def test_training_keeps_one_table_without_keys(spark, monkeypatch):
    written = []
    of = prep.work_dir
    monkeypatch.setattr(prep, "work_dir", lambda *a: written.append(of(*a)) or written[-1])
    raw = spark.range(600).select((F.col("id") * 7 % 50).cast("double").alias("a"), (F.col("id") % 600 * 1.5).alias("b"), F.col("id").cast("double").alias("c"),
                                  (F.col("id") % 3 == 0).cast("int").alias("target"))
    spec = TrainSpec(features=("a", "b", "c"), clip_cols=("b",), product=("a", "b"), ratio=("b", "c"), derived=("p", "q"), num_trees=3, max_depth=3, min_features=5)
    got = run_training(spark, raw, spec)
    fs = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration())
    left = [p for p in written if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p))]
    assert len(written) == 3 and len(left) == 1
    assert got["table"].columns == ["a", "b", "c", "p", "q", "target", "is_test"]
    sizes = {r["target"]: r["n"] for r in got["table"].where("is_test").groupBy("target").agg(F.count("*").alias("n")).collect()}
    assert sizes == {0: 80, 1: 40} and got["metrics"]["train_rows"] == 480
    assert "row_key" in split.unique_key(raw).columns
