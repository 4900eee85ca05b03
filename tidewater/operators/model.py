"""Model operators on ``pyspark.ml``: random forest, multilayer perceptron,
hyper-parameter search, feature importances, evaluation.

Training is distributed by MLlib (per-node histogram aggregation for the forest,
per-partition gradients for the MLP); the only driver-side objects are the fitted
models and small parameter/importance tables.

MLlib's forest sees a row only as the bins of its features, but keeps and visits each row
by itself, with a count for every tree.  Of a large table whose binned rows repeat, the
forest is therefore trained on the distinct binned rows: a row drawn Poisson(1) times for a
tree, n times over, is drawn Poisson(n) times in all, and this is the weight of the binned
row in that tree."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import TaskContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    MultilayerPerceptronClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.metrics import classification_metrics, confusion
from tidewater.operators.prep import write_table
from tidewater.session import delete_dir

# --- fixed values: default forest and search space of the training job ---
SEARCH_SPACE = {"learning_rate": (0.001, 0.1, 0.001), "hidden": (16, 128, 16)}
MAX_TRIALS = 10
PARALLEL_TRIALS = 2
# --- end fixed values ---

MERGE_FROM = 1_000_000        # rows from which a forest looks for equal binned rows,
MERGE_GAIN = 4                # and rows to each distinct one that make it train on those
MERGED_ROWS_A_TASK = 50_000   # trees are fitted side by side, so a tree takes few tasks


def _with_label(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn("label", F.col(label).cast("double"))


def train_forest(df: DataFrame, features: Sequence[str], label: str = "target",
                 num_trees: int = 100, max_depth: int = 10, min_instances_per_node: int = 2,
                 seed: int = 42, max_bins: int = 32, subsampling_rate: float = 1.0,
                 merge_from: int = MERGE_FROM) -> PipelineModel:
    """Assemble features and fit a random forest (``featureSubsetStrategy='auto'``,
    sqrt of the feature count for classification).  MLlib has no minimum-split-size
    parameter; ``min_instances_per_node`` bounds leaf size instead.  The model comes
    without MLlib's training summary: of two classes it holds the session, which cannot
    go to the tasks that predict once the session has used an ``Observation``.

    From ``merge_from`` rows on, if there are ``MERGE_GAIN`` rows or more to each distinct
    binned row, the trees are fitted on the distinct ones (see :func:`_merged_forest`)."""
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=num_trees,
                                maxDepth=max_depth, minInstancesPerNode=min_instances_per_node,
                                seed=seed, maxBins=max_bins, subsamplingRate=subsampling_rate,
                                featureSubsetStrategy="auto")
    d, features = _with_label(df, label), list(features)
    rows = d.count()
    if rows >= merge_from:
        bins = _binning(d, features, max_bins)
        # MLlib refuses to train on missing or infinite values, so they get no bin here
        binned = bins.transform(d).select(*[F.when(F.abs(F.col(c)) < math.inf, F.col(b)).alias(b)
                                            for c, b in zip(features, bins.getOutputCols())], "label")
        distinct = binned.agg(F.approx_count_distinct(F.struct(*binned.columns))).first()[0]
        if distinct * MERGE_GAIN <= rows:
            return _merged_forest(rf, bins, binned)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features",
                                            handleInvalid="keep"), rf])
    fitted = pipe.fit(d)
    fitted.stages[-1] = fitted.stages[-1].copy()
    return fitted


def _binning(df: DataFrame, features: Sequence[str], max_bins: int) -> Bucketizer:
    """The bins that MLlib's forest would make: one for each value where there are at most
    ``max_bins``, cut half way between them, else about equally full ones (of all rows, by a
    quantile sketch; MLlib takes a sample).  NaN comes after the last bin."""
    values = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in features}
    shares = [i / max_bins for i in range(1, max_bins)]
    seen = df.agg(*[F.approx_count_distinct(v).alias(f"{c}__values") for c, v in values.items()],
                  *[F.percentile_approx(v, shares, 10_000).alias(f"{c}__cuts") for c, v in values.items()]).first()
    few = [c for c in features if seen[f"{c}__values"] <= 2 * max_bins]
    found = df.agg(F.lit(0), *[F.sort_array(F.collect_set(values[c])).alias(c) for c in few]).first()
    cuts = {c: seen[f"{c}__cuts"] or [] for c in features}
    cuts |= {c: [lo + (hi - lo) / 2 for lo, hi in zip(found[c], found[c][1:])] for c in few if len(found[c]) <= max_bins}
    splits = []
    for c in features:
        inner = sorted({x for x in cuts[c] if math.isfinite(x)}) or [0.0]
        splits.append([-math.inf, *inner, math.inf])
    return Bucketizer(splitsArray=splits, inputCols=list(features), outputCols=[f"_bin_{c}" for c in features],
                      handleInvalid="keep")


def _draws(trees: Sequence[str], rate: float, seed: int):
    """Adds to each binned row, for every tree, how often its rows are drawn."""
    def draw(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        rng = np.random.default_rng([seed % 2 ** 63, TaskContext.get().partitionId()])
        for b in batches:
            drawn = rng.poisson(b["_n"].to_numpy()[:, None] * rate, (len(b), len(trees)))
            yield pd.concat([b.drop(columns="_n"), pd.DataFrame(drawn, columns=list(trees), index=b.index)], axis=1)
    return draw


def _merged_forest(rf: RandomForestClassifier, bins: Bucketizer, binned: DataFrame) -> PipelineModel:
    """The forest of ``rf`` from distinct binned rows, weighted for each tree by the draws of
    their rows.  A tree is a fit of its own, since MLlib takes one weight for all trees of a
    fit; the trees then make up one forest model behind the binning.  A node's rows are
    counted by their weights: these are whole numbers, so half a row less than the minimum
    is the same bound and safe from rounding."""
    spark, cols, names = binned.sparkSession, bins.getOutputCols(), [f"_draws_{t}" for t in range(rf.getNumTrees())]
    numbers = random.Random(rf.getSeed())
    groups = binned.groupBy(*cols, "label").agg(F.count(F.lit(1)).alias("_n")).sortWithinPartitions(*cols, "label")
    drawn = groups.mapInPandas(_draws(names, rf.getSubsamplingRate(), rf.getSeed()),
                               ", ".join([*(f"`{c}` double" for c in cols), "label double", *(f"{t} long" for t in names)]))
    assembler = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")
    table, path = write_table(assembler.transform(drawn).select("features", "label", *names))
    try:
        facts = table.agg(F.count(F.lit(1)).alias("n"), F.max("label").alias("top"), *[F.sum(t).alias(t) for t in names]).first()
        classes = int(facts["top"]) + 1
        label = F.col("label").alias("label", metadata={"ml_attr": {"type": "nominal", "name": "label", "num_vals": classes}})
        # MLlib looks for cuts in a sample of maxBins^2 rows: all of them, so that no bin is lost
        size = max(rf.getMaxBins() + 2, math.isqrt(facts["n"]) + 2)
        subset = "all" if len(names) == 1 else "sqrt"
        tasks = -(-facts["n"] // MERGED_ROWS_A_TASK)
        at_once = min(len(names), max(4, min(16, spark.sparkContext.defaultParallelism)))

        def fit(tree: str, seed: int):
            least = (rf.getMinInstancesPerNode() - 0.5) / max(facts[tree], 1)
            one = rf.copy({rf.numTrees: 1, rf.bootstrap: False, rf.subsamplingRate: 1.0, rf.featureSubsetStrategy: subset,
                           rf.maxBins: size, rf.minInstancesPerNode: 1, rf.seed: seed,
                           rf.minWeightFractionPerNode: min(least, 0.499), rf.weightCol: tree})
            return one.fit(table.where(F.col(tree) > 0).select("features", label, tree).coalesce(tasks))._java_obj.trees()[0]

        fits = [inheritable_thread_target(spark)(lambda t=t, s=numbers.getrandbits(62): fit(t, s)) for t in names]
        with ThreadPool(at_once) as pool:
            trees = pool.map(lambda f: f(), fits, chunksize=1)
    finally:
        delete_dir(spark, path)
    of = spark._jvm.org.apache.spark.ml.classification
    held = spark.sparkContext._gateway.new_array(of.DecisionTreeClassificationModel, len(trees))
    for i, tree in enumerate(trees):
        held[i] = tree
    forest = rf._copyValues(RandomForestClassificationModel(of.RandomForestClassificationModel(rf.uid, held, len(cols), classes)))
    forest._transfer_params_to_java()
    return PipelineModel([bins, assembler, forest])


def predict(model: PipelineModel, df: DataFrame, label: str | None = "target") -> DataFrame:
    d = _with_label(df, label) if label and label in df.columns else df
    return model.transform(d)


def evaluate_split(model: PipelineModel, train: DataFrame, test: DataFrame,
                   label: str = "target") -> dict:
    """Train/test/eval accuracy and eval weighted F1 (eval = test set), each from a
    confusion table (one scan of the predictions per split)."""
    tr = classification_metrics(confusion(predict(model, train, label), "label", "prediction")).first()
    te = classification_metrics(confusion(predict(model, test, label), "label", "prediction")).first()
    return {"train_accuracy": tr["accuracy"], "test_accuracy": te["accuracy"],
            "eval_accuracy": te["accuracy"], "eval_f1_score": te["weighted_f1"],
            "train_rows": tr["n"], "test_rows": te["n"]}


def evaluate_flagged(model: PipelineModel, df: DataFrame, flag: str = "is_test",
                     label: str = "target") -> dict:
    """``evaluate_split`` for a table whose rows carry a test flag: one prediction
    pass over both sides, one confusion table keyed by the flag (at most
    2 x classes^2 rows, cached while both sides' metrics are read from it).  A forest of
    binned rows predicts each distinct one once."""
    d = _with_label(df, label).withColumn("_test", F.col(flag))
    if isinstance(model.stages[0], Bucketizer):
        bins = model.stages[0]
        d = bins.transform(d).groupBy(*bins.getOutputCols(), "label", "_test").agg(F.count(F.lit(1)).alias("_n"))
        model = PipelineModel(model.stages[1:])
    else:
        d = d.withColumn("_n", F.lit(1).cast("long"))
    conf = model.transform(d).groupBy("_test", "label", "prediction").agg(F.sum("_n").alias("count")).cache()
    try:
        tr = classification_metrics(conf.where(~F.col("_test")).drop("_test")).first()
        te = classification_metrics(conf.where(F.col("_test")).drop("_test")).first()
    finally:
        conf.unpersist()
    return {"train_accuracy": tr["accuracy"], "test_accuracy": te["accuracy"],
            "eval_accuracy": te["accuracy"], "eval_f1_score": te["weighted_f1"],
            "train_rows": tr["n"], "test_rows": te["n"]}


def feature_importance(spark: SparkSession, model: PipelineModel, names: Sequence[str],
                       top: int = 5) -> DataFrame:
    """Top ``top`` features by forest importance (importances sum to 1)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(list(names), [float(x) for x in imp])),
                               "feature string, importance double")
    return df.orderBy(F.desc("importance"), F.asc("feature")).limit(top)


def vector_frame(df: DataFrame, array_col: str = "embedding", label: str = "label") -> DataFrame:
    return df.select(array_to_vector(F.col(array_col)).alias("features"),
                     F.col(label).cast("double").alias("label"), *[c for c in df.columns
                                                                   if c not in (array_col, label)])


def train_mlp(df: DataFrame, n_features: int, n_classes: int, hidden: int = 128,
              max_iter: int = 100, seed: int = 42, step_size: float = 0.03,
              block_size: int = 128, solver: str = "l-bfgs"):
    """``n_features -> hidden -> n_classes`` perceptron (sigmoid hidden layer, softmax
    output) on a ``features``/``label`` frame (see :func:`vector_frame`)."""
    mlp = MultilayerPerceptronClassifier(layers=[n_features, hidden, n_classes], maxIter=max_iter,
                                         seed=seed, stepSize=step_size, blockSize=block_size,
                                         solver=solver)
    return mlp.fit(df)


def sample_grid(space: dict = SEARCH_SPACE, max_trials: int = MAX_TRIALS, seed: int = 42) -> list[dict]:
    """Up to ``max_trials`` distinct points of the stepped grid, drawn with a seed."""
    axes = {}
    for name, (lo, hi, step) in space.items():
        n = int(round((hi - lo) / step)) + 1
        axes[name] = [round(lo + i * step, 10) for i in range(n)]
    rng = random.Random(seed)
    points, seen = [], set()
    total = 1
    for v in axes.values():
        total *= len(v)
    while len(points) < min(max_trials, total):
        p = tuple(rng.choice(v) for v in axes.values())
        if p not in seen:
            seen.add(p)
            points.append(dict(zip(axes, p)))
    return points


def tune_mlp(spark: SparkSession, df: DataFrame, n_features: int, n_classes: int,
             space: dict = SEARCH_SPACE, max_trials: int = MAX_TRIALS, parallelism: int = PARALLEL_TRIALS,
             max_iter: int = 20, seed: int = 42, train_ratio: float = 0.8):
    """Search learning rate x hidden units, maximizing validation accuracy.  (MLlib's
    perceptron trains on full batches, so a batch size would change nothing.)

    Returns ``(trials DataFrame, best params dict, best model)``; trials run
    ``parallelism`` at a time through ``TrainValidationSplit``."""
    mlp = MultilayerPerceptronClassifier(layers=[n_features, 128, n_classes], maxIter=max_iter,
                                         seed=seed, solver="gd")
    points = sample_grid(space, max_trials, seed)
    maps = []
    for p in points:
        b = ParamGridBuilder().addGrid(mlp.stepSize, [float(p["learning_rate"])]) \
                              .addGrid(mlp.layers, [[n_features, int(p["hidden"]), n_classes]]).build()
        maps.extend(b)
    ev = MulticlassClassificationEvaluator(metricName="accuracy")
    tvs = TrainValidationSplit(estimator=mlp, estimatorParamMaps=maps, evaluator=ev,
                               trainRatio=train_ratio, parallelism=parallelism, seed=seed)
    fitted = tvs.fit(df)
    rows = [(i, float(p["learning_rate"]), int(p["hidden"]), float(m))
            for i, (p, m) in enumerate(zip(points, fitted.validationMetrics))]
    trials = spark.createDataFrame(rows, "trial int, learning_rate double, hidden int, accuracy double")
    best_i = max(range(len(rows)), key=lambda i: rows[i][3])
    return trials, points[best_i], fitted.bestModel
