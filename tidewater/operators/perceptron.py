"""Mini-batch perceptron with epochs: ReLU, log-softmax, Adam; data-parallel on Spark.

Rows are dealt to batches of exactly ``batch_size`` once, in a random order (a hash of the row's
key and the seed).  An epoch visits the batches in an order drawn anew.

A step needs the parameters of the one before it.  So batches that are small beside a run (``RUN_CELLS``
values, a bounded part of the table) are laid out in the order of the epoch, one folder per run, and
a task takes the steps of one run; the driver passes the model on to the task of the next.  Spark
shuffles the rows of each epoch, no task holds more than a run, and a job is worth many steps.

A batch larger than a run is a folder and a job of its own: every task sums the loss and the gradients
of its rows, and the driver adds one row per task and takes the Adam step.  Above ``DIRECT_TASKS``
tasks the sums are first added by a second stage.  What crosses the network is the model's size
times the tasks, never rows.

Parameters and both Adam moments are written after every epoch where ``state_path`` is given; a
run that finds such a table goes on after its last epoch with the same result.

Rows without a label, or with a null in the features, are left out of training."""

from __future__ import annotations

import random
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.model import MAX_TRIALS, PARALLEL_TRIALS, sample_grid
from tidewater.operators.numbering import numbered
from tidewater.operators.prep import materialize
from tidewater.session import work_dir

# --- fixed values: network, epochs and search space of the training job; Adam's usual constants ---
HIDDEN, EPOCHS = 128, 3
SEARCH_SPACE = {"learning_rate": (0.001, 0.1, 0.001), "batch_size": (16, 128, 16)}
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8
# --- end fixed values ---

DIRECT_TASKS = 64             # tasks of a step whose sums the driver adds itself
RUN_CELLS = 8 << 20           # feature values of the batches that one task steps through

HISTORY = "epoch int, steps int, rows long, mean_loss double, accuracy double"


@dataclass
class Model:
    """Weights and biases of both layers, with Adam's moments and step count."""

    params: list[np.ndarray]
    first: list[np.ndarray] = field(default_factory=list)
    second: list[np.ndarray] = field(default_factory=list)
    steps: int = 0

    def __post_init__(self) -> None:
        self.first = self.first or [np.zeros_like(p) for p in self.params]
        self.second = self.second or [np.zeros_like(p) for p in self.params]

    @classmethod
    def initial(cls, n_in: int, hidden: int, n_out: int, seed: int) -> Model:
        """Uniform within the root of one over a layer's inputs."""
        r = np.random.default_rng(seed)
        a, b = n_in ** -0.5, hidden ** -0.5
        return cls([r.uniform(-a, a, (n_in, hidden)), r.uniform(-a, a, hidden),
                    r.uniform(-b, b, (hidden, n_out)), r.uniform(-b, b, n_out)])

    def adam(self, grads: list[np.ndarray], rate: float) -> None:
        self.steps += 1
        for p, m, v, g in zip(self.params, self.first, self.second, grads):
            m += (1 - BETA1) * (g - m)
            v += (1 - BETA2) * (g * g - v)
            p -= rate * (m / (1 - BETA1 ** self.steps)) / (np.sqrt(v / (1 - BETA2 ** self.steps)) + EPSILON)


def log_softmax(params: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hidden activations, log probabilities) of rows ``x``."""
    w1, b1, w2, b2 = params
    h = np.maximum(x @ w1 + b1, 0.0)
    z = h @ w2 + b2
    z -= z.max(1, keepdims=True)
    return h, z - np.log(np.exp(z).sum(1, keepdims=True))


def sums(params: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[float, int, list[np.ndarray]]:
    """Summed loss, right answers and summed gradients over rows ``x`` with classes ``y``."""
    h, logp = log_softmax(params, x)
    at = np.arange(len(y))
    d = np.exp(logp)
    d[at, y] -= 1.0
    back = (d @ params[2].T) * (h > 0)
    return (-float(logp[at, y].sum()), int((logp.argmax(1) == y).sum()),
            [x.T @ back, back.sum(0), h.T @ d, d.sum(0)])


def _flat(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in parts])


def _shaped(flat: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    out, at = [], 0
    for p in like:
        out.append(flat[at:at + p.size].reshape(p.shape).copy())
        at += p.size
    return out


_SUMS = "n long, loss double, correct long, grads binary"
_NAMES = ["n", "loss", "correct", "grads"]


def _step_sums(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    params, n, loss, correct, total = shared.value, 0, 0.0, 0, None
    for b in batches:
        if b.num_rows:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(b.num_rows, -1)
            own, right, grads = sums(params, x, b.column("y").to_numpy())
            n, loss, correct = n + b.num_rows, loss + own, correct + right
            total = _flat(grads) if total is None else total + _flat(grads)
    if n:
        yield pa.RecordBatch.from_pydict({"n": [n], "loss": [loss], "correct": [correct], "grads": [total.tobytes()]})


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [r for b in batches for r in b.to_pylist()]
    if rows:
        total = np.sum([np.frombuffer(r["grads"]) for r in rows], axis=0)
        yield pa.RecordBatch.from_pydict({"n": [sum(r["n"] for r in rows)], "loss": [sum(r["loss"] for r in rows)],
                                          "correct": [sum(r["correct"] for r in rows)], "grads": [total.tobytes()]})


def _whole_batches(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(x, y) of each batch in turn, from rows in the order of their ``place``."""
    left = None
    for b in parts:
        if not b.num_rows:
            continue
        x = b.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(b.num_rows, -1)
        new = (x, b.column("y").to_numpy(), b.column("place").to_numpy())
        x, y, place = new if left is None else (np.concatenate(c) for c in zip(left, new))
        cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist()]
        for i, j in zip(cuts, cuts[1:]):
            yield x[i:j], y[i:j]
        left = tuple(c[cuts[-1]:] for c in (x, y, place))
    if left is not None:
        yield left[0], left[1]


_RUN = "n long, loss double, correct long, steps long, params binary, first binary, second binary"


def _run_steps(parts: Iterator[pa.RecordBatch], shared, rate: float) -> Iterator[pa.RecordBatch]:
    params, first, second, steps = shared.value
    model = Model(*[[p.copy() for p in ps] for ps in (params, first, second)], steps)     # workers keep what is broadcast
    n, loss, correct = 0, 0.0, 0
    for x, y in _whole_batches(parts):
        own, right, grads = sums(model.params, x, y)
        model.adam([g / len(y) for g in grads], rate)
        n, loss, correct = n + len(y), loss + own, correct + right
    yield pa.RecordBatch.from_pydict({"n": [n], "loss": [loss], "correct": [correct], "steps": [model.steps],
                                      **{c: [_flat(getattr(model, c)).tobytes()] for c in ("params", "first", "second")}})


def dealt(df: DataFrame, features: str, label: str, key: str, seed: int = 42) -> tuple[DataFrame, int, int]:
    """(rows x, y, pos in a random order; rows; width of x): the rows to train on."""
    kept = "array<float>" if df.schema[features].dataType.simpleString() == "array<float>" else "array<double>"
    rows = df.select(F.col(features).cast(kept).alias("x"), F.col(label).cast("int").alias("y"),
                     F.xxhash64(F.lit(seed), key).alias("draw"), F.col(key).alias("key"))
    rows = rows.where("x IS NOT NULL AND y IS NOT NULL AND NOT exists(x, e -> e IS NULL)")
    rows = materialize(numbered(rows, ["draw", "key"]).select("x", "y", "pos"))
    last, width = rows.agg(F.max("pos"), F.max(F.size("x"))).first()
    if last is None:
        raise ValueError("no rows to train on")
    return rows, last + 1, width


def _batches_per_run(n_rows: int, n_batches: int, width: int) -> int:
    """0 where a batch is larger than a run."""
    return RUN_CELLS // (-(-n_rows // n_batches) * max(width, 1))


def _batched(rows: DataFrame, n_rows: int, width: int, batch_size: int) -> tuple[DataFrame, int, int]:
    n = -(-n_rows // batch_size)
    rows = rows.withColumn("batch", F.floor(F.col("pos") / batch_size).cast("int"))
    if not _batches_per_run(n_rows, n, width):
        path = work_dir(rows.sparkSession, "minibatches")
        rows.write.partitionBy("batch").parquet(path)
        rows = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return rows, n, width


def batches(df: DataFrame, features: str, label: str, key: str, batch_size: int, seed: int = 42) -> tuple[DataFrame, int, int]:
    """(rows x, y, pos, batch; batches; width of x): every row in one batch, all but the last of the same size."""
    return _batched(*dealt(df, features, label, key, seed), batch_size)


def _step(batch: DataFrame, params: list[np.ndarray]) -> tuple[int, float, int, list[np.ndarray]]:
    shared = batch.sparkSession.sparkContext.broadcast(params)      # the model
    try:
        out = batch.select("x", "y").mapInArrow(partial(_step_sums, shared=shared), _SUMS)
        if out.rdd.getNumPartitions() > DIRECT_TASKS:
            out = out.repartition(int(out.rdd.getNumPartitions() ** 0.5) + 1).mapInArrow(_add, _SUMS)
        rows = out.collect()                                        # one row per task
    finally:
        shared.unpersist()
    total = np.sum([np.frombuffer(r.grads) for r in rows], axis=0)
    return sum(r.n for r in rows), sum(r.loss for r in rows), sum(r.correct for r in rows), _shaped(total, params)


def _epoch_in_runs(rows: DataFrame, order: list[int], per_run: int, model: Model, rate: float, path: str) -> tuple[int, float, int]:
    """Takes a step on each batch in that order; returns rows, summed loss and right answers."""
    spark = rows.sparkSession
    places = spark.createDataFrame(pd.DataFrame({"batch": order, "place": range(len(order))}, dtype="int32"), "batch int, place int")
    laid = rows.join(places, "batch").withColumn("run", F.floor(F.col("place") / per_run).cast("int")).drop("batch")
    laid.repartition("run").write.mode("overwrite").partitionBy("run").parquet(path)
    laid, total = spark.read.schema(laid.schema).parquet(path), np.zeros(3)
    for run in range(-(-len(order) // per_run)):
        shared = spark.sparkContext.broadcast((model.params, model.first, model.second, model.steps))      # the model
        try:
            of_run = laid.where(F.col("run") == run).coalesce(1).sortWithinPartitions("place", "pos")      # RUN_CELLS at most
            r = of_run.select("x", "y", "place").mapInArrow(partial(_run_steps, shared=shared, rate=rate), _RUN).first()
        finally:
            shared.unpersist()
        like, model.steps = model.params, r.steps
        model.params, model.first, model.second = (_shaped(np.frombuffer(r[c]), like) for c in ("params", "first", "second"))
        total += (r.n, r.loss, r.correct)
    return int(total[0]), float(total[1]), int(total[2])


def _save(spark: SparkSession, path: str, epoch: int, model: Model, row: tuple) -> None:
    state = [_flat(x).tobytes() for x in (model.params, model.first, model.second)]
    spark.createDataFrame([(*row, model.steps, *state)], f"{HISTORY}, done int, params binary, first binary, second binary") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/state={epoch}")


def _load(spark: SparkSession, path: str, model: Model) -> list[tuple]:
    """Puts the last complete epoch's state into ``model``; returns the history up to it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs, history, last = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), [], None
    while fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/state={len(history) + 1}/_SUCCESS")):
        last = spark.read.parquet(f"{path}/state={len(history) + 1}").first()
        history.append(tuple(last)[:5])
    if last is not None:
        like, model.steps = model.params, last.done
        model.params, model.first, model.second = (_shaped(np.frombuffer(last[c]), like) for c in ("params", "first", "second"))
    return history


def fit_batches(rows: DataFrame, n_batches: int, width: int, n_classes: int, hidden: int = HIDDEN, learning_rate: float = 0.01,
                epochs: int = EPOCHS, seed: int = 42, state_path: str | None = None) -> tuple[Model, list[tuple]]:
    """Trains on dealt rows (see :func:`batches`); returns the model and its history (``HISTORY``)."""
    spark = rows.sparkSession
    model = Model.initial(width, hidden, n_classes, seed)
    history = _load(spark, state_path, model) if state_path else []
    per_run, path = _batches_per_run(rows.count(), n_batches, width), work_dir(spark, "epoch")
    for epoch in range(len(history) + 1, epochs + 1):
        order = list(range(n_batches))
        random.Random(seed * 1_000_003 + epoch).shuffle(order)
        n, loss, correct = 0, 0.0, 0
        if per_run:
            n, loss, correct = _epoch_in_runs(rows, order, per_run, model, learning_rate, path)
        else:
            for b in order:
                rows_of, loss_of, right, grads = _step(rows.where(F.col("batch") == b), model.params)
                model.adam([g / rows_of for g in grads], learning_rate)
                n, loss, correct = n + rows_of, loss + loss_of, correct + right
        history.append((epoch, n_batches, n, loss / n, correct / n))
        if state_path:
            _save(spark, state_path, epoch, model, history[-1])
    return model, history


def train_perceptron(df: DataFrame, n_classes: int, features: str = "embedding", label: str = "label", key: str = "vec_id",
                     hidden: int = HIDDEN, learning_rate: float = 0.01, batch_size: int = 64, epochs: int = EPOCHS,
                     seed: int = 42, state_path: str | None = None) -> tuple[Model, DataFrame]:
    """The model and the epoch table: steps, rows, mean loss (A14) and accuracy (A12) while training."""
    rows, n, width = batches(df, features, label, key, batch_size, seed)
    model, history = fit_batches(rows, n, width, n_classes, hidden, learning_rate, epochs, seed, state_path)
    return model, df.sparkSession.createDataFrame(history, HISTORY)


def class_probabilities(model: Model, features: Column, spark: SparkSession) -> Column:
    """Probabilities (array) of each row's features; null features give null."""
    shared = spark.sparkContext.broadcast(model.params)

    @F.pandas_udf("array<double>")
    def score(x: pd.Series) -> pd.Series:
        out, known = pd.Series([None] * len(x), dtype=object), x.notna()
        if known.any():
            rows = np.exp(log_softmax(shared.value, np.stack([np.asarray(v, float) for v in x[known]]))[1])
            out.loc[known.to_numpy()] = pd.Series(list(rows), index=out.index[known.to_numpy()])
        return out
    return score(features)


def predict(model: Model, df: DataFrame, features: str = "embedding") -> DataFrame:
    """``df`` with ``probability`` (array) and ``prediction`` (the most likely class, the first of equals)."""
    p = df.withColumn("probability", class_probabilities(model, F.col(features), df.sparkSession))
    best = F.array_position("probability", F.array_max("probability")) - 1
    return p.withColumn("prediction", best.cast("double"))


def tune_perceptron(df: DataFrame, n_classes: int, features: str = "embedding", label: str = "label", key: str = "vec_id",
                    space: dict = SEARCH_SPACE, max_trials: int = MAX_TRIALS, parallelism: int = PARALLEL_TRIALS,
                    hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 42) -> tuple[DataFrame, dict, Model]:
    """Search learning rate x batch size for the best accuracy of the last epoch, ``parallelism``
    trials at a time.  Returns (trials, best parameters, best model); rows are dealt once."""
    spark = df.sparkSession
    points = sample_grid(space, max_trials, seed)
    rows = dealt(df, features, label, key, seed)
    batched = {b: _batched(*rows, b) for b in sorted({int(p["batch_size"]) for p in points})}

    def trial(p: dict) -> tuple[Model, list[tuple]]:
        return fit_batches(*batched[int(p["batch_size"])], n_classes, hidden, float(p["learning_rate"]), epochs, seed)
    with ThreadPoolExecutor(parallelism) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(trial), points))
    rows = [(i, float(p["learning_rate"]), int(p["batch_size"]), *h[-1][1:]) for i, (p, (_, h)) in enumerate(zip(points, done))]
    trials = spark.createDataFrame(
        rows, "trial int, learning_rate double, batch_size int, steps int, rows long, mean_loss double, accuracy double")
    best = max(range(len(rows)), key=lambda i: (rows[i][-1], -i))
    return trials, points[best], done[best][0]
