import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import perceptron as P
from tidewater.operators.metrics import classification_metrics, confusion
from tidewater.operators.numbering import numbered


def table(spark, n=200, d=6, seed=1):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d))
    y = (x[:, 0] + x[:, 1] > 0).astype(int) + (x[:, 2] > 0.5)
    rows = [(i, [float(v) for v in a], int(b)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)


def plain_step(params, x, y, rate, m, v, t):
    """One Adam step on one batch, written out."""
    w1, b1, w2, b2 = params
    a = x @ w1 + b1
    h = np.where(a > 0, a, 0)
    z = h @ w2 + b2
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    loss = -np.log(p[np.arange(len(y)), y]).mean()
    dz = (p - np.eye(p.shape[1])[y]) / len(y)
    da = (dz @ w2.T) * (a > 0)
    grads = [x.T @ da, da.sum(0), h.T @ dz, dz.sum(0)]
    out = []
    for i, g in enumerate(grads):
        m[i] = 0.9 * m[i] + 0.1 * g
        v[i] = 0.999 * v[i] + 0.001 * g * g
        out.append(params[i] - rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8))
    return out, loss


def test_epochs_equal_plain_numpy(spark):
    df = table(spark, 100)
    rows, n, width = P.batches(df, "embedding", "label", "vec_id", 32)
    assert (n, width) == (4, 6)
    model, history = P.fit_batches(rows, n, width, 3, hidden=8, learning_rate=0.05, epochs=2, seed=7)
    import random
    data = {b: [(np.array(r.x), r.y) for r in rows.where(F.col("batch") == b).collect()] for b in range(4)}
    assert [len(data[b]) for b in range(4)] == [32, 32, 32, 4]
    params = P.Model.initial(6, 8, 3, 7).params
    m, v, t = [0] * 4, [0] * 4, 0
    for epoch in (1, 2):
        order = list(range(4))
        random.Random(7 * 1_000_003 + epoch).shuffle(order)
        total = 0.0
        for b in order:
            t += 1
            x, y = np.array([a for a, _ in data[b]]), np.array([c for _, c in data[b]])
            params, loss = plain_step(params, x, y, 0.05, m, v, t)
            total += loss * len(y)
        assert history[epoch - 1][:3] == (epoch, 4, 100)
        assert history[epoch - 1][3] == pytest.approx(total / 100)
    for a, b in zip(model.params, params):
        assert np.allclose(a, b)


def test_learns_and_predicts(spark):
    df = table(spark, 400)
    model, history = P.train_perceptron(df, 3, hidden=16, learning_rate=0.05, batch_size=50, epochs=4)
    h = [r.asDict() for r in history.orderBy("epoch").collect()]
    assert h[-1]["mean_loss"] < 0.6 * h[0]["mean_loss"] and h[-1]["accuracy"] > 0.85
    scored = P.predict(model, df.union(spark.createDataFrame([(-1, None, 0)], df.schema)))
    m = classification_metrics(confusion(scored.where("vec_id >= 0").withColumn("label", F.col("label").cast("double")))).first()
    assert m["accuracy"] > 0.85
    assert scored.where("vec_id < 0").first().prediction is None


def test_goes_on_after_a_lost_driver(spark, tmp):
    rows, n, width = P.batches(table(spark), "embedding", "label", "vec_id", 64)
    whole, history = P.fit_batches(rows, n, width, 3, 8, 0.02, 3, 5)
    P.fit_batches(rows, n, width, 3, 8, 0.02, 1, 5, f"{tmp}/state")
    again, parts = P.fit_batches(rows, n, width, 3, 8, 0.02, 3, 5, f"{tmp}/state")
    assert [r[:3] for r in parts] == [r[:3] for r in history]
    assert np.allclose([r[3:] for r in parts], [r[3:] for r in history])
    assert all(np.allclose(a, b) for a, b in zip(whole.params + whole.first + whole.second, again.params + again.first + again.second))


def test_sums_of_many_tasks_are_added_on_spark(spark, monkeypatch):
    rows, n, width = P.batches(table(spark), "embedding", "label", "vec_id", 200)
    params = P.Model.initial(6, 8, 3, 1).params
    one = P._step(rows, params)
    monkeypatch.setattr(P, "DIRECT_TASKS", 0)
    two = P._step(rows, params)
    assert one[0] == two[0] == 200 and one[1] == pytest.approx(two[1]) and one[2] == two[2]
    assert all(np.allclose(a, b) for a, b in zip(one[3], two[3]))


def test_runs_of_batches_equal_a_job_per_batch(spark, monkeypatch):
    df = table(spark, 130)
    fits = {}
    for cells in (1, 6 * 16 * 3, 1 << 20):              # a job per batch, three runs, one run
        monkeypatch.setattr(P, "RUN_CELLS", cells)
        rows, n, width = P.batches(df, "embedding", "label", "vec_id", 16)
        assert (n, P._batches_per_run(130, n, width)) == (9, cells // (15 * 6))
        fits[cells] = P.fit_batches(rows, n, width, 3, 8, 0.05, 2, 7)
    (one, history), *others = fits.values()
    for model, got in others:
        assert [r[:3] for r in got] == [r[:3] for r in history] and np.allclose([r[3:] for r in got], [r[3:] for r in history])
        assert model.steps == 18 and all(np.allclose(a, b) for a, b in zip(one.params + one.second, model.params + model.second))


def test_small_batches_share_jobs_and_folders(spark):
    rows, n, width = P.batches(table(spark, 600), "embedding", "label", "vec_id", 4)
    assert n == 150 and len(rows.inputFiles()) < n
    spark.sparkContext.setJobGroup("epoch", "epoch")
    try:
        P.fit_batches(rows, n, width, 3, 8, 0.05, 1, 7)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("epoch")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(jobs) < 20


def test_rows_without_label_or_values_are_left_out(spark):
    df = table(spark, 30).union(spark.createDataFrame([(100, [1.0] * 5 + [None], 1), (101, None, 1), (102, [1.0] * 6, None)],
                                                      "vec_id long, embedding array<double>, label int"))
    rows, n, _ = P.batches(df, "embedding", "label", "vec_id", 16)
    assert rows.count() == 30 and n == 2
    with pytest.raises(ValueError, match="no rows"):
        P.batches(df.where("vec_id > 100"), "embedding", "label", "vec_id", 16)


def test_search_covers_both_axes(spark):
    space = {"learning_rate": (0.01, 0.05, 0.01), "batch_size": (32, 64, 32)}
    trials, best, model = P.tune_perceptron(table(spark), 3, space=space, max_trials=3, hidden=8, epochs=1)
    got = trials.collect()
    assert len(got) == 3 and {r.rows for r in got} == {200} and all(r.steps == -(-200 // r.batch_size) for r in got)
    top = max(got, key=lambda r: (r.accuracy, -r.trial))
    assert (top.learning_rate, top.batch_size) == (best["learning_rate"], best["batch_size"])


def test_numbers_inside_groups(spark):
    df = spark.createDataFrame([(None if i % 5 == 0 else i % 3, i) for i in range(500)], "g int, v int").repartition(7)
    got = numbered(df, ["v"], "pos", ["g"]).collect()
    want = {}
    for g, v in sorted(((r.g, r.v) for r in got), key=lambda r: r[1]):
        want[g, v] = sum(1 for a in got if a.g == g and a.v < v)
    assert all(r.pos == want[r.g, r.v] for r in got) and len(got) == 500
