import random

import pytest
from pyspark.sql import functions as F

from tidewater.llm import mixing as M


def water_fill(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: [5, 2, 1][i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > 3 * sizes[s]}
        if not over:
            target.update({s: left * w[s] / total for s in open_})
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
        open_ -= over
    return target


@pytest.fixture()
def docs(spark, tmp):
    r = random.Random(2)
    rows = [(i, " ".join(["w"] * r.randint(0, 40)), r.choice(["a", "a", "a", "b", "ç", "d", None]), 1) for i in range(900)]
    rows += [(1000, "one  two\tthree\x0b\x0cfour five", "tiny", 1), (1001, None, "b", 1), (1002, "", None, 1),
             (3, rows[3][1], rows[3][2], 1), (None, "x y", "nul", 1), (1003, "big " * 5000, "d", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, before int").write.parquet(f"{tmp}/documents.parquet")
    return tmp, rows


def test_targets_and_takes(spark, docs):
    tmp, rows = docs
    got = M.op7_mix_curriculum(spark, tmp).collect()
    size = lambda t: len((t or "").encode().split())
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = water_fill(sizes)
    source = {(i, size(t)): s for i, t, s, _ in rows}
    assert len(got) == len(rows)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = source[r.doc_id, r["size"]]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert r.taken % max(r["size"], 1) == 0 and r.taken <= 3 * r["size"]
        assert (r.first_position is None) == (r.taken == 0)
        taken[s] += r.taken
    biggest = {s: max(size(t) for _, t, x, _ in rows if x == s) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= biggest[s] / 2 + 1e-6 for s in sizes)
    again = {tuple(r) for r in M.op7_mix_curriculum(spark, tmp).collect()}
    assert {tuple(r) for r in got} == again


def test_positions_follow_the_schedules(spark):
    for knots in M.SCHEDULES:
        rows = spark.range(1, 100).select((F.col("id") / 100).alias("y")).withColumn("t", M.time_of(F.col("y"), knots)).collect()
        for r in rows:
            part, spent = 0.0, 0.0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
                e = min(max(r.t, t0), t1)
                spent += (e - t0) * (w0 + w0 + (w1 - w0) * (e - t0) / (t1 - t0)) / 2
            assert spent / M.integral(knots) == pytest.approx(r.y, abs=1e-9), part


def test_mix_returns_the_copies_in_order(spark, docs):
    tmp, rows = docs
    d = spark.read.parquet(f"{tmp}/documents.parquet")
    out = M.mix(d)
    assert out.columns == d.columns
    got, n = {}, 0
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len((r.text or "").encode().split())
    want = {}
    for r in M.op7_mix_curriculum(spark, tmp).collect():
        if r.taken:
            want[r.doc_id] = want.get(r.doc_id, 0) + r.taken
    assert got == want


def test_empty(spark, tmp):
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(f"{tmp}/documents.parquet")
    assert M.op7_mix_curriculum(spark, tmp).isEmpty()
    zero = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.target, r.positions) for r in M.plan(zero).collect()] == [(0.0, []), (0.0, [])]


def test_columns_of_any_name_come_back(spark):
    from tidewater.llm import mixing
    docs = spark.createDataFrame([(i, "some words here", "s", i, f"p{i}") for i in range(4)],
                                 "doc_id long, text string, source string, key int, position string")
    got = mixing.mix(docs).collect()
    assert got and all(r.key == r.doc_id and r.position == f"p{r.doc_id}" for r in got)
