import numpy as np
import pytest

from tidewater.llm import vectors as V


def brute(rows):
    """(id, vector or None) -> {id: (links, component)} by comparing all pairs."""
    ok = {i: np.asarray(v, float) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = sorted(ok)
    links = {i: set() for i, _ in rows}
    for x in ids:
        for y in ids:
            if x < y and len(ok[x]) == len(ok[y]) and \
                    ok[x] @ ok[y] / np.linalg.norm(ok[x]) / np.linalg.norm(ok[y]) >= 0.9:
                links[x].add(y)
                links[y].add(x)
    comp = {i: i for i in links}
    for i in sorted(links):
        todo = [i] if comp[i] == i else []
        while todo:
            for y in links[todo.pop()]:
                if comp[y] > i:
                    comp[y] = i
                    todo.append(y)
    return {i: (len(links[i]), comp[i]) for i in links}


@pytest.mark.parametrize("chunk", [256, 20])
def test_near_copies_equal_brute_force(spark, tmp, monkeypatch, chunk):
    monkeypatch.setattr(V, "CHUNK", chunk)
    monkeypatch.setattr(V, "STRANGERS", 32)
    r = np.random.default_rng(chunk)
    rows = [r.standard_normal(64) for _ in range(150)]
    for c in range(4):  # tight groups: cosines far above the threshold
        rows += [rows[c] + 0.02 * r.standard_normal(64) for _ in range([1, 5, 60, 2][c])]
    rows += [rows[7]] * 3 + [rows[8] * 3.0, None, [0.0] * 64, [1.0, None] * 32, [float("nan")] * 64, [], [1.0, 2.0], [2.0, 4.0]]
    rows = [(i * 3, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]
    spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, cells string") \
        .write.parquet(f"{tmp}/embeddings.parquet")
    got = {x.vec_id: x for x in V.op10_collision_counting(spark, tmp).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    assert {i: (x.n_links, x.component_id) for i, x in got.items()} == want
    assert all(x.kept == (x.vec_id == x.component_id) for x in got.values())


def test_recall_at_the_threshold(spark):
    """Pairs at cosines just above 0.9 among strangers: at least 0.9 are found, none below."""
    r = np.random.default_rng(4)
    rows = []
    for _ in range(400):
        a = r.standard_normal(64)
        a /= np.linalg.norm(a)
        b = r.standard_normal(64)
        b -= a * (a @ b)
        c = r.uniform(0.885, 0.93)
        rows += [a, c * a + np.sqrt(1 - c * c) * b / np.linalg.norm(b)]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    want = brute(rows)
    got = {x.id: x for x in V.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert all(x.n_links <= want[i][0] for i, x in got.items())
    assert sum(x.n_links for x in got.values()) >= 0.9 * sum(n for n, _ in want.values())


def test_recall_with_the_signs_and_lists_of_a_large_table(spark, monkeypatch):
    """As above with 10 signs and 18 lists or more, which some 260,000 vectors need."""
    signs, lists, least = V.settings(V.STRANGERS << 10)
    assert signs == 10 and lists >= 17
    monkeypatch.setattr(V, "settings", lambda n: (signs, lists, least))
    r = np.random.default_rng(5)
    rows = []
    for _ in range(1000):
        a = r.standard_normal(64)
        a /= np.linalg.norm(a)
        b = r.standard_normal(64)
        b -= a * (a @ b)
        c = r.uniform(0.9005, 0.91)
        rows += [a, c * a + np.sqrt(1 - c * c) * b / np.linalg.norm(b)]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    got = {x.id: x for x in V.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert all(x.n_links <= 1 and x.component_id == (i - i % 2 if x.n_links else i) for i, x in got.items())
    assert sum(x.n_links for x in got.values()) >= 0.95 * len(rows)


def test_settings_grow_slowly_and_empty(spark):
    assert V.settings(100)[0] == 0 and V.settings(10 ** 9)[1] < 150
    assert all(V.settings(n)[2] == V.settings(10)[2] for n in (1, 1000, 10 ** 6))
    assert V.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).isEmpty()
