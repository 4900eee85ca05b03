import math
import random
import re

import numpy as np
import pytest

from tidewater.llm import lexical

DOCS = "doc_id long, text string, at string, tf int, n string, norm double, item_id long"
SPLIT = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")


def words(text) -> list[str]:
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in SPLIT.findall(text or "")]


def brute(docs: list[tuple], bench: list[tuple]) -> list[tuple]:
    rows = [(i, words(t)) for i, t in docs]
    rows = [(i, w) for i, w in rows if w]
    count, total = len(rows), sum(len(w) for _, w in rows)
    items: dict = {}
    for i, t in bench:
        items.setdefault(i, set()).update(words(t))
    out = []
    for item, terms in items.items():
        scored = []
        weights = {}
        for t in terms:
            df = sum(t in w for _, w in rows)
            if df:
                weights[t] = math.floor(1000 * math.log((2 * count + 2) / (2 * df + 1)))
        for i, w in rows:
            m = 10 + 90 * len(w) * count // total
            s = sum(v * (10 ** 9 * w.count(t) // (1000 * w.count(t) + 8 * m)) for t, v in weights.items())
            if s > 0:
                scored.append((s, i))
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, n + 1, i, s) for n, (s, i) in enumerate(scored[:10])]
    return sorted(out, key=repr)


def run(spark, docs, bench, **options) -> list[tuple]:
    d = spark.createDataFrame([(i, t, "x", 1, "y", 0.5, 3) for i, t in docs], DOCS).repartition(3)
    b = spark.createDataFrame([(i, t, 5, "z") for i, t in bench], "item_id long, text string, doc_id long, rank string")
    return sorted(map(tuple, lexical.search(d, b, **options).collect()), key=repr)


def corpus(n: int, seed: int = 5) -> tuple[list[tuple], list[tuple]]:
    r = random.Random(seed)
    vocab = [f"w{int(r.paretovariate(0.7)) % 300}" for _ in range(2000)] + ["Größe", "ñandú", "ABC", "日本"]
    def text(k):
        return " ".join(r.choice(vocab) for _ in range(k)) + r.choice(["", ".", "\n!"])
    docs = [(3 * i, text(r.randint(1, 60))) for i in range(n)]
    docs += [(5000 + i, docs[4][1]) for i in range(25)]          # copies tie for the last places
    docs += [(None, docs[4][1]), (9000, None), (9001, ""), (9002, "?! ..."), docs[7], docs[7], (9003, text(30_000))]
    bench = [(i, text(r.randint(1, 25))) for i in range(20)] + [(90, docs[4][1]), (91, None), (92, ""), (93, "nowhere"), (3, "w1 extra"), (None, "w2 w3")]
    return docs, bench


def test_equals_brute_force_over_many_buckets_waves_and_blocks(spark, monkeypatch):
    docs, bench = corpus(400)
    monkeypatch.setattr(lexical, "BUCKET", 16)
    monkeypatch.setattr(lexical, "ENTRIES", 500)
    want = brute(docs, bench)
    assert run(spark, docs, bench) == want
    assert run(spark, docs, bench, block_terms=60) == want


def test_one_bucket(spark):
    docs, bench = corpus(60, 8)
    assert run(spark, docs, bench) == brute(docs, bench)


def test_nothing_to_search(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a")], []) == []
    assert run(spark, [(1, None)], [(1, "a")]) == []
    assert run(spark, [(1, "a b")], [(1, "c"), (2, "!")]) == []


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bounds_lose_no_row_and_drop_most(seed):
    r = np.random.default_rng(seed)
    rows = []
    for _ in range(800):
        at = np.sort(r.choice(200, r.integers(1, 40), replace=False)).astype(np.int64)
        rows.append((at, r.integers(1, 900_000, len(at)) * r.integers(0, 2, len(at)) + 1))
    weights = r.integers(1, 9000, 200)
    norms = np.array([math.sqrt(float((weights[a] * p.astype(float) ** 2).sum())) for a, p in rows])
    order = np.argsort(-norms, kind="stable")
    rows = [rows[i] for i in order]
    b = lexical.Bucket(list(range(800)), norms[order], np.concatenate([a for a, _ in rows]), np.concatenate([p for _, p in rows]),
                       np.cumsum([len(a) for a, _ in rows]), np.sqrt(weights))
    scratch = np.zeros(200, np.int64)
    kept = 0
    for n in range(20):
        at = r.choice(200, 12, replace=False)
        q = lexical.Query.of(n, at.tolist(), weights)
        scores = lexical.exact(b, np.arange(800), q, scratch)
        assert not scratch.any()
        held = {c: w for c, w in zip(q.at.tolist(), q.weights.tolist())}
        assert scores.tolist() == [sum(held.get(c, 0) * v for c, v in zip(a.tolist(), p.tolist())) for a, p in rows]
        tenth = int(np.sort(scores)[-10])
        left = lexical.survivors(b, q, tenth)
        assert set(np.flatnonzero(scores >= tenth)) <= set(left.tolist())
        kept += len(left)
    assert kept < 20 * 800 / 2


def test_terms_take_ascii_letters_digits_and_all_other_characters():
    assert [t.decode() for t in lexical.terms("Ab-c_D 1é É{x}\x7fy")] == ["ab", "c", "d", "1é É", "x", "y"]
    assert lexical.terms(None) == []
