import hashlib
import random

import numpy as np
import pytest

from tidewater.llm import winnow as W
from tidewater.llm._bytes import gram_ids


def naive(text):
    if not text:
        return []
    k = min(W.K, len(text))
    ids = [int(gram_ids(np.frombuffer(text[i:i + k], np.uint8), k)[0]) for i in range(len(text) - k + 1)]
    w, chosen = min(W.WINDOW, len(ids)), []
    for s in range(len(ids) - w + 1):
        best = min(range(s, s + w), key=lambda i: (ids[i] >> 24, -i))
        if not chosen or chosen[-1][1] != best:
            chosen.append((ids[best], best))
    return chosen


def _text(r, n):
    return " ".join("".join(r.choice("abcdeéß日") for _ in range(r.randint(1, 6))) for _ in range(n))


@pytest.mark.parametrize("piece", [1 << 20, 50])
def test_equals_naive_winnowing(monkeypatch, piece):
    monkeypatch.setattr(W, "PIECE", piece)
    r = random.Random(1)
    for t in ["", "a", "short text", "x" * 300, "ab" * 200, *(_text(r, n) for n in (5, 12, 13, 14, 60, 200))]:
        got = W.winnow(t.encode())
        assert list(zip(got.ids.tolist(), got.at.tolist())) == naive(t.encode())


def test_shared_bytes_are_found():
    r = random.Random(2)
    for _ in range(50):
        shared = _text(r, 40).encode()[: W.K + W.WINDOW - 1]
        a, b = _text(r, 30).encode(), _text(r, 30).encode()
        x, y = W.winnow(a + shared + b), W.winnow(b + shared + a)
        there = {(h, p - len(a)) for h, p in zip(x.ids.tolist(), x.at.tolist())}
        assert there & {(h, p - len(b)) for h, p in zip(y.ids.tolist(), y.at.tolist())}


@pytest.mark.parametrize("n", [1, 2, 40])
def test_query_equals_brute_force(spark, tmp, n):
    r = random.Random(n)
    texts = [r.choice([_text(r, r.randint(0, 90)), "", None, "same text " * 9]) for _ in range(n)]
    ids = r.sample(range(1000), n)
    rows = [(i, t, True) for i, t in zip(ids, texts)]
    spark.createDataFrame(rows, "doc_id long, text string, carry boolean").repartition(3).write.parquet(f"{tmp}/documents.parquet")
    got = {x.doc_id: x for x in W.op4_winnowing(spark, tmp).collect()}
    down = sorted(rows, reverse=True)
    assert len(got) == n
    for k, (i, t, _) in enumerate(down):
        t, nxt = t or "", down[(k + 1) % n][1] or ""
        cut = len(t) // 3
        e = t[: len(t) - cut] + nxt[:cut] if cut else t
        x = got[i]
        assert x.n_chars == len(t) and x.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        s = {h for h, _ in naive(t.encode())}
        for other, near in ((e, x.near_edited), (nxt, x.near_next)):
            o = {h for h, _ in naive(other.encode())}
            assert near == pytest.approx(len(s & o) / len(s | o) if s | o else 1.0)
        assert x.fingerprint == " ".join(f"{h >> 32:08x}@{p:x}" for h, p in naive(t.encode()))


def test_null_ids_repeated_rows_and_empty(spark, tmp):
    rows = [(None, "some text here"), (3, "abc " * 50), (3, "abc " * 50), (1, "long words " * 20000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp}/documents.parquet")
    got = W.op4_winnowing(spark, tmp).collect()
    assert sorted(str(x.doc_id) for x in got) == ["1", "3", "3", "None"] and all(0 <= x.near_edited <= 1 for x in got)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp}/e/documents.parquet")
    assert W.op4_winnowing(spark, f"{tmp}/e").isEmpty()
    assert W.fingerprints(spark.read.parquet(f"{tmp}/documents.parquet")).count() == 4
