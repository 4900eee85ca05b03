import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidewater.llm import repeats as R


def brute(docs, n=R.LENGTH):
    """(id, bytes) rows -> {id: (n, removed, spans, sha)} by counting every string of n bytes."""
    seen = {}
    for i, t in docs:
        for s in range(len(t) - n + 1):
            seen[t[s:s + n]] = seen.get(t[s:s + n], 0) + 1
    out = []
    for i, t in docs:
        gone = bytearray(len(t))
        for s in range(len(t) - n + 1):
            if seen[t[s:s + n]] > 1:
                gone[s:s + n] = b"\1" * n
        spans = sum(1 for j in range(len(t)) if gone[j] and (j == 0 or not gone[j - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeéß") for _ in range(r.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    base = [text(400) for _ in range(4)]
    docs = ["", "short", text(50), base[0], base[0], "ab" * 900, "x" * 2000, text(300) + base[1][100:100 + 600]]
    for i in range(30):
        b = r.choice(base)
        s = r.randint(0, 900)
        docs.append(text(r.randint(0, 60)) + b[s: s + r.randint(300, 900)] + text(r.randint(0, 60)))
    for i in range(25):  # near copies
        w = base[2].split(" ")
        w[r.randint(0, len(w) - 1)] = word()
        docs.append(" ".join(w))
    docs.append(base[3][:399])
    docs.append(base[3][7:407])
    docs.append(base[1] + base[1])
    return list(enumerate(docs))


@pytest.mark.parametrize("local", [3000, 12, 3])
def test_equals_brute_force(spark, monkeypatch, local, tmp):
    monkeypatch.setattr(R, "LOCAL_BYTES", local * R.depth(R.LENGTH).outer)
    rows = corpus(local)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp}/documents.parquet")
    got = R.op9_suffix_repeats(spark, tmp).collect()
    assert all(x.n_kept == x.n_bytes - x.n_removed for x in got)
    assert sorted(tuple(x)[:5] for x in got) == brute([(i, t.encode()) for i, t in rows])


def test_long_text_in_pieces(monkeypatch):
    import pandas as pd
    rows = [(0, (corpus(5)[7][1] * 3).encode())]
    whole = pd.concat(R._anchors(iter([pd.DataFrame({"k": [0], "t": [rows[0][1]]})]), R.depth(400)))
    monkeypatch.setattr(R, "PIECE", 700)
    cut = pd.concat(R._anchors(iter([pd.DataFrame({"k": [0], "t": [rows[0][1]]})]), R.depth(400)))
    starts = lambda d: sorted((p - x, p, h) for p, lo, hi, h in zip(d.p, d.lo, d.hi, d.h) for x in range(lo, hi + 1))
    assert starts(whole) == starts(cut)


def test_nulls_and_empty(spark, tmp):
    t = "word " * 100
    spark.createDataFrame([(None, t, 1), (None, None, 2), (3, t, 3), (3, t, 3)], "doc_id long, text string, k int") \
        .write.parquet(f"{tmp}/documents.parquet")
    got = [tuple(x)[:4] for x in R.op9_suffix_repeats(spark, tmp).collect()]
    assert sorted(got, key=str) == sorted([(None, 500, 500, 1), (None, 0, 0, 0), (3, 500, 500, 1), (3, 500, 500, 1)], key=str)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert R.removed(empty).isEmpty()


def test_drop_repeats_keeps_columns(spark):
    t = "é" * 300
    docs = spark.createDataFrame([(1, t + "tail", "en", 304, 5), (2, "head" + t, "de", 304, 6), (3, None, None, None, 7)],
                                 "doc_id long, text string, lang string, n_chars long, k int")
    got = {r.doc_id: r for r in R.drop_repeats(docs).collect()}
    assert R.drop_repeats(docs).columns == docs.columns
    assert got[1].text == "tail" and got[1].n_chars == 4 and got[2].text == "head" and got[3].text is None


def test_work_does_not_grow_with_exact_copies(spark, monkeypatch):
    base = corpus(3)[3][1]
    near = base[:700] + "#" + base[701:]
    write, seen = R.stage, {}

    def counted(df, name, *args, **kw):
        out = write(df, name, *args, **kw)
        marks = F.sum(F.size("marks")) if "marks" in out.columns else F.count("*")
        seen.setdefault(name, []).append(out.agg(marks).first()[0])
        return out
    monkeypatch.setattr(R, "stage", counted)
    work = {}
    for copies in (2, 40):
        rows = [(i, base) for i in range(copies)] + [(1000, near), (1001, "alone " + base[200:900])]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = sorted((r.id, bytes(r.t), R.merge(r.spans)) for r in R.removed(docs).collect())
        digest = [(i, len(t), sum(e - s for s, e in x), len(x), hashlib.sha256(R.cut(t, x)).hexdigest()) for i, t, x in got]
        assert digest == brute([(i, t.encode()) for i, t in rows])
        R.drop_repeats(docs).count()
        work[copies], seen = seen, {}
    assert work[2]["rep-ctx"][0] > 0 and work[2] == work[40]


@pytest.mark.parametrize("length", [200, 57, 2])
def test_other_lengths_equal_brute_force(spark, length):
    rows = corpus(11)[:30] if length > 2 else [(0, "abcxyab"), (1, "qrs"), (2, "tuvqr"), (3, "mm"), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = []
    for r in R.removed(docs, length=length).collect():
        t, runs = bytes(r.t), R.merge(r.spans)
        got.append((r.id, len(t), sum(e - s for s, e in runs), len(runs), hashlib.sha256(R.cut(t, runs)).hexdigest()))
    assert sorted(got) == brute([(i, t.encode()) for i, t in rows], length)


def test_columns_of_any_name_come_back(spark):
    t = "word " * 100
    docs = spark.createDataFrame([(1, t, 99, "s"), (2, t, 98, None)], "doc_id long, text string, k int, spans string")
    assert sorted((r.k, r.spans) for r in R.drop_repeats(docs).collect()) == [(98, None), (99, "s")]
