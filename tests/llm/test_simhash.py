import random

import pytest
from pyspark.sql import functions as F

from tidewater.llm import simhash as S


def brute_components(prints):
    """(id, fp) -> {id: least id reachable} by comparing all pairs."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints[:i]):
            if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 2:
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(prints):
        least[find(i)] = min(least.get(find(i), k), k)
    return {k: least[find(i)] for i, (k, _) in enumerate(prints)}


def test_pivot_families():
    p = S.pivots()
    assert len(p) == 1 + S.FAMILIES * S.PER_FAMILY
    for f in range(S.FAMILIES):
        own = p[1 + f * S.PER_FAMILY: 1 + (f + 1) * S.PER_FAMILY]
        assert all((x ^ p[0]) & ~(0xFFFF << (16 * f)) == 0 and x != p[0] for x in own)


@pytest.mark.parametrize("crowded", [256, 4])
def test_links_equal_brute_force(spark, monkeypatch, crowded):
    monkeypatch.setattr(S, "CROWDED", crowded)
    r = random.Random(crowded)
    prints = []
    for c in range(12):
        x = r.getrandbits(64)
        for _ in range(r.choice([1, 3, 40])):
            prints.append(x)
            x = (x if r.random() < .5 else prints[-1]) ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64) if r.random() < .6 else 0)
    r.shuffle(prints)
    rows = [(i, S._signed(p)) for i, p in enumerate(prints)]
    want = brute_components(rows)
    got = S.groups(spark.createDataFrame(rows, "id long, fp long"))
    got = {x.fp: x.component_id for x in got.collect()}
    assert {i: got[p] for i, p in rows} == want


def test_query_on_texts(spark, tmp):
    r = random.Random(7)
    words = ["alpha", "Beta", "gämma", "delta", "eps", "zeta", "eta x", "theta"]
    base = " ".join(r.choice(words) + str(r.randrange(50)) for _ in range(300))
    texts = ["", None, "one", "one two", "One\ttwo", base, base.upper().lower(), base.replace(" ", "\n"), base + " more", "a b c"]
    texts += [base.replace(w, w + "x", 1) for w in base.split()[:20]] + ["long " * 50000]
    rows = [(i, t, "x", 3) for i, t in enumerate(texts)] + [(5, base, "x", 3)]
    spark.createDataFrame(rows, "doc_id long, text string, fp string, id int").write.parquet(f"{tmp}/documents.parquet")
    got = [tuple(x) for x in S.op6_simhash_pivots(spark, tmp).collect()]
    prints = [(i, S.fingerprint(t)) for i, t, _, _ in rows]
    comp = brute_components(prints)
    assert sorted(got) == sorted((i, f"{p:016x}", comp[i]) for i, p in prints)
    kept = S.keep_one(spark.read.parquet(f"{tmp}/documents.parquet"))
    assert kept.columns == ["doc_id", "text", "fp", "id"]
    assert sorted(x.doc_id for x in kept.collect()) == sorted(set(comp.values()))


def test_empty_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(empty).isEmpty() and S.keep_one(empty).isEmpty()
    rows = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (4, "a b c d"), (None, "q w e r t")], "doc_id long, text string")
    assert sorted((x.id is None, x.component_id) for x in S.near_duplicates(rows).collect() if x.component_id) == \
        [(False, 4), (True, 4), (True, 4)]
    assert sorted(x.text for x in S.keep_one(rows).collect()) == ["a b c d", "q w e r t"]


def test_columns_of_any_name_come_back(spark):
    from tidewater.llm import simhash
    docs = spark.createDataFrame([(1, "a b c d", 99, "x"), (2, "a b c d", 98, "y"), (3, "other words are here", 97, None)],
                                 "doc_id long, text string, fp int, first string")
    assert sorted((r.doc_id, r.fp, r.first) for r in simhash.keep_one(docs).select("doc_id", "fp", F.col("first")).collect()) \
        == [(1, 99, "x"), (3, 97, None)]
