import random

import numpy as np

import corpus_pipeline as P
from tidewater.llm import mixing, pieces, simhash, toxicity
from .test_mixing import water_fill
from .test_repeats import brute as repeats_brute
from .test_simhash import brute_components


def _docs():
    r = random.Random(9)
    word = lambda: "".join(r.choice(["ba", "co", "di", "fu", "ge", "lo", "mi"]) for _ in range(r.randint(2, 4)))
    rows, labels = [], []
    shared = " ".join(word() for _ in range(51))
    for i in range(260):
        words = [word() for _ in range(r.randint(30, 90))]
        toxic = r.random() < 0.25
        if toxic:
            words[5:5] = ["idiot", "zorkel" + word(), "vlatsch"]
        if i % 20 == 0:
            words[3:3] = [shared]
        rows.append((i, " ".join(words), "en", "s" + str(i % 4), 0))
        labels.append((i, 1, int(toxic)))
    rows += [(300 + i, rows[i][1], "en", "s0", 0) for i in range(10)] + [(400, "", "en", "s1", 0), (401, None, None, None, 0)]
    return [(*x[:4], len(x[1] or "")) for x in rows], labels


def test_pipeline_equals_its_stages_by_brute_force(spark, tmp):
    rows, labels = _docs()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash", "suffix_repeats", "mixing", "sentencepiece"]
    got = P.run(spark, tmp).collect()

    scored = {r.id: r.score for r in toxicity.scores(spark.read.parquet(f"{tmp}/documents.parquet"), toxicity.labels_of(spark, tmp)).collect()}
    left = [r for r in rows if scored[r[0]] < 0.5]
    assert {i for i, _, t in labels if t} - {r[0] for r in left} and len(left) < len(rows)
    comp = brute_components([(r[0], simhash.fingerprint(r[1])) for r in left])
    left = [r for r in left if comp[r[0]] == r[0]]
    cut = {x[0]: x[2] for x in repeats_brute([(r[0], (r[1] or "").encode()) for r in left], P.REPEAT_BYTES)}
    assert sum(cut.values()) > 0
    seen = {}
    for r in left:
        t = (r[1] or "").encode()
        for s in range(len(t) - P.REPEAT_BYTES + 1):
            seen[t[s:s + P.REPEAT_BYTES]] = seen.get(t[s:s + P.REPEAT_BYTES], 0) + 1
    texts = {}
    for r in left:
        t = (r[1] or "").encode()
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - P.REPEAT_BYTES + 1):
            if seen[t[s:s + P.REPEAT_BYTES]] > 1:
                gone[s:s + P.REPEAT_BYTES] = True
        texts[r[0]] = bytes(b for b, g in zip(t, gone) if not g).decode("utf-8", "ignore")
    sizes = {}
    for r in left:
        sizes[r[3]] = sizes.get(r[3], 0) + len(texts[r[0]].split())
    want = water_fill(sizes)
    taken, codec = dict.fromkeys(sizes, 0), pieces.Codec(pieces.load_pieces(pieces.default_model()))
    source = {r[0]: r[3] for r in left}
    for g in got:
        assert g.ids == codec.encode(texts[g.doc_id]).tolist() and g.n_ids == len(g.ids)
        taken[source[g.doc_id]] += len(texts[g.doc_id].split())
    assert all(abs(taken[s] - want[s]) <= 60 for s in sizes if s)
    assert mixing.MAX_REPEATS >= max(sum(g.doc_id == i for g in got) for i in texts)


def test_empty_tables(spark, tmp):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    assert P.run(spark, tmp).isEmpty()
