import random
import zlib

from tidewater.llm import toxicity as T


def _docs(n=500, seed=3):
    r = random.Random(seed)
    syll = ["ba", "co", "di", "fu", "ge", "lo", "mi", "na", "pe", "ro", "su", "ti"]
    word = lambda: "".join(r.choice(syll) for _ in range(r.randint(2, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(r.randint(20, 120))]
        toxic = r.random() < 0.2
        if toxic:
            for _ in range(r.randint(2, 5)):
                words.insert(r.randrange(len(words)), r.choice(["idiot", "zorkel" + word(), "zorkel" + word(), "vlatsch"]))
        docs.append((i, " ".join(words), "en", 0))
        labels.append((i, 1, int(toxic)))
    docs += [(n, None, None, 1), (n + 1, "", "en", 1), (0, docs[0][1], "en", 0), (None, "ba co", "en", 1),
             (n + 2, "ba co di " * 30000 + "vlatsch zorkelba zorkelco zorkeldi idiot", "en", 1)]
    return docs, labels


def test_held_out_accuracy_and_odd_rows(spark, tmp):
    docs, labels = _docs()
    spark.createDataFrame(docs, "doc_id long, text string, lang string, votes int").write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(labels + [(None, 1, 1), (9999, None, None)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp}/labels.parquet")
    rows = T.op8_toxicity_weak(spark, tmp).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= .5) for r in rows)
    truth = {i: t for i, _, t in labels}
    out = [r for r in rows if r.doc_id in truth and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)
    assert sum(r.predicted == truth[r.doc_id] for r in out) / len(out) > 0.95
    by = {r.doc_id: r for r in rows}
    assert by[500].predicted == 0 and by[501].predicted == 0 and by[502].predicted == 1
    assert len({r.score for r in rows if r.doc_id == 0}) == 1
    # the filter keeps what is scored below 0.5, with all columns
    d = spark.read.parquet(f"{tmp}/documents.parquet")
    kept = T.drop_toxic(d, T.labels_of(spark, tmp))
    assert kept.columns == d.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.score < 0.5)


def test_label_model_finds_good_and_bad_voters(spark):
    r = random.Random(5)
    rows = []
    for i in range(3000):
        y = r.random() < 0.3
        v = [0] * T.VOTERS
        for j in range(6):  # voters 0-3 are right 90 %, 4 copies 3, 5 is a coin
            right = r.random() < (0.5 if j == 5 else 0.9)
            v[j] = v[3] if j == 4 else (T.TOXIC if y == right else T.CLEAN)
        rows.append(("".join(map(str, v)), int(y) if i < 200 else None, 1))
    _, model = T.label_model(spark.createDataFrame(rows, "votes string, toxic int, n long"), {0: 1.0, 1: 1.0})
    assert abs(model["prior"] - 0.3) < 0.06
    assert all(abs(model["accuracy"][j] - 0.9) < 0.06 for j in range(5)) and abs(model["accuracy"][5] - 0.5) < 0.08
    assert model["correlation"][3, 4] > 0.95 and abs(model["correlation"][0, 1]) < 0.15
    assert model["share"][4] < 0.7 * model["share"][0]


def test_no_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "you idiot"), (2, "fine day")], "doc_id long, text string")
    none = spark.createDataFrame([], "id long, toxic int")
    assert T.scores(docs, none).count() == 2
    assert T.scores(docs.where("doc_id > 5"), none).isEmpty()
