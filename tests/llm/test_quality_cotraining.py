import random
import zlib

from tidewater.llm import quality as Q


def test_held_out_accuracy_and_odd_rows(spark, tmp):
    r = random.Random(6)
    docs, labels = [], []
    for i in range(600):
        bad = r.random() < 0.25
        words = ["w" + str(r.randrange(400)) for _ in range(r.randint(30, 80))]
        if bad:
            words = [w + "&&&" for w in words] if r.random() < .5 else [w for w in words[:6] for _ in range(8)]
        text = " ".join(words) if bad and r.random() < .8 else "\n".join(" ".join(words[k:k + 9]) for k in range(0, len(words), 9))
        docs.append((i, text, r.choice(["en", None]), r.choice(["s1", "s2"]), 5))
        if i % 2 or i % 5 == 0:
            labels.append((i, int(not bad), 0))
    docs += [(900, None, None, None, 1), (901, "", "en", "s1", 1), (None, "a b c", "en", "s1", 1), (902, "w1 w2\n" * 40000, "en", "s1", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, fold int").write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    got = Q.op2_cotraining_quality(spark, tmp).collect()
    assert len(got) == len(docs) and all(0 <= x.score <= 1 for x in got)
    truth = {i: y for i, y, _ in labels}
    out = [x for x in got if x.held_out and x.doc_id in truth]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in got if x.doc_id is not None)
    assert len(out) > 40 and sum(x.predicted == truth[x.doc_id] for x in out) / len(out) > 0.93


def test_no_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s")], "doc_id long, text string, lang string, source string")
    none = spark.createDataFrame([], "id long, quality int")
    assert [x.score for x in Q.scores(docs, none).collect()] == [0.5]
    assert Q.scores(docs.limit(0), none).isEmpty()
