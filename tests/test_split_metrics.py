import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import metrics, prep, split
from tidewater.operators.split import key_hash60

from tests.paths import SF01


def test_split_exact_counts_and_brute_force(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey", "o_orderstatus")
    got = split.split_exact(o, "o_orderstatus", "o_orderkey", 0.2, 42)
    w = Window.partitionBy("o_orderstatus").orderBy("h", "o_orderkey")
    brute = (o.withColumn("h", key_hash60("o_orderkey", 42))
              .withColumn("rn", F.row_number().over(w))
              .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("o_orderstatus")))
              .select("o_orderkey", (F.col("rn") <= F.floor(F.col("n") * 0.2 + 0.5)).alias("want")))
    j = got.join(brute, "o_orderkey")
    assert j.count() == o.count()
    assert j.where(F.col("is_test") != F.col("want")).count() == 0
    per = {r.o_orderstatus: (r.t, r.n) for r in got.groupBy("o_orderstatus").agg(
        F.sum(F.col("is_test").cast("int")).alias("t"), F.count(F.lit(1)).alias("n")).collect()}
    for t, n in per.values():
        assert t == int(n * 0.2 + 0.5)


def test_split_hash_fraction(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    frac = split.split_hash(ev, "event_id").agg(F.avg(F.col("is_test").cast("double"))).first()[0]
    assert 0.18 < frac < 0.22


def test_metrics_match_mllib(spark):
    rows = [(float(i % 3), float((i * 7) % 3 if i % 4 else i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    m = metrics.classification_metrics(metrics.confusion(df)).first()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert abs(m.accuracy - ev.evaluate(df, {ev.metricName: "accuracy"})) < 1e-12
    assert abs(m.weighted_f1 - ev.evaluate(df, {ev.metricName: "f1"})) < 1e-12


def test_flagged_evaluation_equals_two_pass(spark):
    from tidewater.operators import model as M
    from tidewater.plans import standins as S

    li = S.lineitem_features(spark, SF01).na.fill(0.0)
    ks = split.split_hash(li.withColumn("rk", F.monotonically_increasing_id()), "rk", 0.2, 42)
    feats = list(S.LINEITEM_FEATURES)
    mdl = M.train_forest(ks.where(~F.col("is_test")), feats, "target", num_trees=5, max_depth=4)
    one = M.evaluate_flagged(mdl, ks, "is_test", "target")
    two = M.evaluate_split(mdl, ks.where(~F.col("is_test")), ks.where(F.col("is_test")), "target")
    assert one == two
    assert one["train_rows"] + one["test_rows"] == li.count()


def test_split_exact_of_repeated_rows(spark):
    rows = [(1, None, 0)] * 60 + [(None, 1, 0)] * 20 + [(i, i, 1) for i in range(100)] + [(5, 5, None)]
    df = spark.createDataFrame(rows, "a int, b int, t int")
    keyed = split.unique_key(df)
    assert keyed.select("row_key").distinct().count() == len(rows)
    for seed in (1, 2, 42):
        got = split.split_exact(keyed, "t", "row_key", 0.2, seed)
        per = {r.t: r.n for r in got.where("is_test").groupBy("t").agg(F.count("*").alias("n")).collect()}
        assert per == {0: 16, 1: 20} and got.count() == len(rows)
    with pytest.raises(ValueError, match="unique"):
        split.split_exact(df.withColumn("k", F.lit("x")), "t", "k", 0.2, 1)


def test_metrics_when_labels_and_predictions_differ(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "z"), ("b", "a")], "label string, prediction string")
    m = metrics.classification_metrics(metrics.confusion(df)).first()
    assert m.n == 3 and abs(m.accuracy - 1 / 3) < 1e-12 and abs(m.weighted_f1 - (2 / 3) * 0.5) < 1e-12
    none = metrics.classification_metrics(metrics.confusion(df.limit(0))).first()
    assert none.accuracy is None


def test_identical_rows_meet_as_one_and_are_numbered_from_one(spark):
    rows = [(1, -0.0, "a")] * 900 + [(1, 0.0, "a")] * 5 + [(None, float("nan"), None)] * 7 + [(i, 0.5, "b") for i in range(20)]
    df = spark.createDataFrame(rows, "a int, x double, s string").repartition(6)
    keyed = split.unique_key(df)
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_count" in plan         # copies are added up before the shuffle
    got = keyed.collect()
    assert sorted(str((r.a, r.x, r.s)) for r in got) == sorted(str(r) for r in rows)
    numbers = {}
    for r in got:
        whole, n = r.row_key.rsplit("-", 1)
        numbers.setdefault((whole, str((r.a, r.x, r.s))), []).append(int(n))
    assert len(numbers) == 23 and len({w for w, _ in numbers}) == 23
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in numbers.values())


def test_many_identical_rows_are_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(split, "COPIES", 10)
    df = spark.createDataFrame([(1, "a")] * 35 + [(2, "b")] * 10 + [(3, "c")] * 11, "a int, s string")
    got = [(r.a, int(r.row_key.rsplit("-", 1)[1])) for r in split.unique_key(df).collect()]
    assert sorted(got) == [(a, n) for a, k in ((1, 35), (2, 10), (3, 11)) for n in range(1, k + 1)]


def test_split_reads_its_table_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(i):
        seen.add(1)
        return i
    df = spark.range(500).select(counted("id").alias("k"), (F.col("id") % 2).alias("t"))
    assert split.split_exact(df, "t", "k", 0.2, 42).where("is_test").count() == 100
    assert seen.value == 500


def test_split_without_its_key_is_the_same(spark, monkeypatch):
    rows = [(i, float(i % 50), i % 3) for i in range(300)] + [(7, 7.0, 1)] * 40 + [(1, 1.0, None)] * 5
    keyed = split.unique_key(spark.createDataFrame(rows, "a int, x double, t int"))

    def both(n_tables):
        written = []
        write = prep.write_table
        monkeypatch.setattr(split, "write_table", lambda d: written.append(d.columns) or write(d))
        got = [split.split_exact(keyed, "t", "row_key", 0.2, 42, keep_key=k).select("a", "x", "t", "is_test") for k in (True, False)]
        assert [sorted(map(str, g.collect())) for g in got][0] == sorted(map(str, got[1].collect()))
        assert len(written) == n_tables and "row_key" in written[0] and "row_key" not in written[1]
        assert got[1].where("is_test").count() == 61 + 7

    both(2)
    few = split.key_hash60
    monkeypatch.setattr(split, "key_hash60", lambda k, seed: few(k, seed) % 25)     # hashes that several keys share
    both(3)


def test_unique_keys_are_the_hash_of_the_row_and_a_number(spark):
    df = spark.createDataFrame([(1, -0.0, 1.5), (1, 0.0, -0.0), (2, float("nan"), None), (2, float("nan"), None)], "a int, x double, y float")
    whole = F.sha2(F.to_json(F.struct("a", "x", "y"), {"ignoreNullFields": "false"}), 256)
    want = {(r.h, r.s) for r in df.select(whole.alias("h"), F.to_json(F.struct("a", "x", "y")).alias("s")).collect()}
    got = split.unique_key(df).withColumn("h", F.split("row_key", "-")[0]).select("h", "row_key", F.to_json(F.struct("a", "x", "y")).alias("s")).collect()
    assert {(r.h, r.s) for r in got} == want and len({r.row_key for r in got}) == 4
    assert [r.row_key[-2:] for r in got if '"a":2' in r.s] in (["-1", "-2"], ["-2", "-1"])
