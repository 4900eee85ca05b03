import pytest
from pyspark.sql import functions as F

from tidewater.config import Config
from tidewater.operators import serving, synth
from tidewater.operators.registry import latest_model_uri, load_latest, registry_table
from tidewater.plans import standins as S
from tidewater.sources.messages import paced_source
from tidewater.streaming.producer import synth_messages

from tests.paths import SF001, SF01


def test_copula_bounds_and_rank_correlation(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select(
        "l_quantity", "l_extendedprice", "l_discount", (F.col("l_returnflag") == "R").cast("int").alias("target"))
    model = synth.copula_fit(li, categorical=["target"])
    out = synth.copula_sample(model, spark.range(20000), "id", seed=7)
    pdf = out.toPandas()
    src = li.toPandas()
    for c in ["l_quantity", "l_extendedprice", "l_discount"]:
        assert pdf[c].min() >= src[c].min() and pdf[c].max() <= src[c].max()
    assert set(pdf["target"].unique()) <= {0, 1}
    a = src[["l_quantity", "l_extendedprice"]].rank().corr().iloc[0, 1]
    b = pdf[["l_quantity", "l_extendedprice"]].rank().corr().iloc[0, 1]
    assert abs(a - b) < 0.05
    assert abs(pdf["target"].mean() - src["target"].mean()) < 0.03
    # deterministic in (id, seed)
    again = synth.copula_sample(model, spark.range(5), "id", seed=7).collect()
    assert again == out.orderBy("id").limit(5).collect()


def test_paced_source_and_producer_batches(spark, tmp):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").select("l_quantity", "l_discount")
    model = synth.copula_fit(li)
    msgs = synth_messages(spark, model, rows_per_batch=10, interval_ms=2000)
    q = msgs.writeStream.format("memory").queryName("produced").trigger(processingTime="0 seconds").start()
    try:
        import time
        deadline = time.time() + 60
        while spark.table("produced").count() < 30 and time.time() < deadline:
            time.sleep(1)
    finally:
        q.stop()
    rows = spark.table("produced").withColumn("j", F.from_json("value", "batch_number int, record_id long")) \
        .select("key", "j.*").orderBy("record_id").collect()
    assert rows[0].record_id == 0 and rows[0].batch_number == 1 and rows[0].key == "0"
    assert rows[10].batch_number == 2 and rows[29].batch_number == 3
    assert paced_source(spark).isStreaming


def test_producer_stops_after_its_batches(spark, tmp):
    from tidewater.streaming.producer import produce
    model = synth.copula_fit(spark.read.parquet(f"{SF001}/lineitem.parquet").select("l_quantity", "l_discount"))
    cfg = Config(source_format="text", source_path=f"{tmp}/topic", checkpoint_path=f"{tmp}/checkpoint")
    assert produce(spark, cfg, model, max_batches=3, rows_per_batch=10, interval_ms=500) == 30
    sent = spark.read.text(f"{tmp}/topic").select(F.get_json_object("value", "$.record_id").cast("long").alias("id"))
    assert sorted(r.id for r in sent.collect()) == list(range(30))


def test_copula_with_text_and_missing_cells_at_14_columns(spark):
    ev = spark.range(3000).select(
        F.when(F.col("id") % 2 == 0, F.lit("even")).when(F.col("id") % 3 == 0, F.lit("three")).alias("word"),
        *[F.when(F.col("id") % 5 != 0, F.round(F.rand(k) * 100, 1)).alias(f"x{k}") for k in range(12)],
        (F.col("id") % 2).cast("int").alias("y"))
    model = synth.copula_fit(ev, categorical=["y"])
    out = synth.copula_sample(model, spark.range(3000), "id", seed=3).toPandas()
    assert list(out.columns) == ["id", *ev.columns]
    assert set(out["word"].dropna()) == {"even", "three"} and set(out["y"]) <= {0, 1}
    assert abs(out["word"].isna().mean() - 1 / 3) < 0.04
    assert all(abs(out[f"x{k}"].isna().mean() - 0.2) < 0.04 for k in range(12))


def test_multi_facet_matches_brute_force(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    ev = ev.withColumn("user_id", F.when(F.col("user_id") % 4 != 0, F.col("user_id")))   # rows without a value
    f = serving.multi_facet(ev, ["event_type", "user_id"], "value", size=3).collect()
    pdf = ev.toPandas()
    for name in ["event_type", "user_id"]:
        vc = pdf.dropna(subset=[name]).groupby(name).size().reset_index(name="n")
        top = vc.sort_values(["n", name], ascending=[False, True]).head(3)
        got = sorted((r.key, r.doc_count) for r in f if r.facet == name)
        assert got == sorted((str(int(k)) if name == "user_id" else k, n) for k, n in zip(top[name], top["n"]))
    total = [r for r in f if r.facet == "_all"][0]
    assert total.doc_count == len(pdf) and abs(total.avg_value - pdf["value"].mean()) < 1e-9


def test_facet_ties_by_typed_key(spark):
    df = spark.createDataFrame([(k,) for k in (9, 10, 100, None, None)], "k int")
    assert [r.key for r in serving.terms_facet(df, "k", 2).collect()] == [9, 10]
    got = serving.multi_facet(df, ["k"], size=2).where("facet = 'k'").orderBy("rank").collect()
    assert [r.key for r in got] == ["9", "10"]


def test_serving_report_and_labels(spark):
    p = spark.createDataFrame([(i, i % 2, 40 + i, f"2024-01-01 00:00:{i:02d}") for i in range(20)],
                              "record_id long, target int, age int, ts string") \
        .withColumn("event_timestamp", F.col("ts").cast("timestamp_ntz")).withColumn("sex", F.col("target"))
    s = serving.to_serving(p, ["target", "sex"])
    rep = serving.serving_report(s)
    assert rep["count"].first()["count"] == 20
    assert [r.record_id for r in rep["latest"].collect()] == [19, 18, 17, 16, 15]
    assert rep["term_target_1"].first().hits == 10
    from tidewater.functions.scalar import code_label
    labs = s.select(code_label("sex").alias("l")).groupBy("l").count().collect()
    assert {r.l: r["count"] for r in labs} == {"Male": 10, "Female": 10}
    empty = serving.serving_report(s.where("false"))
    assert list(empty) == ["count"]


def test_registry_latest_by_time_and_metric(spark, tmp):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from tidewater.operators.registry import register_model
    import time
    df = spark.createDataFrame([(float(i), float(i % 2)) for i in range(40)], "x double, label double")
    m = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                         LogisticRegression()]).fit(df)
    met = {"train_accuracy": 0.9, "test_accuracy": 0.8, "eval_accuracy": 0.8, "eval_f1_score": 0.7}
    a = register_model(spark, m, tmp, "demo", met, {"n_estimators": 1, "test_frac": 0.2})
    time.sleep(1.1)
    b = register_model(spark, m, tmp, "demo", dict(met, eval_accuracy=0.6), {"max_depth": 2})
    register_model(spark, m, tmp, "other", dict(met, eval_accuracy=0.99), {})
    with pytest.raises(ValueError, match="registry field"):
        register_model(spark, m, tmp, "demo", met, {"unheard_of": 1})
    assert a["model_version"].startswith("v_") and a["model_version"].endswith("_acc_0_8000")
    newest = latest_model_uri(spark, tmp, "demo").first().model_uri
    assert newest.endswith(b["model_uri"].split("/models/")[1])
    best = latest_model_uri(spark, tmp, "demo", by="eval_accuracy").first().model_uri
    assert best == a["model_uri"]
    reg = {r.model_uri: r for r in registry_table(spark, tmp).collect()}
    assert len(reg) == 3 and reg[a["model_uri"]].hyperparameters.n_estimators == 1
    assert reg[a["model_uri"]].hyperparameters.test_frac == 0.2 and reg[b["model_uri"]].hyperparameters.max_depth == 2
    model, prepared = load_latest(spark, tmp, "demo")
    assert model.transform(df).count() == 40 and prepared is None
    assert Config().on_error == "raise"


def test_entry_and_contract(spark):
    import __spark_entry__ as E
    out = E.entry(spark)
    assert out.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert S.EVENT_FIELDS == ["user_id", "value", "k"]
