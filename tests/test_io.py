from pyspark.sql import functions as F

from tidewater.operators.metrics import mean_log_loss
from tidewater.schemas import SERVING
from tidewater.sinks.writers import create_serving_table, sample_rows, write_csv
from tidewater.sources.files import describe_table, list_objects, read_csv, read_lake, table_exists
from tidewater.schemas import raw_schema
from tidewater.streaming.facets import live_facets

from tests.paths import SF001


def test_csv_round_trip_and_listing(spark, tmp):
    df = spark.createDataFrame([(63, 1.5), (41, None)], "age int, oldpeak float")
    write_csv(df, f"{tmp}/csv")
    back = read_csv(spark, f"{tmp}/csv", schema=raw_schema(["age", "oldpeak"]))
    assert sorted(back.collect(), key=lambda r: r.age) == sorted(df.collect(), key=lambda r: r.age)
    files = list_objects(spark, tmp, "*.csv")
    assert files.count() >= 1 and set(files.columns) == {"path", "modificationTime", "length"}


def test_describe_and_lake_reads_all_files(spark, tmp):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    d = describe_table(ev).first()
    assert d.row_count == 1000 and d.field_count == 6 and d.partition_count >= 1
    ev.withColumn("date", F.to_date("ts")).write.partitionBy("date").parquet(f"{tmp}/lake")
    lake = read_lake(spark, f"{tmp}/lake")
    assert "date" in lake.columns and lake.count() == 1000


def test_serving_ddl_keep_and_recreate(spark, tmp):
    name = "serving_test_tbl"
    assert create_serving_table(spark, name, SERVING, location=f"{tmp}/tbl", if_exists="recreate")
    assert table_exists(spark, name)
    assert not create_serving_table(spark, name, SERVING, location=f"{tmp}/tbl", if_exists="keep")
    assert dict(spark.table(name).dtypes)["target"] == "string"
    spark.sql(f"DROP TABLE {name}")


def test_sample_rows_and_log_loss(spark):
    df = spark.createDataFrame([(3, 1, 50, 0), (1, 0, 60, 1)], "record_id long, sex int, age int, target int")
    assert sample_rows(df).first().record_id == 1
    from pyspark.ml.linalg import Vectors
    pred = spark.createDataFrame([(0.0, Vectors.dense([0.8, 0.2])), (1.0, Vectors.dense([0.4, 0.6]))],
                                 ["label", "probability"])
    import math
    got = mean_log_loss(pred).first().log_loss
    assert abs(got - (-(math.log(0.8) + math.log(0.6)) / 2)) < 1e-12


def test_live_facets_stream(spark, tmp):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ev.write.parquet(f"{tmp}/ev")
    s = spark.readStream.schema(ev.schema).parquet(f"{tmp}/ev")
    q = (live_facets(s, "event_type", ts="ts", window="1 day", delay="0 seconds")
         .writeStream.format("memory").queryName("live_f").outputMode("complete")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("live_f").agg(F.sum("doc_count")).first()[0]
    assert got == 1000


def test_session_conf_restores_settings(spark):
    from tidewater.session import session_conf

    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(key)
    with session_conf(spark, {key: "128k", "spark.sql.shuffle.partitions": "3"}):
        assert spark.conf.get(key) == "128k"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get(key) == before
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
