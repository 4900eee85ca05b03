import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.operators.newest import hour_folders, newest_n
from tidewater.operators.serving import latest_n
from tidewater.sinks import tables
from tidewater.sinks.writers import write_lake
from tidewater.sources.files import read_lake

START = dt.datetime(2024, 1, 30, 0, 0)


@pytest.fixture()
def lake(spark, tmp):
    rows = [(i, START + dt.timedelta(minutes=20 * (i // 2)), "rare" if i == 5 else f"t{i % 3}") for i in range(240)]    # 40 hours; ties in time
    rows += [(1000, None, "rare")]
    df = spark.createDataFrame(rows, "record_id long, event_timestamp timestamp_ntz, term string")
    df = df.withColumn("date", F.to_date("event_timestamp")).withColumn("hour", F.hour("event_timestamp"))
    write_lake(df, f"{tmp}/lake")
    return f"{tmp}/lake"


def ids(df):
    return [r["record_id"] for r in df.collect()]


def test_folders_from_the_newest(spark, lake):
    names = [f.split("/", -1)[-2:] for f in hour_folders(spark, lake)]
    assert names[0] == ["date=2024-01-31", "hour=15"] and names[6][1] == "hour=9" and names[16] == ["date=2024-01-30", "hour=23"]
    assert "__HIVE" in names[-1][0] and len(names) == 41


@pytest.mark.parametrize("n", [1, 5, 6, 7, 50, 240, 241, 500])
def test_equal_to_the_scan_of_all(spark, lake, n):
    assert ids(newest_n(spark, lake, n)) == ids(latest_n(read_lake(spark, lake), n))


def test_reads_only_the_newest_folders(spark, lake):
    few = newest_n(spark, lake, 5)
    assert {f.split("/")[-3] if "batch" in f.split("/")[-2] else f.split("/")[-2] for f in few.inputFiles()} == {"hour=15"}
    assert len(newest_n(spark, lake, 20).inputFiles()) < len(read_lake(spark, lake).inputFiles()) / 4


def test_filter(spark, lake):
    rare = F.col("term") == "rare"
    assert ids(newest_n(spark, lake, 2, rare)) == ids(latest_n(read_lake(spark, lake).where(rare), 2)) == [5, 1000]
    assert ids(newest_n(spark, lake, 3, F.col("term") == "t1")) == ids(latest_n(read_lake(spark, lake).where("term = 't1'"), 3))
    assert ids(newest_n(spark, lake, 3, F.col("term") == "none")) == []


def test_no_lake(spark, tmp):
    with pytest.raises(FileNotFoundError):
        newest_n(spark, f"{tmp}/nothing")


def test_clustered_files_hold_few_terms(spark, tmp):
    rows = spark.range(4000).select("id", (F.col("id") % 40).cast("int").alias("term"), (F.col("id") % 2).cast("int").alias("hour"))
    tables.write_batch(rows, tmp, 0, ["hour"])
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")              # so small a table would become one file
    try:
        tables.compact(spark, tmp, ["hour"], cluster_by=["term"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    got = tables.read_table(spark, tmp).withColumn("f", F.input_file_name())
    assert got.count() == 4000 and got.select("id").distinct().count() == 4000
    spans = got.groupBy("f").agg(F.min("term").alias("lo"), F.max("term").alias("hi")).collect()
    assert len(spans) >= 6 and sum(r["lo"] <= 7 <= r["hi"] for r in spans) <= 2


def test_a_hot_term_is_split(spark, tmp):
    rows = spark.range(4000).select("id", F.lit(1).alias("term"), F.lit(0).alias("hour"))
    tables.write_batch(rows, tmp, 0, ["hour"])
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tables.compact(spark, tmp, ["hour"], cluster_by=["term"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    sizes = [r["count"] for r in tables.read_table(spark, tmp).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2000
