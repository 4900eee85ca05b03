import json
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewater.sources import topic as T
from tidewater.sources.messages import read_messages
from tidewater.sinks.writers import write_messages


def rows(spark, a, b):
    return spark.range(a, b).select(F.col("id").cast("string").alias("key"), F.concat(F.lit("v"), "id").alias("value")).repartition(3)


def stream(spark, path, wd, name, **options):
    q = (read_messages(spark, "topic", path=path, **options).writeStream.format("parquet").option("path", f"{wd}/{name}")
         .option("checkpointLocation", f"{wd}/{name}-checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return sorted(int(r.key) for r in spark.read.parquet(f"{wd}/{name}").collect())


def test_offsets_count_each_partition_and_keys_come_back(spark, tmp):
    T.send(rows(spark, 0, 50), f"{tmp}/t")
    T.send(rows(spark, 50, 120), f"{tmp}/t")
    got = T.read_topic(spark, f"{tmp}/t").collect()
    assert sorted(int(r.key) for r in got) == list(range(120)) and all(r.value == f"v{r.key}" for r in got)
    by: dict = {}
    for r in got:
        by.setdefault(r.partition, []).append(r.offset)
        assert r.partition == T.partition_of(r.key, T.PARTITIONS)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert T.newest(f"{tmp}/t").next == {str(p): len(by[p]) for p in range(T.PARTITIONS)}
    # a range by JSON offsets
    part = T.read_topic(spark, f"{tmp}/t", startingOffsets=json.dumps({"0": 3}), endingOffsets=json.dumps({"0": 5}))
    assert sorted((r.partition, r.offset) for r in part.collect()) == [(0, 3), (0, 4)]


def test_a_send_counts_once(spark, tmp):
    T.send(rows(spark, 0, 40), f"{tmp}/t", txn="a")
    T.send(rows(spark, 0, 40), f"{tmp}/t", txn="a")          # a retry under the same name
    T.send(rows(spark, 40, 60), f"{tmp}/t", txn="b")
    assert T.read_topic(spark, f"{tmp}/t").count() == 60
    import os
    listed = {f[0] for n in T._numbers(f"{tmp}/t") for f in T._entry(f"{tmp}/t", n).files}
    assert listed == set(os.listdir(f"{tmp}/t/data"))        # the retry's files are gone


def test_a_failed_send_leaves_nothing(spark, tmp):
    T.send(rows(spark, 0, 10), f"{tmp}/t", txn="a")
    bad = rows(spark, 10, 30).withColumn("value", F.when(F.col("key") == "25", F.raise_error(F.lit("broken"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="broken"):
        T.send(bad, f"{tmp}/t", txn="b")
    assert T.read_topic(spark, f"{tmp}/t").count() == 10
    T.send(rows(spark, 10, 30), f"{tmp}/t", txn="b")
    assert sorted(int(r.key) for r in T.read_topic(spark, f"{tmp}/t").collect()) == list(range(30))


def test_two_writers_at_once_both_count(tmp):
    import os
    os.makedirs(f"{tmp}/t/data")
    first = T.newest(f"{tmp}/t")
    assert T.add(f"{tmp}/t", [("x", 0, 5)], 2, None)
    assert not T._append(f"{tmp}/t", T.Entry(first.number + 1))   # the number is taken
    assert T.add(f"{tmp}/t", [("y", 0, 3)], 2, None)
    assert T.newest(f"{tmp}/t").next == {"0": 8, "1": 0}


def test_starting_offsets(spark, tmp):
    T.send(rows(spark, 0, 30), f"{tmp}/t")
    assert stream(spark, f"{tmp}/t", tmp, "all", starting_offsets="earliest") == list(range(30))
    held = {str(p): 0 for p in range(T.PARTITIONS)}
    held["1"] = T.newest(f"{tmp}/t").next["1"]
    some = stream(spark, f"{tmp}/t", tmp, "some", starting_offsets=json.dumps(held))
    assert some == [i for i in range(30) if T.partition_of(str(i), T.PARTITIONS) != 1]
    q = (read_messages(spark, "topic", path=f"{tmp}/t", starting_offsets="latest").writeStream.format("parquet")
         .option("path", f"{tmp}/new").option("checkpointLocation", f"{tmp}/new-checkpoint").trigger(processingTime="100 milliseconds").start())
    try:
        q.processAllAvailable()
        T.send(rows(spark, 30, 45), f"{tmp}/t")
        end = time.time() + 60
        while time.time() < end and spark.read.schema("key string").parquet(f"{tmp}/new").count() < 15:
            q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(int(r.key) for r in spark.read.parquet(f"{tmp}/new").collect()) == list(range(30, 45))
    # a restart goes on where the checkpoint ends, whatever the option says
    T.send(rows(spark, 45, 50), f"{tmp}/t")
    assert stream(spark, f"{tmp}/t", tmp, "all", starting_offsets="latest") == list(range(50))


def test_loss_policy(spark, tmp):
    T.send(rows(spark, 0, 40), f"{tmp}/t")
    assert stream(spark, f"{tmp}/t", tmp, "seen", starting_offsets="earliest") == list(range(40))
    T.send(rows(spark, 40, 60), f"{tmp}/t")
    T.expire(f"{tmp}/t", T.newest(f"{tmp}/t").next)
    T.send(rows(spark, 60, 70), f"{tmp}/t")
    assert sorted(int(r.key) for r in T.read_topic(spark, f"{tmp}/t").collect()) == list(range(60, 70))
    with pytest.raises(StreamingQueryException, match="have been removed"):
        stream(spark, f"{tmp}/t", tmp, "seen", starting_offsets="earliest", fail_on_data_loss=True)
    assert stream(spark, f"{tmp}/t", tmp, "seen", starting_offsets="earliest", fail_on_data_loss=False) \
        == list(range(40)) + list(range(60, 70))


def test_batch_size_is_refused(spark, tmp):
    with pytest.raises(ValueError, match="max_per_trigger"):
        read_messages(spark, "topic", path=f"{tmp}/t", max_per_trigger=20)


def test_stream_to_topic_counts_a_replayed_batch_once(spark, tmp):
    rows(spark, 0, 30).write.parquet(f"{tmp}/in")
    for _ in range(2):                                       # the second run has lost its checkpoint: batch 0 comes again
        q = (spark.readStream.schema("key string, value string").parquet(f"{tmp}/in").writeStream
             .format(T.register(spark)).option("path", f"{tmp}/t").option("txn", "copy")
             .option("checkpointLocation", f"{tmp}/checkpoint-{_}").trigger(availableNow=True).start())
        q.awaitTermination()
    assert T.read_topic(spark, f"{tmp}/t").count() == 30


def test_null_keys_and_empty_topics(spark, tmp):
    write_messages(spark.createDataFrame([(None, "x"), ("k", None)], "key string, value string"), "topic", path=f"{tmp}/t")
    assert sorted((r.key or "", r.value or "", r.offset) for r in T.read_topic(spark, f"{tmp}/t").collect())[0] == ("", "x", 0)
    assert T.read_topic(spark, f"{tmp}/none").count() == 0
