import pytest
from pyspark.sql import functions as F

from tidewater.config import Config
from tidewater.sinks import tables as T
from tidewater.sinks.writers import write_messages
from tidewater.streaming.ingest import run_ingest


def put(spark, path, batch, rows, cols=("hour",)):
    T.write_batch(spark.createDataFrame(rows, "id long, v string, hour int"), path, batch, cols)


def rows(df):
    return sorted(tuple(r) for r in df.select("id", "v", "hour").collect())


def files(spark, path, hour):
    """Live files of one hour."""
    return len(T.read_table(spark, path).where(F.col("hour") == hour).select(F.input_file_name().alias("f")).distinct().collect())


def test_files_of_an_hour_stay_few_and_rows_stay(spark, tmp):
    want = []
    for b in range(20):
        new = [(100 * b + i, f"v{b}", i % 2) for i in range(6)]
        put(spark, tmp, b, new)
        want += new
        if b % 3 == 2:
            assert T.compact(spark, tmp, ["hour"], fanout=2)
        assert rows(T.read_table(spark, tmp)) == sorted(want)
        levels = [g["level"] for g in T.snapshot(spark, tmp)["generations"]]
        assert levels == sorted(levels, reverse=True) and len(set(levels)) == len(levels)    # one of each level at most
        assert files(spark, tmp, 0) <= 3 + 3                                                 # levels and batches since
    assert not T.read_table(spark, tmp).where("hour = 7").collect()
    T.vacuum(spark, tmp, keep=1)
    assert rows(T.read_table(spark, tmp)) == sorted(want)


def test_partition_filter_reaches_the_folders(spark, tmp):
    put(spark, tmp, 0, [(1, "a", 1), (2, "b", 2)])
    T.compact(spark, tmp, ["hour"])
    put(spark, tmp, 1, [(3, "c", 1)])
    plan = T.read_table(spark, tmp).where("hour = 1")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(hour") == 2


def test_crash_between_write_and_switch(spark, tmp, monkeypatch):
    put(spark, tmp, 0, [(1, "a", 1)])
    put(spark, tmp, 1, [(2, "b", 1)])

    def crash(*a):
        raise OSError("gone")
    monkeypatch.setattr(T, "_switch", crash)
    with pytest.raises(OSError):
        T.compact(spark, tmp, ["hour"])
    monkeypatch.undo()
    assert len(T._names(spark, f"{tmp}/generations")) == 1
    assert rows(T.read_table(spark, tmp)) == [(1, "a", 1), (2, "b", 1)]       # the stray folder is not read
    assert T.compact(spark, tmp, ["hour"]) and not T.compact(spark, tmp, ["hour"])
    assert rows(T.read_table(spark, tmp)) == [(1, "a", 1), (2, "b", 1)]
    T.vacuum(spark, tmp, keep=1)
    assert len(T._names(spark, f"{tmp}/generations")) == 1 and T._names(spark, f"{tmp}/batches") == []
    # a manifest that was cut off is passed over
    fs, p = T._fs(spark, f"{tmp}/manifest/000000000099.json")
    out = fs.create(p, False)
    out.write(bytearray(b'{"number": 99, "gen'))
    out.close()
    assert rows(T.read_table(spark, tmp)) == [(1, "a", 1), (2, "b", 1)]
    put(spark, tmp, 5, [(9, "z", 1)])
    assert T.compact(spark, tmp, ["hour"]) and T.snapshot(spark, tmp)["number"] == 100


def test_readers_go_on_while_batches_are_merged(spark, tmp):
    put(spark, tmp, 0, [(1, "a", 1)])
    put(spark, tmp, 1, [(2, "b", 1)])
    before = T.read_table(spark, tmp)
    T.compact(spark, tmp, ["hour"])
    put(spark, tmp, 2, [(3, "c", 1)])
    T.vacuum(spark, tmp, keep=2)
    T.compact(spark, tmp, ["hour"])
    assert rows(before) == [(1, "a", 1), (2, "b", 1)]
    assert rows(T.read_table(spark, tmp)) == [(1, "a", 1), (2, "b", 1), (3, "c", 1)]


def test_replayed_and_unfinished_batches(spark, tmp):
    put(spark, tmp, 0, [(1, "a", 1), (2, "b", 1)])
    put(spark, tmp, 0, [(1, "a", 1)])                                         # replaced before it was merged
    T.compact(spark, tmp, ["hour"])
    put(spark, tmp, 0, [(1, "a", 1)])                                         # replayed after
    spark.createDataFrame([(9, "x", 1)], "id long, v string, hour int").write.parquet(f"{tmp}/batches/batch_id=4")
    T._delete(spark, f"{tmp}/batches/batch_id=4/_SUCCESS")
    assert rows(T.read_table(spark, tmp)) == [(1, "a", 1)]


def test_one_row_per_key(spark, tmp):
    put(spark, tmp, 0, [(1, "a", 1), (2, "b", 1), (2, "c", 1), (None, "n", 1)], ())
    assert {(r.id, r.v) for r in T.read_table(spark, tmp, "id", ["v"]).collect()} == {(1, "a"), (2, "c"), (None, "n")}
    T.compact(spark, tmp, key="id", order_by=["v"], fanout=2)
    put(spark, tmp, 1, [(2, "a", 2), (3, "d", 2)], ())                        # an update: later batch, smaller value
    want = {1: "a", 2: "a", 3: "d", None: "n"}
    assert {r.id: r.v for r in T.read_table(spark, tmp, "id", ["v"]).collect()} == want
    for b in range(2, 6):
        put(spark, tmp, b, [(2, f"u{b}", 1), (10 + b, "x", 1)], ())
        T.compact(spark, tmp, key="id", order_by=["v"], fanout=2)
        want |= {2: f"u{b}", 10 + b: "x"}
        got = T.read_table(spark, tmp, "id", ["v"]).collect()
        assert {r.id: r.v for r in got} == want and len(got) == len(want)
    put(spark, tmp, 3, [(2, "stale", 1)], ())                                 # a replay of a merged batch
    assert {r.id: r.v for r in T.read_table(spark, tmp, "id", ["v"]).collect()} == want


def test_stream_into_snapshots(spark, tmp):
    cfg = Config(source_format="topic", source_path=f"{tmp}/topic", starting_offsets="earliest", lake_path=f"{tmp}/lake",
                 serving_path=f"{tmp}/serving", dead_letter_path=f"{tmp}/dead", checkpoint_path=f"{tmp}/checkpoint",
                 serving_key="record_id", compact_every=2)
    for n in range(5):
        message = '{{"batch_number": {0}, "record_id": {1}, "timestamp": "2024-01-01T0{0}:00:00", "data": {{"k": {0}}}}}'
        some = [(str(i), message.format(n, i)) for i in (1, 10 + n)]
        write_messages(spark.createDataFrame(some, "key string, value string"), "topic", path=cfg.source_path)
        run_ingest(spark, cfg, fields=["k"], int_fields=["k"], available_now=True).awaitTermination()
    assert T.read_table(spark, cfg.lake_path).count() == 10
    got = {r.record_id: r.k for r in T.read_table(spark, cfg.serving_path, "record_id", ["event_timestamp"]).collect()}
    assert got == {1: 4, 10: 0, 11: 1, 12: 2, 13: 3, 14: 4}
    assert T.snapshot(spark, cfg.lake_path)["upto"] >= 2
    with pytest.raises(ValueError, match="no batch"):
        T.read_table(spark, f"{tmp}/none")
