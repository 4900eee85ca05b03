import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewater.config import Config
from tidewater.plans import standins as S
from tidewater.sinks.writers import write_messages
from tidewater.sources.files import read_lake
from tidewater.streaming.ingest import run_ingest

from tests.paths import SF001


def _cfg(wd, **kw):
    base = dict(source_format="text", source_path=f"{wd}/topic", lake_path=f"{wd}/lake",
                serving_path=f"{wd}/serving", dead_letter_path=f"{wd}/dead",
                checkpoint_path=f"{wd}/checkpoint")
    base.update(kw)
    return Config(**base)


def _run(spark, cfg, **kw):
    q = run_ingest(spark, cfg, fields=S.EVENT_FIELDS, int_fields=S.EVENT_INT_FIELDS,
                   available_now=True, max_per_trigger=1, **kw)
    try:
        q.awaitTermination()
    except StreamingQueryException:
        pass
    return q


def test_ingest_exact_totals_and_layout(spark, tmp):
    msgs = S.event_messages(spark, SF001, keep=("event_id",))
    write_messages(msgs, "text", path=f"{tmp}/topic", num_files=3, order_by="event_id")
    # malformed messages go to quarantine, not to the lake
    spark.createDataFrame([("not json",), ('{"record_id": 1, "timestamp": "bad"}',)], "value string") \
        .write.mode("append").text(f"{tmp}/topic")
    cfg = _cfg(tmp)
    q = _run(spark, cfg)
    assert q.exception() is None
    lake = read_lake(spark, cfg.lake_path)
    assert lake.count() == 1000
    assert dict(lake.dtypes)["date"] == "date" and dict(lake.dtypes)["hour"] == "int"
    assert lake.select("record_id").distinct().count() == 1000
    serving = spark.read.parquet(cfg.serving_path)
    assert serving.count() == 1000
    dead = spark.read.parquet(f"{cfg.dead_letter_path}/quarantine")
    assert dead.count() == 2
    # restart with the same checkpoint: nothing is re-ingested
    _run(spark, cfg)
    assert read_lake(spark, cfg.lake_path).count() == 1000


def test_failed_batch_is_replayed_once(spark, tmp, monkeypatch):
    """The lake fails after the serving table was written: the replay must not write the
    serving rows a second time."""
    from tidewater.streaming import ingest as I
    msgs = S.event_messages(spark, SF001, keep=("event_id",))
    write_messages(msgs, "text", path=f"{tmp}/topic", num_files=2, order_by="event_id")
    cfg = _cfg(tmp)

    def broken(*a, **k):
        raise OSError("lake is away")
    monkeypatch.setattr(I, "write_lake", broken)
    q = _run(spark, cfg)
    assert q.exception() is not None                  # raise: checkpoint not advanced
    before = spark.read.parquet(cfg.serving_path).count()
    assert 0 < before < 1000                          # the first batch was served, the lake has nothing
    monkeypatch.undo()
    q = _run(spark, cfg)
    assert q.exception() is None
    for path in (cfg.lake_path, cfg.serving_path):
        got = read_lake(spark, path)
        assert got.count() == 1000 and got.select("record_id").distinct().count() == 1000


def test_isolate_mode_dead_letters(spark, tmp):
    msgs = S.event_messages(spark, SF001)
    write_messages(msgs, "text", path=f"{tmp}/topic", num_files=1)
    cfg = _cfg(tmp, serving_format="no-such-format", on_error="isolate")
    q = _run(spark, cfg)
    assert q.exception() is None
    failed = spark.read.parquet(f"{cfg.dead_letter_path}/failed")
    assert failed.where(F.col("failed_sink") == "serving").count() == 1000
    assert read_lake(spark, cfg.lake_path).count() == 1000


def test_dedupe_keeps_every_broken_message(spark, tmp):
    msgs = S.event_messages(spark, SF001)
    write_messages(msgs, "text", path=f"{tmp}/topic", num_files=1)
    write_messages(msgs, "text", path=f"{tmp}/topic", num_files=1)   # producer retry: every id twice
    spark.createDataFrame([("not json",), ("not json",), ("{}",), ('{"record_id": 1, "timestamp": "bad"}',)], "value string") \
        .write.mode("append").text(f"{tmp}/topic")
    cfg = _cfg(tmp)
    q = _run(spark, cfg, dedupe_within="1 hour")
    assert read_lake(spark, cfg.lake_path).count() == 1000
    assert spark.read.parquet(f"{cfg.dead_letter_path}/quarantine").count() == 4
    rejected = spark.read.parquet(f"{cfg.dead_letter_path}/rejected")
    assert q.exception() is None
    assert rejected.count() == 1000 == rejected.select("record_id").distinct().count()   # repeats, most of them late
    assert rejected.where("raw_value IS NULL OR outcome NOT IN ('duplicate', 'late')").isEmpty()


def _messages(spark, *rows):
    return spark.createDataFrame([(str(i), f'{{"batch_number": 1, "record_id": {i}, "timestamp": "{t}", "data": {{"k": 1}}}}') for i, t in rows],
                                 "key string, value string")


def test_late_rows_and_repeats_are_kept(spark, tmp):
    cfg = _cfg(tmp, source_format="topic", starting_offsets="earliest")

    def run(*rows):
        write_messages(_messages(spark, *rows), "topic", path=cfg.source_path)
        q = run_ingest(spark, cfg, fields=["k"], int_fields=["k"], available_now=True, dedupe_within="1 hour")
        q.awaitTermination()

    def rejected():
        return sorted((r.record_id, r.outcome) for r in spark.read.parquet(f"{cfg.dead_letter_path}/rejected").collect())
    run((1, "2024-01-01T00:00:00"), (2, "2024-01-02T00:00:00"), (2, "2024-01-02T00:00:00"))
    assert rejected() == [(2, "duplicate")]
    run((3, "2024-01-01T22:59:59"), (4, "2024-01-01T23:00:00"),      # the watermark is at 23:00
        (1, "2024-01-01T00:00:00"),                                  # its state has ended
        (2, "2024-01-02T00:00:00"))                                  # still held
    assert rejected() == [(1, "late"), (2, "duplicate"), (2, "duplicate"), (3, "late")]
    run((5, "2024-01-03T00:00:00"))
    run((2, "2024-01-03T00:30:00"), (2, "2024-01-03T00:31:00"))      # a reused id, after its time: new, then a repeat
    assert rejected() == [(1, "late"), (2, "duplicate"), (2, "duplicate"), (2, "duplicate"), (3, "late")]
    assert sorted(r.record_id for r in read_lake(spark, cfg.lake_path).collect()) == [1, 2, 2, 4, 5]


def test_missing_dead_letter_folder_rejected(spark, tmp):
    with pytest.raises(ValueError, match="dead_letter_path"):
        run_ingest(spark, _cfg(tmp, dead_letter_path=None), available_now=True)


def test_missing_checkpoint_rejected(spark, tmp):
    with pytest.raises(ValueError):
        run_ingest(spark, _cfg(tmp, checkpoint_path=None), available_now=True)


def test_deduplicated_batches_write_an_hour_in_one_file(spark, tmp):
    write_messages(S.event_messages(spark, SF001), "text", path=f"{tmp}/topic", num_files=1)
    cfg = _cfg(tmp)
    _run(spark, cfg, dedupe_within="1 hour")
    files = read_lake(spark, cfg.lake_path).select("date", "hour", F.input_file_name().alias("file")).distinct()
    assert {r["count"] for r in files.groupBy("date", "hour").count().collect()} == {1}


def test_keys_of_one_bucket_are_told_apart(spark, tmp, monkeypatch):
    from tidewater.streaming import dedupe
    monkeypatch.setattr(dedupe, "BUCKETS", 1)
    test_late_rows_and_repeats_are_kept(spark, tmp)


def test_state_has_partitions_by_cores(spark):
    from tidewater.session import session_conf
    from tidewater.streaming import dedupe
    for asked, got in ((5, 5), (1000, max(32, 2 * spark.sparkContext.defaultParallelism))):
        with session_conf(spark, {"spark.sql.shuffle.partitions": str(asked)}), dedupe.state_conf(spark):
            assert spark.conf.get("spark.sql.shuffle.partitions") == str(got)
