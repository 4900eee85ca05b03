
from pyspark.sql import functions as F

from tidewater.functions.envelope import to_envelope
from tidewater.functions.parse import parse_messages, split_quarantine
from tidewater.schemas import FEATURES

GOOD = ('{"batch_number": 1, "record_id": 0, "timestamp": "2024-01-01T10:20:30.5", '
        '"data": {"age": 63.0, "sex": 1, "cp": 3.0, "trestbps": 145.0, "chol": 233.0, "fbs": 1.0, '
        '"restecg": 0.0, "thalach": 150.0, "exang": 0.0, "oldpeak": 2.3, "slope": 0.0, "ca": 0.0, '
        '"thal": 1.0, "target": 1.0}}')


def _parse(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return parse_messages(df).collect()


def test_well_formed(spark):
    r = _parse(spark, [GOOD])[0]
    assert r.batch_number == 1 and r.record_id == 0
    assert r.age == 63 and r.sex == 1 and r.target == 1
    assert abs(r.oldpeak - 2.3) < 1e-6
    assert str(r.event_timestamp) == "2024-01-01 10:20:30.500000"
    assert str(r.date) == "2024-01-01" and r.hour == 10


def test_edge_rows(spark):
    rows = _parse(spark, [
        GOOD.replace('"age": 63.0', '"age": NaN'),
        "not json",
        None,
        '{"batch_number": 2, "record_id": 5, "timestamp": "2024-01-01T00:00:00"}',
        GOOD.replace('"batch_number": 1', '"batch_number": "x"'),
        GOOD.replace('"target": 1.0}', '"target": 1.0, "extra": 7}'),
        GOOD.replace("2024-01-01T10:20:30.5", "yesterday"),
        GOOD.replace('"cp": 3.0', '"cp": 1.9').replace('"slope": 0.0', '"slope": -1.9'),
        GOOD.replace('"chol": 233.0', '"chol": 3e10'),
    ])
    nan, bad_json, null, no_data, bad_type, extra, bad_ts, frac, big = rows
    assert nan.age is None and nan.sex == 1                      # NaN -> NULL int, not 0
    for r in (bad_json, null):
        assert r.batch_number is None and r.record_id is None and r.event_timestamp is None
    assert no_data.record_id == 5 and no_data.age is None
    assert bad_type.batch_number is None and bad_type.record_id == 0
    assert extra.target == 1
    assert bad_ts.event_timestamp is None and bad_ts.date is None
    assert frac.cp == 1 and frac.slope == -1                     # truncation
    assert big.chol is None                                      # overflow -> NULL


def test_quarantine_split(spark):
    df = spark.createDataFrame([(GOOD,), ("not json",), (GOOD.replace("2024", "20x4"),)], "value string")
    good, bad = split_quarantine(parse_messages(df))
    assert good.count() == 1 and bad.count() == 2


def test_envelope_round_trip(spark):
    src = spark.createDataFrame(
        [(i, f"2024-01-0{1 + i % 3} 0{i % 10}:00:00", float(i), float(i % 2)) for i in range(25)],
        "record_id long, ts string, age double, target double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    env = to_envelope(src, record_id="record_id", timestamp="ts", data=["age", "target"], batch_size=10)
    back = parse_messages(env, fields=["age", "target"], int_fields=["age", "target"]).orderBy("record_id").collect()
    assert [r.batch_number for r in back[:11]] == [1] * 10 + [2]
    assert [r.age for r in back] == list(range(25))
    assert back[7].event_timestamp.hour == 7
    keys = env.orderBy("key").select("key").collect()
    assert keys[0].key == "0"


def test_envelope_keeps_nulls_on_request(spark):
    src = spark.createDataFrame([(1, None)], "record_id long, age double").withColumn(
        "ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    v1 = to_envelope(src, timestamp="ts", data=["age"]).first().value
    v2 = to_envelope(src, timestamp="ts", data=["age"], keep_nulls=True).first().value
    assert '"age"' not in v1 and '"age":null' in v2
    assert len(FEATURES) == 14
