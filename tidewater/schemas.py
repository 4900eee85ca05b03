"""Record layouts: message envelope, payload, processed row, serving table.

Column lists are parameters everywhere; the defaults below describe the 14-column
tabular classification record the ingest path was built for."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the record layout the message producer and consumer agree on ---
FEATURES = [
    "age", "sex", "cp", "trestbps", "chol", "fbs", "restecg",
    "thalach", "exang", "oldpeak", "slope", "ca", "thal", "target",
]
FLOAT_FIELDS = ["oldpeak"]
CLIP_COLUMNS = ["age", "trestbps", "chol", "thalach", "oldpeak"]
LABEL = "target"
# serving-table fields stored as keyword (string) values
KEYWORD_FIELDS = ["sex", "cp", "fbs", "restecg", "exang", "slope", "ca", "thal", "target"]
# --- end fixed values ---

INT_FIELDS = [f for f in FEATURES if f not in FLOAT_FIELDS]


def payload_schema(fields: list[str] = FEATURES) -> T.StructType:
    """Payload numbers travel as floats (a mixed row is upcast before encoding)."""
    return T.StructType([T.StructField(f, T.FloatType(), True) for f in fields])


def envelope_schema(payload: T.StructType | None = None) -> T.StructType:
    return T.StructType([
        T.StructField("batch_number", T.IntegerType(), True),
        T.StructField("record_id", T.LongType(), True),
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("data", payload if payload is not None else payload_schema(), True),
    ])


PAYLOAD = payload_schema()
ENVELOPE = envelope_schema(PAYLOAD)


def raw_schema(fields: list[str] = FEATURES, float_fields: list[str] = FLOAT_FIELDS) -> T.StructType:
    """Raw training CSV: ints except the float fields."""
    return T.StructType([
        T.StructField(f, T.FloatType() if f in float_fields else T.IntegerType(), True)
        for f in fields
    ])


RAW = raw_schema()


def serving_schema(fields: list[str] = FEATURES, keyword: list[str] = KEYWORD_FIELDS,
                   float_fields: list[str] = FLOAT_FIELDS) -> T.StructType:
    cols = [
        T.StructField("batch_number", T.IntegerType(), True),
        T.StructField("record_id", T.LongType(), True),
        T.StructField("event_timestamp", T.TimestampNTZType(), True),
    ]
    for f in fields:
        if f in keyword:
            t = T.StringType()
        elif f in float_fields:
            t = T.FloatType()
        else:
            t = T.IntegerType()
        cols.append(T.StructField(f, t, True))
    return T.StructType(cols)


SERVING = serving_schema()

REGISTRY = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("hyperparameters", T.StructType([
        T.StructField("n_estimators", T.IntegerType()),
        T.StructField("max_depth", T.IntegerType()),
        T.StructField("min_instances_per_node", T.IntegerType()),
        T.StructField("seed", T.LongType()),
        T.StructField("test_frac", T.DoubleType()),
    ])),
    T.StructField("metrics", T.StructType([
        T.StructField("train_accuracy", T.DoubleType()),
        T.StructField("test_accuracy", T.DoubleType()),
        T.StructField("eval_accuracy", T.DoubleType()),
        T.StructField("eval_f1_score", T.DoubleType()),
    ])),
    T.StructField("model_type", T.StringType()),
    T.StructField("framework", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("model_uri", T.StringType()),
    T.StructField("preparation", T.StringType()),
])
