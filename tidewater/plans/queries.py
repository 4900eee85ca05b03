"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole input tables; ``ORACLE`` holds the DuckDB SQL that must give the same rows.

Computed columns carry the same alias on both sides; doubles that come out of
different summation orders are rounded to 6 places on both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.functions.parse import parse_messages
from tidewater.functions.scalar import code_label
from tidewater.operators import serving
from tidewater.plans import standins as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- ingest parsing

_PARSED_SQL = """
SELECT CAST(floor(event_id / 10) + 1 AS INTEGER) AS batch_number,
       event_id AS record_id,
       ts AS event_timestamp,
       CAST(CAST(user_id AS FLOAT) AS INTEGER) AS user_id,
       round(CAST(CAST(value AS FLOAT) AS DOUBLE), 4) AS value,
       CAST(CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS FLOAT) AS INTEGER) AS k,
       CAST(ts AS DATE) AS date,
       CAST(hour(ts) AS INTEGER) AS hour
FROM events
"""

_PARSED_COLS = ["batch_number", "record_id", "event_timestamp", "user_id", "value", "k", "date", "hour"]


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = S.event_messages(spark, sf_dir)
    return parse_messages(msgs, fields=S.EVENT_FIELDS, int_fields=S.EVENT_INT_FIELDS)


def _final_parsed(df: DataFrame) -> DataFrame:
    return (df.withColumn("value", F.round(F.col("value").cast("double"), 4))
              .select(*_PARSED_COLS))


@register("parse_flatten", _PARSED_SQL)
def q_parse_flatten(spark, sf_dir):
    """Envelope round trip: table -> JSON messages -> parse -> flat typed rows."""
    return _final_parsed(parsed_events(spark, sf_dir))


@register("json_props", """
SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def q_json_props(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events")
    return ev.select("event_id", "event_type", S.props_k().alias("k"))


# ---------------------------------------------------------------- serving queries

@register("count_rows", "SELECT count(*) AS count FROM events")
def q_count_rows(spark, sf_dir):
    return serving.count_rows(S.table(spark, sf_dir, "events"))


@register("latest_n", "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 5")
def q_latest_n(spark, sf_dir):
    return serving.latest_n(S.table(spark, sf_dir, "events"), 5, ts="ts", tiebreak="event_id")


@register("term_count", """
SELECT count(*) AS hits, count(event_type) AS value_count FROM events WHERE event_type = 'click'
""")
def q_term_count(spark, sf_dir):
    return serving.term_count(S.table(spark, sf_dir, "events"), "event_type", "click")


@register("facet_terms", """
SELECT user_id AS key, count(*) AS doc_count FROM events WHERE user_id IS NOT NULL
GROUP BY user_id ORDER BY doc_count DESC, key ASC LIMIT 10
""")
def q_facet_terms(spark, sf_dir):
    return serving.terms_facet(S.table(spark, sf_dir, "events"), "user_id", 10)


# each facet by itself: rows with a value, most frequent first, equal counts by the typed key
_FACET_MULTI_SQL = """
SELECT 'event_type' AS facet, key, doc_count, avg_value, rank FROM (
  SELECT event_type AS key, count(*) AS doc_count, round(avg(value), 6) AS avg_value,
         CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) AS INTEGER) AS rank
  FROM events WHERE event_type IS NOT NULL GROUP BY event_type) WHERE rank <= 10
UNION ALL
SELECT 'user_id', CAST(key AS VARCHAR), doc_count, avg_value, rank FROM (
  SELECT user_id AS key, count(*) AS doc_count, round(avg(value), 6) AS avg_value,
         CAST(row_number() OVER (ORDER BY count(*) DESC, user_id) AS INTEGER) AS rank
  FROM events WHERE user_id IS NOT NULL GROUP BY user_id) WHERE rank <= 10
UNION ALL
SELECT '_all', NULL, count(*), round(avg(value), 6), 1 FROM events
"""


@register("facet_multi", _FACET_MULTI_SQL)
def q_facet_multi(spark, sf_dir):
    """Two terms facets + an average in one scan (grouping sets)."""
    out = serving.multi_facet(S.table(spark, sf_dir, "events"), ["event_type", "user_id"], "value", 10)
    return out.withColumn("avg_value", F.round("avg_value", 6))


@register("serving_table", """
SELECT CAST(floor(event_id / 10) + 1 AS INTEGER) AS batch_number, event_id AS record_id,
       ts AS event_timestamp,
       CAST(user_id AS VARCHAR) AS user_id,
       round(CAST(CAST(value AS FLOAT) AS DOUBLE), 4) AS value,
       CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) AS k,
       CASE WHEN user_id = 1 THEN 'one' ELSE 'other' END AS user_label
FROM events
""")
def q_serving_table(spark, sf_dir):
    """Parsed events typed for the serving table (keyword fields as strings)."""
    p = parsed_events(spark, sf_dir).drop("processed_at", "date", "hour")
    s = serving.to_serving(p, keyword_fields=["user_id", "k"])
    return (s.withColumn("value", F.round(F.col("value").cast("double"), 4))
             .withColumn("user_label", code_label("user_id", 1, "one", "other")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facets + average over messages parsed from the events table."""
    p = parsed_events(spark, sf_dir)
    return serving.multi_facet(p, ["user_id", "k"], "value", 10)


# ---------------------------------------------------------------- feature preparation

from tidewater.operators import prep, quality  # noqa: E402
from tidewater.operators.quantiles import exact_quantiles  # noqa: E402

_LI_SRC = S.LINEITEM_FEATURES_SQL
_LI_F = S.LINEITEM_FEATURES
_LI_CLIP = S.LINEITEM_CLIP
_LI_DERIVED = ("qty_x_price", "disc_per_tax")
_PROBS = [0.1, 0.25, 0.5, 0.75, 0.9]


def _r6(df: DataFrame, cols) -> DataFrame:
    cs = set(cols)
    return df.select(*[F.round(F.col(c), 6).alias(c) if c in cs else F.col(c) for c in df.columns])


@register("exact_quantiles", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS p, round(quantile_cont({c}, {p}), 6) AS value FROM ({_LI_SRC})"
    for c in _LI_F for p in _PROBS) + ")")
def q_exact_quantiles(spark, sf_dir):
    """Exact linear quantiles of four columns (distributed order statistics)."""
    q = exact_quantiles(S.lineitem_features(spark, sf_dir), _LI_F, _PROBS)
    rows = [(c, p, round(v, 6)) for c in _LI_F for p, v in zip(_PROBS, q[c])]
    return spark.createDataFrame(rows, "column_name string, p double, value double")


def _impute_sql() -> str:
    meds = ", ".join(f"median({c}) AS m_{c}" for c in _LI_F)
    sel = ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in _LI_F)
    return f"src AS ({_LI_SRC}), med AS (SELECT {meds} FROM src), imp AS (SELECT {sel}, target FROM src, med)"


@register("impute_median", "WITH " + _impute_sql() + " SELECT " +
          ", ".join(f"round({c}, 6) AS {c}" for c in _LI_F) + ", target FROM imp")
def q_impute_median(spark, sf_dir):
    out = prep.impute_median(S.lineitem_features(spark, sf_dir), _LI_F)
    return _r6(out, _LI_F)


@register("dedupe", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def q_dedupe(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return prep.dedupe(li)


def _clip_sql(src: str, k: float) -> str:
    qs = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in _LI_CLIP)
    sel = []
    for c in _LI_F:
        if c in _LI_CLIP:
            sel.append(f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, q1_{c} - {k} * (q3_{c} - q1_{c})), "
                       f"q3_{c} + {k} * (q3_{c} - q1_{c})) END AS {c}")
        else:
            sel.append(c)
    return f"q AS (SELECT {qs} FROM {src}), cl AS (SELECT {', '.join(sel)}, target FROM {src}, q)"


@register("winsorize_iqr", f"WITH src AS ({_LI_SRC}), " + _clip_sql("src", 0.5) + " SELECT " +
          ", ".join(f"round({c}, 6) AS {c}" for c in _LI_F) + ", target FROM cl")
def q_winsorize_iqr(spark, sf_dir):
    """IQR clipping with k=0.5 so the bounds bite; NULLs stay NULL, no row dropped."""
    out = prep.winsorize_iqr(S.lineitem_features(spark, sf_dir), _LI_CLIP, k=0.5)
    return _r6(out, _LI_F)


def _std_sql(src: str, cols) -> str:
    st = ", ".join(f"avg({c}) AS u_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    return f"st AS (SELECT {st} FROM {src})"


def _std_select(src: str, cols, tail: str) -> str:
    sel = ", ".join(f"round(({c} - u_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}" for c in cols)
    return f"SELECT {sel}{tail} FROM {src}, st"


@register("standardize", f"WITH src AS (SELECT * FROM lineitem), " +
          _std_sql("src", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]) + " " +
          _std_select("src", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], ", l_orderkey, l_linenumber"))
def q_standardize(spark, sf_dir):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = S.table(spark, sf_dir, "lineitem").select(*cols, "l_orderkey", "l_linenumber")
    return _r6(prep.standardize(li, cols), cols)


_CURATE_COLS = _LI_F + list(_LI_DERIVED)
_CURATE_SQL = ("WITH " + _impute_sql() + ", dd AS (SELECT DISTINCT * FROM imp), " + _clip_sql("dd", 3.0) +
               ", fe AS (SELECT *, l_quantity * l_extendedprice AS qty_x_price, "
               "l_discount / (l_tax + 1) AS disc_per_tax FROM cl), " + _std_sql("fe", _CURATE_COLS) + " " +
               _std_select("fe", _CURATE_COLS, ", target"))


def curated_lineitem(spark, sf_dir, **kw):
    return prep.curate(S.lineitem_features(spark, sf_dir), features=_LI_F, label=S.LINEITEM_LABEL,
                       clip_cols=_LI_CLIP, k=3.0, product=("l_quantity", "l_extendedprice"),
                       ratio=("l_discount", "l_tax"), derived=_LI_DERIVED, **kw)


@register("curate", _CURATE_SQL)
def q_curate(spark, sf_dir):
    """impute -> dedupe -> winsorize -> derived features -> standardize."""
    return _r6(curated_lineitem(spark, sf_dir), _CURATE_COLS)


_QUALITY_SQL = f"""
WITH src AS ({_LI_SRC}),
pc AS (SELECT target AS cls, count(*) AS n,
              sum({' + '.join(f"CAST({c} IS NULL OR isnan({c}) AS BIGINT)" for c in _LI_F)}
                  + CAST(target IS NULL AS BIGINT)) AS miss
       FROM src GROUP BY target),
r AS (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_records, CAST(4 AS INTEGER) AS total_features,
             CAST(coalesce(sum(miss), 0) AS BIGINT) AS missing_cells,
             min(CASE WHEN cls IS NOT NULL THEN n END) AS min_class_count FROM pc)
SELECT *, total_records >= 100 AS min_records, total_features >= 10 AS min_features,
       missing_cells = 0 AS no_missing, coalesce(min_class_count >= 30, false) AS balanced_target,
       (total_records >= 100 AND total_features >= 10 AND missing_cells = 0
        AND coalesce(min_class_count >= 30, false)) AS is_valid
FROM r
"""


@register("quality_report", _QUALITY_SQL)
def q_quality_report(spark, sf_dir):
    return quality.quality_report(S.lineitem_features(spark, sf_dir), label=S.LINEITEM_LABEL)


# ---------------------------------------------------------------- split / metrics

from tidewater.functions.scalar import argmax, normalize_vector, version_string  # noqa: E402
from tidewater.operators import metrics, split  # noqa: E402

_H32 = "('0x' || substr(md5(concat_ws('|', '42', CAST({k} AS VARCHAR))), 1, 8))::BIGINT"
_H60 = "('0x' || substr(md5(concat_ws('|', '42', CAST({k} AS VARCHAR))), 1, 15))::BIGINT"


@register("split_hash", f"""
SELECT event_id, event_type, {_H32.format(k='event_id')} < {int(0.2 * 2 ** 32)} AS is_test FROM events
""")
def q_split_hash(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events").select("event_id", "event_type")
    return split.split_hash(ev, "event_id", 0.2, 42)


@register("split_exact", f"""
SELECT o_orderkey, o_orderstatus, rn <= floor(n * 0.2 + 0.5) AS is_test
FROM (SELECT o_orderkey, o_orderstatus,
             row_number() OVER (PARTITION BY o_orderstatus ORDER BY h, o_orderkey) AS rn,
             count(*) OVER (PARTITION BY o_orderstatus) AS n
      FROM (SELECT *, {_H60.format(k='o_orderkey')} AS h FROM orders))
""")
def q_split_exact(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return split.split_exact(o, "o_orderstatus", "o_orderkey", 0.2, 42)


_RULE_SQL = """CASE WHEN value < 50 THEN 'view' WHEN value < 100 THEN 'click'
     WHEN value < 150 THEN 'signup' WHEN value < 200 THEN 'purchase' ELSE 'error' END"""


def _rule_predictions(spark, sf_dir):
    """Deterministic rule-based predictions of ``event_type`` from ``value``."""
    ev = S.table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("label"), F.expr(_RULE_SQL).alias("prediction"))


@register("confusion", f"""
SELECT event_type AS label, {_RULE_SQL} AS prediction, count(*) AS count FROM events GROUP BY 1, 2
""")
def q_confusion(spark, sf_dir):
    return metrics.confusion(_rule_predictions(spark, sf_dir))


@register("metrics", f"""
WITH c AS (SELECT event_type AS label, {_RULE_SQL} AS prediction, count(*) AS cnt FROM events GROUP BY 1, 2),
s AS (SELECT label, sum(cnt) AS support FROM c GROUP BY label),
p AS (SELECT prediction AS label, sum(cnt) AS predicted FROM c GROUP BY prediction),
t AS (SELECT label, sum(cnt) AS tp FROM c WHERE label = prediction GROUP BY label),
per AS (SELECT coalesce(s.label, p.label) AS label, coalesce(support, 0) AS support,
               coalesce(predicted, 0) AS predicted, coalesce(tp, 0) AS tp
        FROM s FULL JOIN p ON s.label = p.label LEFT JOIN t ON coalesce(s.label, p.label) = t.label)
SELECT CAST(sum(support) AS BIGINT) AS n, round(sum(tp) / sum(support), 6) AS accuracy,
       round(sum(support * CASE WHEN support + predicted = 0 THEN 0 ELSE 2.0 * tp / (support + predicted) END)
             / sum(support), 6) AS weighted_f1
FROM per
""")
def q_metrics(spark, sf_dir):
    m = metrics.classification_metrics(metrics.confusion(_rule_predictions(spark, sf_dir)))
    return m.select("n", F.round("accuracy", 6).alias("accuracy"), F.round("weighted_f1", 6).alias("weighted_f1"))


# ---------------------------------------------------------------- set ops / scalar

@register("union_by_name", """
SELECT event_id, ts, event_type, value, NULL::BIGINT AS user_id FROM events WHERE event_type <= 'purchase'
UNION ALL
SELECT event_id, ts, event_type, NULL::DOUBLE AS value, user_id FROM events WHERE event_type > 'purchase'
""")
def q_union_by_name(spark, sf_dir):
    """Frames with different column sets concatenated by name (missing -> NULL)."""
    ev = S.table(spark, sf_dir, "events")
    a = ev.where(F.col("event_type") <= "purchase").select("event_id", "ts", "event_type", "value")
    b = ev.where(F.col("event_type") > "purchase").select("user_id", "event_type", "ts", "event_id")
    return a.unionByName(b, allowMissingColumns=True)


@register("version_string", """
SELECT o_orderkey,
       replace('v_' || strftime(o_orderdate, '%Y%m%d_%H%M%S') || '_acc_' || printf('%.4f', o_totalprice / 1000000.0),
               '.', '_') AS model_version
FROM orders
""")
def q_version_string(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", version_string("o_orderdate", F.col("o_totalprice") / 1e6).alias("model_version"))


@register("normalize_vector", """
SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, round((embedding[i] - 0.1307::DOUBLE) / 0.3081::DOUBLE, 6) AS value
FROM (SELECT vec_id, embedding, generate_subscripts(embedding, 1) AS i FROM embeddings)
""")
def q_normalize_vector(spark, sf_dir):
    e = S.table(spark, sf_dir, "embeddings")
    n = e.select("vec_id", F.posexplode(normalize_vector("embedding", 0.1307, 0.3081)).alias("pos", "value"))
    return n.withColumn("value", F.round("value", 6))


@register("argmax", """
SELECT vec_id, label, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax FROM embeddings
""")
def q_argmax(spark, sf_dir):
    e = S.table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", argmax("embedding").alias("argmax"))


@register("event_time_facets", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS doc_count
FROM events GROUP BY 1, 2, 3
""")
def q_event_time_facets(spark, sf_dir):
    """Hourly event-time buckets per facet value (batch form of the live facet)."""
    ev = S.table(spark, sf_dir, "events")
    g = ev.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("doc_count"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "event_type", "doc_count")


# ---------------------------------------------------------------- streaming ingest / lake

from tidewater.config import Config  # noqa: E402
from tidewater.session import JIT_SIZED_CODEGEN, session_conf, work_dir  # noqa: E402
from tidewater.sinks import tables  # noqa: E402
from tidewater.sinks.writers import write_lake, write_messages  # noqa: E402
from tidewater.sources.files import read_lake  # noqa: E402
from tidewater.sources.messages import read_messages  # noqa: E402
from tidewater.streaming.ingest import run_ingest  # noqa: E402


FILES_PER_BATCH = 64          # message files of one micro-batch


def ingest_events(spark: SparkSession, sf_dir: str, messages: DataFrame | None = None,
                  dedupe_within: str | None = None) -> Config:
    """Publish every event as messages (the writer's partitions are the files), run the
    ingest stream to completion (``availableNow``) and return the folders it wrote."""
    wd = work_dir(spark, "ingest")
    if messages is None:
        messages = S.event_messages(spark, sf_dir, keep=("event_id",))
    write_messages(messages, "text", path=f"{wd}/topic")
    cfg = Config(source_format="text", source_path=f"{wd}/topic", lake_path=f"{wd}/lake",
                 serving_path=f"{wd}/serving", dead_letter_path=f"{wd}/dead",
                 checkpoint_path=f"{wd}/checkpoint", on_error="raise")
    q = run_ingest(spark, cfg, fields=S.EVENT_FIELDS, int_fields=S.EVENT_INT_FIELDS,
                   available_now=True, max_per_trigger=FILES_PER_BATCH, dedupe_within=dedupe_within)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return cfg


@register("stream_ingest", _PARSED_SQL)
def q_stream_ingest(spark, sf_dir):
    """Stream all events through the dual sink and read the lake back."""
    cfg = ingest_events(spark, sf_dir)
    return _final_parsed(read_lake(spark, cfg.lake_path))


@register("ingest_quarantine", """
SELECT CAST(count(*) FILTER (event_id % 7 <> 0) AS BIGINT) AS good,
       CAST(count(*) FILTER (event_id % 7 <> 0 AND event_id % 11 = 0) AS BIGINT) AS duplicates,
       CAST(count(*) FILTER (event_id % 7 = 0) + count(*) FILTER (event_id % 7 = 0 AND event_id % 11 = 0) AS BIGINT) AS quarantined
FROM events
""")
def q_ingest_quarantine(spark, sf_dir):
    """Every 7th message broken, every 11th sent twice, de-duplication on: where each went.
    Broken messages are all kept, twice if they were sent twice; only good ones are merged."""
    sent = S.event_messages(spark, sf_dir, keep=("event_id",))
    sent = sent.withColumn("value", F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("broken "), "key")).otherwise(F.col("value")))
    sent = sent.union(sent.where(F.col("event_id") % 11 == 0))
    cfg = ingest_events(spark, sf_dir, sent.select("key", "value", "event_id"), dedupe_within="3650 days")
    n = spark.read.text(cfg.source_path).agg(F.count("*").alias("sent"))
    good = read_lake(spark, cfg.lake_path).agg(F.count("*").alias("good"), F.count_distinct("record_id").alias("ids"))
    bad = spark.read.parquet(f"{cfg.dead_letter_path}/quarantine").agg(F.count("*").alias("quarantined"))
    return n.join(good).join(bad).select(                   # three one-row tables
        F.col("ids").alias("good"), (F.col("sent") - F.col("good") - F.col("quarantined")).alias("duplicates"), "quarantined")


_REJECTS_SQL = """
WITH e AS (SELECT event_id AS i, epoch_ms(ts) AS t FROM events),
one AS (SELECT * FROM e WHERE i % 13 <> 0),
two AS (SELECT *, i % 13 <> 0 AS again FROM e WHERE i % 13 = 0 OR i % 11 = 0),
w AS (SELECT max(t) - 86400000 AS w FROM one WHERE i % 7 <> 0),
m AS (SELECT 'good' AS outcome FROM one WHERE i % 7 <> 0
      UNION ALL SELECT 'broken' FROM one WHERE i % 7 = 0
      UNION ALL SELECT CASE WHEN i % 7 = 0 THEN 'broken' WHEN again AND t + 86400000 > w THEN 'duplicate'
                            WHEN t < w THEN 'late' ELSE 'good' END FROM two, w)
SELECT outcome, count(*) AS n FROM m GROUP BY outcome
"""


@register("ingest_rejects", _REJECTS_SQL)
def q_ingest_rejects(spark, sf_dir):
    """Two sends to a topic, each ingested by the same stream with a day of de-duplication: the second
    holds repeats and rows that were kept back.  Where every message went, by outcome."""
    wd = work_dir(spark, "rejects")
    sent = S.event_messages(spark, sf_dir, keep=("event_id",))
    sent = sent.withColumn("value", F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("broken "), "key")).otherwise(F.col("value")))
    held = F.col("event_id") % 13 == 0
    cfg = Config(source_format="topic", source_path=f"{wd}/topic", starting_offsets="earliest", lake_path=f"{wd}/lake",
                 serving_path=f"{wd}/serving", dead_letter_path=f"{wd}/dead", checkpoint_path=f"{wd}/checkpoint")
    for name, part in (("one", sent.where(~held)), ("two", sent.where(held | (F.col("event_id") % 11 == 0)))):
        for _ in range(2):                                          # each send is repeated, and counts once
            write_messages(part, "topic", path=cfg.source_path, txn=name)
        run_ingest(spark, cfg, fields=S.EVENT_FIELDS, int_fields=S.EVENT_INT_FIELDS, available_now=True,
                   dedupe_within="1 day").awaitTermination()
    good = read_lake(spark, cfg.lake_path).select(F.lit("good").alias("outcome"))
    bad = spark.read.parquet(f"{cfg.dead_letter_path}/quarantine").select(F.lit("broken").alias("outcome"))
    rejected = spark.read.parquet(f"{cfg.dead_letter_path}/rejected").select("outcome")
    return good.union(bad).union(rejected).groupBy("outcome").agg(F.count("*").alias("n"))


@register("topic_replay", """
SELECT CAST(event_id AS VARCHAR) AS key, event_id AS record_id, CAST(floor(event_id / 10) + 1 AS INTEGER) AS batch_number FROM events
""")
def q_topic_replay(spark, sf_dir):
    """All events through a topic, sent twice under one name, and read back by a stream from its start."""
    wd = work_dir(spark, "replay")
    for _ in range(2):
        write_messages(S.event_messages(spark, sf_dir), "topic", path=f"{wd}/topic", txn="events")
    q = (read_messages(spark, "topic", path=f"{wd}/topic", starting_offsets="earliest").writeStream.format("parquet")
         .option("path", f"{wd}/read").option("checkpointLocation", f"{wd}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.schema("key string, value string").parquet(f"{wd}/read")
    return got.select("key", F.get_json_object("value", "$.record_id").cast("long").alias("record_id"),
                      F.get_json_object("value", "$.batch_number").cast("int").alias("batch_number"))


BATCHES = 6                   # micro-batches of the table queries


@register("lake_snapshots", _PARSED_SQL)
def q_lake_snapshots(spark, sf_dir):
    """All events as micro-batches of a lake with snapshots, merged every second batch and one batch
    written twice, read back through the newest snapshot."""
    path = f"{work_dir(spark, 'snapshots')}/lake"
    rows = prep.materialize(parsed_events(spark, sf_dir).drop("processed_at"))
    for n in range(BATCHES):
        for again in ([n, 0] if n == 3 else [n]):                   # batch 0 is replayed after it was merged
            tables.write_batch(rows.where(F.col("record_id") % BATCHES == again), path, again, ["date"])
        if n % 2:
            tables.compact(spark, path, ["date"], fanout=2)
            tables.vacuum(spark, path)
    return _final_parsed(tables.read_table(spark, path))


@register("serving_merge", """
WITH e AS (SELECT event_id AS i, ts, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT i AS record_id, CASE WHEN i % 5 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS event_timestamp,
       CAST(user_id AS VARCHAR) AS user_id, CAST(CASE WHEN i % 5 = 0 THEN k + 1000 ELSE k END AS VARCHAR) AS k FROM e
""")
def q_serving_merge(spark, sf_dir):
    """A keyed serving table: all events in batches, every fifth one updated by a later batch, a third
    of them sent again unchanged in between; one row per id is read back."""
    path = f"{work_dir(spark, 'keyed')}/serving"
    rows = parsed_events(spark, sf_dir).drop("processed_at", "date", "hour", "value")
    rows = prep.materialize(serving.to_serving(rows, keyword_fields=["user_id", "k"]))
    updated = rows.where(F.col("record_id") % 5 == 0).withColumn("k", (F.col("k").cast("int") + 1000).cast("string")) \
        .withColumn("event_timestamp", F.col("event_timestamp") + F.expr("INTERVAL 1 DAY"))
    sends = [rows.where(F.col("record_id") % BATCHES == n) for n in range(BATCHES)] + [rows.where(F.col("record_id") % 3 == 0), updated]
    for n, send in enumerate(sends):
        tables.write_batch(send, path, n)
        if n in (1, 3, 6):
            tables.compact(spark, path, key="record_id", order_by=["event_timestamp"], fanout=2)
    return tables.read_table(spark, path, "record_id", ["event_timestamp"]).select("record_id", "event_timestamp", "user_id", "k")


@register("lake_prune", _PARSED_SQL.replace("FROM events", "FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-15'"))
def q_lake_prune(spark, sf_dir):
    """Write the date/hour lake, then read it with a partition filter (pruned scan)."""
    wd = work_dir(spark, "lake")
    write_lake(parsed_events(spark, sf_dir).drop("processed_at"), f"{wd}/lake")
    lake = read_lake(spark, f"{wd}/lake")
    return _final_parsed(lake.where(F.col("date") >= F.lit("2024-01-15").cast("date")))


# ---------------------------------------------------------------- aggregates, gate and newest rows of a stream

from tidewater.operators.newest import newest_n  # noqa: E402
from tidewater.streaming import gate as G  # noqa: E402
from tidewater.streaming import rollups as R  # noqa: E402

SENDS = 4                     # sends of the queries below, each one micro-batch
ROLLUP_FACETS = ["k", "user_id"]


def ingest_sends(spark: SparkSession, name: str, sends: list[DataFrame], **kw) -> Config:
    """Each send to a topic, and ingested by the same stream into keyed tables."""
    wd = work_dir(spark, name)
    cfg = Config(source_format="topic", source_path=f"{wd}/topic", starting_offsets="earliest", lake_path=f"{wd}/lake",
                 serving_path=f"{wd}/serving", dead_letter_path=f"{wd}/dead", checkpoint_path=f"{wd}/checkpoint",
                 serving_key="record_id")
    for n, send in enumerate(sends):
        write_messages(send, "topic", path=cfg.source_path, txn=f"send-{n}")
        run_ingest(spark, cfg, fields=S.EVENT_FIELDS, int_fields=S.EVENT_INT_FIELDS, available_now=True, **kw).awaitTermination()
    return cfg


_LIVE_FACETS_SQL = """
WITH e AS (SELECT user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(CAST(value AS FLOAT) AS DOUBLE) AS v FROM events),
g AS (SELECT 'k' AS facet, k AS typed, count(*) AS doc_count, avg(v) AS a FROM e WHERE k IS NOT NULL GROUP BY k
      UNION ALL SELECT 'user_id', user_id, count(*), avg(v) FROM e WHERE user_id IS NOT NULL GROUP BY user_id
      UNION ALL SELECT '_all', NULL, count(*), avg(v) FROM e),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY facet ORDER BY doc_count DESC, typed) AS INTEGER) AS rank FROM g)
SELECT facet, CAST(typed AS VARCHAR) AS key, doc_count, round(a, 6) AS avg_value, rank FROM r WHERE rank <= 10
"""


@register("live_rollup_facets", _LIVE_FACETS_SQL)
def q_live_rollup_facets(spark, sf_dir):
    """Facets and average kept by the ingest stream over three sends of all events, read from the partials."""
    sent = S.event_messages(spark, sf_dir, keep=("event_id",))
    roll = R.facet_rollup(f"{work_dir(spark, 'facets')}/facets", ROLLUP_FACETS, "value", compact_every=2)
    ingest_sends(spark, "rollup", [sent.where(F.col("event_id") % 3 == n) for n in range(3)], rollups=[roll])
    return R.read_facets(spark, roll, ROLLUP_FACETS, "value").withColumn("avg_value", F.round("avg_value", 6))


SKETCHED = ["l_quantity", "l_extendedprice", "l_discount"]
RANKS = [0.01, 0.25, 0.5, 0.75, 0.99]


@register("live_quantiles", " UNION ALL ".join(
    f"SELECT l_returnflag, '{c}' AS \"column\", q, count({c}) AS n, min(CAST({c} AS DOUBLE)) AS lo, max(CAST({c} AS DOUBLE)) AS hi, true AS within_error "
    f"FROM lineitem, (VALUES {', '.join(f'(CAST({q} AS DOUBLE))' for q in RANKS)}) t(q) GROUP BY l_returnflag, q" for c in SKETCHED))
def q_live_quantiles(spark, sf_dir):
    """Sketches of four micro-batches of all line items, merged twice: count, exact ends, and whether the
    true ranks of each quantile's value are within the sketch's error of the rank asked for."""
    li = S.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", *SKETCHED)
    roll = R.quantile_rollup(f"{work_dir(spark, 'sketches')}/sketches", SKETCHED, by=["l_returnflag"], compact_every=2)
    for n in range(SENDS):
        roll.add(li.where(F.col("l_orderkey") % SENDS == n), n)
    got = prep.materialize(roll.read(spark).select("l_returnflag", "column", "n", R.at_rank(0).alias("lo"), R.at_rank(1).alias("hi"),
                           F.inline(F.array(*[F.struct(F.lit(q).alias("q"), R.at_rank(q).alias("at")) for q in RANKS]))))
    cells = li.select(F.col("l_returnflag"), F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in SKETCHED])))
    ranks = cells.join(F.broadcast(got), ["l_returnflag", "column"]).groupBy("l_returnflag", "column", "q", "n", "lo", "hi").agg(  # flags x columns x ranks
        F.avg((F.col("v") < F.col("at")).cast("int")).alias("below"), F.avg((F.col("v") <= F.col("at")).cast("int")).alias("upto"))
    e = R.rank_error()
    return ranks.select("l_returnflag", "column", "q", "n", "lo", "hi",
                        ((F.col("below") - e <= F.col("q")) & (F.col("q") <= F.col("upto") + e)).alias("within_error"))


_GATE_SQL = """
WITH e AS (SELECT event_id % 4 AS b, CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS k, user_id,
                  CASE WHEN event_id % 100 = 1 THEN NULL ELSE value END AS v, event_id FROM events),
s AS (SELECT * FROM e WHERE NOT (b = 3 AND k = 2 AND event_id % 1000 <> 3)),
c AS (SELECT b, k, count(*) AS n FROM s WHERE k IS NOT NULL GROUP BY b, k),
q AS (SELECT s.b, count(*) AS n, CAST(sum((v IS NULL)::INT + (k IS NULL)::INT + (user_id IS NULL)::INT) AS BIGINT) AS m,
             (SELECT min(n) FROM c WHERE c.b = s.b) AS least FROM s GROUP BY s.b)
SELECT b AS batch_id, n AS total_records, CAST(2 AS INTEGER) AS total_features, m AS missing_cells, least AS min_class_count,
       n >= 100 AS min_records, m = 0 AS no_missing, coalesce(least >= 30, false) AS balanced_target,
       n >= 100 AND m = 0 AND coalesce(least >= 30, false) AS is_valid,
       CASE WHEN n >= 100 AND m = 0 AND coalesce(least >= 30, false) THEN n ELSE 0 END AS lake_rows,
       CASE WHEN n >= 100 AND m = 0 AND coalesce(least >= 30, false) THEN 0 ELSE n END AS rows_aside FROM q
"""


@register("ingest_gate", _GATE_SQL)
def q_ingest_gate(spark, sf_dir):
    """Four sends through a stream with a gate: the second lacks cells, the fourth has few rows of a
    class.  The report of each batch, and how many of its rows the lake has and were set aside."""
    ev = S.table(spark, sf_dir, "events").withColumn("value", F.when(F.col("event_id") % 100 == 1, None).otherwise(F.col("value")))
    k = S.props_k() % 3
    ev = ev.where(~((F.col("event_id") % 4 == 3) & (k == 2) & (F.col("event_id") % 1000 != 3)))
    sent = S.to_envelope(ev, record_id="event_id", timestamp="ts", data={"user_id": F.col("user_id"), "value": F.col("value"), "k": k},
                         batch_size=10, keep=("event_id",))
    rule = G.Gate("k", [0, 1, 2], ["user_id", "value"], min_features=2)
    cfg = ingest_sends(spark, "gate", [sent.where(F.col("event_id") % SENDS == n) for n in range(SENDS)], gate=rule)
    kept = tables.read_table(spark, cfg.lake_path).groupBy((F.col("record_id") % SENDS).alias("batch_id")).agg(F.count("*").alias("lake_rows"))
    aside = G.set_aside(spark, cfg.lake_path).groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(F.count("*").alias("rows_aside"))
    return G.reports(spark, cfg.lake_path).drop("other_class_count", "min_features").join(kept, "batch_id", "left").join(aside, "batch_id", "left") \
        .fillna(0, ["lake_rows", "rows_aside"])


@register("newest_first", """
WITH e AS (SELECT event_id AS record_id, ts AS event_timestamp, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
a AS (SELECT 'all' AS "query", * FROM e ORDER BY event_timestamp DESC, record_id DESC LIMIT 25),
b AS (SELECT 'k = 7' AS "query", * FROM e WHERE k = 7 ORDER BY event_timestamp DESC, record_id DESC LIMIT 5)
SELECT * FROM a UNION ALL SELECT * FROM b
""")
def q_newest_first(spark, sf_dir):
    """Newest rows, of all and of one term, from the newest hour folders of a lake of all events."""
    path = f"{work_dir(spark, 'newest')}/lake"
    write_lake(parsed_events(spark, sf_dir).drop("processed_at"), path)
    cols = ["record_id", "event_timestamp", "k"]
    newest = newest_n(spark, path, 25, cols=cols).select(F.lit("all").alias("query"), "*")
    return newest.union(newest_n(spark, path, 5, F.col("k") == 7, cols=cols).select(F.lit("k = 7").alias("query"), "*"))


# ---------------------------------------------------------------- models (rows-only checks)

from tidewater.operators import model as M  # noqa: E402
from tidewater.operators.registry import latest_model_uri, registry_table  # noqa: E402
from tidewater.plans.jobs import TrainSpec, run_scoring, run_training  # noqa: E402

FOREST = "lineitem-label"


def _lineitem_spec() -> TrainSpec:
    return TrainSpec(features=tuple(_LI_F), label=S.LINEITEM_LABEL, clip_cols=tuple(_LI_CLIP), k=3.0,
                     product=("l_quantity", "l_extendedprice"), ratio=("l_discount", "l_tax"),
                     derived=_LI_DERIVED, min_features=len(_LI_F) + len(_LI_DERIVED))


def trained(spark, sf_dir) -> dict:
    """Train and register the stand-in model: the job's default forest behind its gate."""
    root = work_dir(spark, "models")
    return {**run_training(spark, S.lineitem_features(spark, sf_dir), _lineitem_spec(), model_root=root, name=FOREST),
            "root": root}


_SPLIT_SIZES = ("WITH " + _impute_sql() + ", dd AS (SELECT DISTINCT * FROM imp), "
                "c AS (SELECT target, count(*) AS n FROM dd GROUP BY target)")


@register("forest_train", _SPLIT_SIZES + """
SELECT CAST(sum(n - floor(n * 0.2 + 0.5)) AS BIGINT) AS train_rows, CAST(sum(floor(n * 0.2 + 0.5)) AS BIGINT) AS test_rows,
       true AS beats_majority, true AS f1_above_majority FROM c
""")
def q_forest_train(spark, sf_dir):
    """Sizes of the split, and whether the forest is clearly better on the test rows than
    always answering the larger class (half of its errors at most)."""
    t = trained(spark, sf_dir)
    m = t["metrics"]
    share = t["table"].where("is_test").groupBy("target").agg(F.count("*").alias("n")) \
        .agg((F.max("n") / F.sum("n")).alias("majority"))
    return share.select(
        F.lit(int(m["train_rows"])).cast("long").alias("train_rows"), F.lit(int(m["test_rows"])).cast("long").alias("test_rows"),
        (F.lit(m["eval_accuracy"]) > 1 - (1 - F.col("majority")) / 2).alias("beats_majority"),
        (F.lit(m["eval_f1_score"]) > 1 - (1 - F.col("majority")) / 2).alias("f1_above_majority"))


@register("split_exact_curated", _SPLIT_SIZES + """
SELECT target, CAST(n AS BIGINT) AS n, CAST(floor(n * 0.2 + 0.5) AS BIGINT) AS test_rows FROM c
""")
def q_split_exact_curated(spark, sf_dir):
    """The exact split of the curated table, clipped so tightly that rows become equal."""
    t = prep.curate(S.lineitem_features(spark, sf_dir), features=_LI_F, label=S.LINEITEM_LABEL, clip_cols=_LI_F, k=0.0,
                    product=("l_quantity", "l_extendedprice"), ratio=("l_discount", "l_tax"), derived=_LI_DERIVED,
                    fit_on=lambda d: split.split_exact(split.unique_key(d), S.LINEITEM_LABEL, "row_key", 0.2, 42))
    return t.groupBy("target").agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("long")).alias("test_rows"))


_PREPARED_SQL = ("WITH " + _impute_sql() + ", dd AS (SELECT DISTINCT * FROM imp), " + _clip_sql("dd", 3.0) +
                 ", fe AS (SELECT *, l_quantity * l_extendedprice AS qty_x_price, l_discount / (l_tax + 1) AS disc_per_tax FROM cl), " +
                 _std_sql("fe", _CURATE_COLS) + ", raw AS (SELECT " + ", ".join(
                     f"least(greatest({c}, q1_{c} - 3.0 * (q3_{c} - q1_{c})), q3_{c} + 3.0 * (q3_{c} - q1_{c})) AS {c}"
                     if c in _LI_CLIP else c for c in _LI_F) + ", target FROM imp, q), "
                 "rf AS (SELECT *, l_quantity * l_extendedprice AS qty_x_price, l_discount / (l_tax + 1) AS disc_per_tax FROM raw) " +
                 _std_select("rf", _CURATE_COLS, ", target"))


@register("prepared_features", _PREPARED_SQL)
def q_prepared_features(spark, sf_dir):
    """Raw rows prepared for scoring with what curation learned: every row, no missing cell."""
    raw = S.lineitem_features(spark, sf_dir)
    _, prepared = curated_lineitem(spark, sf_dir, return_preparation=True)
    saved = prep.Preparation.from_json(prepared.to_json())
    return _r6(saved.apply(raw).select(*_CURATE_COLS, "target"), _CURATE_COLS)


@register("forest_importance")
def q_forest_importance(spark, sf_dir):
    return trained(spark, sf_dir)["importance"]


@register("latest_model", f"SELECT '{FOREST}' AS name, 100 AS n_estimators, 10 AS max_depth, true AS has_preparation")
def q_latest_model(spark, sf_dir):
    """The registry's row of the newest model folder of that name."""
    root = trained(spark, sf_dir)["root"]
    newest = latest_model_uri(spark, root, FOREST, "mtime").select(F.regexp_extract("model_uri", "([^/]+)/model$", 1).alias("folder"))
    reg = registry_table(spark, root).withColumn("folder", F.regexp_extract("model_uri", "([^/]+)/model$", 1))
    return reg.join(newest, "folder").select("name", "hyperparameters.n_estimators", "hyperparameters.max_depth",
                                             F.col("preparation").isNotNull().alias("has_preparation"))


@register("score_batch")
def q_score_batch(spark, sf_dir):
    """All raw rows, prepared and scored with the registered forest."""
    return run_scoring(spark, S.lineitem_features(spark, sf_dir), trained(spark, sf_dir)["root"], FOREST, keep=["target"])


@register("score_stream")
def q_score_stream(spark, sf_dir):
    """The same model and preparation applied to a streaming read of the raw table."""
    root = trained(spark, sf_dir)["root"]
    wd = work_dir(spark, "score_stream")
    src = S.table(spark, sf_dir, "lineitem")
    stream = (spark.readStream.schema(src.schema).option("pathGlobFilter", "lineitem.parquet")
              .parquet(sf_dir))
    scored = run_scoring(spark, S.feature_rows(stream), root, FOREST, keep=["target"])
    q = (scored.writeStream.format("parquet").option("path", f"{wd}/out")
         .option("checkpointLocation", f"{wd}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{wd}/out")


from tidewater.operators.registry import register_model  # noqa: E402
from tidewater.streaming.scoring import read_scored, run_live_scoring  # noqa: E402


@register("score_live_models", """
SELECT CASE WHEN l_orderkey % 3 = 0 THEN 3 ELSE 5 END AS n_estimators, count(*) AS scored, true AS beats_majority FROM lineitem GROUP BY 1
""")
def q_score_live_models(spark, sf_dir):
    """All raw line items through one scoring stream in three parts; a second model is registered after
    the first part.  Rows by the model that scored them, and whether it beats the larger class."""
    wd, cols = work_dir(spark, "live_models"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    raw = S.table(spark, sf_dir, "lineitem").select("l_orderkey", *cols, S.lineitem_label().alias("target"))
    parts = [raw.where(F.col("l_orderkey") % 3 == n) for n in range(3)]

    def put(n: int) -> None:
        parts[n].write.mode("append").parquet(f"{wd}/in")

    def register_forest(trees: int) -> None:
        fitted = M.train_forest(parts[0], cols, num_trees=trees, max_depth=5)
        got = M.evaluate_split(fitted, parts[0], parts[1])
        register_model(spark, fitted, f"{wd}/models", FOREST, got, {"n_estimators": trees, "max_depth": 5})

    register_forest(3)
    put(0)
    q = run_live_scoring(spark.readStream.schema(raw.schema).parquet(f"{wd}/in"), f"{wd}/models", FOREST, f"{wd}/out",
                         f"{wd}/checkpoint", keep=["target"], trigger_seconds=1)
    try:
        q.processAllAvailable()
        register_forest(5)
        for n in (1, 2):
            put(n)
            q.processAllAvailable()
    finally:
        q.stop()
    reg = registry_table(spark, f"{wd}/models").select(F.regexp_extract("model_uri", "([^/]+)/model$", 1).alias("model_folder"), "hyperparameters.n_estimators")
    rows = read_scored(spark, f"{wd}/out").join(F.broadcast(reg), "model_folder")       # two registry rows
    ones = F.avg("target")
    return rows.groupBy("n_estimators").agg(F.count("prediction").alias("scored"),
                                            (F.avg((F.col("prediction") == F.col("target")).cast("int")) > F.greatest(ones, 1 - ones)).alias("beats_majority"))


def _embedding_frame(spark, sf_dir):
    e = S.table(spark, sf_dir, "embeddings")
    return split.split_hash(M.vector_frame(e, "embedding", "label"), "vec_id", 0.2, 42)


@register("mlp")
def q_mlp(spark, sf_dir):
    """64 -> 128 -> 10 perceptron on the embeddings; train/test accuracy."""
    d = _embedding_frame(spark, sf_dir)
    train, test = d.where(~F.col("is_test")), d.where(F.col("is_test"))
    mdl = M.train_mlp(train, 64, 10)
    tr = metrics.classification_metrics(metrics.confusion(mdl.transform(train))).first()
    te = metrics.classification_metrics(metrics.confusion(mdl.transform(test))).first()
    return spark.createDataFrame([(float(tr["accuracy"]), float(te["accuracy"]), int(tr["n"]), int(te["n"]),
                                   len(mdl.summary().objectiveHistory))],
                                 "train_accuracy double, test_accuracy double, train_rows long, "
                                 "test_rows long, iterations int")


@register("tune")
def q_tune(spark, sf_dir):
    """Seeded search over learning rate x hidden units, two trials at a time; the best
    model's accuracy on the held-out rows is given with every trial."""
    d = _embedding_frame(spark, sf_dir)
    trials, _, best = M.tune_mlp(spark, d.where(~F.col("is_test")), 64, 10)
    held = metrics.classification_metrics(metrics.confusion(best.transform(d.where(F.col("is_test"))))).first()
    return trials.withColumn("best_held_out_accuracy", F.lit(float(held["accuracy"])))


from tidewater.operators import perceptron as MB  # noqa: E402

MLP_BATCH = 64


@register("mlp_epochs", f"""
SELECT CAST(e AS INTEGER) AS epoch, CAST(ceil(n / {MLP_BATCH}.0) AS INTEGER) AS steps, n AS rows, true AS loss_falls,
       CASE WHEN e = 3 THEN true END AS beats_majority, CASE WHEN e = 3 THEN n END AS scored, CASE WHEN e = 3 THEN classes END AS classes
FROM (SELECT count(*) AS n, count(DISTINCT label) AS classes FROM embeddings WHERE label IS NOT NULL), range(1, 4) t(e)
""")
def q_mlp_epochs(spark, sf_dir):
    """64 -> 128 -> 10 perceptron, ReLU and log-softmax, three epochs of Adam on batches of 64: the
    epoch table, and how the last model scores all rows."""
    e = S.table(spark, sf_dir, "embeddings")
    model, history = MB.train_perceptron(e, 10, batch_size=MLP_BATCH, learning_rate=0.005)
    scored = prep.materialize(MB.predict(model, e).select(F.col("label").cast("double").alias("label"), "prediction"))
    share = scored.groupBy("label").agg(F.count("*").alias("n")).agg(
        (F.max("n") / F.sum("n")).alias("majority"), F.sum("n").alias("scored"), F.count("*").alias("classes"))
    met = metrics.classification_metrics(metrics.confusion(scored)).select("accuracy").withColumnRenamed("accuracy", "reached").join(share)  # one-row tables
    before = F.lag("mean_loss").over(Window.orderBy("epoch"))  # a row per epoch
    last = F.col("epoch") == MB.EPOCHS
    return history.withColumn("loss_falls", F.coalesce(F.col("mean_loss") < before, F.lit(True))).join(met).select(
        "epoch", "steps", "rows", "loss_falls", F.when(last, F.col("reached") > F.col("majority")).alias("beats_majority"),
        F.when(last, F.col("scored")).alias("scored"), F.when(last, F.col("classes")).alias("classes"))


@register("tune_minibatch")
def q_tune_minibatch(spark, sf_dir):
    """Seeded search over learning rate x batch size, two trials at a time; the best model's
    accuracy on the held-out rows is given with every trial."""
    e = split.split_hash(S.table(spark, sf_dir, "embeddings"), "vec_id", 0.2, 42)
    trials, _, best = MB.tune_perceptron(e.where(~F.col("is_test")), 10)
    held = MB.predict(best, e.where(F.col("is_test"))).select(F.col("label").cast("double").alias("label"), "prediction")
    row = metrics.classification_metrics(metrics.confusion(held)).first()
    return trials.withColumn("best_held_out_accuracy", F.lit(float(row["accuracy"])))


# ---------------------------------------------------------------- synthesis (rows-only checks)

from tidewater.operators import synth  # noqa: E402


@register("profile_columns")
def q_profile_columns(spark, sf_dir):
    p = synth.profile_columns(S.lineitem_features(spark, sf_dir), categorical=["target"])
    return spark.createDataFrame([tuple(x[k] for k in ("name", "role", "lo", "hi", "digits", "ndv", "missing")) for x in p], "name string, role string, lo double, hi double, digits int, ndv long, missing double")


@register("copula_sample")
def q_copula_sample(spark, sf_dir):
    """Fit on the lineitem features and draw as many rows as the table has."""
    src = S.lineitem_features(spark, sf_dir)
    model = synth.copula_fit(src, categorical=["target"])
    n = src.count()
    with session_conf(spark, JIT_SIZED_CODEGEN):            # the draws are one wide projection
        return prep.materialize(synth.copula_sample(model, spark.range(n), "id", seed=42))
