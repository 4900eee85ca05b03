"""Column-role adapters for the driver's test tables.

The operators are written for the 14-field classification record; the test tables
carry other columns, so each adapter names which columns play which role:

* ``events`` -> messages: ``record_id=event_id``, ``timestamp=ts``, payload
  ``{user_id, value, k}`` (``k`` read from the ``props`` JSON text).
* ``lineitem`` -> feature table: four numeric features and a label that follows from
  them (a discounted quantity above 25, or a high price at a low tax).
  The table has no NULLs, so a deterministic rule blanks a few cells per column
  (every row is kept) to exercise imputation.
* ``orders`` -> stratified split by ``o_orderstatus`` keyed on ``o_orderkey``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.envelope import to_envelope

EVENT_FIELDS = ["user_id", "value", "k"]
EVENT_INT_FIELDS = ["user_id", "k"]
LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINEITEM_CLIP = ["l_quantity", "l_extendedprice"]
LINEITEM_LABEL = "target"


_LABEL_SQL = ("CAST(l_quantity * (1 - l_discount) > 25 OR (l_extendedprice > 40000 AND l_tax < 0.03) AS INTEGER)")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def props_k() -> F.Column:
    return F.get_json_object(F.col("props"), "$.k").try_cast("int")


def event_messages(spark: SparkSession, sf_dir: str, keep=()) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return to_envelope(ev, record_id="event_id", timestamp="ts",
                       data={"user_id": F.col("user_id"), "value": F.col("value"), "k": props_k()},
                       batch_size=10, keep=keep)


def lineitem_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four features plus a 0/1 label; NULL cells injected by a fixed rule."""
    return feature_rows(table(spark, sf_dir, "lineitem"))


def feature_rows(li: DataFrame) -> DataFrame:
    """The same for any frame of lineitem rows, streams too."""
    return li.select(
        F.when(F.col("l_linenumber") == 7, None).otherwise(F.col("l_quantity")).alias("l_quantity"),
        F.col("l_extendedprice"),
        F.when(F.col("l_linenumber") == 6, None).otherwise(F.col("l_discount")).alias("l_discount"),
        F.col("l_tax"),
        lineitem_label().alias(LINEITEM_LABEL),
    )


def lineitem_label() -> F.Column:
    return F.expr(_LABEL_SQL)


# The same adapter in SQL, for the DuckDB oracle.
LINEITEM_FEATURES_SQL = f"""
SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS l_quantity,
       l_extendedprice,
       CASE WHEN l_linenumber = 6 THEN NULL ELSE l_discount END AS l_discount,
       l_tax,
       {_LABEL_SQL} AS target
FROM lineitem
"""
