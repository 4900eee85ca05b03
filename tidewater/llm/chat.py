"""Multi-party chat formatting by perspective rotation (operator 3).

For every participant of a conversation the dialogue is rendered once with that speaker as
the assistant and all others as named users; the mask covers what the assistant says.

A rendered dialogue is given turn by turn, with the place of each turn in the whole, so a
conversation of any length is never collected: its turns are put in order by range
partitioning, and a turn's place is a running sum inside its range plus the ranges' totals
(``ordered``) less the place where its dialogue begins.  SQL functions only.

Format of a turn::

    <|im_start|>assistant\\n...<|im_end|>\\n
    <|im_start|>user name=SPEAKER\\n...<|im_end|>\\n
    <|im_start|>system\\n...<|im_end|>\\n

Defined results: ``system`` turns are in every rendering and are nobody's perspective; a
conversation of system turns alone gives no rows; a null text is empty, a null role is the
speaker ``unknown``; a null conversation id is a conversation of its own; turns that tie are
ordered by speaker, then text; repeated rows are each rendered; ``<|im_`` inside a text is
written ``<| im_``; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._frames import ordered, read, stage

SYSTEM, UNKNOWN = "system", "unknown"


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """One row for each perspective and turn: conv, perspective, turn, speaker, rendered, start,
    end (characters of the dialogue), mask_start, mask_end (null where nothing is trained)."""
    said = stage(turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit(UNKNOWN)).alias("speaker"),
        F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("<|im_"), F.lit("<| im_")).alias("text")), "chat-turns")
    people = stage(said.where(F.col("speaker") != SYSTEM).select(F.col("conv").alias("of"), F.col("speaker").alias("perspective"))
                   .distinct(), "chat-people")
    rows = said.join(people, F.col("conv").eqNullSafe(F.col("of")))
    assistant = F.col("speaker") == F.col("perspective")
    head = F.concat(F.lit("<|im_start|>"), F.when(F.col("speaker") == SYSTEM, SYSTEM).when(assistant, "assistant")
                    .otherwise(F.concat(F.lit("user name="), "speaker")), F.lit("\n"))
    rows = rows.select("conv", "perspective", "turn", "speaker", assistant.alias("trained"), head.alias("head"), "text") \
        .withColumn("rendered", F.concat("head", "text", F.lit("<|im_end|>\n"))) \
        .withColumn("size", F.char_length("rendered").cast("long"))
    order = [F.asc_nulls_last("conv"), F.asc("perspective"), F.asc_nulls_last("turn"), F.asc("speaker"), F.asc("text")]
    placed = stage(ordered(rows, order, "size", "chat-order"), "chat-placed")
    begins = stage(placed.groupBy(F.col("conv").alias("of"), F.col("perspective").alias("by"))
                   .agg(F.min("before").alias("begin")), "chat-begins")
    start = F.col("before") - F.col("begin")
    return placed.join(begins, F.col("conv").eqNullSafe(F.col("of")) & (F.col("perspective") == F.col("by"))).select(
        "conv", "perspective", "turn", "speaker", "rendered", start.alias("start"), (start + F.col("size")).alias("end"),
        F.when(F.col("trained"), start + F.char_length("head")).alias("mask_start"),
        F.when(F.col("trained"), start + F.col("size")).alias("mask_end"))


def op3_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(read(spark, sf_dir, "conversations")).select(
        F.col("conv").alias("conv_id"), "perspective", "turn", "speaker", F.sha2("rendered", 256).alias("rendered_sha256"),
        F.col("start").alias("start_char"), F.col("end").alias("end_char"), "mask_start", "mask_end")


OP3_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker,
         replace(coalesce(text, ''), '<|im_', '<| im_') AS text FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
rows_ AS (
  SELECT s.*, p.perspective,
         '<|im_start|>' || CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant'
                                ELSE 'user name=' || speaker END || chr(10) AS head
  FROM said s JOIN people p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
sized AS (
  SELECT *, head || text || '<|im_end|>' || chr(10) AS rendered FROM rows_),
placed AS (
  SELECT *, sum(length(rendered)) OVER (PARTITION BY conv_id, perspective
    ORDER BY turn NULLS LAST, speaker, text ROWS UNBOUNDED PRECEDING) AS e FROM sized)
SELECT conv_id, perspective, turn, speaker, sha256(rendered) AS rendered_sha256,
       CAST(e - length(rendered) AS BIGINT) AS start_char, CAST(e AS BIGINT) AS end_char,
       CAST(CASE WHEN speaker = perspective THEN e - length(rendered) + length(head) END AS BIGINT) AS mask_start,
       CAST(CASE WHEN speaker = perspective THEN e END AS BIGINT) AS mask_end
FROM placed
"""
