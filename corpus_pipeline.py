"""A corpus pipeline of five operators; each stage is written as Parquet and read again.

1. toxicity: documents that the weakly supervised classifier scores 0.5 or more go.
2. simhash: one document of each group of near-duplicates stays, the one of smallest id.
3. suffix_repeats: strings of REPEAT_BYTES bytes that occur more than once are cut out; documents stay.
4. mixing: each document as often as the target weights take it, in training order.
5. sentencepiece: the token ids of every document, with the round trip checked.

All stages but the last return the columns of their input.  Nulls, empty and very long
texts, repeated rows, empty tables and extra columns are handled as each operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import mixing, pieces, repeats, simhash, toxicity
from tidewater.llm._frames import read, stage


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.labels_of(spark, sf_dir))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


#: Bytes of a repeated string that is cut out: a passage of 51 words of four letters and a blank
#: has 255, so strings of 200 find such passages also where their ends differ.
REPEAT_BYTES = 200


def suffix_repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.drop_repeats(docs, length=REPEAT_BYTES)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


#: Words that a worker of the last stage remembers: fewer than by default, since the workers still
#: hold memory of the stages before.
CACHED_WORDS = 100_000


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(docs, pieces.default_model(), cached_words=CACHED_WORDS)
    return encoded.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash", simhash_stage),
    ("suffix_repeats", suffix_repeats_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: The toxicity stage is a trained classifier: SQL can't express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
