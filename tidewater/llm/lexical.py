"""Ranked lexical search by norm buckets (operator 11).

Every document is a vector over the queries' terms: its whole-number impacts, a function of the
term's occurrences and the document's length.  A query holds its terms' whole-number weights,
and a score is their inner product.  For the bounds, both sides are scaled by the roots of the
weights, which leaves inner products as they are.

Vectors are ordered by length, longest first, and cut into buckets of ``BUCKET`` rows.  For each
query and bucket, with the score of the query's tenth best document so far as the threshold:

1. Cauchy-Schwarz: the bucket's vectors that are too short for the threshold, whatever their
   direction, are cut off; often that is the whole bucket.
2. Coordinate bounds: along the query's heaviest coordinates (``FOCUS`` of its squared length), a
   unit vector close enough to the query must lie in an interval around the query's own
   coordinate; and the product over these coordinates plus a bound for all others must reach the
   threshold: Cauchy-Schwarz, or the bucket's largest impacts there, whichever is less.
3. What is left is scored exactly in 64-bit integers, and the threshold rises.

Bounds are doubles with a margin of ``SLACK`` on the safe side, and only what is below the
threshold goes, so equal scores are never lost: the ranking is exact.

Buckets are read in waves, each eight times as many files as the one before it; after a wave the
thresholds of all tasks are merged, and the floor that they set on the length is a filter of the
next wave's Parquet scan.  A task returns ten rows a query at most.

Queries are worked through in blocks of about ``BLOCK_TERMS`` terms; a block, its thresholds and
its document frequencies are what is collected and broadcast, so their size has that bound
(plus one query).  Each block reads all documents once.  All counts are over all documents.

Defined results: null texts and texts without terms are no documents; benchmark rows of one
item_id are one item with the terms of all of them, a null item_id is one item; an item without
terms or matches has no rows; equal scores go by ascending doc_id, a null doc_id last; repeated
rows are ranked each by itself; empty tables give no rows; other columns are ignored; texts of
any length are counted whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.session import session_conf, work_dir

from ._frames import BATCH_ROWS, discard, ordered, read, stage

TOP = 10
BUCKET = 2_000                # vectors of a bucket
FOCUS = 0.9                   # share of a query's squared length in the coordinates that are looked at before a vector is scored
BLOCK_TERMS = 50_000          # terms of the queries that one pass over the documents serves
ENTRIES = 8_000_000           # impacts of a file of buckets, about
WAVE = 8                      # growth of the waves
SLACK = 1e-9
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# the same over UTF-8: all bytes of other characters are above 0x7F
_TERM = re.compile(TERM.encode())


def terms(text: str | None) -> list[bytes]:
    """Terms in order, with repeats; only A-Z are lower-cased."""
    return _TERM.findall((text or "").encode().lower())


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def weight(docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holding + 1)))


class Bucket:
    """Impact vectors by falling length, in rows and as lists by coordinate."""

    def __init__(self, ids: list, norms: np.ndarray, at: np.ndarray, impacts: np.ndarray, ends: np.ndarray, roots: np.ndarray):
        self.ids, self.norms, self.at, self.impacts = ids, norms, at, impacts
        self.starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
        self.ends = ends.astype(np.int64)
        row = np.repeat(np.arange(len(ids)), self.ends - self.starts)
        order = np.argsort(at, kind="stable")
        self.list_at, self.list_row = at[order], row[order]
        self.list_value = impacts[order] * roots[self.list_at]
        held, first = np.unique(self.list_at, return_index=True)
        self.most = np.zeros(len(roots), np.int64)               # largest impact of each coordinate
        self.most[held] = np.maximum.reduceat(impacts[order], first)

    def column(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that have the coordinate (ascending), and their scaled values."""
        a, b = np.searchsorted(self.list_at, [coordinate, coordinate + 1])
        return self.list_row[a:b], self.list_value[a:b]


class Query(NamedTuple):
    number: int
    at: np.ndarray            # coordinates, heaviest first
    weights: np.ndarray       # int64
    norm: float               # of the scaled vector
    focus: int                # how many coordinates are looked at first

    @classmethod
    def of(cls, number: int, at: list[int], weights: np.ndarray) -> Query:
        at = np.array(sorted((c for c in at if weights[c] > 0), key=lambda c: (-weights[c], c)), np.int64)
        mass = np.cumsum(weights[at])
        total = float(mass[-1]) if len(at) else 0.0
        return cls(number, at, weights[at], math.sqrt(total), int(np.searchsorted(mass, FOCUS * total)) + 1)


def survivors(bucket: Bucket, query: Query, threshold: int) -> np.ndarray:
    """Rows of the bucket whose score may be ``threshold`` or more."""
    need = threshold * (1 - SLACK)
    n = int(np.searchsorted(-bucket.norms, -need / query.norm, side="right"))  # the longer ones
    if not n:
        return np.empty(0, np.int64)
    norms = bucket.norms[:n]
    near = np.minimum(need / (query.norm * norms), 1.0)      # least cosine, by row
    part, seen, mass = np.zeros(n), np.zeros(n), 0.0
    keep = np.ones(n, bool)
    for coordinate, w in zip(query.at[:query.focus].tolist(), query.weights[:query.focus].tolist()):
        rows, values = bucket.column(coordinate)
        m = int(np.searchsorted(rows, n))
        rows, values = rows[:m], values[:m]
        own = math.sqrt(w)
        share = own / query.norm
        spread = np.sqrt((1 - share * share) * (1 - near * near) + SLACK)
        low = share * near - spread - SLACK
        high = np.where(near < share, 1.0, share * near + spread) + SLACK
        unit = np.zeros(n)
        unit[rows] = values / norms[rows]
        keep &= (unit >= low) & (unit <= high)
        part[rows] += own * values
        seen[rows] += values * values
        mass += w
    others = float(query.weights[query.focus:] @ bucket.most[query.at[query.focus:]])
    rest = math.sqrt(max(query.norm * query.norm - mass, 0.0) * (1 + SLACK) + SLACK)
    left = np.sqrt(np.maximum(norms * norms * (1 + SLACK) - seen, 0.0))
    keep &= part * (1 + SLACK) + np.minimum(rest * left, others) >= need
    return np.flatnonzero(keep)


def exact(bucket: Bucket, rows: np.ndarray, query: Query, scratch: np.ndarray) -> np.ndarray:
    """Scores of some rows; ``scratch`` (int64, one place for each coordinate) is zero before and after."""
    scratch[query.at] = query.weights
    starts, n = bucket.starts[rows], bucket.ends[rows] - bucket.starts[rows]
    first = np.cumsum(n) - n
    entry = np.repeat(starts - first, n) + np.arange(int(n.sum()))
    sums = np.concatenate(([0], np.cumsum(scratch[bucket.at[entry]] * bucket.impacts[entry])))
    scratch[query.at] = 0
    return sums[first + n] - sums[first]


def _order(entry: tuple) -> tuple:
    score, i = entry
    return -score, i is None, i or 0


def search_bucket(bucket: Bucket, queries: list[Query], best: dict, floor: dict, scratch: np.ndarray) -> None:
    """Updates ``best`` (query number -> up to ``TOP`` (score, id), best first)."""
    longest = float(bucket.norms[0])
    for q in queries:
        held = best.get(q.number, [])
        threshold = max(floor.get(q.number, 1), held[-1][0] if len(held) == TOP else 1)
        if q.norm * longest < threshold * (1 - SLACK):
            continue
        rows = survivors(bucket, q, threshold)
        if not len(rows):
            continue
        scores = exact(bucket, rows, q, scratch)
        if (scores >= threshold).sum() > TOP:    # all that tie with the tenth stay for their ids
            threshold = max(threshold, int(np.partition(scores, len(scores) - TOP)[len(scores) - TOP]))
        good = np.flatnonzero(scores >= threshold).tolist()
        if good:
            best[q.number] = sorted(held + [(int(scores[i]), bucket.ids[rows[i]]) for i in good], key=_order)[:TOP]


class Block(NamedTuple):
    """Queries that share a pass over the documents."""

    items: list               # their ids
    vocabulary: dict          # term -> coordinate
    at: list                  # coordinates of each


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_terms: int) -> Iterator[Block]:
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.explode(_terms(F.col(text_col))).alias("term")).distinct() \
        .groupBy("item").agg(F.collect_list("term").alias("terms"), F.count("*").alias("n"))
    items = stage(ordered(items, [F.asc("item")], "n", "lexical-order")
                  .withColumn("block", F.floor(F.col("before") / block_terms).cast("long")), "lexical-items")
    last = items.agg(F.max("block")).first()[0]
    for b in range(0 if last is None else last + 1):
        rows = items.where(F.col("block") == b).select("item", "terms").collect()
        names = sorted({t for r in rows for t in r.terms})
        vocabulary = {t.encode(): i for i, t in enumerate(names)}
        if rows:
            yield Block([r.item for r in rows], vocabulary, [[vocabulary[t.encode()] for t in r.terms] for r in rows])


def counts(docs: DataFrame, vocabulary: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n (terms with repeats), at (coordinates of the vocabulary's terms), tf: documents with terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.get
        for whole in batches:
            for first in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(first, BATCH_ROWS)
                n, at, tf = [], [], []
                for text in batch.column("text"):
                    found = terms(text.as_py())
                    hits = np.array([c for c in map(known, found) if c is not None], np.int32)
                    coordinates, times = np.unique(hits, return_counts=True)
                    n.append(len(found))
                    at.append(coordinates)
                    tf.append(times)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(n, pa.int64()), pa.array(at, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int64()))],
                    names=["id", "n", "at", "tf"])
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "id long, n long, at array<int>, tf array<long>").where("n > 0")


def vectors(counted: DataFrame, docs: int, words: int, weights: np.ndarray) -> DataFrame:
    """id, norm, at, impacts: scaled lengths and whole-number impacts of documents that share a term."""
    shared = counted.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            at, tf = batch.column("at"), batch.column("tf")
            m = np.array([10 + 90 * n * docs // words for n in batch.column("n").to_pylist()], np.int64)
            lengths = np.diff(at.offsets.to_numpy())
            times = tf.flatten().to_numpy()
            impacts = (1_000_000_000 * times) // (1000 * times + 8 * np.repeat(m, lengths))
            row = np.repeat(np.arange(len(m)), lengths)
            norms = np.sqrt(np.bincount(row, w[at.flatten().to_numpy()] * impacts.astype(float) ** 2, len(m)))
            offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(norms), at, pa.ListArray.from_arrays(offsets, pa.array(impacts))],
                names=["id", "norm", "at", "impacts"])
    return counted.where(F.size("at") > 0).mapInArrow(run, "id long, norm double, at array<int>, impacts array<long>") \
        .where("norm > 0")


def _wave(buckets: DataFrame, queries: list[Query], weights: np.ndarray, floor: dict) -> DataFrame:
    """(query, id, score): the best ten of every task."""
    shared = buckets.sparkSession.sparkContext.broadcast((queries, weights, floor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, floor = shared.value
        best, scratch, roots = {}, np.zeros(len(weights), np.int64), np.sqrt(weights)
        for b in batches:
            if not b.num_rows:
                continue
            order = np.argsort(-b.column("norm").to_numpy(), kind="stable")  # a task may read two files
            if (order[1:] < order[:-1]).any():
                b = b.take(pa.array(order))
            at = b.column("at")
            search_bucket(Bucket(b.column("id").to_pylist(), b.column("norm").to_numpy(), at.flatten().to_numpy(),
                                 b.column("impacts").flatten().to_numpy(), np.cumsum(np.diff(at.offsets.to_numpy())), roots),
                          queries, best, floor, scratch)
        rows = [(q, i, s) for q, held in best.items() for s, i in held]
        yield pa.RecordBatch.from_pandas(pd.DataFrame({"query": pd.Series([r[0] for r in rows], dtype="int64"),
                                                       "id": pd.array([r[1] for r in rows], "Int64"),
                                                       "score": pd.Series([r[2] for r in rows], dtype="int64")}), preserve_index=False)
    return buckets.select("id", "norm", "at", "impacts").mapInArrow(run, "query long, id long, score long")


def _best(found: DataFrame) -> DataFrame:
    first = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= TOP)


def _search_block(docs: DataFrame, block: Block, id_col: str, text_col: str, name: str, held: list) -> DataFrame:
    spark = docs.sparkSession
    counted = stage(counts(docs, block.vocabulary, id_col, text_col), f"{name}-counts", into=held)
    total = counted.agg(F.count("*").alias("docs"), F.sum("n").alias("words"), F.sum(F.size("at")).alias("entries")).first()
    holding = np.zeros(len(block.vocabulary), np.int64)
    for r in counted.select(F.explode("at").alias("c")).groupBy("c").count().collect():  # one row a term of the block
        holding[r["c"]] = r["count"]
    weights = np.array([weight(total.docs, int(h)) if h else 0 for h in holding], np.int64)
    queries = [q for q in (Query.of(n, at, weights) for n, at in enumerate(block.at)) if len(q.at)]
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (total.entries or 0) // ENTRIES)
    rows = vectors(counted, total.docs, total.words or 1, weights)
    buckets = stage(rows.repartitionByRange(files, F.desc("norm"), F.asc("id")).sortWithinPartitions(F.desc("norm"))
                    .withColumn("file", F.spark_partition_id()), f"{name}-vectors", BATCH_ROWS, held)
    found, floor, low, high = None, {}, 0, 1
    while low < files and queries:
        # the least length that any query still asks for
        least = min(floor.get(q.number, 1) / q.norm for q in queries) * (1 - 2 * SLACK)
        some = buckets.where((F.col("file") >= low) & (F.col("file") < high) & (F.col("norm") >= least))
        with session_conf(spark, {"spark.sql.files.openCostInBytes": str(1 << 27)}):  # a task for each file
            wave = stage(_wave(some, queries, weights, floor), f"{name}-wave", BUCKET, held)
        found = wave if found is None else stage(_best(found.union(wave)).select("query", "id", "score"), f"{name}-best", BUCKET, held)
        low, high = high, high * WAVE
        tenth = _best(found).where(F.col("rank") == TOP).select("query", "score").collect()  # one row a query of the block
        floor = {r.query: r.score for r in tenth}
    names = spark.createDataFrame([(n, i) for n, i in enumerate(block.items)], "query long, item_id long")
    if found is None:
        found = spark.createDataFrame([], "query long, id long, score long")
    return _best(found).join(names, "query").select("item_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score")


def search(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``TOP`` best documents."""
    spark, schema = docs.sparkSession, "item_id long, rank int, doc_id long, score long"
    path = work_dir(spark, "lexical-ranks")
    spark.createDataFrame([], schema).write.parquet(path)
    for n, block in enumerate(_blocks(benchmark, item_col, item_text_col, block_terms)):
        held: list = []
        _search_block(docs, block, id_col, text_col, f"lexical-{n}", held).write.mode("append").parquet(path)
        discard(spark, held)
    return spark.read.schema(schema).parquet(path)


def op11_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS t FROM documents),
n AS (SELECT r, doc_id, len(t) AS n FROM d WHERE len(t) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM n),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, s GROUP BY term, docs),
x AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words)))) AS BIGINT) AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN n USING (r), s GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM x WHERE score > 0 QUALIFY rank <= 10
"""
