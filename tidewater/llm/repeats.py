"""Removal of repeated byte strings (operator 9): suffix buckets refined by bucket pointers.

A byte goes if a ``LENGTH``-byte string that covers it also starts anywhere else, in the
same or another document.  So every start offset must learn whether its suffix shares the
first ``LENGTH`` bytes with another suffix: bucket-pointer refinement down to that depth.

* Initial buckets.  Of each window of ``LENGTH`` bytes one q-gram stands for all: the one
  with the least identifier, rightmost of equals.  Equal windows choose the same one, so
  the q-gram's bucket (``anchor``) holds every suffix that can match, and each start
  offset belongs to one anchor, ``d`` bytes before it.  Buckets of one place end there.
* Refinement.  The suffixes of a bucket are a range of distances ``d``.  Sorting by the
  identifiers at later (and earlier) offsets splits the bucket: all windows of a range
  contain its inner string, and its outer string contains them all.  An inner string found
  once ends the range; an outer string found twice settles it; else the range is halved
  and both halves, keyed by the bucket they came from and the identifier of the bytes
  they gain, are refined again.  At one offset, inner and outer string are the same.
* The first round runs on identifiers alone as Spark aggregates and joins.  Later rounds
  compare bytes: a bucket of up to ``LOCAL_BYTES`` bytes is refined to the end in the task
  that holds it, a larger one by further Spark rounds, with the same rows as a result.

Exact copies are merged first: all rounds run on one row per distinct text.  Anchors are
about 1/128 of the bytes, so a round shuffles identifiers, not texts.
Identifiers are 64-bit; settling needs two to agree, or the bytes themselves.

Defined results: null text counts as empty; texts under ``LENGTH`` bytes keep all; a
repeated row is one more copy, and copies of a text of at least ``LENGTH`` bytes lose all
bytes; rows with a null id are kept as rows; an empty table gives no rows; other columns
are ignored.  Very long texts are cut into overlapping pieces inside a task.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ._bytes import gram_ids_pair, window_argmin
from ._frames import discard, read, stage, unused

LENGTH = 400                  # bytes of a repeated string, where the caller names no other number


class Depth(NamedTuple):
    """How deep suffixes are compared: strings of ``length`` bytes, ``span`` start offsets for each
    window choice."""

    length: int
    span: int

    @property
    def q(self) -> int:
        return self.length - self.span + 1

    @property
    def outer(self) -> int:
        return self.length + self.span - 1


def depth(length: int) -> Depth:
    if length < 2:
        raise ValueError("a repeated string has two bytes at least")
    return Depth(length, max(1, 16 * length // 25))


PIECE = 1 << 18               # bytes hashed at a time in a task
LOCAL_BYTES = 16 << 20        # contexts of a bucket refined inside one task: a second's work, less than one Spark round

_ANCHOR = "k long, h long, o long, p long, lo int, hi int"


def _pieces(texts: pd.Series, length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (row, offset of the piece in its text, bytes) of about PIECE bytes."""
    group, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), PIECE):
            part = t[at: at + PIECE + length - 1] if len(t) > PIECE else t
            group.append((i, at, part))
            size += len(part)
            if size >= PIECE:
                yield group
                group, size = [], 0
            if len(t) <= PIECE:
                break
    if group:
        yield group


def _anchors(batches: Iterator[pd.DataFrame], deep: Depth) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        keys = pdf["k"].to_numpy()
        for group in _pieces(pdf["t"], deep.length):
            buf = np.frombuffer(b"".join(g[2] for g in group), np.uint8)
            sizes = np.array([len(g[2]) for g in group])
            ends = np.cumsum(sizes)
            of = np.repeat(np.arange(len(group)), sizes)
            near, far = gram_ids_pair(buf, deep.q, deep.outer)
            best = window_argmin(near, deep.span)
            if not len(best):
                continue
            starts = np.arange(len(best))
            at = np.where(starts + deep.length <= ends[of[: len(best)]], best, -1)
            first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            last = np.concatenate((first[1:], [len(at)])) - 1
            own = at[first] >= 0
            a, b, p = first[own], last[own], at[first][own]
            g = of[p]
            begin = ends[g] - sizes[g]
            whole = (p - (deep.span - 1) >= begin) & (p + deep.length <= ends[g])
            outer = np.zeros(len(p), np.int64)  # 0: its outer string crosses an end of the text
            outer[whole] = far[p[whole] - (deep.span - 1)].view(np.int64)
            row = np.array([x[0] for x in group])[g]
            off = np.array([x[1] for x in group])[g]
            yield pd.DataFrame({"k": keys[row], "h": near[p].view(np.int64),
                                "o": outer,
                                "p": p - begin + off, "lo": (p - b).astype(np.int32),
                                "hi": (p - a).astype(np.int32)})


def _contexts(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """The bytes around each anchor that its ranges need, one row per anchor."""
    for pdf in batches:
        out = defaultdict(list)
        for key, text, marks in zip(pdf["k"], pdf["t"], pdf["marks"]):
            for m in marks:
                p, lo, hi = m["p"], m["lo"], m["hi"]
                for c, v in (("k", key), ("h", m["h"]), ("p", p), ("lo", lo), ("hi", hi), ("open", m["open"]),
                             ("hot", m["hot"]), ("ctx", text[p - hi: p - lo + length])):
                    out[c].append(v)
        yield pd.DataFrame(out, columns=["k", "h", "p", "lo", "hi", "open", "hot", "ctx"])


_CONTEXT = "k long, h long, p long, lo int, hi int, open boolean, hot boolean, ctx binary"


def _refine(rows: list[tuple[int, int, int, int, bool, bytes]], a: int, b: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """Refine one bucket over distances a..b.  rows: (k, p, lo, hi, open, ctx) where ctx
    holds the windows at distances lo..hi; yields (k, p, lo, hi) for settled open ranges."""
    inner = defaultdict(list)
    for r in rows:
        if r[2] <= b and r[3] >= a:
            inner[r[5][r[3] - a: r[3] - b + length]].append(r)
    for same in inner.values():
        if not any(r[4] for r in same) or all(r[:2] == same[0][:2] for r in same):
            continue
        outer, left = defaultdict(list), []
        for r in same:
            if r[2] <= a and r[3] >= b:
                outer[r[5][r[3] - b: r[3] - a + length]].append(r)
            else:
                left.append(r)
        for group in outer.values():
            if all(r[:2] == group[0][:2] for r in group):
                left += group
                continue
            yield from ((r[0], r[1], a, b) for r in group if r[4])
            left.append((*group[0][:4], False, group[0][5]))  # one stays as a partner
        if a < b:
            mid = (a + b) // 2
            yield from _refine(left, a, mid, length)
            yield from _refine(left, mid + 1, b, length)


def _refine_local(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Rows come sorted by bucket; a bucket may continue in the next batch."""
    def rows():
        for pdf in batches:
            yield from zip(zip(pdf["h"], pdf["a"], pdf["b"]), pdf["k"], pdf["p"], pdf["lo"], pdf["hi"], pdf["open"], pdf["ctx"])

    out: list[tuple[int, int, int, int]] = []
    for (_, a, b), bucket in groupby(rows(), key=lambda r: r[0]):
        out.extend(_refine([r[1:] for r in bucket], a, b, length))
        if len(out) > 50_000:
            yield pd.DataFrame(out, columns=["k", "p", "lo", "hi"])
            out = []
    yield pd.DataFrame(out, columns=["k", "p", "lo", "hi"])


_RANGE = "k long, p long, lo int, hi int"
_PLACE = "xxhash64(k, p)"


def _twice(df: DataFrame, keys: list[str], name: str, into: list) -> DataFrame:
    """Keys held by two or more places.  Written out, so that the join that follows has a
    plain exchange on both sides and AQE can split a hot key."""
    return stage(df.groupBy(*keys).agg(F.expr(f"min({_PLACE})").alias("x"), F.expr(f"max({_PLACE})").alias("y")).where("x <> y").select(*keys),
                 name, into=into)


def _halves(rows: DataFrame) -> DataFrame:
    """Each row for both halves of its range of distances, where it owns any of them."""
    half = F.expr("(a + b) DIV 2").cast("int")
    parts = F.explode(F.array(F.struct(F.col("a"), half.alias("b")), F.struct((half + 1).alias("a"), F.col("b"))))
    return rows.withColumn("r", parts).select("h", "k", "p", "lo", "hi", "open", "ctx", "r.a", "r.b") \
        .where("lo <= b AND hi >= a")


def _refine_hot(rows: DataFrame, deep: Depth, into: list) -> tuple[DataFrame, DataFrame]:
    """Rounds of ``_refine`` as Spark aggregates and joins, for buckets of any size: a round
    splits a bucket by the bytes that the halves of its range gain.  Returns what is settled
    (k, p, lo, hi), and the rows of buckets that have become small."""
    found, small = rows.selectExpr("k", "p", "lo", "hi").limit(0), rows.limit(0)
    length, local = deep.length, LOCAL_BYTES // deep.outer
    # the first round was run on identifiers alone
    rows = stage(_halves(rows), "rep-hot", into=into)
    while not rows.isEmpty():
        keyed = rows.withColumn("i", F.expr(f"xxhash64(h, a, substring(ctx, hi - a + 1, {length} - (b - a)))"))
        keys = stage(keyed.groupBy("i").agg(
            F.expr(f"min({_PLACE})").alias("x"), F.expr(f"max({_PLACE})").alias("y"), F.count("*").alias("n"))
            .where("x <> y").select("i", (F.col("n") > local).alias("big")), "rep-in", into=into)
        keyed = stage(keyed.drop("h").join(keys, "i").withColumnRenamed("i", "h"), "rep-live", into=into)
        small = small.unionByName(keyed.where("NOT big").drop("big"))
        keyed = keyed.where("big").drop("big").withColumn(
            "w", F.expr(f"CASE WHEN lo <= a AND hi >= b THEN substring(ctx, hi - b + 1, {length} + b - a) END"))
        shared = _twice(keyed.where("w IS NOT NULL"), ["h", "w"], "rep-out", into).withColumn("s", F.lit(True))
        keyed = stage(keyed.join(shared, ["h", "w"], "left"), "rep-round", into=into)
        found = found.union(keyed.where("s AND open").selectExpr("k", "p", "a AS lo", "b AS hi"))
        left = keyed.where("s IS NULL").unionByName(
            keyed.where("s").withColumn("open", F.lit(False)).dropDuplicates(["h", "w"]))
        rows = stage(_halves(left.where("a < b")), "rep-half", into=into)
    return found, small


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """texts: (k, t binary) with k = xxhash64 of the text.  Returns (k, spans), one row per
    text: the byte ranges covered by repeated strings of ``length`` bytes, packed and unmerged
    (see ``merge``)."""
    deep = depth(length)
    held: list = []
    # copies of a text are one row from here on: marks, buckets and contexts do not grow with them
    texts = stage(texts.where(F.octet_length("t") >= length).groupBy("k").agg(
        F.count("*").alias("n"), F.octet_length(F.first("t")).cast("long").alias("size"), F.first("t").alias("t")),
        "rep-texts", into=held)
    marks = stage(texts.select("k", "t").mapInPandas(partial(_anchors, deep=deep), _ANCHOR), "rep-anchors", into=held)
    marks = stage(marks.join(_twice(marks, ["h"], "rep-first", held), "h"), "rep-buckets", into=held)
    whole = marks.where("o <> 0")
    shared = _twice(whole, ["h", "o"], "rep-outer", held).withColumn("s", F.lit(True))
    marks = stage(marks.join(shared, ["h", "o"], "left"), "rep-marks", into=held)
    settled = marks.where("s").select("k", "p", "lo", "hi")

    # what is still open, and one partner for each settled outer string of its bucket
    undecided = marks.where("s IS NULL").select("h", "k", "p", "lo", "hi", F.lit(True).alias("open"))
    buckets = stage(undecided.groupBy("h").agg(F.count("*").alias("n")), "rep-open", into=held)
    # written out, so that the join meets one row for each string, not one for each place
    strings = stage(marks.where("s").groupBy("h", "o").agg(F.min(F.struct("k", "p")).alias("x")), "rep-strings", into=held)
    partners = (strings.join(buckets.select("h"), "h", "left_semi")
                .select("h", "x.k", "x.p", F.lit(0).alias("lo"), F.lit(deep.span - 1).alias("hi"), F.lit(False).alias("open")))
    rows = stage(undecided.union(partners), "rep-rows", into=held)
    sizes = stage(rows.groupBy("h").agg((F.count("*") > LOCAL_BYTES // deep.outer).alias("hot")), "rep-sizes", into=held)

    wanted = stage(rows.join(sizes, "h").groupBy("k").agg(
        F.collect_list(F.struct("h", "p", "lo", "hi", "open", "hot")).alias("marks")), "rep-wanted", into=held)
    near = texts.join(wanted, "k")
    ctx = stage(near.select("k", "t", "marks").mapInPandas(partial(_contexts, length=length), _CONTEXT), "rep-ctx", 100, held)
    ctx = ctx.select("h", "k", "p", "lo", "hi", "open", "ctx", F.lit(0).alias("a"), F.lit(deep.span - 1).alias("b"), "hot")
    found, small = _refine_hot(ctx.where("hot").drop("hot"), deep, held)
    local = ctx.where("NOT hot").drop("hot").unionByName(small).repartition("h").sortWithinPartitions("h", "a")
    ranges = settled.union(local.mapInPandas(partial(_refine_local, length=length), _RANGE)).union(found)
    spans = ranges.selectExpr("k", "p - hi AS s", f"p - lo + {length} AS e")
    spans = spans.union(texts.where("n > 1").select("k", F.lit(0).cast("long"), "size"))
    # one number a range: a text of few distinct bytes has as many ranges as bytes
    packed = F.shiftleft("s", 32).bitwiseOR(F.col("e") - F.col("s"))
    found = stage(spans.groupBy("k").agg(F.collect_set(packed).alias("spans")), "rep-spans")
    discard(texts.sparkSession, held)
    return found


def merge(spans: np.ndarray | None) -> list[tuple[int, int]]:
    """Maximal runs of packed ranges (start in the upper, length in the lower 32 bits);
    ranges that touch are one run."""
    if spans is None or not len(spans):
        return []
    spans = np.sort(np.asarray(spans, np.int64))
    s, e = spans >> 32, (spans >> 32) + (spans & 0xFFFFFFFF)
    reach = np.maximum.accumulate(e)
    first = np.flatnonzero(np.append(True, s[1:] > reach[:-1]))
    return list(zip(s[first].tolist(), reach[np.append(first[1:], len(s)) - 1].tolist()))


def cut(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    if not runs:
        return text
    at = [0, *(x for run in runs for x in run), len(text)]
    return b"".join(text[at[i]: at[i + 1]] for i in range(0, len(at), 2))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    t = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(t).alias("k"), t.alias("t"))


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: id, t (bytes, whole), spans (packed removed ranges,
    unmerged, null if none)."""
    texts = _texts(docs, id_col, text_col)
    return texts.join(repeated_spans(texts.select("k", "t"), length), "k", "left").select("id", "t", "spans")


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        runs = [merge(x) for x in pdf["spans"]]
        yield pd.DataFrame({
            "doc_id": pdf["id"], "n_bytes": [len(t) for t in pdf["t"]],
            "n_removed": [sum(e - s for s, e in r) for r in runs], "n_spans": [len(r) for r in runs],
            "kept_sha256": [hashlib.sha256(cut(t, r)).hexdigest() for t, r in zip(pdf["t"], runs)],
            "n_kept": [len(t) - sum(e - s for s, e in r) for t, r in zip(pdf["t"], runs)]})


def op9_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(removed(read(spark, sf_dir, "documents")).mapInPandas(
        _digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_kept long"), "rep-result")


def drop_repeats(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", length: int = LENGTH) -> DataFrame:
    """``docs`` with the bytes of repeated strings of ``length`` bytes cut out of the text and the
    number of characters set anew; all rows and other columns stay, whatever their names.  A
    character that a cut leaves in part is dropped."""
    names = docs.columns
    t = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    key, found = unused(names, "k"), unused(names, "spans")
    spans = repeated_spans(docs.select(F.xxhash64(t).alias("k"), t.alias("t")), length).toDF(key, found)
    out = docs.withColumn(key, F.xxhash64(t)).join(spans, key, "left") \
        .withColumn(text_col, F.when(F.col(found).isNull(), F.col(text_col)).otherwise(_kept_text(F.col(text_col), F.col(found))))
    if chars_col in names:
        out = out.withColumn(chars_col, F.when(F.col(found).isNull(), F.col(chars_col))
                             .otherwise(F.char_length(text_col)).cast(docs.schema[chars_col].dataType))
    return out.select(*names)


@F.pandas_udf(StringType())
def _kept_text(text: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([t if s is None or t is None else cut(t.encode(), merge(s)).decode("utf-8", "ignore")
                      for t, s in zip(text, spans)], dtype=object)


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
g AS (SELECT doc_id, h, unnest(range(0, n - 399)) AS s FROM d WHERE n >= 400),
k AS (SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, 800)) AS m FROM g),
twice AS (SELECT m FROM k GROUP BY m HAVING count(*) > 1),
hits AS (SELECT doc_id, s FROM k SEMI JOIN twice USING (m)),
marked AS (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 400 THEN 0 ELSE 1 END AS fresh FROM hits),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM marked),
runs AS (SELECT doc_id, run, min(s) AS a, max(s) + 400 AS b FROM numbered GROUP BY doc_id, run),
gaps AS (SELECT doc_id, run, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY run), 0) AS before FROM runs),
cuts AS (
  SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, max(b) AS last,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY run) AS head
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256,
       CAST(n AS BIGINT) - coalesce(n_removed, 0) AS n_kept
FROM d LEFT JOIN cuts USING (doc_id)
"""
