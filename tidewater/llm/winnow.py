"""Document fingerprints by winnowing (operator 4).

Identifiers of all ``K``-grams of a text's UTF-8 bytes (rolling by prefix doubling); of each
window of ``WINDOW`` consecutive ones the least is chosen, the rightmost of equals.  The
chosen identifiers and their byte positions are the fingerprint.  Two texts that share
``K + WINDOW - 1`` bytes share at least one chosen gram; the positions say where.  Texts too
short for a window have their least gram, texts under ``K`` bytes one identifier of all
their bytes.  Likeness of two fingerprints: shared identifiers over all identifiers of both
(sets); two empty texts are alike (1).

``op4`` pairs each text with its edited one, for which it needs the document before it in
ascending id order.  Documents are dealt to contiguous id ranges of equal bytes, a task each; a range streams in
ascending order and carries the last document along; the last document of a range is also
sent to the next range that has any (one row per range), where it only serves as the first
one's neighbour.

Defined results: null and empty texts have the empty fingerprint; ids that tie follow a
hash of their text; a null id sorts first; an only document is its own neighbour; an empty
table gives no rows; other columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import gram_ids, window_argmin
from ._frames import BATCH_ROWS, ordered, read, stage

K, WINDOW = 24, 41            # bytes of a gram; grams of a window: 64 shared bytes are always found
PIECE = 1 << 20               # grams hashed at a time
RANGE_BYTES = 128 << 20       # bytes of text in a range of ids, at most about


class Print(NamedTuple):
    ids: np.ndarray           # uint64, in the order of their positions
    at: np.ndarray            # byte positions


EMPTY = Print(np.empty(0, np.uint64), np.empty(0, np.int64))


def winnow(text: bytes, k: int = K, window: int = WINDOW) -> Print:
    """The fingerprint of one text."""
    if not text:
        return EMPTY
    buf = np.frombuffer(text, np.uint8)
    if len(buf) <= k:
        return Print(gram_ids(buf, len(buf)), np.zeros(1, np.int64))
    ids, at = [], []
    last = -1
    for start in range(0, max(1, len(buf) - k - window + 2), PIECE):
        grams = gram_ids(buf[start: start + PIECE + k + window - 2], k)
        best = window_argmin(grams, min(window, len(grams)))
        best = best[np.append(True, best[1:] != best[:-1])]
        own = best[best + start > last]
        ids.append(grams[own])
        at.append(own + start)
        last = at[-1][-1] if len(own) else last
    return Print(np.concatenate(ids), np.concatenate(at))


def likeness(a: Print, b: Print) -> float:
    x, y = np.unique(a.ids), np.unique(b.ids)
    if not len(x) and not len(y):
        return 1.0
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def as_string(p: Print) -> str:
    """Chosen identifiers (upper 32 bits) with their positions: ``hash@position`` in hex."""
    return " ".join(f"{h:08x}@{a:x}" for h, a in zip((p.ids >> np.uint64(32)).tolist(), p.at.tolist()))


def edited(text: str, following: str) -> str:
    """The last third of the characters replaced by as many first ones of the next document."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n] if n else text


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, hashes (array, signed 64-bit), positions (array)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            prints = [winnow((t or "").encode()) for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf["id"], "hashes": [p.ids.view(np.int64) for p in prints],
                                "positions": [p.at for p in prints]})
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .mapInPandas(run, "id long, hashes array<long>, positions array<long>")


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come in ascending order inside a range; the row before a row is its next document
    in descending order.  Rows with ``carry`` only serve as such."""
    before, prints = "", EMPTY
    for pdf in (b.iloc[at: at + BATCH_ROWS] for b in batches for at in range(0, len(b), BATCH_ROWS)):
        rows = []
        for has, i, text, carry in zip(pdf["has"], pdf["id"], pdf["text"], pdf["carry"]):
            text = text or ""
            own = winnow(text.encode())
            if not carry:
                other = edited(text, before)
                changed = own if other == text else winnow(other.encode())
                rows.append((i if has else None, len(text), hashlib.sha256(other.encode()).hexdigest(), as_string(own), as_string(changed),
                             likeness(own, changed), likeness(own, prints)))
            before, prints = text, own
        out = pd.DataFrame(rows, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                          "near_edited", "near_next"])
        out["doc_id"] = pd.array([r[0] for r in rows], "Int64")
        yield out


def with_neighbour(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(range, carry, has, id, tie, text), one id range after the other: in a range every row but
    the first, a carried one, follows the document that comes before it in ascending order."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("has", F.col("id").isNotNull()).withColumn("id", F.coalesce("id", F.lit(0))) \
        .withColumn("tie", F.xxhash64("text"))
    # ids and sizes alone, to cut the order into ranges of equal bytes; a range has one border row
    sizes = rows.select("has", "id", "tie", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    laid = ordered(stage(sizes, "win-sizes", 10_000), [F.asc("has"), F.asc("id"), F.asc("tie")], "size", "win-order")
    total = laid.agg(F.sum("size")).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))
    part = F.floor(F.col("before") * n / F.lit(max(total, 1)))
    borders = laid.groupBy(part.alias("part")).agg(F.max(F.struct("has", "id", "tie")).alias("last")).orderBy("last").collect()
    last = [tuple(b["last"]) for b in borders]

    @F.pandas_udf("struct<range int, last boolean>")
    def place(has: pd.Series, ids: pd.Series, tie: pd.Series) -> pd.DataFrame:
        keys = list(zip(has.tolist(), ids.tolist(), tie.tolist()))
        at = [bisect_left(last, k) for k in keys]
        return pd.DataFrame({"range": at, "last": [last[i] == k for i, k in zip(at, keys)]})
    own = F.struct(F.col("p.range"), F.lit(False).alias("carry"))
    on = F.struct(((F.col("p.range") + 1) % max(1, len(last))).alias("range"), F.lit(True).alias("carry"))
    rows = rows.withColumn("p", place("has", "id", "tie")) \
        .withColumn("to", F.explode(F.when(F.col("p.last"), F.array(own, on)).otherwise(F.array(own)))) \
        .select("to.range", "to.carry", "has", "id", "tie", "text")
    return rows.repartitionById(max(len(last), 1), F.col("range")) \
        .sortWithinPartitions("range", F.desc("carry"), "has", "id", "tie")


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_neighbour(read(spark, sf_dir, "documents")).select("has", "id", "text", "carry").mapInPandas(
        _compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                  "near_edited double, near_next double")
