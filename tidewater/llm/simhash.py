"""SimHash near-duplicates (operator 6): candidate pairs from a pivot distance table.

Fingerprint: texts lower-cased in A-Z, words ``[^\\x20\\x09-\\x0D]+``, shingles of
``shingle`` words joined by a space, repeats included (fewer words: the whole sequence),
XXH64 (seed 42) of each; a bit is 1 if set in over half of them.  No words: zero.

Links: the Hamming distances of each distinct fingerprint to many reference fingerprints
(pivots) are computed once.  A pivot family differs from the base pivot only inside its
own 16 of the 64 bits, so two fingerprints that agree on those bits have equal distances,
relative to the base, to the whole family; up to two differing bits leave two of the four
families untouched.  So every pair to be linked meets in a bucket keyed by the coordinates
of two families.  Pairs of a bucket whose coordinates (all pivots) differ by more than the
radius anywhere are discarded (triangle inequality), the rest verified bit by bit.

A crowded bucket is not paired up: each of its fingerprints is sent to all fingerprints
within one bit (65 hubs); two are within two bits exactly if they share a hub, and each is
linked to the least of its hub.  That is linear in the bucket, with the same components.

Defined results: null and empty texts have fingerprint zero and are linked like others;
equal fingerprints are one class, whatever their number; repeated rows are each returned;
a null id never becomes a component id unless the whole component has null ids; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ._frames import components, read, stage, unused

RADIUS = 2
FAMILIES = 4                  # of 64 / FAMILIES bits each; RADIUS + 2, so that two stay untouched
PER_FAMILY = 14               # pivots that differ from the base inside the family's bits
CROWDED = 256                 # fingerprints of a bucket that are paired up; larger ones use hubs


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivots() -> list[int]:
    """The base pivot, then PER_FAMILY pivots for each family; made by a fixed rule."""
    width = 64 // FAMILIES
    draw = lambda *k: xxhash.xxh64_intdigest(repr(k).encode(), 42)
    base = draw("base")
    return [base] + [base ^ ((draw(f, j) & ((1 << width) - 1) or 1) << (f * width))
                     for f in range(FAMILIES) for j in range(PER_FAMILY)]


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """One text, plainly (the reference for tests)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i: i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def fingerprint_udf(shingle: int = 3):
    """Pandas UDF text -> fingerprint as a signed 64-bit integer."""
    @F.pandas_udf(LongType())
    def simhash(texts: pd.Series) -> pd.Series:
        digest, out = xxhash.xxh64_intdigest, np.zeros(len(texts), np.uint64)
        for row, text in enumerate(texts):
            words = (text or "").encode().lower().split()
            if not words:
                continue
            if len(words) > shingle:
                grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
            else:
                grams = [b" ".join(words)]
            hs = np.fromiter((digest(g, 42) for g in grams), np.uint64)
            ones = np.zeros(64, np.int64)
            for at in range(0, len(hs), 1 << 16):
                bits = np.unpackbits(hs[at: at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += bits.sum(axis=0, dtype=np.int64)
            out[row] = np.packbits(2 * ones > len(hs), bitorder="little").view(np.uint64)[0]
        return pd.Series(out.view(np.int64))
    return simhash


def _bits(a: str | Column, b: str | Column) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(b if isinstance(b, Column) else F.col(b)))


def links(prints: DataFrame) -> DataFrame:
    """prints: distinct ``fp``.  Edges (a, b) of fingerprints within RADIUS bits: all pairs
    found in buckets that are not crowded, a spanning star per hub for the others."""
    at = [_bits("fp", F.lit(_signed(p))).cast("tinyint") for p in pivots()]
    table = prints.select("fp", F.array(*at).alias("at"))
    base, keys = F.col("at")[0], []
    for f, g in combinations(range(FAMILIES), 2):
        own = [F.col("at")[1 + x * PER_FAMILY + j] - base for x in (f, g) for j in range(PER_FAMILY)]
        keys.append(F.xxhash64(F.lit(f), F.lit(g), *own))
    table = stage(table.withColumn("keys", F.array(*keys)), "sim-pivots")
    rows = table.select("fp", "at", F.explode("keys").alias("key"))
    sizes = stage(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "sim-sizes")
    rows = stage(rows.join(sizes, "key"), "sim-buckets")

    pairable = rows.where(F.col("n") <= CROWDED)
    a, b = pairable.select("key", F.col("fp").alias("a"), F.col("at").alias("at_a")), \
        pairable.select("key", F.col("fp").alias("b"), F.col("at").alias("at_b"))
    near = F.forall(F.arrays_zip("at_a", "at_b"), lambda x: F.abs(x["at_a"] - x["at_b"]) <= RADIUS)
    pairs = a.join(b, "key").where("a < b").where(near).where(_bits("a", "b") <= RADIUS).select("a", "b")

    crowded = rows.where(F.col("n") > CROWDED).select("fp").distinct()
    hubs = crowded.select("fp", F.explode(F.array(F.col("fp"), *(
        F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)))).alias("hub"))
    hubs = stage(hubs, "sim-hubs")
    least = stage(hubs.groupBy("hub").agg(F.min("fp").alias("a")), "sim-least")
    stars = hubs.join(least, "hub").where("a <> fp").select("a", F.col("fp").alias("b"))
    return pairs.union(stars).distinct()


def groups(prints: DataFrame) -> DataFrame:
    """prints: rows (id, fp).  Returns (fp, component_id): the least id that links reach."""
    classes = stage(prints.groupBy("fp").agg(F.min("id").alias("first")), "sim-classes")
    roots = stage(components(links(classes.select("fp"))), "sim-roots")
    joined = stage(classes.join(roots, classes.fp == roots.node, "left")
                   .select("fp", "first", F.coalesce("root", "fp").alias("root")), "sim-joined")
    ids = stage(joined.groupBy("root").agg(F.min("first").alias("component_id")), "sim-ids")
    return stage(joined.join(ids, "root").select("fp", "component_id"), "sim-groups")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, fp (signed 64-bit), component_id."""
    prints = stage(docs.select(F.col(id_col).alias("id"), fingerprint_udf(shingle)(F.col(text_col)).alias("fp")), "sim-prints")
    return prints.join(groups(prints), "fp").select("id", "fp", "component_id")


def op6_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` without the documents that have a smaller id in their group; all columns."""
    names = docs.columns
    fp, first = unused(names, "fp"), unused(names, "first")
    marked = stage(docs.withColumn(fp, fingerprint_udf(shingle)(F.col(text_col))), "sim-docs")
    found = groups(marked.select(F.col(id_col).alias("id"), F.col(fp).alias("fp"))) \
        .select(F.col("fp").alias(fp), F.col("component_id").alias(first))
    return (marked.join(found, fp).where(F.col(id_col).eqNullSafe(F.col(first)))
            .dropDuplicates([fp, id_col]).select(*names))
