"""Embedding near-duplicates by collision-counting projections (operator 10).

A unit vector's one-dimensional projections lie close together for near vectors: two at
cosine ``COSINE`` differ by a normal deviate of standard deviation ``sqrt(2 - 2 * COSINE)``.

* Sorted lists.  Each of several lists sorts the vectors by one projection and looks at a
  query-centred window of half-width ``HALF`` around each.  So that windows hold few
  strangers at any table size, a list is first split by the signs of further projections; one
  sign halves the strangers and keeps a near pair with probability 1 - angle / pi.  The number
  of signs grows with the logarithm of the row count, the number of lists with what it takes
  to find a pair at the threshold in one of them with probability ``RECALL``.
* Counting.  For each pair met in a window, ``COUNTED`` further projections are compared: a
  collision is a difference of at most ``HALF``.  Pairs with fewer collisions than the count
  that a pair at the threshold reaches with probability ``PASS`` are dropped.
* Verification.  The cosine of the others is taken in double precision.

A pair met in several lists counts in the first only (the places of linked rows in the lists
before are computed anew from their vectors, so rows travel with one list's place), so links are
summed where they are found: no pair is ever a row of a table.  A part
of a list with more than ``CHUNK`` rows is compared in blocks of two chunks, each its own
group, so no task holds a whole part; a block hands on link counts and a spanning forest.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components
link with nothing; vectors of different lengths do not link; equal vectors are one class and
count one by one; repeated rows are rows; a null id is never a component id unless the whole
component has null ids; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._frames import components, read, stage

COSINE = 0.9
HALF = 0.9                    # two standard deviations at the threshold
RECALL = 0.98
COUNTED, PASS = 48, 0.995
STRANGERS = 256               # rows of a split list that share all signs
CHUNK = 256
SEED = 10


def _normal(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def settings(n: int) -> tuple[int, int, int]:
    """(signs per list, lists, least collisions) for ``n`` vectors."""
    signs = max(0, math.ceil(math.log2(max(n, 1) / STRANGERS)))
    window = 2 * _normal(HALF / math.sqrt(2 - 2 * COSINE)) - 1
    found = (1 - math.acos(COSINE) / math.pi) ** signs * window
    lists = math.ceil(math.log(1 - RECALL) / math.log(1 - found))
    above, least = 0.0, COUNTED + 1
    while above < PASS and least > 0:
        least -= 1
        above += math.comb(COUNTED, least) * window ** least * (1 - window) ** (COUNTED - least)
    return signs, lists, least


def directions(d: int, n: int, kind: int) -> np.ndarray:
    """``n`` random directions in ``d`` dimensions, standard normal, from a fixed seed."""
    return np.random.default_rng([SEED, kind, d]).standard_normal((d, n))


def _unit(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # lengths neither overflow nor vanish
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def project(u: np.ndarray, signs: int, lists: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of unit vectors in each list: cells (length and signs) and sorting projections."""
    d = u.shape[1]
    p = np.einsum("ij,jk->ik", u, directions(d, lists * (signs + 1), 0)).reshape(len(u), lists, signs + 1)
    cells = ((p[:, :, :signs] > 0) @ (1 << np.arange(signs, dtype=np.int64))) * 65536 + d
    return cells.astype(np.int64), p[:, :, signs]


def _places(signs: int, lists: int):
    """Each vector's place in each list."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sizes = pdf["v"].map(len)
            for _, part in pdf.groupby(sizes.to_numpy()):
                cells, sorts = project(_unit(part["v"]), signs, lists)
                yield pd.DataFrame({"k": part["k"].to_numpy(), "cells": list(cells), "sorts": list(sorts)})
    return run


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links a-b among n rows."""
    parent = list(range(n))
    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        i, j = x, y
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        while parent[j] != j:
            parent[j] = j = parent[parent[j]]
        if i != j:
            parent[i] = j
            out.append((x, y))
    return out


def links_of_block(t: int, chunk: np.ndarray, guest: np.ndarray, u: np.ndarray, s: np.ndarray,
                   signs: int, lists: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) of rows of one block that list ``t`` is the first to find; ``s`` are the rows'
    sorting projections in it."""
    near = np.triu(np.abs(s[:, None] - s) <= HALF, 1) & ~(guest[:, None] & guest)
    if chunk[0] != chunk[-1] or (chunk != chunk[0]).any():
        near &= chunk[:, None] != chunk
    a, b = np.nonzero(near)
    counted = np.einsum("ij,jk->ik", u, directions(u.shape[1], COUNTED, 1))
    keep = []
    for at in range(0, len(a), 1 << 14):
        i, j = a[at: at + (1 << 14)], b[at: at + (1 << 14)]
        hit = (np.abs(counted[i] - counted[j]) <= HALF).sum(axis=1) >= least
        i, j = i[hit], j[hit]
        hit = np.einsum("ij,ij->i", u[i], u[j]) >= COSINE
        i, j = i[hit], j[hit]
        if t and len(i):
            linked, at_rows = np.unique(np.concatenate((i, j)), return_inverse=True)
            cells, sorts = project(u[linked], signs, lists)
            x, y = at_rows[:len(i)], at_rows[len(i):]
            before = ((cells[x, :t] == cells[y, :t]) & (np.abs(sorts[x, :t] - sorts[y, :t]) <= HALF)).any(axis=1)
            i, j = i[~before], j[~before]
        keep.append((i, j))
    return tuple(np.concatenate(x) for x in zip(*keep)) if keep else (a, b)


def _links(signs: int, lists: int, least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for pdf in batches:
                yield from pdf.itertuples(index=False, name=None)
        out: list[tuple[int, int | None, int]] = []
        for key, group in groupby(rows(), key=lambda r: r[:5]):  # list, cell, slot, chunk, chunk
            got = list(group)
            if len(got) < 2:
                continue
            chunk, guest, k, w, v, sort = zip(*(r[5:] for r in got))
            a, b = links_of_block(key[0], np.array(chunk), np.array(guest, bool), _unit(v), np.array(sort), signs, lists, least)
            if len(a):
                w = np.array(w)
                n = np.bincount(a, w[b], len(got)) + np.bincount(b, w[a], len(got))
                out += [(k[i], None, int(n[i])) for i in np.flatnonzero(n)]
                out += [(k[x], k[y], 0) for x, y in _forest(len(got), a, b)]
            if len(out) > 20_000:
                yield _frame(out)
                out = []
        yield _frame(out)
    return run


def _frame(rows: list) -> pd.DataFrame:
    return pd.DataFrame({"a": [r[0] for r in rows], "b": pd.array([r[1] for r in rows], "Int64"), "n": [r[2] for r in rows]})


def near_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per row of ``table``: id, n_links (other rows linked directly), component_id."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    rows = table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    rows = rows.withColumn("k", F.when(fine, F.xxhash64(F.transform("v", lambda x: x.cast("double") + 0.0))))
    classes = stage(rows.where("k IS NOT NULL").groupBy("k").agg(
        F.count("*").alias("w"), F.min("id").alias("first"), F.first("v").alias("v")), "vec-classes")
    signs, lists, least = settings(classes.count())
    placed = stage(classes.select("k", "v").mapInPandas(
        _places(signs, lists), "k long, cells array<long>, sorts array<double>"), "vec-places")
    # a window reaches into the slots beside its own: each row is also a guest of the next slot
    at = placed.select("k", F.posexplode(F.arrays_zip("cells", "sorts")).alias("t", "at"))
    slot = F.floor(F.col("at.sorts") / HALF).cast("int")
    at = at.select("k", "t", F.col("at.cells").alias("cell"), F.col("at.sorts").alias("sort"), F.explode(F.array(
        F.struct(slot.alias("slot"), F.lit(False).alias("guest")),
        F.struct((slot + 1).alias("slot"), F.lit(True).alias("guest")))).alias("s")) \
        .select("t", "cell", "s.slot", "s.guest", "k", "sort")
    part = ["t", "cell", "slot"]
    sizes = stage(at.groupBy(*part).agg(F.count("*").alias("n"), F.count(F.when(~F.col("guest"), 1)).alias("own"))
                  .where("n > 1 AND own > 0").select(*part, F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")), "vec-sizes")
    at = at.join(sizes, part).withColumn("chunk", F.pmod(F.xxhash64("k"), F.col("chunks")).cast("int"))
    at = at.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    blocks = stage(at.select(*part, F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
                             "chunk", "guest", "k", "sort"), "vec-blocks")
    full = blocks.join(classes.select("k", "w", "v"), "k")
    key = [*part, "i", "j"]
    found = stage(full.select(*key, "chunk", "guest", "k", "w", "v", "sort").repartition(*key)
                  .sortWithinPartitions(*key).mapInPandas(_links(signs, lists, least), "a long, b long, n long"), "vec-links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("k")).agg(F.sum("n").alias("links"))
    roots = components(found.where("b IS NOT NULL").select("a", "b"))
    joined = stage(classes.select("k", "w", "first").join(counts, "k", "left")
                   .join(roots.withColumnRenamed("node", "k"), "k", "left")
                   .select("k", "w", "first", "links", F.coalesce("root", "k").alias("root")), "vec-joined")
    ids = stage(joined.groupBy("root").agg(F.min("first").alias("component")), "vec-ids")
    known = stage(joined.join(ids, "root").select(
        "k", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n"), "component"), "vec-known")
    return rows.select("id", "k").join(known, "k", "left").select(
        "id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("k").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id"))


def op10_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors(read(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id",
                        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


#: All pairs; the operator finds those at cosines well above the threshold for certain.
OP10_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
ok AS (
  SELECT vec_id, e FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
parts AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
links AS (SELECT a AS vec_id, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM parts LEFT JOIN links USING (vec_id)
"""
