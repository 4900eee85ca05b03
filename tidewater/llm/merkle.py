"""Merkle manifest of a dataset, its trees stored in van Emde Boas layout (operator 12).

Leaves of one group (a language) stand in id order; every ``ARITY`` consecutive nodes become
the sha256 of their joined hex digests, until one is left, the group's subroot.  The subroots,
in the order of their groups, are the leaves of one more tree; its last node is the root.

A tree is cut into aligned subtrees (blocks) of ``ARITY ** HEIGHT`` leaves.  The nodes of a
block lie in one array in van Emde Boas order: the upper half of the levels first, then the
subtrees below it from left to right, each laid out the same way.  :func:`address` gives a
node's place by arithmetic alone; building a block and reading siblings both go through it.
The roots of the blocks are the leaves of the next tree of blocks, and so on until a group
has a single block.  A block is one row and one task's work, whatever the size of its group;
a group of any size is only ever a join key of narrow rows.

Proofs go down again: the blocks of the highest tree give each of their leaves the siblings
up to the root, these are joined to the blocks below by (group, block), and the lowest blocks
give each document its proof and the root folded from it.

Places inside a group come from a range partitioning by (group, id), counts by (partition,
group) and the rows' numbers inside their partition; no group is collected or sorted in one
task.  Every tree of blocks is a Parquet table under ``spark.checkpoint.dir``.

Defined results: a null column counts as ``-``; a null group is a group of its own and comes
first, the empty string next; null ids come before all others and are never tampered with;
rows of equal id follow their leaf digest, equal rows give equal rows but for their proofs; a
group of one document has that leaf as its subroot and an empty proof inside the group; an
empty table gives no rows; other columns are ignored; texts of any length are hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._frames import read, stage

ARITY, HEIGHT = 8, 4          # nodes of a run; levels above the leaves of a block (4096 leaves)
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BLOCK = ("key string, block long, blocks long, leaves int, levels int, nodes binary, root string, "
         "tags array<string>, others array<string>")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------------ layout of a block

def size(levels: int) -> int:
    """Nodes of a full tree of so many levels."""
    return (ARITY ** levels - 1) // (ARITY - 1)


def levels_of(leaves: int) -> int:
    n = 1
    while leaves > 1:
        leaves, n = -(-leaves // ARITY), n + 1
    return n


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Places of the nodes ``index`` at one depth (0: the root) of a tree of ``levels`` levels."""
    at = np.zeros(len(index), np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        depth, levels = depth - top, levels - top
        tree, index = np.divmod(index, ARITY ** depth)  # the subtrees below the upper half
        at += size(top) + tree * size(levels)
    return at


def build_block(leaves: str, levels: int) -> np.ndarray:
    """Nodes (rows of 32 bytes, van Emde Boas order; absent ones are zero) over joined hex digests."""
    nodes = np.zeros((size(levels), 32), np.uint8)
    for depth in range(levels - 1, -1, -1):
        n = len(leaves) // 64
        nodes[address(depth, np.arange(n), levels)] = np.frombuffer(bytes.fromhex(leaves), np.uint8).reshape(-1, 32)
        run = 64 * ARITY
        leaves = "".join([digest(leaves[a:a + run]) for a in range(0, len(leaves), run)])
    return nodes


def block_paths(nodes: np.ndarray, leaves: int, levels: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """The leaves' joined hex digests, and for each level from the leaves up to below the root
    every node's siblings (to the left, to the right)."""
    first, paths, n, run = "", [], leaves, 64 * ARITY
    for depth in range(levels - 1, -1, -1):
        text = nodes[address(depth, np.arange(n), levels)].tobytes().hex()
        first = first or text
        if depth:
            paths.append([(text[a - a % run:a], text[a + 64:a - a % run + run]) for a in range(0, len(text), 64)])
        n = -(-n // ARITY)
    return first, paths


# ------------------------------------------------------------------ trees of blocks

def _numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with idx (0, 1, ... inside their key, in the order ``order``) and n (rows of the key)."""
    parts = stage(rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
                  .withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()), name, 10_000)
    key = Window.partitionBy("key")              # one row per partition that holds the key
    earlier = key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy("part", "key").agg(F.count("*").alias("here"), F.min("row").alias("first"))
    counts = counts.select("part", "key", (F.col("first") - F.coalesce(F.sum("here").over(earlier), F.lit(0))).alias("shift"),
                           F.sum("here").over(key).alias("n"))
    return parts.join(counts, ["part", "key"]).withColumn("idx", F.col("row") - F.col("shift")) \
        .select("key", "idx", "n", "digest", "tag", "other")


def _blocks(rows: DataFrame, height: int, name: str) -> DataFrame:
    """rows: key, idx, n, digest, tag, other.  One row per block (``BLOCK``)."""
    leaves = ARITY ** height

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        key, n = pdf["key"].iloc[0], int(pdf["n"].iloc[0])
        levels = height + 1 if n > leaves else levels_of(n)
        nodes = build_block("".join(pdf["digest"]), levels)
        tags, others = (pdf[c].astype(object).where(pdf[c].notna(), None).tolist() for c in ("tag", "other"))
        return pd.DataFrame({"key": [key], "block": [int(pdf["idx"].iloc[0]) // leaves], "blocks": [-(-n // leaves)],
                             "leaves": [len(pdf)], "levels": [levels], "nodes": [nodes.tobytes()],
                             "root": [nodes[0].tobytes().hex()], "tags": [tags], "others": [others]})
    rows = rows.withColumn("block", F.floor(F.col("idx") / leaves).cast("long"))
    return stage(rows.groupBy("key", "block").applyInPandas(make, BLOCK), name)


class Forest(NamedTuple):
    trees: list               # tables of blocks, lowest first
    roots: DataFrame          # key, root: one row per group
    height: int


def forest(rows: DataFrame, order: Sequence[str], name: str, height: int = HEIGHT) -> Forest:
    """rows: key, digest, tag, other and the columns ``order``."""
    trees, numbered = [], _numbered(rows, order, f"{name}-leaves")
    while True:
        tree = _blocks(numbered, height, f"{name}-blocks{len(trees)}")
        trees.append(tree)
        more = tree.where("blocks > 1")
        if more.isEmpty():
            break
        numbered = more.select("key", F.col("block").alias("idx"), F.col("blocks").alias("n"), F.col("root").alias("digest"),
                               F.lit(None).cast("string").alias("tag"), F.lit(None).cast("string").alias("other"))
    roots = trees[0].where("blocks = 1").select("key", "root")
    for tree in trees[1:]:
        roots = roots.union(tree.where("blocks = 1").select("key", "root"))
    return Forest(trees, roots, height)


def _descend(tree: DataFrame, above: DataFrame, height: int, schema: str, rows_of, name: str) -> DataFrame:
    """Hands the siblings above every block's root (key, block, lefts, rights) on to its leaves;
    ``rows_of(block row, first leaf's idx, leaves, paths)`` gives the rows of one block."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                nodes = np.frombuffer(row.nodes, np.uint8).reshape(-1, 32)
                leaves, inside = block_paths(nodes, row.leaves, row.levels)
                outside = list(zip(row.lefts, row.rights))
                paths = ([level[i // ARITY ** k] for k, level in enumerate(inside)] + outside for i in range(row.leaves))
                yield pd.DataFrame(rows_of(row, row.block * ARITY ** height, leaves, paths), columns=names)
    names = [part.split()[0] for part in schema.split(", ")]
    return stage(tree.join(above, ["key", "block"]).mapInPandas(run, schema), name, 1)  # a row is a block


_PATH = "key string, block long, tag string, subroot string, lefts array<string>, rights array<string>"


def _hand_on(row, base: int, leaves: str, paths) -> list[tuple]:
    return [(row.key, base + i, row.tags[i], row.subroot, [a for a, _ in p], [b for _, b in p]) for i, p in enumerate(paths)]


def _groups(row, base: int, leaves: str, paths) -> list[tuple]:
    """The leaves of the tree of groups are the groups' subroots."""
    return [(key, block, tag, leaves[64 * i:64 * i + 64], lefts, rights)
            for i, (key, block, tag, _, lefts, rights) in enumerate(_hand_on(row, base, leaves, paths))]


def leaf_paths(f: Forest, above: DataFrame, schema: str, rows_of, name: str) -> DataFrame:
    """The rows that ``rows_of`` makes of the lowest blocks; above: key, subroot, lefts, rights of
    every group's last node."""
    none = F.array().cast("array<string>")
    tops = above.select("key", F.lit(0).cast("long").alias("block"), "subroot", "lefts", "rights") if above is not None else None
    path = None
    for k in range(len(f.trees) - 1, -1, -1):
        last = f.trees[k].where("blocks = 1")
        own = tops.join(last.select("key"), "key") if tops is not None else \
            last.select("key", "block", F.lit(None).cast("string").alias("subroot"), none.alias("lefts"), none.alias("rights"))
        over = own.select("key", "block", "subroot", "lefts", "rights")
        if path is not None:
            over = over.unionByName(path.select("key", "block", "subroot", "lefts", "rights"))
        path = _descend(f.trees[k], over, f.height, schema if k == 0 else _PATH, rows_of if k == 0 else _hand_on, f"{name}-paths{k}")
    return path


# ------------------------------------------------------------------ the manifest of documents

def leaf_digest(columns: Sequence[Column]) -> Column:
    """sha256 over ``byte count:value`` of each column, ``-`` for null."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(leaf: str, path) -> str:
    for left, right in path:
        leaf = digest(left + leaf + right)
    return leaf


def _proofs(row, base: int, leaves: str, paths) -> list[tuple]:
    out = []
    for i, path in enumerate(paths):
        leaf = leaves[64 * i:64 * i + 64]
        other = row.others[i]
        out.append((row.tags[i], leaf, row.subroot, digest("".join([a + b for a, b in path])), fold(other or leaf, path)))
    return out


def group_key(group: Column) -> Column:
    """A key that keeps a null group apart and first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", group_col: str = "lang",
             other: Column | None = None, height: int = HEIGHT) -> tuple[DataFrame, str | None]:
    """(proofs, root).  proofs, one row per document: tag (the id as text), leaf, subroot (of its
    group), proof_sha256, folded (from ``other``, a leaf digest or null, in the leaf's place).
    No document: no root."""
    rows = docs.select(group_key(F.col(group_col)).alias("key"), F.col(id_col).cast("long").alias("id"),
                       leaf_digest([F.col(c) for c in columns]).alias("digest"),
                       (F.lit(None).cast("string") if other is None else other).alias("other"))
    # texts are read and hashed once; sampling and sorting the ranges then read digests
    rows = stage(rows.withColumn("tag", F.col("id").cast("string")), "merkle-digests", 10_000)
    lower = forest(rows, ["id", "digest"], "merkle-docs", height)  # nulls first
    subroots = lower.roots.select(F.lit("").alias("key"), F.col("root").alias("digest"), F.col("key").alias("tag"),
                                  F.lit(None).cast("string").alias("other"))
    upper = forest(subroots, ["tag"], "merkle-groups", height)
    above = leaf_paths(upper, None, _PATH, _groups, "merkle-groups") \
        .select(F.col("tag").alias("key"), "subroot", "lefts", "rights")
    proofs = leaf_paths(lower, above, "tag string, leaf string, subroot string, proof_sha256 string, folded string", _proofs,
                        "merkle-docs")
    root = upper.roots.first()                   # at most one row
    return proofs, root and root["root"]


def tampered() -> Column:
    """Leaf digest of the lower-cased text where 3 divides the id's crc32; else null."""
    columns = [F.translate(F.col(c), UPPER, LOWER) if c == "text" else F.col(c) for c in COLUMNS]
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, leaf_digest(columns))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    proofs, root = manifest(docs, other=tampered())
    root = F.lit(root).cast("string")
    return proofs.select(F.col("tag").cast("long").alias("doc_id"), "leaf", "subroot", root.alias("root"), "proof_sha256",
                         F.col("folded").alias("folded_root"), (F.col("folded") == root).alias("verified"))


# ------------------------------------------------------------------ the same rows in DuckDB SQL

def _sql(rounds: int = 7, group_rounds: int = 2) -> str:
    """For up to 8 ** rounds documents of a language and 8 ** group_rounds languages."""
    def leaf(text: str) -> str:
        cols = {**{c: f"CAST({c} AS VARCHAR)" for c in COLUMNS}, "text": text}
        return "sha256(" + " || ".join(
            f"coalesce(CAST(octet_length(encode({e})) AS VARCHAR) || ':' || {e}, '-')" for e in cols.values()) + ")"
    step = "SELECT i, xor(x >> 1, (x & 1) * 3988292384) AS x FROM "
    table = "(SELECT i, i AS x FROM range(256) r(i))"
    for _ in range(8):
        table = f"({step}{table})"
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda c: ascii(c)::BIGINT)), lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295)")
    ctes = [f"crc AS (SELECT list(x ORDER BY i) AS t FROM {table})",
            f"""d AS (SELECT coalesce('=' || lang, '') AS k, doc_id, {leaf('text')} AS leaf,
                CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS other
                FROM documents, crc)""",
            "l AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d)"]

    def tree(name: str, first: str, n: int) -> None:
        ctes.append(f"{name}0 AS ({first})")
        for r in range(n):
            ctes.append(f"""{name}s{r} AS (SELECT k, i, d, count(*) OVER (PARTITION BY k) AS n,
                coalesce(string_agg(d, '') OVER (PARTITION BY k, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
                coalesce(string_agg(d, '') OVER (PARTITION BY k, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
                FROM {name}{r})""")
            ctes.append(f"""{name}{r + 1} AS (SELECT k, i // 8 AS i, CASE WHEN max(n) = 1 THEN max(d)
                ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d FROM {name}s{r} GROUP BY k, i // 8)""")
    tree("t", "SELECT k, i, leaf AS d FROM l", rounds)
    tree("u", f"SELECT '' AS k, row_number() OVER (ORDER BY k) - 1 AS i, d FROM t{rounds}", group_rounds)
    ctes.append(f"""g AS (SELECT k, d AS subroot, row_number() OVER (ORDER BY k) - 1 AS g FROM t{rounds})""")
    ctes.append("""f0 AS (SELECT l.k, i, g, doc_id, leaf, subroot, coalesce(other, leaf) AS f, '' AS p FROM l JOIN g ON l.k = g.k)""")
    steps = [(f"ts{r}", "x.k = s.k AND x.i // {p} = s.i", 8 ** r) for r in range(rounds)]
    steps += [(f"us{r}", "x.g // {p} = s.i", 8 ** r) for r in range(group_rounds)]
    for n, (name, on, p) in enumerate(steps):
        ctes.append(f"""f{n + 1} AS (SELECT x.k, x.i, x.g, doc_id, leaf, subroot,
            CASE WHEN s.n = 1 THEN f ELSE sha256(s.a || f || s.b) END AS f, p || s.a || s.b AS p
            FROM f{n} x JOIN {name} s ON {on.format(p=p)})""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, subroot, r.d AS root, sha256(p) AS proof_sha256, f AS folded_root, f = r.d AS verified
FROM f{len(steps)}, u{group_rounds} r"""


OP12_SQL = _sql()
