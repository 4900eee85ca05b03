import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tag string, key int, idx string"


def H(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc, lower: bool = False) -> str:
    out = ""
    for c in merkle.COLUMNS:
        v = doc[c]
        if v is None:
            out += "-"
            continue
        v = str(v)
        if c == "text" and lower:
            v = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in v)
        out += f"{len(v.encode())}:{v}"
    return H(out)


def tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and every leaf's siblings (left, right) from the bottom."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            first = at[i] // 8 * 8
            p.append(("".join(nodes[first:at[i]]), "".join(nodes[at[i] + 1:first + 8])))
        nodes = [H("".join(nodes[a:a + 8])) for a in range(0, len(nodes), 8)]
        at = [a // 8 for a in at]
    return nodes[0], paths


def brute(docs: list[dict]) -> list[tuple]:
    groups: dict = {}
    for d in docs:
        groups.setdefault(d["lang"], []).append(d)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, leaf_of(d)))
    trees = [tree([leaf_of(d) for d in groups[g]]) for g in order]
    root, upper = tree([t[0] for t in trees])
    out = []
    for g, (subroot, paths), above in zip(order, trees, upper):
        for d, path in zip(groups[g], paths):
            changed = d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 3 == 0
            fold = leaf_of(d, changed)
            for a, b in path + above:
                fold = H(a + fold + b)
            out.append((d["doc_id"], leaf_of(d), subroot, root, H("".join(a + b for a, b in path + above)), fold, fold == root))
    return out


def documents(n: int, langs: list, seed: int = 3) -> list[dict]:
    r = random.Random(seed)
    rows = [{"doc_id": i * 7, "text": r.choice(["", "Some Text", "ÄÖ É mixed Case", "x" * 3000, None]) , "lang": r.choice(langs),
             "source": r.choice(["a", "b", None, ""]), "n_chars": r.choice([None, 0, 12, -3]), "tag": "t", "key": 1, "idx": "i"}
            for i in range(n)]
    return rows


def run(spark, rows: list[dict], height: int) -> list[tuple]:
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(5)
    proofs, root = merkle.manifest(docs, other=merkle.tampered(), height=height)
    out = proofs.select(F.col("tag").cast("long"), "leaf", "subroot", F.lit(root).cast("string"), "proof_sha256", "folded",
                        F.col("folded") == F.lit(root).cast("string"))
    return sorted(map(tuple, out.collect()), key=repr)


def place(depth: int, index: int, levels: int) -> int:
    """The layout by its definition: upper half, then the lower trees in order."""
    def order(depth, index, levels):
        if levels == 1:
            return [(depth, index)]
        top = levels // 2
        out = order(depth, index, top)
        for t in range(8 ** top):
            out += order(depth + top, index * 8 ** top + t, levels - top)
        return out
    return order(0, 0, levels).index((depth, index))


@pytest.mark.parametrize("levels", [1, 2, 3, 4])
def test_addresses_follow_the_recursive_layout(levels):
    for depth in range(levels):
        n = 8 ** depth
        got = merkle.address(depth, np.arange(n), levels)
        assert all(got[i] == place(depth, i, levels) for i in ([*range(n)] if n <= 64 else range(0, n, 37)))
    every = np.concatenate([merkle.address(d, np.arange(8 ** d), levels) for d in range(levels)])
    assert sorted(every.tolist()) == list(range(merkle.size(levels)))


@pytest.mark.parametrize("n, levels", [(1, 1), (2, 2), (8, 2), (9, 3), (65, 4), (5, 4)])
def test_blocks_give_their_root_and_siblings(n, levels):
    leaves = [H(str(i)) for i in range(n)]
    nodes = merkle.build_block("".join(leaves), levels)
    text, paths = merkle.block_paths(nodes, n, levels)
    assert text == "".join(leaves)
    root = nodes[0].tobytes().hex()
    for i, leaf in enumerate(leaves):
        assert merkle.fold(leaf, [level[i // 8 ** k] for k, level in enumerate(paths)]) == root
    if levels == merkle.levels_of(n):
        assert root == tree(leaves)[0]


@pytest.mark.parametrize("height", [1, 2, 4])
def test_manifest_equals_brute_force(spark, height):
    rows = documents(300, ["en"] * 6 + ["de", "", None]) + [
        {**documents(1, ["only"])[0], "doc_id": 5}, {**documents(1, ["en"])[0], "doc_id": None}]
    rows += rows[:3]                             # repeated rows
    assert run(spark, rows, height) == sorted(brute(rows), key=repr)


def test_tampering_is_found_and_nothing_else(spark):
    rows = [{**d, "text": "Upper Case"} for d in documents(60, ["en", "de"])]
    for r in run(spark, rows, 2):
        assert r[6] == (zlib.crc32(str(r[0]).encode()) % 3 != 0)


def test_one_document_and_none(spark):
    rows = documents(1, [None])
    assert run(spark, rows, 4) == brute(rows)
    assert run(spark, rows, 4)[0][4] == H("")
    assert run(spark, [], 4) == []
