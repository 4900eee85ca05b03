import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import Row

from tidewater.llm import bpe

FILE, PATTERN = bpe.default_ranks()
RANKS = bpe.read_ranks(FILE)


def brute(piece: bytes) -> list[int]:
    """Leftmost pair of least rank, by looking at all pairs each time."""
    if piece in RANKS:
        return [RANKS[piece]]
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        pairs = [(RANKS[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in RANKS]
        if not pairs:
            return [RANKS[p] for p in parts]
        _, i = min(pairs)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def brute_text(text: str) -> list[int]:
    import regex
    return [i for m in regex.findall(PATTERN, text) for i in brute(m.encode())]


def words(seed: int, n: int, longest: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdeeeéßx日🙂AZ") for _ in range(r.randint(1, longest))) for _ in range(n)]


def test_one_match_equals_brute_force():
    v = bpe.Vocabulary(RANKS)
    for w in words(1, 300, 30) + ["a" * 300, "ab" * 99, "\n" * 70, "zzzzzzz"]:
        assert v.merge(w.encode()) == brute(w.encode())


@pytest.mark.parametrize("width", [4, 16, 64])
def test_many_matches_equal_one(width):
    v = bpe.Vocabulary(RANKS)
    some = [w.encode() for w in words(width, 400, width) if 2 <= len(w.encode()) <= width and w.encode() not in RANKS]
    assert [np.frombuffer(x, np.int32).tolist() for x in v.merge_many(some, width)] == [brute(p) for p in some]


def test_ties_take_the_leftmost_pair():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256}
    v = bpe.Vocabulary(ranks)
    assert v.merge(b"aaa") == [256, 97]
    assert np.frombuffer(v.merge_many([b"aaa"], 4)[0], np.int32).tolist() == [256, 97]


def test_texts_equal_the_library_and_come_back(spark):
    import tiktoken
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
    texts = ["", None, " ", "a", "Hello  world\n\n it's 2024 ", "a <|endoftext|> b", "x" * 5000, " \t\n" * 2000,
             "日本語のテキスト" * 50, " ".join(words(7, 3000, 12)), "a", "tab\tand\r\nreturn   x"]
    rows = [Row(doc_id=None if i == 3 else (1 << 60) + i, text=t, ids=7, data="x", value=1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, data string, value int")
    got = sorted(bpe.encode(docs, FILE, PATTERN).collect(), key=lambda r: (r.id is not None, r.id))
    want = sorted(zip([r.doc_id for r in rows], texts), key=lambda r: (r[0] is not None, r[0]))
    assert [(r.id, r.ids) for r in got] == [(i, library.encode_ordinary(t or "")) for i, t in want]
    assert all(r.ids == brute_text(t or "") for r, (_, t) in zip(got, want) if t and len(t) < 100)
    back = sorted(bpe.decode(bpe.encode(docs, FILE, PATTERN), FILE, PATTERN).collect(), key=lambda r: (r.id is not None, r.id))
    assert [bytes(r.data).decode() for r in back] == [t or "" for _, t in want]
    digests = sorted(bpe.encode_checked(docs, FILE, PATTERN).collect(), key=lambda r: (r.id is not None, r.id))
    for d, r, (i, t) in zip(digests, got, want):
        assert (d.id, d.n_tokens) == (i, len(r.ids))
        assert d.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
        assert d.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_small_caches_and_slices_give_the_same(monkeypatch):
    texts = [" ".join(words(s, 500, 9)) for s in range(4)]
    want = [brute_text(t) for t in texts]
    monkeypatch.setattr(bpe, "PIECES", 37)
    monkeypatch.setattr(bpe, "ROWS", 5)
    assert [x.tolist() for x in bpe.ByteBpe(RANKS, PATTERN, 20).encode(texts)] == want


def test_empty_table_and_repeats(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_checked(empty, FILE, PATTERN).count() == 0
    twice = spark.createDataFrame([(1, "same words"), (1, "same words")], "doc_id long, text string")
    a, b = bpe.encode_checked(twice, FILE, PATTERN).collect()
    assert a == b


def test_query_on_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    import tiktoken
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
    got = bpe.op13_byte_bpe(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
