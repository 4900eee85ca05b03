import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidewater.llm import simple8b as S


@pytest.mark.parametrize("seed", range(8))
def test_round_trip_of_any_ids(seed):
    r = np.random.default_rng(seed)
    n = int(r.integers(1, 20000))
    bits = r.integers(0, [1, 3, 16, 16, 60, 64, 17, 64][seed] + 1, n)
    ids = np.array([int(r.integers(0, 2 ** 63)) * 2 + 1 & ((1 << int(b)) - 1) for b in bits], np.uint64)
    if seed % 2:
        ids[n // 3: n // 2] = 0
    words, first = S.pack(ids)
    assert len(first) == -(-n // S.BLOCK)
    assert (S.unpack(words, first, n) == ids).all()
    for k in {0, len(first) - 1}:  # a block by itself
        a, b = first[k], first[k + 1] if k + 1 < len(first) else len(words)
        part = ids[k * S.BLOCK: (k + 1) * S.BLOCK]
        assert (S.unpack(words[a:b], np.array([0]), len(part)) == part).all()


def test_words_hold_what_the_selectors_say():
    words, _ = S.pack(np.array([1] * 60 + [3] * 30 + [50256, 7, 2 ** 61], np.uint64))
    assert [int(w) & 15 for w in words[:4]] == [1, 2, 12, 14][:2] + [int(words[2]) & 15, int(words[3]) & 15]
    assert len(S.pack(np.zeros(240, np.uint64))[0]) == 2
    assert S.pack(np.array([2 ** 63], np.uint64))[0].tolist() == [0, 2 ** 63]


TEXTS = ["", "Hello world", " lead", "trail ", " ", "\n", "a\nb", "a \n b", "don't stop\nit's", "tab\tbed", "two  blanks",
         "wörld, naïve! ça: 日本語 x1 12345 &&& a,b,c.", "<|endoftext|> and <|endoftext|>x", "end\n", "\nstart, of", "a's 's ' s",
         "x" * 3000, "nb sp", "ſt Ǆ ª½ ²x", "word.\nNext one. \"quoted\" (x)"]


def test_word_cache_equals_the_library():
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(S.default_tokenizer())
    bpe = S.ByteBpe(open(S.default_tokenizer(), encoding="utf-8").read(), 30)
    r = random.Random(4)
    alphabet = ["a", "b", "The", "é", "ß", "'s", "'", ".", ",", "1", "²", " ", " ", " ", "\n", "_", "-", "|", "日", "$$$", "ª"]
    texts = TEXTS + ["".join(r.choice(alphabet) for _ in range(r.randint(1, 60))) for _ in range(400)]
    for t, ids in zip(texts, bpe.encode(texts)):
        assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids, t


def test_query_equals_brute_force(spark, tmp, monkeypatch):
    from tokenizers import Tokenizer
    rows = [(97 * i % 1000, t, 1) for i, t in enumerate(TEXTS)] + [(2000, None, 1), (2001, "long text. " * 30000, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(4).write.parquet(f"{tmp}/documents.parquet")
    monkeypatch.setattr(S, "FILE_IDS", 500)
    got = [tuple(r) for r in S.op5_simple8b(spark, tmp).orderBy("doc_id").collect()]
    lib = Tokenizer.from_file(S.default_tokenizer())
    want, at = [], 0
    for i, t, _ in sorted(rows):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want


def test_files_read_back_as_documents(spark, tmp):
    docs = spark.createDataFrame([(None, "a b"), (5, "c"), (5, "d"), (1, "")], "doc_id long, text string")
    files = S.write_ids(docs, S.default_tokenizer(), f"{tmp}/files", end=None)
    assert files.agg({"n_docs": "sum"}).first()[0] == 4
    got = S.read_ids(spark, f"{tmp}/files").collect()
    assert sorted((str(r.id), len(r.ids)) for r in got) == [("1", 0), ("5", 1), ("5", 1), ("None", 2)]


def test_empty(spark, tmp):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp}/documents.parquet")
    assert S.op5_simple8b(spark, tmp).isEmpty()


def test_a_batch_looks_up_each_distinct_word_once(monkeypatch):
    bpe = S.ByteBpe(open(S.default_tokenizer(), encoding="utf-8").read())
    asked, find = [], S.WordTable.find
    monkeypatch.setattr(S.WordTable, "find", lambda self, words: asked.extend(words.to_pylist()) or find(self, words))
    texts = ["one two, three\nfour " * 20 + "five"] * 50
    lib = bpe.tokenizer.encode(texts[0], add_special_tokens=False).ids
    assert all(ids.tolist() == lib for ids in bpe.encode(texts))
    assert sorted(asked) == sorted(["\none", "one", "two,", "three", "\nfour", "five"])
    monkeypatch.setattr(bpe, "_library", lambda texts: [] if not texts else 1 / 0)  # all is known now
    assert all(ids.tolist() == lib for ids in bpe.encode(texts))


def test_word_table_is_bounded_and_finds_what_it_has():
    table, words = S.WordTable(50), [f"w{i}" for i in range(500)] + ["x" * 65]
    for at in range(0, 501, 20):
        some = words[at: at + 20]
        table.keep(pa.array(some, pa.large_string()), pa.array([w.encode() for w in some], pa.large_binary()))
        assert len(table) <= 50 and len(table.old) <= 50
    got = table.find(pa.array(words, pa.large_string())).to_pylist()
    assert got[-1] is None and got[0] is None and got[499] == b"w499"
    assert all(x in (None, w.encode()) for w, x in zip(words, got)) and 50 < 501 - got.count(None) <= 100
    table.keep(pa.array(["a", "b"], pa.large_string()), pa.array([bytes(50 * S.WORD_BYTES), b"b"], pa.large_binary()))
    assert "a" not in list(table) and table.size <= 50 * S.WORD_BYTES


def test_white_space_of_every_kind_equals_the_library():
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(S.default_tokenizer())
    bpe = S.ByteBpe(open(S.default_tokenizer(), encoding="utf-8").read(), 30)
    texts = [t for x in range(0x3100) if chr(x).isspace() or x < 0x21 or x in (0x180E, 0x200B)
             for c in [chr(x)] for t in (c, f"a{c}b", f"a {c}b", f"a{c} b", f"a\n{c}b", f"{c}a b", f"a b{c}", f"a{c}{c}b")]
    for t, ids in zip(texts, bpe.encode(texts)):
        assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)
