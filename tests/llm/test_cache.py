from sys import getsizeof

from tidewater.llm import _cache as C
from tidewater.llm import pieces as P
from tidewater.llm import simple8b as S


def held(cache):
    return sum(getsizeof(w) + getsizeof(x) for part in (cache, cache.old) for w, x in part.items())


def test_bytes_are_bounded_however_words_come():
    words = {f"{i:060d}": bytes(1000) for i in range(3000)}
    for several in (True, False):
        cache = C.WordCache(1000)
        for found in [words] if several else [{w: x} for w, x in words.items()]:
            cache.put(found)
        assert 0 < held(cache) <= 2 * 1000 * C.WORD_BYTES
    last = f"{2999:060d}"
    assert cache.find(last) == words[last]


def test_long_words_are_not_kept_and_encode_alike():
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(S.default_tokenizer())
    texts = [f"{i}x日本" * 300 + "\nshort words here" for i in range(20)]
    bpe = S.ByteBpe(open(S.default_tokenizer(), encoding="utf-8").read())
    for _ in range(2):
        for t, ids in zip(texts, bpe.encode(texts)):
            assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids
    codec = P.Codec(P.load_pieces(P.default_model()))
    first = [codec.encode(t).tolist() for t in texts]
    assert [codec.encode(t).tolist() for t in texts] == first
    for cache in (bpe.words, bpe.parts, codec.marked, codec.plain):
        assert all(len(w) <= C.LONGEST for part in (cache, cache.old) for w in part)
        assert held(cache) < 10_000
