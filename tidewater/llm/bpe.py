"""Byte-level BPE by a segment tree over byte positions (operator 13).

A text is cut into the matches of the rank file's pattern; each match is encoded by itself.
A match that is a token as a whole is that token.  Any other starts as single bytes.  A
segment tree over its byte positions holds, for every position at which a live part starts,
the rank of that part joined with the live part after it (infinite if no token); a node
holds the least of its two children, rank first and position second, so the root names the
leftmost pair of least rank.  A merge takes the right part's position out, and updates the
two positions whose pair changed (the merged part and the live part before it), each along
one path to the root.  A match of n bytes so takes O(n log n) steps and 32 n bytes.

Matches are encoded once per worker and kept in a bounded cache.  New ones of up to
``WIDEST`` bytes are encoded together (:meth:`Vocabulary.merge_many`): the same trees as rows of
one matrix, one merge of each row at a time.  Longer ones are encoded one by one
(:meth:`Vocabulary.merge`).  Texts are cut ``PIECES`` matches at a time, so a long text holds its
ids and one such list, not all of its matches.  The rank file is read by the driver and
broadcast (its size is the vocabulary's, not the data's).

Defined results: null and empty texts have no ids and decode to nothing; texts of any length,
also without blanks, are encoded whole; repeated rows give repeated rows; a null id stays
null; an empty table gives no rows; other columns are ignored, whatever their names.  Texts
must be valid UTF-8; every text then decodes to its own bytes.  Special tokens' strings are
ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._cache import WordCache
from ._frames import BATCH_ROWS, read

CACHED_WORDS = 300_000
PIECES = 200_000              # matches of a text handled at a time
NONE = (1 << 63) - 1          # no pair here; above every key, which is rank * 2**40 + position
_AT = (1 << 40) - 1           # the position in a key
WIDEST = 64                   # bytes of a match that is encoded together with others
ROWS = 20_000                 # such matches at a time


class Vocabulary:
    """The tokens of a rank file, and the merges of one match or of many."""

    def __init__(self, ranks: dict[bytes, int]):
        if not all(bytes([b]) in ranks for b in range(256)):
            raise ValueError("every byte needs a rank")
        self.keys = {token: rank << 40 for token, rank in ranks.items()}
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.byte_rank = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # every way to make a token of two others, ordered by the two ranks
        self.size = max(ranks.values()) + 1
        made = sorted((ranks[t[:i]] * self.size + ranks[t[i:]], r) for t, r in ranks.items()
                      for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        self.pairs = np.array([p for p, _ in made] + [NONE], np.int64)
        self.pair_key = np.array([r << 40 for _, r in made] + [NONE], np.int64)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one match.  ``nodes[n + i]`` is position i's key, ``nodes[k]`` the lesser of
        nodes 2k and 2k + 1."""
        get, n = self.keys.get, len(piece)
        if (whole := get(piece)) is not None:
            return [whole >> 40]
        nodes = array("q", [NONE]) * (2 * n)
        for i in range(n - 1):
            nodes[n + i] = get(piece[i:i + 2], NONE) | i
        for i in range(n - 1, 0, -1):
            nodes[i] = min(nodes[2 * i], nodes[2 * i + 1])
        after = array("q", range(1, n + 1))      # where the part that starts here ends
        before = array("q", range(-1, n - 1))    # where the live part before it starts
        while (least := nodes[1]) != NONE:
            left = least & _AT
            right = after[left]
            end = after[left] = after[right]
            key = NONE
            if end < n:
                before[end] = left
                key = get(piece[left:after[end]], NONE) | left
            changed = [(n + right, NONE), (n + left, key)]
            if left:
                at = before[left]
                changed.append((n + at, get(piece[at:end], NONE) | at))
            for i, key in changed:
                nodes[i] = key
                while i > 1:                     # along the path to the root, as far as nodes change
                    key = min(key, nodes[i ^ 1])
                    i >>= 1
                    if nodes[i] == key:
                        break
                    nodes[i] = key
        ids, at = [], 0
        while at < n:
            ids.append(self.keys[piece[at:after[at]]] >> 40)
            at = after[at]
        return ids

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Keys (position 0) of the tokens that two tokens make."""
        pair = a * self.size + b
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, self.pair_key[at], NONE)

    def merge_many(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids (as int32 bytes) of matches of up to ``width`` bytes, a power of two; none may be
        a token as a whole.  Row w of ``nodes`` is the tree of match w over ``width`` positions."""
        n = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), np.uint8).reshape(-1, width)
        ids = np.zeros((len(pieces), width + 1), np.int64)
        ids[:, :width] = self.byte_rank[raw]
        place = np.arange(width + 1)
        nodes = np.full((len(pieces), 2 * width), NONE, np.int64)
        nodes[:, width:-1] = np.where(place[1:width] < n[:, None], self._pair(ids[:, :-2], ids[:, 1:-1]) | place[:width - 1], NONE)
        for level in (width >> k for k in range(1, width.bit_length())):
            nodes[:, level:2 * level] = np.minimum(nodes[:, 2 * level:4 * level:2], nodes[:, 2 * level + 1:4 * level:2])
        after, before = np.tile(place + 1, (len(pieces), 1)), np.tile(place - 1, (len(pieces), 1))
        live = place[:width] < n[:, None]
        row = np.arange(len(pieces))
        while True:
            least = nodes[row, 1]
            row = row[least != NONE]
            if not len(row):
                break
            least = least[least != NONE]
            left = least & _AT
            right = after[row, left]
            end = after[row, right]
            after[row, left], before[row, end], live[row, right] = end, left, False
            ids[row, left] = least >> 40
            at = before[row, left]
            inside = end < n[row]
            key = np.where(inside, self._pair(ids[row, left], ids[row, end]) | left, NONE)
            earlier = np.where(at >= 0, self._pair(ids[row, at], ids[row, left]) | at, NONE)
            at = np.where(at >= 0, at, left)     # at the front there is no part before it
            earlier = np.where(at == left, key, earlier)
            paths = [width + right, width + left, width + at]
            for i, value in zip(paths, (NONE, key, earlier)):
                nodes[row, i] = value
            while paths[0][0] > 1:               # all leaves are at one depth
                paths = [i >> 1 for i in paths]
                for i in paths:
                    nodes[row, i] = np.minimum(nodes[row, 2 * i], nodes[row, 2 * i + 1])
        flat, ends = ids[:, :width][live].astype(np.int32).tobytes(), (4 * np.cumsum(live.sum(1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]


def read_ranks(rank_file: str) -> dict[bytes, int]:
    """token -> rank, of a file with a base64 token and its rank on each line."""
    with open(rank_file, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class ByteBpe:
    """Encoder and decoder of one rank file in one worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cached_words: int = CACHED_WORDS):
        self.vocabulary, self.pattern, self.words = Vocabulary(ranks), regex.compile(pattern), WordCache(cached_words)

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of matches that the newer half of the cache does not hold."""
        v, known, found, new = self.vocabulary, {}, {}, {}
        for w in words:
            ids = self.words.find(w)
            if ids is not None:
                known[w] = ids
                continue
            raw = w.encode()
            if raw in v.keys or len(raw) > WIDEST:
                found[w] = array("i", v.merge(raw)).tobytes()
            else:
                new.setdefault(1 << (len(raw) - 1).bit_length(), []).append((w, raw))
        for width, some in new.items():
            for at in range(0, len(some), ROWS):
                part = some[at:at + ROWS]
                found.update(zip([w for w, _ in part], v.merge_many([raw for _, raw in part], width)))
        self.words.put(found)
        return known | found

    def _matches(self, text: str) -> Iterator[list[str]]:
        if len(text) <= PIECES:
            yield self.pattern.findall(text)
            return
        matches = (m.group() for m in self.pattern.finditer(text))
        while some := list(islice(matches, PIECES)):
            yield some

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids (int32) of each text."""
        out: list[list[bytes]] = [[] for _ in texts]
        held, n, get = [], 0, self.words.get

        def flush() -> None:
            lost = {w for _, words, ids in held if None in ids for w, x in zip(words, ids) if x is None}
            learnt = self._learn(lost)
            for i, words, ids in held:
                out[i].append(b"".join([learnt[w] if x is None else x for w, x in zip(words, ids)] if None in ids else ids))
            held.clear()
        for i, text in enumerate(texts):
            for words in self._matches(text or ""):
                held.append((i, words, list(map(get, words))))
                n += len(words)
                if n >= PIECES:
                    flush()
                    n = 0
        flush()
        return [np.frombuffer(b"".join(x), np.int32) for x in out]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids.tolist()))


_CODECS: dict[str, ByteBpe] = {}


def _codec(key: str, ranks, pattern: str) -> ByteBpe:
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = ByteBpe(ranks.value, pattern)
    return _CODECS[key]


def _map(df: DataFrame, rank_file: str, pattern: str, value: str, schema: str, make) -> DataFrame:
    """One row per row of ``df`` (id and ``value``): the id, and the columns that ``make(codec,
    values)`` gives.  Ids pass as Arrow columns, so large ones and nulls stay as they are."""
    ranks = read_ranks(rank_file)
    key = hashlib.sha256(repr((pattern, ranks)).encode()).hexdigest()
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(key, shared, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), *make(codec, batch.column("value").to_pylist())], names=names)
    return df.select(F.col("id"), F.col(value).alias("value")).mapInArrow(run, schema)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ids (array of int)."""
    return _map(_texts(docs, id_col, text_col), rank_file, pattern, "text", "id long, ids array<int>",
                lambda codec, texts: [pa.array(codec.encode(texts), pa.list_(pa.int32()))])


def decode(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """encoded: (id, ids).  One row per row: id, data (the bytes)."""
    return _map(encoded, rank_file, pattern, "ids", "id long, data binary",
                lambda codec, rows: [pa.array([codec.decode(np.asarray(ids or [], np.int32)) for ids in rows], pa.binary())])


def _digest(codec: ByteBpe, texts: list[str | None]) -> list[pa.Array]:
    rows = codec.encode(texts)
    return [pa.array([len(ids) for ids in rows], pa.int64()),
            pa.array([hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest() for ids in rows], pa.string()),
            pa.array([hashlib.sha256(codec.decode(ids)).hexdigest() for ids in rows], pa.string())]


def encode_checked(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Encodes and decodes in one pass: id, n_tokens, ids_sha256 (of the decimal ids joined by
    commas), decoded_sha256."""
    return _map(_texts(docs, id_col, text_col), rank_file, pattern, "text",
                "id long, n_tokens long, ids_sha256 string, decoded_sha256 string", _digest)


def default_ranks() -> tuple[str, str]:
    """The public rank file that queries use, and its pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_checked(read(spark, sf_dir, "documents"), *default_ranks()).withColumnRenamed("id", "doc_id")
