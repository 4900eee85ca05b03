"""SentencePiece encoding and decoding (operator 1).

An Aho-Corasick automaton over the pieces of a model file is fed the text once; at each
position the output links give every piece that ends there, and each relaxes the best score
of the position (Viterbi).  The best path is the segmentation with the greatest sum of piece
scores (of equal ones, that whose last piece is longest).  A character without a piece of its
own costs the least score less ``UNKNOWN_PENALTY`` and is written as byte pieces.

A space becomes the mark U+2581 and one mark is put in front, as the model's normalizer
says.  No piece has a mark after another character, and none has a line feed, so paths
never cross these places: the text is cut there, each distinct word is segmented once per
worker (bounded cache), and whole texts of any length take memory in proportion to their ids.
A U+2581 in the text itself is written as byte pieces, so decoding gives back every text.

Defined results: null and empty texts have no ids and decode to the empty text; repeated
rows are encoded alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._cache import WordCache
from ._frames import read, stage

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 300_000


def load_pieces(model_file: str) -> list[tuple[str, float, str]]:
    """(piece, score, kind) by id; kind: normal, byte or other (control, unknown, unused)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    kind = lambda i: "byte" if sp.is_byte(i) else "other" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) \
        else "normal"
    return [(sp.id_to_piece(i), sp.get_score(i), kind(i)) for i in range(sp.get_piece_size())]


class Automaton:
    """Aho-Corasick over the normal pieces: goto, failure and output links."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        self.next: list[dict[str, int]] = [{}]
        self.piece: list[tuple[int, float, int] | None] = [None]  # length, score, id of the piece that ends here
        self.byte_id: dict[int, int] = {}
        scores = [0.0]
        for i, (text, score, kind) in enumerate(pieces):
            if kind == "byte":
                self.byte_id[int(text[3:5], 16)] = i
            if kind != "normal":
                continue
            if MARK in text.lstrip(MARK) or "\n" in text or " " in text:
                raise ValueError(f"piece {text!r} would cross a word boundary")
            scores.append(score)
            at = 0
            for ch in text:
                to = self.next[at].get(ch)
                if to is None:
                    to = self.next[at][ch] = len(self.next)
                    self.next.append({})
                    self.piece.append(None)
                at = to
            self.piece[at] = (len(text), score, i)
        self.unknown = min(scores) - UNKNOWN_PENALTY
        self.fail, self.out = [0] * len(self.next), [0] * len(self.next)
        queue = deque(self.next[0].values())
        while queue:
            at = queue.popleft()
            for ch, to in self.next[at].items():
                f = self.fail[at]
                while f and ch not in self.next[f]:
                    f = self.fail[f]
                self.fail[to] = self.next[f].get(ch, 0) if at else 0
                queue.append(to)
            f = self.fail[at]
            self.out[at] = f if self.piece[f] else self.out[f]

    def segment(self, text: str) -> list[int]:
        """Ids of the best path over ``text`` (marks already in place)."""
        nxt, piece, fail, out = self.next, self.piece, self.fail, self.out
        best: list[float] = [0.0]
        back: list[tuple[int, int]] = [(0, -1)]
        state = 0
        for i, ch in enumerate(text, 1):
            while state and ch not in nxt[state]:
                state = fail[state]
            state = nxt[state].get(ch, 0)
            top, via, single = None, (i - 1, -1), False
            at = state if piece[state] else out[state]
            while at:  # longest first
                length, score, pid = piece[at]
                s = best[i - length] + score
                if top is None or s > top:
                    top, via = s, (i - length, pid)
                single = single or length == 1
                at = out[at]
            if not single and (top is None or best[i - 1] + self.unknown > top):
                top, via = best[i - 1] + self.unknown, (i - 1, -1)
            best.append(top)
            back.append(via)
        ids: list[int] = []
        at = len(text)
        while at:
            start, pid = back[at]
            ids.extend([pid] if pid >= 0 else [self.byte_id[b] for b in reversed(text[start:at].encode())])
            at = start
        return ids[::-1]


class Codec:
    """Encoder and decoder of one model in one worker."""

    def __init__(self, pieces: list[tuple[str, float, str]], cached_words: int = CACHED_WORDS):
        self.automaton = Automaton(pieces)
        self.marked, self.plain = WordCache(cached_words), WordCache(cached_words // 4)
        self.bytes = [bytes([int(t[3:5], 16)]) if k == "byte" else t.replace(MARK, " ").encode() if k == "normal" else b""
                      for t, _, k in pieces]
        self.feed = np.array([self.automaton.byte_id[10]], np.int32).tobytes()
        self.own_mark = np.array([self.automaton.byte_id[b] for b in MARK.encode()], np.int32).tobytes()

    def _segment(self, text: str) -> bytes:
        return np.array(self.automaton.segment(text), np.int32).tobytes()

    def _of(self, cache: WordCache, word: str, marks: str) -> bytes:
        """Ids of ``marks`` and a word; the cache knows them by blanks for all marks but one."""
        key = " " * (len(marks) - 1) + word
        got = cache.find(key)
        if got is None:
            first, *own = word.split(MARK)  # marks of the text itself are written as bytes
            got = self.own_mark.join([self._segment(marks + first), *map(self._segment, own)])
            cache.put({key: got})
        return got

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        out: list[bytes] = []
        known, plain = self.marked.get, self.plain
        for n, line in enumerate(text.split("\n")):
            if n:
                out.append(self.feed)
            words = line.split(" ")
            if n and words[0]:  # only the text's first word has a mark put in front
                out.append(self._of(plain, words[0], ""))
            rest = words if not n else words[1:]
            if "" in rest:  # runs of spaces: the marks before a word are segmented with it
                spaces = ""
                for k, w in enumerate(rest):
                    spaces += MARK
                    if w or k == len(rest) - 1:
                        out.append(self._of(self.marked, w, spaces))
                        spaces = ""
                continue
            for w in rest:
                got = known(w)
                out.append(self._of(self.marked, w, MARK) if got is None else got)
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        return (text[1:] if text[:1] == b" " else text).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def _codec(model: str, pieces, cached_words: int = CACHED_WORDS) -> Codec:
    """The worker's codec of a model; ``pieces`` is the broadcast list (its size is the model's)."""
    key = f"{model} {cached_words}"
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(pieces.value, cached_words)
    return _CODECS[key]


def _shared(spark: SparkSession, model_file: str):
    pieces = load_pieces(model_file)
    return hashlib.md5(repr(pieces).encode()).hexdigest(), spark.sparkContext.broadcast(pieces)


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
           cached_words: int = CACHED_WORDS) -> DataFrame:
    """One row per row of ``docs``: id, ids (array of int).  A worker remembers about ``cached_words``
    words; fewer save memory and cost time."""
    model, pieces = _shared(docs.sparkSession, model_file)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(model, pieces, cached_words)
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "ids": [codec.encode(t) for t in pdf["text"]]})
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .mapInPandas(run, "id long, ids array<int>")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """encoded: (id, ids).  One row per row: id, text."""
    model, pieces = _shared(encoded.sparkSession, model_file)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(model, pieces)
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "text": [codec.decode(np.asarray([] if x is None else x, np.int32)) for x in pdf["ids"]]})
    return encoded.select("id", "ids").mapInPandas(run, "id long, text string")


def encode_checked(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes in one pass: id, n_ids, ids_crc32 (of the ids as little-endian
    32-bit integers), decoded_sha256, round_trip (the decoded text equals the text)."""
    model, pieces = _shared(docs.sparkSession, model_file)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(model, pieces)
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                ids = codec.encode(text)
                back = codec.decode(ids)
                rows.append((len(ids), zlib.crc32(ids.astype("<u4").tobytes()),
                             hashlib.sha256(back.encode()).hexdigest(), back == (text or "")))
            out = pd.DataFrame(rows, columns=["n_ids", "ids_crc32", "decoded_sha256", "round_trip"])
            out.insert(0, "id", pdf["id"].to_numpy())
            yield out
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .mapInPandas(run, "id long, n_ids long, ids_crc32 long, decoded_sha256 string, round_trip boolean")


def default_model() -> str:
    """The public SentencePiece model that queries use."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(encode_checked(read(spark, sf_dir, "documents"), default_model()), "pieces") \
        .withColumnRenamed("id", "doc_id")
