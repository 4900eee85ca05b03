"""Simple-8b files of token ids (operator 5).

Words are 64 bits: a selector in the low 4 bits, then as many ids of equal width as fit.

    selector   1   2   3   4   5   6   7   8   9  10  11  12  13  14
    ids       60  30  20  15  12  10   8   7   6   5   4   3   2   1
    bits       1   2   3   4   5   6   7   8  10  12  15  20  30  60

Selector 15 is a run of 120 zeros.  Selector 0 is an escape: the next word is one id, raw,
for ids of more than 60 bits.  Ids are cut into blocks of ``BLOCK``; a block starts with a
new word (its last word is padded with zeros), and the file's index has each block's first
word, so blocks decode independently, all words of one selector at a time.

A file (little endian): magic ``S8B1``; counts of documents, ids, blocks and words (uint64);
per block its first word (uint64); per document its id (int64), null flag (uint8) and the end
of its ids in the file (uint64); the words.

Files are written by tasks over range partitions in ascending id order, each under its
final name only when whole (a rerun task replaces it by the same bytes), through the file
system of the path (``pyarrow.fs``), and read back with Spark's ``binaryFile`` source.

Defined results: null and empty texts have the end id alone; ids that tie are ordered by a
hash of the text; null document ids come first; an empty table writes no files and gives no
rows; other columns are ignored.  A text of any length is encoded whole and may span blocks;
a file ends after the document that fills it.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import session_conf, work_dir

from ._cache import LONGEST, WORD_BYTES
from ._frames import ordered, read, stage

WIDTHS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15),
          (3, 20), (2, 30), (1, 60))      # selectors 1 to 14: ids, bits
RUN = 120                                 # zeros of selector 15
BLOCK = 4096                              # ids of a block
FILE_IDS = 1 << 20                        # ids after which a file ends
OPEN_COST = 1 << 18                       # bytes that a file counts for beside its own when files are dealt to tasks
MAGIC = b"S8B1"
CACHED_WORDS = 100_000                    # a look-up of a batch passes over the whole table
END = 0


_COUNTS = np.array([1, *(c for c, _ in WIDTHS), RUN], np.int64)


_LIMITS = np.array([0, *((1 << bits) - 1 for _, bits in WIDTHS)], np.uint64)
_RANKS = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64)).astype(np.uint8)


def _ranks(ids: np.ndarray) -> np.ndarray:
    """For each id the selector of least width that holds it; 0 for a zero, 15 for an escape."""
    if len(ids) and int(ids.max()) < len(_RANKS):
        return _RANKS[ids]
    return np.searchsorted(_LIMITS, ids).astype(np.uint8)


def _choose(ids: np.ndarray) -> np.ndarray:
    """For each position the selector of a word that starts there, the one that takes most ids: a
    row a block.  A last word may be filled with zeros, so what follows a block counts as zeros."""
    blocks = -(-len(ids) // BLOCK)
    filled = np.zeros(blocks * BLOCK, np.uint8)
    filled[: len(ids)] = _ranks(ids)
    rank = np.zeros((blocks, BLOCK + RUN), np.uint8)
    rank[:, :BLOCK] = filled.reshape(blocks, BLOCK)
    out = np.zeros((blocks, BLOCK), np.uint8)
    most, m = rank, 1                     # the highest rank of the m ids from each position on
    for k in range(len(WIDTHS), 0, -1):   # ever narrower, so the last that fits takes most ids
        count = WIDTHS[k - 1][0]
        while 2 * m <= count:
            most, m = np.maximum(most[:, :-m], most[:, m:]), 2 * m
        window = np.maximum(most[:, :BLOCK], most[:, count - m: count - m + BLOCK])
        np.copyto(out, k, where=window <= k)
    # a run of zeros is never filled up
    run = np.maximum(window[:, : BLOCK - RUN + 1], window[:, RUN // 2: BLOCK - RUN // 2 + 1]) == 0
    run[blocks - 1:, max(0, len(ids) - (blocks - 1) * BLOCK - RUN + 1):] = False
    np.copyto(out[:, : BLOCK - RUN + 1], 15, where=run)
    return out


def _starts(step: np.ndarray) -> np.ndarray:
    """The positions where words start, all blocks a word at a time.  step: a row a block, the ids
    that a word at each position takes."""
    blocks = len(step)
    flat, at, ends = step.reshape(-1), np.arange(blocks) * BLOCK, np.arange(1, blocks + 1) * BLOCK
    mark = np.zeros(blocks * BLOCK, bool)
    while len(at):
        mark[at] = True
        at = at + flat[at]
        live = at < ends
        if not live.all():
            at, ends = at[live], ends[live]
    return np.flatnonzero(mark)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all blocks of ``ids`` (uint64), and the first word of each block."""
    n = len(ids)
    pick = _choose(ids)
    starts = _starts(_COUNTS[pick])
    starts = starts[starts < n]
    left = np.minimum(BLOCK - starts % BLOCK, n - starts)  # ids up to the end of the block
    sel = pick.reshape(-1)[starts]
    size = np.where(sel == 0, 2, 1)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    padded = np.concatenate([ids, np.zeros(RUN, np.uint64)])
    for k in np.unique(sel):
        own = sel == k
        at, to = starts[own], place[own]
        if k == 0:
            words[to + 1] = ids[at]
        elif k == 15:
            words[to] = 15
        else:
            count, bits = WIDTHS[k - 1]
            value, space = np.full(len(at), k, np.uint64), left[own]
            last = np.flatnonzero(space < count)
            for j in range(count):
                part = padded[at + j]
                if len(last):
                    part[last] *= space[last] > j  # a block's last word is filled with zeros
                value |= part << np.uint64(4 + j * bits)
            words[to] = value
    return words, place[starts % BLOCK == 0]


def _leads(sel: np.ndarray) -> np.ndarray:
    """Places of the words that have a selector: the word after an escape has none."""
    lead = np.ones(len(sel), bool)
    skip = -1
    for at in np.flatnonzero(sel == 0).tolist():
        if at != skip:
            skip = at + 1
            lead[skip] = False
    return np.flatnonzero(lead)


def unpack(words: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of blocks that begin at the words ``first``, a selector at a time."""
    sel = (words & np.uint64(15)).astype(np.int64)
    lead = _leads(sel)
    sel = sel[lead]
    counts = _COUNTS[sel]
    start = np.cumsum(counts) - counts
    block = np.searchsorted(first, lead, side="right") - 1
    base = start[np.searchsorted(lead, first)]
    start += block * BLOCK - base[block]
    end = np.minimum((block + 1) * BLOCK, n)
    out = np.zeros(n + 1, np.uint64)  # what fills a last word goes to the end and is cut off
    for k in np.unique(sel):
        own = sel == k
        if k == 0:
            out[start[own]] = words[lead[own] + 1]
        elif k < 15:
            count, bits = WIDTHS[k - 1]
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits) + np.uint64(4)
            at, own = start[own], np.flatnonzero(own)
            to = at[:, None] + np.arange(count)
            last = np.flatnonzero(at + count > end[own])
            to[last] = np.where(to[last] < end[own[last]][:, None], to[last], n)
            out[to] = (words[lead[own]][:, None] >> shifts) & np.uint64((1 << bits) - 1)
    return out[:n]


def write_file(docs: list[tuple[int | None, np.ndarray]]) -> bytes:
    """The bytes of one file; docs: (id, ids)."""
    sizes = np.array([len(x) for _, x in docs], np.uint64)
    ids = np.concatenate([x for _, x in docs]).astype(np.uint64) if docs else np.empty(0, np.uint64)
    words, first = pack(ids) if len(ids) else (ids, ids)
    head = np.array([len(docs), len(ids), len(first), len(words)], np.uint64)
    return b"".join([MAGIC, head.tobytes(), first.astype(np.uint64).tobytes(),
                     np.array([0 if i is None else i for i, _ in docs], np.int64).tobytes(),
                     np.array([i is None for i, _ in docs], np.uint8).tobytes(),
                     np.cumsum(sizes, dtype=np.uint64).tobytes(), words.tobytes()])


def read_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, the ends of their ids, and all ids."""
    if data[:4] != MAGIC:
        raise ValueError("not a Simple-8b file")
    n_docs, n_ids, n_blocks, n_words = (int(x) for x in np.frombuffer(data, np.uint64, 4, 4))
    at = 36
    first = np.frombuffer(data, np.uint64, n_blocks, at).astype(np.int64)
    at += 8 * n_blocks
    docs = np.frombuffer(data, np.int64, n_docs, at)
    at += 8 * n_docs
    null = np.frombuffer(data, np.uint8, n_docs, at)
    at += n_docs
    ends = np.frombuffer(data, np.uint64, n_docs, at).astype(np.int64)
    at += 8 * n_docs
    words = np.frombuffer(data, np.uint64, n_words, at)
    return [None if x else int(d) for d, x in zip(docs, null)], ends, unpack(words, first, n_ids) if n_ids else words


_NO_WORDS, _NO_IDS = pa.array([], pa.large_string()), pa.array([], pa.large_binary())


class WordTable:
    """Words and their ids as Arrow columns, bounded as ``_cache.WordCache`` is: ``limit`` words, or
    ``limit`` times ``WORD_BYTES`` bytes, make a generation, and the one before it is kept."""

    def __init__(self, limit: int, generations: int = 2):
        self.limit, self.size, self.words, self.ids = limit, 0, _NO_WORDS, _NO_IDS
        self.old = WordTable(limit, generations - 1) if generations > 1 else None

    def __len__(self) -> int:
        return len(self.words)

    def __iter__(self) -> Iterator[str]:
        return iter(self.words.to_pylist())

    def items(self) -> Iterator[tuple[str, bytes]]:
        return zip(self.words.to_pylist(), self.ids.to_pylist())

    def find(self, words: pa.Array) -> pa.Array:
        """Ids of each word, null where they are not known; what only the older generation has
        moves to the newer."""
        at = pc.index_in(words, value_set=self.words)
        ids = self.ids.take(at)
        if at.null_count and self.old is not None and len(self.old):
            rest = words.filter(at.is_null())
            old = pc.index_in(rest, value_set=self.old.words)
            place = np.arange(len(words))
            place[at.is_null().to_numpy(zero_copy_only=False)] = len(words) + np.arange(len(rest))
            moved = self.old.ids.take(old)
            ids = pa.concat_arrays([ids, moved]).take(pa.array(place))
            self.keep(rest.filter(old.is_valid()), moved.filter(old.is_valid()))
        return ids

    def keep(self, words: pa.Array, ids: pa.Array) -> None:
        """Take in words that the newer generation has not."""
        short = pc.less_equal(pc.utf8_length(words), LONGEST)
        words, ids = words.filter(short), ids.filter(short)
        sizes = np.cumsum(pc.binary_length(words).to_numpy() + pc.binary_length(ids).to_numpy() + 16)
        room = self.limit * WORD_BYTES
        n = min(self.limit, int(np.searchsorted(sizes, room, side="right")))
        if not n:
            return
        words, ids, size = words[:n], ids[:n], int(sizes[n - 1])
        if len(self) + n > self.limit or self.size + size > room:
            self.old.words, self.old.ids = self.words, self.ids
            self.words, self.ids, self.size = _NO_WORDS, _NO_IDS, 0
        self.words, self.ids = pa.concat_arrays([self.words, words]), pa.concat_arrays([self.ids, ids])
        self.size += size


class ByteBpe:
    """The tokenizers library behind a bounded cache of words.

    The file's pre-tokenizer always cuts before a blank between two other characters, and
    before and after a line feed between two others, so a text's ids are those of its words,
    each with the blank or line feed before it.  Texts are split, and the ids of their words put
    together, as Arrow columns; only distinct words are looked up.  Texts with any other white
    space, or with a special token's string, go to the library whole."""

    # blanks and line feeds at an end or next to each other, and all other white space
    _other = ("\\A[ \n]|[ \n]\\z|[ \n][ \n]|"
              "[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

    def __init__(self, tokenizer_json: str, cached_words: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        # strings of special tokens in a text become these tokens, as the library has it
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.blank = np.zeros(max(vocabulary.values()) + 1, bool)
        self.blank[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True  # the byte of a blank
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.cuts = len(line) == 1        # else words cannot be told apart by a line feed's id
        self.line = np.zeros(len(self.blank), bool)
        self.line[line] = True
        # words after a blank, without it; words after a line feed, with it
        self.words, self.parts = WordTable(cached_words), WordTable(3 * cached_words // 5)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _library_words(self, words: pa.Array, mark: str, marks: np.ndarray) -> pa.Array:
        """Words that follow a blank or line feed go to the library as one text: it cuts there,
        so a word's ids start at each id whose token starts with that mark."""
        if not len(words):
            return _NO_IDS
        _, at, data = pc.binary_replace_slice(words, 0, 0, mark).buffers()
        at, data = np.frombuffer(at, np.int64)[: len(words) + 1], memoryview(data)
        found, sizes = [], [[0]]
        for i in range(0, len(words), 20_000):
            j = min(i + 20_000, len(words))
            ids = np.frombuffer(self._library([str(data[at[i]: at[j]], "utf-8")])[0], np.uint32)
            first = np.flatnonzero(marks[ids])
            if len(first) != j - i:
                raise RuntimeError("the tokenizer file does not cut before blanks and line feeds")
            found.append(ids)
            sizes.append(np.diff(first, append=len(ids)))
        ends = 4 * np.cumsum(np.concatenate(sizes).astype(np.int64))
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(found))])

    def _known(self, table: WordTable, words: pa.Array, mark: str, marks: np.ndarray) -> pa.Array:
        ids = table.find(words)
        lost = ids.is_null()
        at = np.arange(len(words))
        new = np.flatnonzero(lost.to_numpy(zero_copy_only=False))
        at[new] = len(words) + np.arange(len(new))
        learnt, words = self._library_words(words.filter(lost), mark, marks), words.filter(lost)
        table.keep(words, learnt)
        return pa.concat_arrays([ids, learnt]).take(pa.array(at))

    def _ids(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words, with those of the blank or line feed before them."""
        lines = pc.starts_with(words, "\n").to_numpy(zero_copy_only=False)
        apart, after = np.flatnonzero(~lines), np.flatnonzero(lines)
        ids = pa.concat_arrays([self._known(self.words, words.take(pa.array(apart)), " ", self.blank),
                                self._known(self.parts, words.take(pa.array(after)), "", self.line)])
        return ids.take(pa.array(np.argsort(np.concatenate([apart, after]))))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids (uint32) of each text."""
        column = pa.array([t or "" for t in texts], pa.large_string())
        rest = pc.match_substring_regex(column, self._other)
        for x in self.special:
            rest = pc.or_(rest, pc.match_substring(column, x))
        rest = rest.to_numpy(zero_copy_only=False) | (not self.cuts)
        filled = pc.not_equal(column, "").to_numpy(zero_copy_only=False)
        out = [np.empty(0, np.uint32)] * len(texts)
        whole, split = np.flatnonzero(filled & rest).tolist(), np.flatnonzero(filled & ~rest).tolist()
        for i, ids in zip(whole, self._library([texts[i] for i in whole])):
            out[i] = np.frombuffer(ids, np.uint32)
        if not split:
            return out
        # a text is given a line feed in front, so that its first word has a mark, too
        lines = pc.replace_substring(column.take(pa.array(split)), "\n", " \n")
        words = pc.split_pattern(pc.binary_replace_slice(lines, 0, 0, "\n"), " ")
        coded = words.flatten().dictionary_encode()
        ids = self._ids(coded.dictionary).take(coded.indices)
        raw = np.frombuffer(ids.buffers()[2], np.uint32)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[words.offsets.to_numpy()] // 4
        for i, a, b in zip(split, ends[:-1].tolist(), ends[1:].tolist()):
            out[i] = raw[a + 1: b]
        return out


_TOKENIZERS: dict[str, ByteBpe] = {}


def _tokenizer(key: str, file) -> ByteBpe:
    """The worker's tokenizer of a broadcast file (its size is the file's)."""
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = ByteBpe(file.value)
    return _TOKENIZERS[key]


def _put(folder: str, name: str, data: bytes) -> None:
    """Write a file under a name of its own, then give it its final one."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    part = f"{path}/_{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(part) as f:
        f.write(data)
    store.move(part, f"{path}/{name}")


def write_ids(docs: DataFrame, tokenizer_file: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
              end: int | None = END) -> DataFrame:
    """Encode ``docs`` in ascending id order into files under ``folder``; returns one row per
    file: file, n_docs, n_ids.  File names sort in the order of the ids."""
    with open(tokenizer_file, encoding="utf-8") as f:
        content = f.read()
    key, file = str(zlib.crc32(content.encode())), docs.sparkSession.sparkContext.broadcast(content)
    tail = np.array([] if end is None else [end], np.uint32)
    _make(folder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        bpe, part, files = _tokenizer(key, file), TaskContext.get().partitionId(), []
        held, n = [], 0

        def flush() -> None:
            nonlocal held, n
            if held:
                name = f"part-{part:06d}-{len(files):06d}.s8b"
                _put(folder, name, write_file(held))
                files.append((name, len(held), n))
                held, n = [], 0
        for pdf in batches:
            for i, ids in zip(pdf["id"].astype(object).where(pdf["id"].notna(), None), bpe.encode(list(pdf["text"]))):
                held.append((None if i is None else int(i), np.concatenate([ids, tail])))
                n += len(held[-1][1])
                if n >= FILE_IDS:
                    flush()
        flush()
        yield pd.DataFrame(files, columns=["file", "n_docs", "n_ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    return stage(rows.mapInPandas(run, "file string, n_docs long, n_ids long"), "s8b-files", 1000)


def _make(folder: str) -> None:
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    store.create_dir(path, recursive=True)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the files under ``folder``: file, id, at (place in its file), ids_before
    (in the file), ids (array)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for name, docs, ends, ids in _files(batches):
            begins = np.concatenate(([0], ends[:-1]))
            yield pd.DataFrame({"file": name, "id": pd.array(docs, "Int64"), "ids_before": begins,
                                "ids": [ids[a:b].astype(np.int64) for a, b in zip(begins, ends)]})
    return _binary(spark, folder).mapInPandas(run, "file string, id long, ids_before long, ids array<long>")


def _binary(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*.s8b").load(folder) \
        .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def _files(batches: Iterator[pd.DataFrame]):
    for pdf in batches:
        for name, data in zip(pdf["file"], pdf["content"]):
            yield name, *read_file(data)


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for name, docs, ends, ids in _files(batches):
        begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
        raw = ids.astype("<u4").tobytes()
        yield pd.DataFrame({"file": name, "doc_id": pd.array(docs, "Int64"), "ids_before": begins, "n_tokens": ends - begins,
                            "ids_crc32": [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]})


def default_tokenizer() -> str:
    """The public tokenizer file that queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "s8b")
    files = write_ids(read(spark, sf_dir, "documents"), default_tokenizer(), folder)
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    starts = ordered(files, [F.asc("file")], "n_ids", "s8b-order").select("file", F.col("before").alias("first"))
    # files of some 150 KB: counted as 4 MB each, as Spark does, they make a task of every few
    with session_conf(spark, {"spark.sql.files.openCostInBytes": str(OPEN_COST)}):
        docs = stage(_binary(spark, folder).mapInPandas(
            _digest, "file string, doc_id long, ids_before long, n_tokens long, ids_crc32 long"), "s8b-docs", 1)  # a row is a file
    return docs.join(starts, "file").select("doc_id", (F.col("first") + F.col("ids_before")).alias("start"),
                                            "n_tokens", "ids_crc32")
