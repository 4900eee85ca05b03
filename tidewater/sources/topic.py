"""A replayable topic of key/value messages in a shared folder, as a Spark data source.

``tidewater_topic`` reads and writes, in batch and as a stream.  It stands where a broker is not
at hand (tests, backfills, replays); a topic's folder must be mounted by all machines.

A topic has a fixed number of partitions; a message's partition follows from its key, and its
offset counts the messages before it in its partition.  Tasks write Parquet files that nobody
sees yet; the driver's commit gives them their offsets and adds one entry to the topic's log
(``log/000000000007.json``), whose creation is atomic and fails if another writer was first, who is
then followed.  A send that fails leaves no entry, and a send that is repeated under the same name
(option ``txn``; a stream names its batches) finds the first one's entry and adds nothing.

Reader options: ``startingOffsets`` (``earliest``, ``latest`` or JSON of partition to offset),
``endingOffsets`` (batch only) and ``failOnDataLoss`` (messages that :func:`expire` removed raise an
error, or are skipped).  A trigger reads all that is new, a task for each file: Spark does not tell
a Python source where a restarted query stands, so it can't hold a batch to a number of offsets."""

from __future__ import annotations

import json
import logging
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamReader, DataSourceStreamWriter, DataSourceWriter,
                                    InputPartition, WriterCommitMessage)

log = logging.getLogger(__name__)

PARTITIONS = 4                # of a topic that is written for the first time
FILE_ROWS = 100_000           # messages of a file
TXNS = 1_000                  # names of sends that the newest log entry remembers
SCHEMA = "key string, value string, partition int, offset long, timestamp timestamp"
_FILE = pa.schema([("key", pa.string()), ("value", pa.string())])


def partition_of(key: str | None, partitions: int) -> int:
    return 0 if key is None else zlib.crc32(key.encode()) % partitions


# ------------------------------------------------------------------ the log

@dataclass
class Entry:
    """What one commit added, and the topic's state after it."""

    number: int = 0
    at: int = 0                                    # microseconds since 1970
    files: list = field(default_factory=list)      # [name, partition, first offset, messages]
    earliest: dict = field(default_factory=dict)   # partition -> first offset that is still there
    next: dict = field(default_factory=dict)       # partition -> offset of the next message
    txns: list = field(default_factory=list)


def _path(root: str, *parts: str) -> str:
    return os.path.join(root.removeprefix("file:"), *parts)


def _numbers(root: str) -> list[int]:
    folder = _path(root, "log")
    return sorted(int(n[:-5]) for n in os.listdir(folder) if n.endswith(".json")) if os.path.isdir(folder) else []


def _entry(root: str, number: int) -> Entry:
    with open(_path(root, "log", f"{number:012d}.json"), encoding="utf-8") as f:
        return Entry(**json.load(f))


def newest(root: str) -> Entry:
    numbers = _numbers(root)
    return _entry(root, numbers[-1]) if numbers else Entry()


def _append(root: str, entry: Entry) -> bool:
    """Makes the entry visible as a whole, or not at all where its number is taken."""
    os.makedirs(_path(root, "log"), exist_ok=True)
    draft = _path(root, "log", f".{uuid.uuid4().hex}")
    with open(draft, "w", encoding="utf-8") as f:
        json.dump(entry.__dict__, f)
    try:
        os.link(draft, _path(root, "log", f"{entry.number:012d}.json"))
        return True
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)


def _now() -> int:
    import time

    return time.time_ns() // 1000


def add(root: str, files: list, partitions: int, txn: str | None) -> bool:
    """Gives written files (name, partition, messages) their offsets; False if ``txn`` has been added before."""
    while True:
        last = newest(root)
        if txn is not None and txn in last.txns:
            return False
        now = {str(p): last.next.get(str(p), 0) for p in range(max(partitions, len(last.next)))}
        placed = []
        for name, p, n in files:
            placed.append([name, p, now[str(p)], n])
            now[str(p)] += n
        earliest = {p: last.earliest.get(p, 0) for p in now}
        txns = (last.txns + [txn])[-TXNS:] if txn is not None else last.txns
        if _append(root, Entry(last.number + 1, _now(), placed, earliest, now, txns)):
            return True


def files_between(root: str, start: dict, end: dict) -> list[tuple[str, int, int, int, int, int]]:
    """(file, partition, its first offset, from row, to row, time) of all messages in the range; the log
    is read backwards until the range is covered."""
    out, left = [], {p: start.get(p, 0) for p in end if start.get(p, 0) < end[p]}
    for number in reversed(_numbers(root)):
        if not left:
            break
        entry = _entry(root, number)
        for name, p, first, n in entry.files:
            a, b = max(start.get(str(p), 0), first), min(end.get(str(p), 0), first + n)
            if a < b:
                out.append((name, p, first, a - first, b - first, entry.at))
            if str(p) in left and first <= left[str(p)]:
                del left[str(p)]
    return out


def expire(root: str, before: dict) -> None:
    """Removes the files whose messages all lie before the offsets given by partition."""
    while True:
        last = newest(root)
        earliest = {**last.earliest, **{str(p): max(last.earliest.get(str(p), 0), min(o, last.next.get(str(p), 0))) for p, o in before.items()}}
        if _append(root, Entry(last.number + 1, _now(), [], earliest, last.next, last.txns)):
            break
    for number in _numbers(root):
        for name, p, first, n in _entry(root, number).files:
            if first + n <= earliest.get(str(p), 0) and os.path.exists(_path(root, "data", name)):
                os.unlink(_path(root, "data", name))


# ------------------------------------------------------------------ reading

@dataclass
class Slice(InputPartition):
    name: str
    partition: int
    first: int
    start: int
    stop: int
    at: int


def _offsets(root: str, wanted: str) -> dict:
    last = newest(root)
    if wanted == "earliest":
        return dict(last.earliest)
    if wanted == "latest":
        return dict(last.next)
    return {p: int(dict(json.loads(wanted)).get(p, 0)) for p in last.next} or {p: int(o) for p, o in json.loads(wanted).items()}


class _Reading:
    def __init__(self, options):
        self.root = options["path"]
        self.strict = str(options.get("failOnDataLoss", "true")).lower() != "false"

    def slices(self, start: dict, end: dict) -> list[Slice]:
        start, gone = dict(start), newest(self.root).earliest
        for p in end:
            if start.get(p, 0) < min(gone.get(p, 0), end[p]):
                lost = f"messages {start.get(p, 0)} to {gone[p]} of partition {p} of {self.root} have been removed"
                if self.strict:
                    raise ValueError(f"{lost}; set failOnDataLoss to false to go on behind them")
                log.warning("%s; reading goes on behind them", lost)
                start[p] = gone[p]
        return [Slice(*f) for f in files_between(self.root, start, end)]

    def read(self, part: Slice) -> Iterator[pa.RecordBatch]:
        path, seen = _path(self.root, "data", part.name), 0
        if not os.path.exists(path) and not self.strict:
            return
        for b in pq.ParquetFile(path).iter_batches(10_000):
            own = b.slice(max(0, part.start - seen), max(0, min(len(b), part.stop - seen) - max(0, part.start - seen)))
            at = part.first + max(seen, part.start)
            seen += len(b)
            if len(own):
                n = len(own)
                yield pa.RecordBatch.from_arrays(
                    [own.column("key"), own.column("value"), pa.array([part.partition] * n, pa.int32()),
                     pa.array(range(at, at + n), pa.int64()), pa.array([part.at] * n, pa.timestamp("us", "UTC"))],
                    names=["key", "value", "partition", "offset", "timestamp"])


class TopicReader(_Reading, DataSourceReader):
    def __init__(self, options):
        super().__init__(options)
        self.start = _offsets(self.root, options.get("startingOffsets", "earliest"))
        self.end = _offsets(self.root, options.get("endingOffsets", "latest"))

    def partitions(self):
        return self.slices(self.start, self.end) or [Slice("", 0, 0, 0, 0, 0)]

    def read(self, part: Slice):
        return super().read(part) if part.name else iter(())


class TopicStreamReader(_Reading, DataSourceStreamReader):
    def __init__(self, options):
        super().__init__(options)
        self.starting = options.get("startingOffsets", "latest")

    def initialOffset(self) -> dict:
        return _offsets(self.root, self.starting)

    def latestOffset(self) -> dict:
        return newest(self.root).next

    def partitions(self, start: dict, end: dict):
        return self.slices(start, end)


# ------------------------------------------------------------------ writing

@dataclass
class Written(WriterCommitMessage):
    files: list


class _Writing:
    def __init__(self, options):
        self.root = options["path"]
        self.partitions = len(newest(self.root).next) or int(options.get("partitions", PARTITIONS))
        self.txn = options.get("txn")
        os.makedirs(_path(self.root, "data"), exist_ok=True)

    def write(self, iterator) -> Written:
        held: dict[int, list] = {}
        files: list = []

        def flush(p: int) -> None:
            rows = held.pop(p)
            name = f"{uuid.uuid4().hex}.parquet"
            pq.write_table(pa.Table.from_pylist(rows, schema=_FILE), _path(self.root, "data", name))
            files.append((name, p, len(rows)))
        for row in iterator:
            p = partition_of(row["key"], self.partitions)
            held.setdefault(p, []).append({"key": row["key"], "value": row["value"]})
            if len(held[p]) >= FILE_ROWS:
                flush(p)
        for p in list(held):
            flush(p)
        return Written(files)

    def _commit(self, messages, txn: str | None) -> None:
        files = [tuple(f) for m in messages if m is not None for f in m.files]
        if not add(self.root, files, self.partitions, txn):
            self._drop(messages)

    def _drop(self, messages) -> None:
        for m in messages:
            for name, _, _ in (m.files if m is not None else ()):
                os.unlink(_path(self.root, "data", name))


class TopicWriter(_Writing, DataSourceWriter):
    def commit(self, messages) -> None:
        self._commit(messages, self.txn)

    def abort(self, messages) -> None:
        self._drop(messages)


class TopicStreamWriter(_Writing, DataSourceStreamWriter):
    def commit(self, messages, batchId: int) -> None:
        self._commit(messages, f"{self.txn or 'stream'}-{batchId}")

    def abort(self, messages, batchId: int) -> None:
        self._drop(messages)


class TopicSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidewater_topic"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TopicReader:
        return TopicReader(self.options)

    def streamReader(self, schema) -> TopicStreamReader:
        return TopicStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> TopicWriter:
        if overwrite:
            raise ValueError("a topic is only appended to")
        return TopicWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> TopicStreamWriter:
        return TopicStreamWriter(self.options)


def register(spark: SparkSession) -> str:
    """Makes the format known to the session; returns its name."""
    spark.dataSource.register(TopicSource)
    return TopicSource.name()


def send(df: DataFrame, path: str, txn: str | None = None, partitions: int = PARTITIONS) -> None:
    """Appends the ``key``/``value`` rows of a batch; once only for each ``txn``."""
    w = df.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value") \
        .write.format(register(df.sparkSession)).option("path", path).option("partitions", partitions)
    (w.option("txn", txn) if txn is not None else w).mode("append").save()


def read_topic(spark: SparkSession, path: str, **options) -> DataFrame:
    """The messages from ``startingOffsets`` to ``endingOffsets`` as a batch."""
    return spark.read.format(register(spark)).options(**options).load(path)
