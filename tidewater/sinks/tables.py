"""Tables of micro-batches with snapshots: small batch folders are merged while readers run.

``batches/batch_id=N`` holds what one micro-batch wrote; writing it again replaces it.  ``compact``
merges the batches since the last one into a generation (``generations/gen=...``), and ``FANOUT``
generations of one level into one of the next, so each row is rewritten once per level and an hour
holds a bounded number of files.  ``manifest/000000000007.json`` names the live generations and the last
batch they contain.  A compaction writes its files first and then adds a manifest; creating it is
the switch.  A crash before it leaves folders that no manifest names (:func:`vacuum` removes them);
a reader that has started goes on with the files of its snapshot, which ``vacuum`` keeps for as
many manifests as it is told.  A batch that is replayed after it was merged changes nothing.

With a ``key`` the table holds one row per key: the one of the latest batch, inside a batch the
greatest by ``order_by``.  Reading merges: generations and batches behind the oldest generation are
reduced to their latest rows, which take the place of that generation's rows.  Rows whose key is
null are kept as they are.

One process compacts a table at a time; batches may be written meanwhile."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

FANOUT = 4                    # generations of a level that are merged into one of the next
BATCH = "_batch"              # column: the batch a row came from


# ------------------------------------------------------------------ files, through Spark's own file systems

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _manifest(spark: SparkSession, path: str, number: int) -> dict | None:
    """None where its writer did not get to the end."""
    fs, p = _fs(spark, f"{path}/manifest/{number:012d}.json")
    stream = fs.open(p)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n[:-5]) for n in _names(spark, f"{path}/manifest") if n.endswith(".json") and not n.startswith(".")]


def snapshot(spark: SparkSession, path: str) -> dict:
    """The newest manifest: number, generations (oldest first: name, level), upto (last batch in them)."""
    for number in reversed(_numbers(spark, path)):
        found = _manifest(spark, path, number)
        if found is not None:
            return found
    return {"number": 0, "generations": [], "upto": -1}


def _switch(spark: SparkSession, path: str, manifest: dict) -> None:
    """Fails if the number is taken."""
    number = max([manifest["number"], *_numbers(spark, path)]) + 1
    fs, p = _fs(spark, f"{path}/manifest/{number:012d}.json")
    out = fs.create(p, False)
    try:
        out.write(bytearray(json.dumps({**manifest, "number": number}).encode()))
    finally:
        out.close()


def _batches(spark: SparkSession, path: str, after: int) -> list[int]:
    """Complete batches behind ``after``."""
    ids = [int(n.split("=")[1]) for n in _names(spark, f"{path}/batches") if n.startswith("batch_id=")]
    return sorted(i for i in ids if i > after and _exists(spark, f"{path}/batches/batch_id={i}/_SUCCESS"))


# ------------------------------------------------------------------ writing and reading

def write_batch(df: DataFrame, path: str, batch_id: int, partition_cols: Sequence[str] = (), folder: str = "batches",
                observed: tuple[Observation, Sequence[Column]] | None = None) -> None:
    """The rows of one micro-batch; a batch that comes again replaces itself.  ``observed`` metrics are
    collected by the tasks that write (behind the rebalance: a shuffle that runs again counts nothing twice)."""
    rows = df.hint("rebalance", *partition_cols) if partition_cols else df
    if observed:
        rows = rows.observe(observed[0], *observed[1])
    w = rows.write.mode("overwrite")
    (w.partitionBy(*partition_cols) if partition_cols else w).parquet(f"{path}/{folder}/batch_id={batch_id}")


def move_batch(spark: SparkSession, path: str, batch_id: int, source: str, target: str) -> None:
    """A batch from one folder of the table to another, in the place of what it left there before."""
    fs, old = _fs(spark, f"{path}/{source}/batch_id={batch_id}")
    _, new = _fs(spark, f"{path}/{target}/batch_id={batch_id}")
    fs.mkdirs(new.getParent())
    fs.delete(new, True)
    if not fs.rename(old, new):
        raise OSError(f"batch {batch_id} of {path} could not be moved from {source} to {target}")


def _generation(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame | None:
    if not names:
        return None
    return spark.read.option("basePath", f"{path}/generations").option("mergeSchema", "true") \
        .parquet(*[f"{path}/generations/gen={n}" for n in names]).drop("gen")


def _recent(spark: SparkSession, path: str, ids: Sequence[int]) -> DataFrame | None:
    if not ids:
        return None
    return spark.read.option("basePath", f"{path}/batches").option("mergeSchema", "true") \
        .parquet(*[f"{path}/batches/batch_id={i}" for i in ids]).withColumn(BATCH, F.col("batch_id").cast("long")).drop("batch_id")


def _union(*frames: DataFrame | None) -> DataFrame | None:
    out = None
    for f in frames:
        if f is not None:
            out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def _latest(rows: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """One row per key; rows that tie in everything named are told apart by their hash.  The window
    keeps one row of each key per task before the shuffle, so a key with many rows is no burden."""
    names = rows.columns
    order = [F.desc(BATCH), *[F.desc_nulls_last(c) for c in order_by], F.xxhash64(*names)]
    ranked = rows.where(F.col(key).isNotNull()).withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where("_rank = 1").select(*names).union(rows.where(F.col(key).isNull()))


def read_table(spark: SparkSession, path: str, key: str | None = None, order_by: Sequence[str] = (), keep_batch: bool = False) -> DataFrame:
    """The table as of now; partition filters reach the folders."""
    now = snapshot(spark, path)
    names = [g["name"] for g in now["generations"]]
    recent = _recent(spark, path, _batches(spark, path, now["upto"]))
    if key is None:
        out = _union(_generation(spark, path, names), recent)
    else:
        oldest, newer = _generation(spark, path, names[:1]), _union(_generation(spark, path, names[1:]), recent)
        if newer is None:
            out = oldest
        else:
            newer = _latest(newer, key, order_by)
            # a null key equals nothing, so such rows of both sides stay
            out = newer if oldest is None else _union(oldest.join(newer.select(F.col(key)), key, "left_anti").select(*oldest.columns), newer)
    if out is None:
        raise ValueError(f"{path} holds no batch yet")
    return out if keep_batch else out.drop(BATCH)


# ------------------------------------------------------------------ compaction

def compact(spark: SparkSession, path: str, partition_cols: Sequence[str] = (), key: str | None = None,
            order_by: Sequence[str] = (), fanout: int = FANOUT,
            reduce: Callable[[DataFrame], DataFrame] | None = None, cluster_by: Sequence[str] = ()) -> bool:
    """Merges all batches written so far, and full levels above them; False if there was none.

    ``reduce`` (of a table without a key) makes fewer rows of the merged ones, for partial aggregates;
    reducing what is reduced must give the same as reducing all at once.

    ``cluster_by`` puts rows of near values into the same files, so a term filter skips files and row
    groups by their statistics; a value of very many rows is split by the rows' hash.  Keyed tables are written in key order, so a look-up by key reads few row groups."""
    now = snapshot(spark, path)
    ids = _batches(spark, path, now["upto"])
    if not ids:
        return False
    # how many of the newest generations the merged batches fill up with, level by level
    level, taken = 1, 0
    while len(now["generations"]) >= taken + fanout - 1 and all(
            g["level"] == level for g in now["generations"][len(now["generations"]) - taken - (fanout - 1):len(now["generations"]) - taken]):
        taken, level = taken + fanout - 1, level + 1
    kept = now["generations"][:len(now["generations"]) - taken]
    rows = _union(_generation(spark, path, [g["name"] for g in now["generations"][len(kept):]]), _recent(spark, path, ids))
    if key is not None:
        rows = _latest(rows, key, order_by)
        rows = rows.repartitionByRange(key).sortWithinPartitions(key) if not partition_cols else rows
    elif reduce is not None:
        rows = reduce(rows.drop(BATCH)).withColumn(BATCH, F.lit(ids[-1]).cast("long"))
    if cluster_by:
        order = [*partition_cols, *cluster_by, F.xxhash64(*rows.columns)]
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*partition_cols, *cluster_by)
    elif partition_cols:
        rows = rows.hint("rebalance", *partition_cols)
    name = uuid.uuid4().hex
    w = rows.write
    (w.partitionBy(*partition_cols) if partition_cols else w).parquet(f"{path}/generations/gen={name}")
    _switch(spark, path, {"number": now["number"], "generations": kept + [{"name": name, "level": level}], "upto": ids[-1]})
    return True


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Removes what none of the last ``keep`` manifests needs: merged batches, replaced generations, and
    what a compaction that did not finish has left.  Not while one is running."""
    numbers = _numbers(spark, path)
    live = [m for m in (_manifest(spark, path, n) for n in numbers[-keep:]) if m is not None]
    if len(live) < keep:                         # the state before the first manifest is one too
        return
    names = {g["name"] for m in live for g in m["generations"]}
    for n in _names(spark, f"{path}/generations"):
        if n.startswith("gen=") and n[4:] not in names:
            _delete(spark, f"{path}/generations/{n}")
    merged = min(m["upto"] for m in live)
    for n in _names(spark, f"{path}/batches"):
        if n.startswith("batch_id=") and int(n[9:]) <= merged:
            _delete(spark, f"{path}/batches/{n}")
    for n in numbers[:-keep]:
        _delete(spark, f"{path}/manifest/{n:012d}.json")
