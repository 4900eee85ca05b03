"""Newest rows of a lake without reading it all: hour folders from the newest, stopping early.

The lake's ``date`` and ``hour`` are those of the event time, so once the newest folders hold ``n`` matching
rows, every other folder's rows are older.  Only folder names are listed, and only of the days that are
needed; each round doubles the folders, so at most about twice the hours needed are counted.  Rows
without an event time lie in the null folders, which come last."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.serving import latest_n
from tidewater.sources.files import subfolders

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"      # Spark's folder name of a null


def _descending(spark: SparkSession, path: str, column: str) -> list[str]:
    names = [f for f in subfolders(spark, path) if f.startswith(f"{column}=")]
    value = {f: f.split("=", 1)[1] for f in names}
    dated = [f for f in names if value[f] != NO_VALUE]
    dated.sort(key=lambda f: int(value[f]) if value[f].isdigit() else value[f], reverse=True)
    return dated + [f for f in names if value[f] == NO_VALUE]


def hour_folders(spark: SparkSession, path: str) -> Iterator[str]:
    """Folders ``date=/hour=`` from the newest; a day is listed when it is reached."""
    for date in _descending(spark, path, "date"):
        for hour in _descending(spark, f"{path}/{date}", "hour"):
            yield f"{path}/{date}/{hour}"


def newest_n(spark: SparkSession, path: str, n: int = 5, where: Column | None = None, ts: str = "event_timestamp",
             tiebreak: str = "record_id", cols: Sequence[str] | None = None) -> DataFrame:
    """The rows of :func:`tidewater.operators.serving.latest_n` over the (filtered) lake at ``path``."""
    path, left = path.rstrip("/"), hour_folders(spark, path.rstrip("/"))
    taken: list[str] = []
    found, step = 0, 1
    while found < n:
        group = [f for _, f in zip(range(step), left)]
        if not group:
            break
        found += _rows(spark, path, group, where).where(F.col(ts).isNotNull()).limit(n - found).count()
        taken += group
        step *= 2
    if not taken:
        raise FileNotFoundError(f"no date=/hour= folders under {path}")
    return latest_n(_rows(spark, path, taken, where), n, ts, tiebreak, cols)


def _rows(spark: SparkSession, path: str, folders: Sequence[str], where: Column | None) -> DataFrame:
    rows = spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*folders)
    return rows if where is None else rows.where(where)
