"""Batch sources: Parquet lake, CSV, object listings, table description."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.schemas import RAW


def read_lake(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Partition-discovering Parquet scan of every file (``date``/``hour`` come back
    typed).  Frames with different column sets combine by name (``mergeSchema``)."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = RAW,
             header: bool = True) -> DataFrame:
    """CSV with a declared schema (inference only when ``schema`` is None)."""
    r = spark.read.option("header", str(header).lower())
    r = r.schema(schema) if schema is not None else r.option("inferSchema", "true")
    return r.csv(path)


def list_objects(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Recursive listing ``path, modificationTime, length`` (file content not read)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).load(root)
            .select("path", "modificationTime", "length"))


def describe_table(df: DataFrame) -> DataFrame:
    """One row: row count, field count, input partition count."""
    n_parts = df.rdd.getNumPartitions()
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(len(df.columns)).alias("field_count"),
        F.lit(n_parts).alias("partition_count"))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``, by the file system that Spark reads it with."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []
