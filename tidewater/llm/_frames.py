"""DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.session import session_conf, work_dir

#: Rows of an Arrow batch between the JVM and a Python worker: whole texts are wide rows, and
#: both sides hold several copies of a batch.
BATCH_ROWS = 500
#: Bytes of a row group of intermediate tables: a writer holds one in memory, and wide binary
#: columns fill the default of 128 MB in every task.
ROW_GROUP = 16 << 20
WORDS = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def unused(names: list[str], name: str) -> str:
    """``name``, made longer until no column is called so (Spark's names ignore case)."""
    taken = {n.lower() for n in names}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def stage(df: DataFrame, name: str, batch_rows: int = BATCH_ROWS, into: list | None = None) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back: cuts the
    lineage with files that all executors share, so a lost executor costs no rework.
    into: gets the folder, for :func:`discard` once nothing reads the table any more."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    if into is not None:
        into.append(path)
    with session_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(batch_rows)}):
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b; long): root is the smallest
    node of its connected component.

    Alternating large-star / small-star: each round is two aggregations by node (with
    map-side combine) and two joins, written out as a shared table.  The number of rounds
    is logarithmic in the longest path.  No group is collected; a node with very many
    neighbours is only ever a join key.  The aggregates are written out before they are
    joined, so both sides of a join are plain exchanges and AQE can split such a key."""
    pairs = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .distinct(), "cc-edges")
    nodes = stage(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "cc-nodes")
    before, held = None, []
    for i in range(max_rounds):
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(pairs.select("b", "a"))
        low = stage(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), f"cc-low-{i}", into=held)
        # large-star: a node's larger neighbours are linked to its smallest neighbour
        large = (both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
                 .where("a <> b").distinct())
        large = stage(large, f"cc-large-{i}", into=held)
        # small-star: here every edge is (smaller, larger); smaller neighbours meet at their least
        least = stage(large.groupBy("b").agg(F.min("a").alias("m")), f"cc-least-{i}", into=held)
        small = (large.join(least, "b").select(F.explode(F.array(
            F.struct(F.col("m").alias("x"), F.col("a").alias("y")),
            F.struct(F.col("m").alias("x"), F.col("b").alias("y")))).alias("e"))
            .select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).where("a <> b").distinct())
        pairs = stage(small, f"cc-small-{i}")
        discard(pairs.sparkSession, held)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    root = pairs.groupBy("b").agg(F.min("a").alias("root"))
    return nodes.join(root, nodes.node == root.b, "left").select("node", F.coalesce("root", "node").alias("root"))



def discard(spark: SparkSession, paths: list) -> None:
    """Delete staged tables."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ordered(df: DataFrame, by: list, value: str, name: str) -> DataFrame:
    """``df`` with ``pos`` (1, 2, ... in the order ``by``) and ``before`` (the sum of column
    ``value`` over all earlier rows), without a single-task window: rows are range-partitioned
    and written out with their partition's number, running sums are taken inside each
    partition, and the totals of the partitions (one small row each) are added on top."""
    parts = stage(df.repartitionByRange(*by).withColumn("part", F.spark_partition_id()), name)
    totals = parts.groupBy("part").agg(F.count("*").alias("n"), F.sum(value).alias("v"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("part"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"),
                           F.coalesce(F.sum("v").over(earlier), F.lit(0)).alias("v0"))
    inside = Window.partitionBy("part").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    return (parts.withColumn("pos", F.row_number().over(Window.partitionBy("part").orderBy(*by)))
            .withColumn("before", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(F.broadcast(totals), "part")  # one row per partition
            .withColumn("pos", F.col("pos") + F.col("n0")).withColumn("before", F.col("before") + F.col("v0"))
            .drop("part", "n0", "v0"))
