"""Reproducible stratified train/test split.

* ``split_hash``: stateless; a row is test when a seeded md5 hash of its key falls
  below ``frac * 2^32``.  No shuffle, same answer on every engine with md5.
* ``split_exact``: exactly ``floor(n_c * frac + 0.5)`` test rows per class ``c``,
  the ones with the smallest ``(hash60, key)``.  Instead of a per-class window
  (which sorts a whole class in one task), the per-class threshold hash is found by
  the distributed order-statistic search, then a broadcast of one threshold row per
  class marks the rows in a map-only pass.  Keys must be unique, and are checked.
  The table is written once with its hashes, so the passes read only the columns they need;
  a key that the caller does not want back is not written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.prep import write_table
from tidewater.operators.quantiles import first_histogram, order_statistics, stats_from
from tidewater.session import DROP_SHUFFLES, delete_dir, session_conf

MAX_CLASSES = 10_000          # one threshold row per class is sent to every task
COPIES = 100_000              # identical rows numbered by one array
# types whose JSON tells every two values apart, and that can be grouped by
COUNTABLE = (T.NumericType, T.StringType, T.BooleanType, T.DateType)


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def key_hash32(key: Column | str, seed: int = 42) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), _c(key).cast("string"))), 1, 8),
                  16, 10).cast("long")


def key_hash60(key: Column | str, seed: int = 42) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), _c(key).cast("string"))), 1, 15),
                  16, 10).cast("long")


def split_hash(df: DataFrame, key: str, frac: float = 0.2, seed: int = 42,
               out: str = "is_test") -> DataFrame:
    return df.withColumn(out, key_hash32(key, seed) < F.lit(int(frac * 2 ** 32)))


def test_counts(n: int, frac: float) -> int:
    return int((n * frac) + 0.5)


def unique_key(df: DataFrame, key: str = "row_key") -> DataFrame:
    """A key for each row: a hash of all values (NULLs are told apart from absent and from
    text) and a number among identical rows, so it is unique whatever the table holds.

    Identical rows are counted and come out again numbered, so however many there are, they meet as
    one row.  Tables with columns of other types than ``COUNTABLE`` number them by a window."""
    whole = F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256)
    if all(isinstance(f.dataType, COUNTABLE) for f in df.schema):
        # grouping would turn -0.0 into 0.0: identical fractions come back by max
        fractions = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
        rows = (df.withColumn("_whole", whole).groupBy("_whole", *[c for c in df.columns if c not in fractions])
                  .agg(F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in fractions])
                  .withColumn("_from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"), F.lit(COPIES).cast("long"))))
                  .withColumn("_number", F.explode(F.sequence("_from", F.least("_n", F.col("_from") + (COPIES - 1))))))
        return rows.select(*df.columns, F.concat_ws("-", "_whole", F.col("_number").cast("string")).alias(key))
    w = Window.partitionBy("_whole").orderBy("_whole")
    return (df.withColumn("_whole", whole)
              .withColumn(key, F.concat_ws("-", F.col("_whole"), F.row_number().over(w).cast("string")))
              .drop("_whole"))


def split_exact(df: DataFrame, label: str, key: str, frac: float = 0.2, seed: int = 42,
                out: str = "is_test", keep_key: bool = True) -> DataFrame:
    """Raises ``ValueError`` when a key repeats (see :func:`unique_key`) or when there are
    more than ``MAX_CLASSES`` classes.  Rows without a label are never test rows.
    ``keep_key=False`` returns the same rows without the key; it is then written only where
    two rows share a hash, which takes the keys to tell them apart."""
    with session_conf(df.sparkSession, DROP_SHUFFLES):
        return _split_exact(df, label, key, frac, seed, out, keep_key)


def _split_exact(df: DataFrame, label: str, key: str, frac: float, seed: int, out: str, keep_key: bool) -> DataFrame:
    spark, source = df.sparkSession, df
    columns = [c for c in df.columns if keep_key or c != key]
    table, path = write_table(df.withColumn("_hash", key_hash60(key, seed)).select(*columns, "_hash"))
    h = table.select(F.col(label).alias("gid"), F.col("_hash").alias("x"), *([F.col(key).alias("k")] if keep_key else []))
    # a key that repeats has a hash that repeats, and hashes are shorter to shuffle
    twice = h.groupBy("x").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("x")
    if not twice.isEmpty():
        if not keep_key:
            delete_dir(spark, path)
            return _split_exact(source, label, key, frac, seed, out, True).drop(key)
        if not h.join(twice, "x").groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            raise ValueError(f"split_exact needs unique keys; {key!r} repeats")
    if h.select("gid").distinct().limit(MAX_CLASSES + 1).count() > MAX_CLASSES:
        raise ValueError(f"split_exact takes at most {MAX_CLASSES} classes")
    # class sizes come from the search's first histogram (one aggregate for both)
    hx_df = h.where(F.col("gid").isNotNull()).select("gid", "x")
    first = first_histogram(hx_df)
    want = {g: test_counts(n, frac) for g, (n, _, _) in stats_from(first).items()}
    targets = {g: [k - 1] for g, k in want.items() if k > 0}
    if not targets:
        return table.select(*columns, F.lit(False).alias(out))
    got = order_statistics(hx_df, targets, first=first)
    gid_type = h.schema["gid"].dataType.simpleString()
    limits = [(g, got[(g, targets[g][0])], want[g]) for g in targets]                       # one row per class
    hx, same = F.col("_hash"), F.lit(True)
    if keep_key:
        t_rows = F.broadcast(spark.createDataFrame(limits, f"gid {gid_type}, t long, want long"))
        near = h.join(t_rows, "gid").where(F.col("x") <= F.col("t"))
        below = near.groupBy("gid").agg(F.sum((F.col("x") < F.col("t")).cast("long")).alias("below"))
        # unique keys that share the 60-bit threshold hash: one, but for hash collisions
        rank = F.row_number().over(Window.partitionBy("gid").orderBy("k"))
        last = (near.where(F.col("x") == F.col("t")).withColumn("rn", rank).join(below, "gid")
                    .where(F.col("rn") == F.col("want") - F.col("below"))
                    .select(F.col("gid").alias("_g"), F.col("t").alias("_t"), F.col("k").alias("_k")))
        same = F.col(key) <= F.col("_k")
    else:                                                   # no two rows share a hash
        last = spark.createDataFrame([(g, t) for g, t, _ in limits], f"_g {gid_type}, _t long")
    j = table.join(F.broadcast(last), table[label].eqNullSafe(F.col("_g")), "left")
    flag = F.coalesce((hx < F.col("_t")) | ((hx == F.col("_t")) & same), F.lit(False))
    return j.select(*[table[c] for c in columns], flag.alias(out))
