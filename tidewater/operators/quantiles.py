"""Exact order statistics and linear-interpolated quantiles, distributed.

Spark's ``percentile``/``median`` aggregates merge a value->count map per group in
one task, which does not scale to a column with billions of distinct values.  Here
the k-th smallest value of each group is found by histogram refinement:

1. the first aggregate needs no bounds: values are bucketed by sign and magnitude
   (``PER_OCTAVE`` log-scale slices per power of two, a monotone map), and the same
   ``groupBy(group, bucket)`` gives ``count, min, max`` per group as totals;
2. each later round, every open search interval ``[lo, hi]`` is cut into ``bins``
   equal-width buckets and one ``groupBy(interval, bucket)`` (partial aggregation
   map-side, so the shuffle carries at most intervals x bins rows per task) returns
   bucket counts and exact bucket min/max;
3. the bucket holding the wanted rank becomes the next interval (its exact
   ``[min, max]``); bucket assignment is monotone in the value, so equal values
   never straddle buckets and a hot value (a third of the rows) ends the search at
   once as a one-value bucket;
4. once an interval holds at most ``collect_limit`` values they are fetched and
   the rank is read exactly.

The interval table is tiny (two rows per wanted rank) and is broadcast after its
size is checked.  Ranks are 0-based over non-NULL, non-NaN values (NaN counts as
missing, as in pandas).  ``x`` may be double or long (exact for 64-bit keys).
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Hashable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_MAX_INTERVALS = 100_000
# first-round buckets per power of two; the bucket count per group is bounded by the
# octaves the values span (at most about 2 x 2100 x PER_OCTAVE), not by the row count
PER_OCTAVE = 64


def long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Stack columns into ``(gid, x double)`` rows, dropping NULL and NaN."""
    parts = ", ".join(f"{i}, CAST(`{c}` AS DOUBLE)" for i, c in enumerate(cols))
    out = df.selectExpr(f"stack({len(cols)}, {parts}) AS (gid, x)")
    return out.where(F.col("x").isNotNull() & ~F.isnan("x"))


def _magnitude_bucket(x: Column, per_octave: int = PER_OCTAVE) -> Column:
    """Monotone bucket id from sign and magnitude: 0 for zero, +-(slice of log2|x|)
    otherwise, +-top for infinities.  Equal values always share a bucket."""
    ax = F.abs(x).cast("double")
    base = 1100 * per_octave                 # |log2| < 1100 for every nonzero double
    inner = F.floor(F.log2(ax) * F.lit(float(per_octave))) + F.lit(base + 1)
    pos = F.when(ax == F.lit(math.inf), F.lit(2 * base + 2)).otherwise(inner)
    return F.when(x > 0, pos).when(x < 0, -pos).otherwise(F.lit(0)).cast("long")


def first_histogram(long_df: DataFrame, per_octave: int = PER_OCTAVE) -> dict[Hashable, list]:
    """Per group, sorted ``(bucket, count, min, max)`` over magnitude buckets: one
    partially aggregated pass that needs no prior bounds."""
    rows = (long_df.groupBy("gid", _magnitude_bucket(F.col("x"), per_octave).alias("b"))
                   .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("bmin"), F.max("x").alias("bmax"))
                   .collect())
    out: dict[Hashable, list] = defaultdict(list)
    for r in rows:
        out[r["gid"]].append((r["b"], r["n"], r["bmin"], r["bmax"]))
    for v in out.values():
        v.sort()
    return dict(out)


def stats_from(hist: dict[Hashable, list]) -> dict[Hashable, tuple[int, float, float]]:
    return {g: (sum(b[1] for b in v), v[0][2], v[-1][3]) for g, v in hist.items()}


def _locate(buckets: list, want: int) -> tuple[int, int, float, float]:
    """(values before, count, min, max) of the bucket holding 0-based rank ``want``."""
    cum = 0
    for _, cnt, bmin, bmax in buckets:
        if want < cum + cnt:
            return cum, cnt, bmin, bmax
        cum += cnt
    raise RuntimeError("rank not found in histogram")  # pragma: no cover


def order_statistics(long_df: DataFrame, targets: dict[Hashable, Iterable[int]],
                     stats: dict[Hashable, tuple[int, float, float]] | None = None,
                     bins: int = 4096, collect_limit: int = 4096,
                     max_rounds: int = 64, first: dict[Hashable, list] | None = None
                     ) -> dict[tuple[Hashable, int], float]:
    """Exact ``rank``-th smallest ``x`` per ``gid`` for every wanted (gid, rank).
    ``first`` is a ``first_histogram`` of ``long_df`` (computed here if neither it
    nor ``stats`` is given); the search then starts inside its buckets."""
    if first is None and stats is None:
        first = first_histogram(long_df)
    if stats is None:
        stats = stats_from(first)
    # open search state per target: [lo, hi, below, count]
    state: dict[tuple, list] = {}
    result: dict[tuple, float] = {}
    for g, ranks in targets.items():
        if g not in stats:
            continue
        n, lo, hi = stats[g]
        for r in set(ranks):
            if not 0 <= r < n:
                raise ValueError(f"rank {r} outside 0..{n - 1} for group {g}")
            if lo == hi:
                result[(g, r)] = lo
            elif first is not None and g in first:
                below, cnt, bmin, bmax = _locate(first[g], r)
                if bmin == bmax:
                    result[(g, r)] = bmin
                else:
                    state[(g, r)] = [bmin, bmax, below, cnt]
            else:
                state[(g, r)] = [lo, hi, 0, n]

    gid_type = long_df.schema["gid"].dataType.simpleString()
    x_type = long_df.schema["x"].dataType.simpleString()
    for _ in range(max_rounds):
        if not state:
            break
        small = {k: v for k, v in state.items() if v[3] <= collect_limit}
        if small:
            _finish(long_df, small, result, gid_type, x_type)
            for k in small:
                del state[k]
        if not state:
            break
        # one interval per distinct (gid, lo, hi)
        ivals = sorted({(k[0], v[0], v[1]) for k, v in state.items()}, key=repr)
        iid = {iv: i for i, iv in enumerate(ivals)}
        hist = _histogram(long_df, ivals, bins, gid_type, x_type)
        for k, v in list(state.items()):
            cum, cnt, bmin, bmax = _locate(hist[iid[(k[0], v[0], v[1])]], k[1] - v[2])
            if bmin == bmax:
                result[k] = bmin
                del state[k]
            else:
                state[k] = [bmin, bmax, v[2] + cum, cnt]
    if state:
        raise RuntimeError(f"order statistics did not converge for {len(state)} targets")
    return result


def _interval_df(spark, ivals, gid_type, x_type):
    xt = T._parse_datatype_string(x_type)
    schema = T.StructType([T.StructField("iid", T.IntegerType()),
                           T.StructField("gid", T._parse_datatype_string(gid_type)),
                           T.StructField("lo", xt), T.StructField("hi", xt)])
    df = spark.createDataFrame([(i, g, lo, hi) for i, (g, lo, hi) in enumerate(ivals)], schema)
    # size checked: broadcast only a bounded interval table, else let the planner shuffle
    return F.broadcast(df) if len(ivals) <= BROADCAST_MAX_INTERVALS else df


def _histogram(long_df, ivals, bins, gid_type, x_type):
    spark = long_df.sparkSession
    iv = _interval_df(spark, ivals, gid_type, x_type)
    j = long_df.join(iv, "gid").where((F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi")))
    width = (F.col("hi") - F.col("lo")).cast("double")
    b = F.floor((F.col("x") - F.col("lo")).cast("double") / width * F.lit(bins)).cast("int")
    b = F.least(F.greatest(b, F.lit(0)), F.lit(bins - 1))
    rows = (j.groupBy("iid", b.alias("b"))
             .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("bmin"), F.max("x").alias("bmax"))
             .collect())
    out: dict[int, list] = defaultdict(list)
    for r in rows:
        out[r["iid"]].append((r["b"], r["n"], r["bmin"], r["bmax"]))
    for v in out.values():
        v.sort()
    return out


def _finish(long_df, small, result, gid_type, x_type):
    """Fetch the few values left in each small interval and read ranks exactly."""
    ivals = sorted({(k[0], v[0], v[1]) for k, v in small.items()}, key=repr)
    iid = {iv: i for i, iv in enumerate(ivals)}
    iv = _interval_df(long_df.sparkSession, ivals, gid_type, x_type)
    rows = (long_df.join(iv, "gid")
                   .where((F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi")))
                   .select("iid", "x").collect())
    vals: dict[int, list] = defaultdict(list)
    for r in rows:
        vals[r["iid"]].append(r["x"])
    for v in vals.values():
        v.sort()
    for k, v in small.items():
        xs = vals[iid[(k[0], v[0], v[1])]]
        result[k] = xs[k[1] - v[2]]


def linear_positions(n: int, p: float) -> tuple[int, int, float]:
    """Ranks and weight for linear interpolation at probability ``p`` over ``n`` values."""
    h = (n - 1) * p
    j = int(math.floor(h))
    return j, min(j + 1, n - 1), h - j


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    **kw) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per column (pandas / ``quantile_cont`` semantics).

    A column with no non-missing value gives ``None`` for every probability."""
    cols = list(cols)
    lv = long_values(df, cols)
    first = first_histogram(lv)
    stats = stats_from(first)
    targets: dict[int, set] = defaultdict(set)
    for i in range(len(cols)):
        if i in stats:
            for p in probs:
                a, b, _ = linear_positions(stats[i][0], p)
                targets[i].update((a, b))
    got = order_statistics(lv, targets, stats, first=first, **kw)
    out: dict[str, list] = {}
    for i, c in enumerate(cols):
        if i not in stats:
            out[c] = [None] * len(probs)
            continue
        vals = []
        for p in probs:
            a, b, w = linear_positions(stats[i][0], p)
            lo, hi = got[(i, a)], got[(i, b)]
            vals.append(lo if w == 0 else lo + (hi - lo) * w)
        out[c] = vals
    return out


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     accuracy: int = 10_000) -> dict[str, list[float | None]]:
    """One-pass sketch quantiles (``percentile_approx``), all columns in one aggregate."""
    cols = list(cols)
    aggs = [F.percentile_approx(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")),
                                list(probs), accuracy).alias(c) for c in cols]
    row = df.agg(*aggs).first()
    return {c: (list(row[c]) if row[c] is not None else [None] * len(probs)) for c in cols}


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              method: str = "exact", **kw) -> dict[str, list[float | None]]:
    if method == "exact":
        return exact_quantiles(df, cols, probs, **kw)
    if method == "approx":
        return approx_quantiles(df, cols, probs, **kw)
    raise ValueError(f"unknown quantile method {method!r}")
