"""Serving queries over the serving table: count, latest-N, term filter + count,
terms facets and several facets plus a metric in one scan.

Facets use grouping sets (one scan, one shuffle for all facets) and a per-facet
``row_number() <= size`` filter, which Spark plans as a partial WindowGroupLimit
before the shuffle: each map task forwards at most ``size`` buckets per facet, so a
high-cardinality or hot facet never lands whole in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.schemas import KEYWORD_FIELDS


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("count"))


def latest_n(df: DataFrame, n: int = 5, ts: str = "event_timestamp",
             tiebreak: str = "record_id", cols: Sequence[str] | None = None) -> DataFrame:
    """Newest ``n`` rows by event time (ties by id): a TakeOrderedAndProject top-k."""
    out = df.orderBy(F.col(ts).desc_nulls_last(), F.col(tiebreak).desc_nulls_last()).limit(n)
    return out.select(*cols) if cols else out


def term_filter(df: DataFrame, field: str, value) -> DataFrame:
    """Exact term match; pushed to the Parquet scan as a data filter."""
    return df.where(F.col(field) == F.lit(value))


def term_count(df: DataFrame, field: str, value) -> DataFrame:
    """Rows whose ``field`` equals ``value`` and the non-null count of that field."""
    return (term_filter(df, field, value)
            .agg(F.count(F.lit(1)).alias("hits"), F.count(F.col(field)).alias("value_count")))


def terms_facet(df: DataFrame, field: str, size: int = 10) -> DataFrame:
    """Top ``size`` buckets ``(key, doc_count)``: count desc, then key asc.  Rows without a
    value are in no bucket."""
    return (df.where(F.col(field).isNotNull()).groupBy(F.col(field).alias("key")).agg(F.count(F.lit(1)).alias("doc_count"))
              .orderBy(F.desc("doc_count"), F.asc("key")).limit(size))


def multi_facet(df: DataFrame, facets: Sequence[str], metric: str | None = None,
                size: int = 10) -> DataFrame:
    """Several terms facets and one average in one scan.

    Output rows ``facet, key, doc_count, avg_<metric>, rank``: ``size`` top buckets per
    facet (keys as strings, count desc then typed key asc: 9 before 10) plus one
    ``facet='_all'`` row holding the grand total and the overall average.  Rows without a
    value of a facet are in none of its buckets, but in the total.
    """
    facets = list(facets)
    sets = [[f] for f in facets] + [[]]
    aggs = [F.count(F.lit(1)).alias("doc_count")]
    if metric:
        aggs.append(F.avg(metric).alias(f"avg_{metric}"))
    g = df.groupingSets(sets, *facets).agg(*aggs, F.grouping_id().alias("_gid"))
    nf = len(facets)
    full = (1 << nf) - 1
    facet_name: Column = F.lit("_all")
    key: Column = F.lit(None).cast("string")
    for i, f in enumerate(facets):
        gid = full ^ (1 << (nf - 1 - i))        # only facet i is grouped
        facet_name = F.when(F.col("_gid") == gid, F.lit(f)).otherwise(facet_name)
        key = F.when(F.col("_gid") == gid, F.col(f).cast("string")).otherwise(key)
    typed = [F.col(f).alias(f"_typed_{f}") for f in facets]     # NULL outside the own facet
    g = g.select(facet_name.alias("facet"), key.alias("key"), *typed, *[c for c in g.columns
                 if c not in facets and c != "_gid"]).where((F.col("facet") == "_all") | F.col("key").isNotNull())
    w = Window.partitionBy("facet").orderBy(F.desc("doc_count"), *[F.asc_nulls_first(f"_typed_{f}") for f in facets])
    g = g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= size)
    return g.drop(*[f"_typed_{f}" for f in facets])


def to_serving(df: DataFrame, keyword_fields: Sequence[str] = KEYWORD_FIELDS) -> DataFrame:
    """Serving-table typing: keyword fields become strings, the rest is kept."""
    kw = set(keyword_fields)
    return df.select(*[F.col(c).cast("string").alias(c) if c in kw else F.col(c)
                       for c in df.columns])


def serving_report(df: DataFrame, *, label: str = "target", facets: Sequence[str] = ("target", "sex"),
                   metric: str = "age", ts: str = "event_timestamp", tiebreak: str = "record_id",
                   latest: int = 5, label_values: Sequence = ("0", "1")) -> dict[str, DataFrame]:
    """The serving check-list: count, latest N, term counts per label value, facets.

    Lazy DataFrames; the caller decides what to run.  ``df.isEmpty()`` guards the
    rest the way the reference skipped queries on an empty index."""
    out = {"count": count_rows(df)}
    if df.isEmpty():
        return out
    out["latest"] = latest_n(df, latest, ts=ts, tiebreak=tiebreak)
    for v in label_values:
        out[f"term_{label}_{v}"] = term_count(df, label, v)
    out["facets"] = multi_facet(df, facets, metric)
    return out
