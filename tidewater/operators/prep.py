"""Feature preparation: median imputation, de-duplication, IQR winsorizing, derived
features, standardization, and their composition ``curate``.

Statistics are computed by distributed aggregates and come back to the driver as a
handful of scalars; applying them is a projection with literals (one codegen'd
stage, no join).  NaN counts as missing, like pandas."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import asdict, dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.quantiles import quantiles
from tidewater.schemas import CLIP_COLUMNS, FEATURES, LABEL
from tidewater.session import DROP_SHUFFLES, delete_dir, session_conf, work_dir

_WRITTEN: ContextVar[list | None] = ContextVar("written", default=None)       # tables of the ``steps`` under way


def _fractional(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))


def missing(df: DataFrame, c: str) -> Column:
    """NULL, or NaN for float columns."""
    col = F.col(c)
    return (col.isNull() | F.isnan(col)) if _fractional(df, c) else col.isNull()


def medians(df: DataFrame, cols: Sequence[str], method: str = "exact") -> dict[str, float | None]:
    return {c: v[0] for c, v in quantiles(df, cols, [0.5], method=method).items()} if cols else {}


def impute_median(df: DataFrame, cols: Sequence[str] = FEATURES, exclude: Sequence[str] = (),
                  method: str = "exact", values: dict[str, float | None] | None = None) -> DataFrame:
    """Fill NULL/NaN cells with the column's exact median (pandas ``median``), or with
    ``values`` found earlier.

    Integer columns take the median as a double, as pandas does.  An all-missing
    column stays missing."""
    med = values if values is not None else medians(df, [c for c in cols if c not in set(exclude)], method)
    out = []
    for c in df.columns:
        m = med.get(c)
        if m is not None:
            out.append(F.when(missing(df, c), F.lit(m)).otherwise(F.col(c).cast("double")).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop duplicate rows (NULL = NULL, NaN = NaN).  Planned as a hash aggregate with
    a map-side partial step, so heavily repeated rows collapse before the shuffle."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def iqr_bounds(df: DataFrame, cols: Sequence[str] = CLIP_COLUMNS, k: float = 3.0,
               method: str = "exact") -> dict[str, tuple[float, float] | None]:
    q = quantiles(df, cols, [0.25, 0.75], method=method)
    out = {}
    for c in cols:
        q1, q3 = q[c]
        out[c] = None if q1 is None else (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return out


def clip(df: DataFrame, bounds: dict[str, tuple[float, float] | None]) -> DataFrame:
    """Clip to ``[lo, hi]``; NULL and NaN stay as they are; no row is dropped."""
    out = []
    for c in df.columns:
        b = bounds.get(c)
        if b is None:
            out.append(F.col(c))
            continue
        col = F.col(c)
        clipped = F.least(F.greatest(col, F.lit(b[0])), F.lit(b[1]))
        out.append(F.when(missing(df, c), col).otherwise(clipped).alias(c))
    return df.select(*out)


def winsorize_iqr(df: DataFrame, cols: Sequence[str] = CLIP_COLUMNS, k: float = 3.0,
                  method: str = "exact") -> DataFrame:
    """Clip each column to ``[Q1 - k*IQR, Q3 + k*IQR]`` (linear quartiles)."""
    return clip(df, iqr_bounds(df, cols, k, method))


def add_features(df: DataFrame, product: tuple[str, str] = ("age", "thalach"),
                 ratio: tuple[str, str] = ("chol", "thalach"),
                 names: tuple[str, str] = ("age_x_thalach", "bmi_proxy")) -> DataFrame:
    """``a*b`` and ``c/(d+1)``; division by zero gives NULL (ANSI-safe)."""
    a, b = product
    c, d = ratio
    return df.select(
        *df.columns,
        (F.col(a) * F.col(b)).cast("double").alias(names[0]),
        F.try_divide(F.col(c).cast("double"), F.col(d).cast("double") + F.lit(1.0)).alias(names[1]),
    )


def scaler_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One-row table of ``mean`` and population ``std`` per column (one aggregate)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    return df.agg(*aggs)


def standardize(df: DataFrame, cols: Sequence[str], stats: dict | DataFrame | None = None) -> DataFrame:
    """``(x - mean) / std`` with population std; a zero std divides by 1.

    ``stats`` (a row or the one-row table from :func:`scaler_stats`) lets scoring
    reuse the statistics fitted on training data."""
    if stats is None:
        stats = scaler_stats(df, cols)
    if isinstance(stats, DataFrame):
        stats = stats.first().asDict()
    out = []
    cs = set(cols)
    for c in df.columns:
        if c not in cs:
            out.append(F.col(c))
            continue
        mu, sd = stats[f"{c}__mean"], stats[f"{c}__std"]
        if mu is None:
            out.append(F.col(c).cast("double").alias(c))
            continue
        sd = 1.0 if (sd is None or sd == 0) else sd
        out.append(((F.col(c).cast("double") - F.lit(mu)) / F.lit(sd)).alias(c))
    return df.select(*out)


def write_table(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written as Parquet under the shared ``spark.checkpoint.dir``, and its folder."""
    spark, path = df.sparkSession, work_dir(df.sparkSession, "table")
    with session_conf(spark, DROP_SHUFFLES):
        df.write.parquet(path)
    if (written := _WRITTEN.get()) is not None:
        written.append(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def steps(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables written inside the block are deleted at its end, but for those written by the
    function it gives: they are the block's results."""
    before, kept = _WRITTEN.get(), []

    def keep(df: DataFrame) -> DataFrame:
        table, path = write_table(df)
        kept.append(path)
        return table

    token = _WRITTEN.set([])
    try:
        yield keep
    finally:
        written = _WRITTEN.get()
        _WRITTEN.reset(token)
        for path in written:
            if path not in kept:
                delete_dir(spark, path)
        if before is not None:
            before.extend(kept)


def materialize(df: DataFrame, how: str = "checkpoint") -> DataFrame:
    """Cut lineage before a table is re-read by several statistics passes.

    ``checkpoint`` writes Parquet under the shared ``spark.checkpoint.dir`` (survives
    executor loss, and later passes read only their columns); ``persist`` keeps blocks on
    executors (recomputed from lineage if lost)."""
    if how == "checkpoint":
        return write_table(df)[0]
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return df


def curate(df: DataFrame, features: Sequence[str] = FEATURES[:-1], label: str = LABEL,
           clip_cols: Sequence[str] = CLIP_COLUMNS, k: float = 3.0,
           product: tuple[str, str] = ("age", "thalach"), ratio: tuple[str, str] = ("chol", "thalach"),
           derived: tuple[str, str] = ("age_x_thalach", "bmi_proxy"),
           impute_label: bool = False, method: str = "exact",
           materialize_as: str = "checkpoint", return_preparation: bool = False,
           fit_on: Callable[[DataFrame], DataFrame] | None = None):
    """select -> impute median -> dedupe -> winsorize -> derived features -> standardize.

    Returns features (double, standardized) followed by the unscaled label.  The
    label is not imputed unless ``impute_label`` (a median label can be 0.5).

    ``fit_on`` adds columns to the table before it is scaled and among them a boolean
    ``is_test``; the scaler is then fitted on the other rows only, and the added columns
    are returned too.  What it gives is read twice, not written: a split writes its table itself.
    ``return_preparation`` also returns the fitted :class:`Preparation`, which prepares raw
    rows in the same way at scoring time."""
    base = df.select(*features, label)
    to_fill = list(features) + ([label] if impute_label else [])
    med = medians(base, to_fill, method)
    dd = materialize(dedupe(impute_median(base, values=med)), materialize_as)
    bounds = iqr_bounds(dd, clip_cols, k, method)
    fe = add_features(clip(dd, bounds), product, ratio, derived)
    feat_cols = list(features) + list(derived)
    if fit_on is not None:
        fe = fit_on(fe)
    stats = scaler_stats(fe.where(~F.col("is_test")) if fit_on is not None else fe, feat_cols).first().asDict()
    extra = [c for c in fe.columns if c not in feat_cols and c != label]
    out = standardize(fe, feat_cols, stats).select(*feat_cols, label, *extra)
    if not return_preparation:
        return out
    return out, Preparation(features=list(features), medians={c: med.get(c) for c in features},
                            bounds={c: None if b is None else list(b) for c, b in bounds.items()},
                            product=list(product), ratio=list(ratio), derived=list(derived), scaler=stats)


@dataclass
class Preparation:
    """What ``curate`` learned, as plain values: applied to raw rows it gives the features
    the model was trained on.  Saved as JSON beside the model."""

    features: list[str]
    medians: dict[str, float | None]
    bounds: dict[str, list[float] | None]
    product: list[str]
    ratio: list[str]
    derived: list[str]
    scaler: dict[str, float | None]

    def apply(self, df: DataFrame) -> DataFrame:
        """impute -> clip -> derive -> standardize; one projection chain, no row is dropped
        and other columns stay, so it works on streams too."""
        filled = impute_median(df, values=self.medians)
        clipped = clip(filled, {c: None if b is None else tuple(b) for c, b in self.bounds.items()})
        return standardize(add_features(clipped, tuple(self.product), tuple(self.ratio), tuple(self.derived)),
                           self.feature_columns, self.scaler)

    @property
    def feature_columns(self) -> list[str]:
        return [*self.features, *self.derived]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "Preparation":
        return Preparation(**json.loads(text))
