"""Gaussian-copula table synthesis, fitted and sampled by Spark.

Fit (a few aggregates, results are small):
  * ``profile_columns``: role (categorical / numeric), min, max, decimal digits and
    approximate distinct count per column, in one aggregate;
  * numeric marginals: a 101-point ``percentile_approx`` grid (bounded sketches),
    computed in the same aggregate as the profile;
  * categorical marginals: category frequencies (``groupBy``, few categories);
  * dependence: each value is mapped to a normal score ``Phi^-1(F(x))`` through its
    fitted marginal (mid-rank for ties) with column expressions, and all pairwise
    Pearson correlations of the scores come from one aggregate; the d x d matrix
    (d = column count) gets a Cholesky factor, with a small ridge if needed.

Sample (one map-only stage over any id column, e.g. ``spark.range(n)`` or a stream's
record ids): per id and dimension, two uniforms from ``xxhash64(id, seed, k)``,
Box-Muller normals, correlated by the Cholesky factor, mapped to uniforms by the
normal CDF and through each inverse marginal; numeric values are clipped to the
observed range and rounded to the observed digits.  Every draw is a pure function
of (id, seed), so a replayed micro-batch reproduces the same rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import JIT_SIZED_CODEGEN, session_conf

GRID = [i / 100 for i in range(101)]
TWO53 = float(2 ** 53)


@dataclass
class ColumnModel:
    name: str
    role: str                       # "numeric" | "categorical"
    lo: float | None = None
    hi: float | None = None
    digits: int = 0
    grid: list | None = None        # numeric: 101 quantiles
    categories: list | None = None  # categorical: values (sorted)
    cumulative: list | None = None  # categorical: cumulative frequencies
    missing: float = 0.0            # share of NULL (or NaN) cells


@dataclass
class CopulaModel:
    columns: list[ColumnModel]
    cholesky: list[list[float]]
    types: dict[str, str]


def _decimal_digits(x: Column, cap: int = 10) -> Column:
    """Fewest decimal places that represent ``x`` (up to ``cap``), by arithmetic.
    ``rint`` (not ``round``, which goes through BigDecimal for doubles) keeps the
    tolerance test a few floating-point operations per value."""
    out = F.lit(cap)
    for k in range(cap - 1, -1, -1):
        y = x * F.lit(10.0 ** k)
        out = F.when(F.abs(y - F.rint(y)) <= F.lit(1e-9) * F.greatest(F.lit(1.0), F.abs(y)), F.lit(k)).otherwise(out)
    return F.when(x.isNull() | F.isnan(x), F.lit(None)).otherwise(out)


def _number(df: DataFrame, c: str) -> Column:
    """The column as a double; NULL for text columns, whose values are only categories."""
    return F.lit(None).cast("double") if isinstance(df.schema[c].dataType, T.StringType) else F.col(c).cast("double")


def _profile_aggs(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    aggs = []
    for c in cols:
        x = _number(df, c)
        absent = F.col(c).isNull() | F.coalesce(F.isnan(x), F.lit(False))
        aggs += [F.avg(absent.cast("double")).alias(f"{c}__missing"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                 F.max(_decimal_digits(x)).alias(f"{c}__digits"),
                 F.approx_count_distinct(c).alias(f"{c}__ndv")]
    return aggs


def _profile_from(row, df: DataFrame, cols: Sequence[str], categorical: Sequence[str]) -> list[dict]:
    out = []
    for c in cols:
        integral = isinstance(df.schema[c].dataType, T.IntegralType) or (row[f"{c}__digits"] or 0) == 0
        text = isinstance(df.schema[c].dataType, T.StringType)
        role = "categorical" if (text or c in categorical or (integral and (row[f"{c}__ndv"] or 0) <= 2)) else "numeric"
        out.append({"name": c, "role": role, "lo": row[f"{c}__min"], "hi": row[f"{c}__max"],
                    "digits": int(row[f"{c}__digits"] or 0), "ndv": row[f"{c}__ndv"],
                    "missing": float(row[f"{c}__missing"] or 0.0)})
    return out


def profile_columns(df: DataFrame, cols: Sequence[str] | None = None,
                    categorical: Sequence[str] = ()) -> list[dict]:
    """Role detection (+ override; text is categorical), min, max, decimal digits, approx
    distinct count, share of missing cells."""
    cols = list(cols or df.columns)
    return _profile_from(df.agg(*_profile_aggs(df, cols)).first(), df, cols, categorical)


def _cholesky(c: np.ndarray) -> np.ndarray:
    ridge = 0.0
    for _ in range(12):
        try:
            m = c + ridge * np.eye(len(c))
            return np.linalg.cholesky(m / (1.0 + ridge))
        except np.linalg.LinAlgError:
            ridge = 1e-6 if ridge == 0 else ridge * 10
    raise ValueError("the correlation matrix cannot be made positive definite")


def copula_fit(df: DataFrame, cols: Sequence[str] | None = None, categorical: Sequence[str] = (),
               accuracy: int = 10_000, max_categories: int = 1000) -> CopulaModel:
    cols = list(cols or df.columns)
    d = df.select(*cols)
    # one pass for the profile and every grid: roles are only known afterwards, and a
    # grid sketch is bounded, so computing it for a column that turns out categorical
    # costs less than a second scan
    row = d.agg(*_profile_aggs(d, cols), *[F.percentile_approx(_number(d, c), GRID, accuracy)
                                        .alias(f"{c}__grid") for c in cols]).first()
    prof = _profile_from(row, d, cols, categorical)
    grids = {c: list(row[f"{c}__grid"]) if row[f"{c}__grid"] is not None else None for c in cols}
    models = []
    for p in prof:
        c = p["name"]
        if p["role"] == "categorical":
            freq = (d.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
                     .orderBy(c).limit(max_categories + 1).collect())
            if len(freq) > max_categories:
                raise ValueError(f"column {c} has more than {max_categories} categories")
            tot = sum(r["n"] for r in freq) or 1
            cum, acc = [], 0
            for r in freq:
                acc += r["n"]
                cum.append(acc / tot)
            models.append(ColumnModel(c, "categorical", p["lo"], p["hi"], 0,
                                      categories=[r[c] for r in freq], cumulative=cum, missing=p["missing"]))
        else:
            models.append(ColumnModel(c, "numeric", p["lo"], p["hi"], p["digits"], grid=grids[c], missing=p["missing"]))
    # normal scores through the fitted marginals (missing cells score 0, the median),
    # computed in staged projections so each score is evaluated once per row, then
    # every pairwise Pearson correlation in one partial aggregate
    k = len(models)
    corr = np.eye(k)
    if k > 1:
        sc = d.select(*[(F.col(m.name) if m.role == "categorical" else F.col(m.name).cast("double")).alias(f"_x{i}")
                        for i, m in enumerate(models)])
        for i, m in enumerate(models):
            sc = _normal_score(_cdf_stages(sc, m, f"_x{i}", f"_p{i}"), f"_p{i}", f"_z{i}")
        z = sc.select(*[F.coalesce(F.col(f"_z{i}"), F.lit(0.0)).alias(f"z{i}") for i in range(k)])
        pairs = [(i, j) for i in range(k) for j in range(i + 1, k)]
        with session_conf(df.sparkSession, JIT_SIZED_CODEGEN):
            row = z.agg(*[F.corr(f"z{i}", f"z{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
        for i, j in pairs:
            v = row[f"c{i}_{j}"]
            corr[i, j] = corr[j, i] = 0.0 if v is None or math.isnan(v) else float(v)
    L = _cholesky(corr)
    types = {c: df.schema[c].dataType.simpleString() for c in cols}
    return CopulaModel(models, L.tolist(), types)


def _count_below(x: Column, grid: Sequence[float], strict: bool = True) -> Column:
    """Number of sorted ``grid`` points ``< x`` (``<= x`` if not ``strict``), as a
    balanced CASE tree: about log2(len) codegen'd comparisons per value, no lambdas.
    Meant for short arrays (category cumulative frequencies)."""
    def node(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        go_right = (x > F.lit(float(grid[mid]))) if strict else (x >= F.lit(float(grid[mid])))
        return F.when(go_right, node(mid + 1, hi)).otherwise(node(lo, mid))
    return node(0, len(grid))


# normal scores at the grid's probabilities; the outermost two stand for the tails
Z_GRID = [NormalDist().inv_cdf(min(max(q, 5e-4), 1 - 5e-4)) for q in GRID]


def _normal_score(df: DataFrame, p: str, out: str) -> DataFrame:
    """Standard normal score of the probability ``p``: linear between the literal scores of
    the 101 grid probabilities (two look-ups, so many columns stay small as code)."""
    at = F.col(p) * F.lit(float(len(GRID) - 1))
    df = df.withColumn(f"{out}_i", F.least(F.floor(at).cast("int"), F.lit(len(GRID) - 2)))
    i, z = F.col(f"{out}_i"), F.array(*[F.lit(v) for v in Z_GRID])
    lo, hi = F.element_at(z, i + 1), F.element_at(z, i + 2)
    return df.withColumn(out, lo + (hi - lo) * (at - i)).drop(f"{out}_i")


def _cdf_stages(df: DataFrame, m: ColumnModel, x: str, out: str) -> DataFrame:
    """Mid-rank CDF of column ``x`` under the fitted marginal, kept inside (0, 1)."""
    xc = F.col(x)
    if m.role == "categorical":
        ok = xc.isNotNull()
        if not m.categories:
            return df.withColumn(out, F.lit(None).cast("double"))
        cats = F.array(*[F.lit(v) for v in m.categories])
        cum = F.array(*[F.lit(float(v)) for v in m.cumulative])
        prev = F.array(*[F.lit(float(v)) for v in [0.0] + m.cumulative[:-1]])
        df = df.withColumn(f"{out}_i", F.array_position(cats, xc).cast("int"))
        i = F.col(f"{out}_i")
        u = F.when(ok & (i > 0), (F.element_at(prev, i) + F.element_at(cum, i)) / 2)
        df = df.withColumn(out, u).drop(f"{out}_i")
    elif not m.grid:
        df = df.withColumn(out, F.lit(None).cast("double"))
    else:
        ok = xc.isNotNull() & ~F.isnan(xc)
        # rank of x among the grid points by a JVM binary search (Bucketizer over the
        # distinct grid values), then literal lookups for ties -> mid-rank
        g = [float(v) for v in m.grid]
        uniq = sorted(set(g))
        lt = [0] + [sum(1 for v in g if v < u_) for u_ in uniq]     # grid points < value
        le = [0] + [sum(1 for v in g if v <= u_) for u_ in uniq]    # grid points <= value
        bk = Bucketizer(splits=[-math.inf] + uniq + [math.inf], inputCol=f"{out}_x",
                        outputCol=f"{out}_j", handleInvalid="keep")
        df = bk.transform(df.withColumn(f"{out}_x", F.when(ok, xc).otherwise(F.lit(0.0))))
        j = F.col(f"{out}_j").cast("int") + 1                        # 1-based lookup index
        uval = F.array(*[F.lit(v) for v in [math.nan] + uniq])
        ltc, lec = F.array(*[F.lit(v) for v in lt]), F.array(*[F.lit(v) for v in le])
        df = df.withColumn(f"{out}_b", F.when(xc == F.element_at(uval, j), F.element_at(ltc, j))
                                        .otherwise(F.element_at(lec, j))) \
               .withColumn(f"{out}_e", F.element_at(lec, j))
        below, upto = F.col(f"{out}_b"), F.col(f"{out}_e")
        grid = F.array(*[F.lit(v) for v in g])
        i = F.greatest(below, F.lit(1))
        g0, g1 = F.element_at(grid, i), F.element_at(grid, F.least(i + 1, F.lit(len(g))))
        interp = (F.least(below, F.lit(len(g) - 1)) - 1
                  + F.coalesce(F.try_divide(xc - g0, g1 - g0), F.lit(0.0))) / F.lit(len(g) - 1.0)
        u = F.when(upto > below, (below + upto - 1) / F.lit(2.0 * (len(g) - 1))).otherwise(interp)
        df = df.withColumn(out, F.when(ok, u)).drop(f"{out}_x", f"{out}_j", f"{out}_b", f"{out}_e")
    return df.withColumn(out, F.least(F.greatest(F.col(out), F.lit(1e-6)), F.lit(1 - 1e-6)))


def _uniform(id_col: Column, seed: int, k: int, j: int) -> Column:
    h = F.xxhash64(id_col, F.lit(seed), F.lit(k), F.lit(j))
    return (F.pmod(h, F.lit(2 ** 53)).cast("double") + F.lit(0.5)) / F.lit(TWO53)


def _phi(x: Column) -> Column:
    """Standard normal CDF via an erf approximation (absolute error < 1.5e-7);
    ``x`` should be a column reference (it is used several times)."""
    z = F.abs(x) / F.lit(math.sqrt(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * z)
    poly = t * (F.lit(0.254829592) + t * (F.lit(-0.284496736) + t * (F.lit(1.421413741)
               + t * (F.lit(-1.453152027) + t * F.lit(1.061405429)))))
    erf = F.lit(1.0) - poly * F.exp(-z * z)
    return F.when(x >= 0, (F.lit(1.0) + erf) / 2).otherwise((F.lit(1.0) - erf) / 2)


def _inverse_marginal_stages(df: DataFrame, m: ColumnModel, u: str, out: str, out_type: str) -> DataFrame:
    uc = F.col(u)
    if m.role == "categorical":
        if not m.categories:
            return df.withColumn(out, F.lit(None).cast(out_type))
        cats = F.array(*[F.lit(x) for x in m.categories])
        idx = F.least(_count_below(uc, m.cumulative, strict=True), F.lit(len(m.categories) - 1))
        return df.withColumn(out, F.element_at(cats, idx + 1).cast(out_type))
    if not m.grid:
        return df.withColumn(out, F.lit(None).cast(out_type))
    n = len(m.grid) - 1
    grid = F.array(*[F.lit(float(x)) for x in m.grid])
    df = df.withColumn(f"{out}_i", F.least(F.floor(uc * F.lit(float(n))).cast("int"), F.lit(n - 1)))
    i = F.col(f"{out}_i")
    df = df.withColumn(f"{out}_lo", F.element_at(grid, i + 1)) \
           .withColumn(f"{out}_hi", F.element_at(grid, i + 2))
    lo, hi = F.col(f"{out}_lo"), F.col(f"{out}_hi")
    v = lo + (hi - lo) * (uc * F.lit(float(n)) - i)
    v = F.least(F.greatest(v, F.lit(float(m.lo))), F.lit(float(m.hi)))
    return df.withColumn(out, F.round(v, m.digits).cast(out_type)).drop(f"{out}_i", f"{out}_lo", f"{out}_hi")


def copula_sample(model: CopulaModel, ids: DataFrame, id_col: str = "id", seed: int = 42,
                  keep: Sequence[str] = ()) -> DataFrame:
    """One synthetic row per id (map-only; deterministic in ``(id, seed)``)."""
    rid = F.col(id_col)
    d = len(model.columns)
    zs = []
    for k in range(d):
        u1, u2 = _uniform(rid, seed, k, 0), _uniform(rid, seed, k, 1)
        zs.append(F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2))
    df = ids.select(*keep, rid.alias("_id"), *[zk.alias(f"_z{k}") for k, zk in enumerate(zs)])
    L = model.cholesky
    xs = []
    for i in range(d):
        terms = [F.col(f"_z{j}") * F.lit(float(L[i][j])) for j in range(i + 1) if L[i][j] != 0.0]
        acc = terms[0] if terms else F.lit(0.0)
        for t in terms[1:]:
            acc = acc + t
        xs.append(acc.alias(f"_x{i}"))
    df = df.select(*keep, "_id", *xs)
    df = df.select(*keep, "_id", *[_phi(F.col(f"_x{i}")).alias(f"_u{i}") for i in range(d)])
    for i, m in enumerate(model.columns):
        df = _inverse_marginal_stages(df, m, f"_u{i}", m.name, model.types[m.name])
        if m.missing:
            absent = _uniform(F.col("_id"), seed, i, 2) < F.lit(m.missing)
            df = df.withColumn(m.name, F.when(~absent, F.col(m.name)))
    return df.select(*keep, F.col("_id").alias(id_col), *[m.name for m in model.columns])
