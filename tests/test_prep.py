import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.operators import prep
from tidewater.operators.quantiles import exact_quantiles, order_statistics


@pytest.mark.parametrize("limit", [4, 100_000])
def test_exact_quantiles_match_numpy(spark, limit):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(size=3000), np.full(1600, 2.5), rng.integers(0, 5, 400).astype(float)])
    y = rng.exponential(size=5000)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact_quantiles(df, ["x", "y"], probs, bins=16, collect_limit=limit)
    for c, arr in (("x", x), ("y", y)):
        want = np.quantile(arr, probs)
        assert np.allclose(got[c], want, rtol=0, atol=1e-12), (c, got[c], want)


def test_order_statistics_hot_value_and_long_keys(spark):
    rows = [(0, 7)] * 3000 + [(0, i) for i in range(6000)] + [(1, 2 ** 60 - i) for i in range(50)]
    df = spark.createDataFrame(rows, "gid int, x long")
    got = order_statistics(df, {0: [0, 4000, 8999], 1: [0, 49]}, bins=8, collect_limit=2)
    s0 = sorted(r[1] for r in rows if r[0] == 0)
    assert got[(0, 0)] == s0[0] and got[(0, 4000)] == s0[4000] and got[(0, 8999)] == s0[8999]
    assert got[(1, 0)] == 2 ** 60 - 49 and got[(1, 49)] == 2 ** 60


@pytest.mark.parametrize("limit", [2, 100_000])
def test_order_statistics_signs_zeros_infinities_and_extremes(spark, limit):
    """Every rank of a column mixing signs, +-0, infinities, subnormals and huge
    magnitudes equals the sorted values (first-round buckets are by magnitude)."""
    rng = np.random.default_rng(11)
    vals = ([0.0, -0.0, 0.0, float("inf"), float("-inf"), 5e-324, -5e-324, 1e308, -1e308,
             1.0, 1.0 + 2 ** -52, -1.0, 2.0, 0.5, 3.0] + list(rng.normal(size=300) * 10.0 ** rng.integers(-8, 8, 300))
            + [7.25] * 200)
    df = spark.createDataFrame([(0, float(v)) for v in vals], "gid int, x double")
    got = order_statistics(df, {0: list(range(len(vals)))}, bins=4, collect_limit=limit)
    srt = sorted(vals)
    assert [got[(0, r)] for r in range(len(vals))] == srt


def test_nan_and_null_count_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,), (10.0,)], "a double")
    assert exact_quantiles(df, ["a"], [0.5])["a"] == [2.0]
    allnull = spark.createDataFrame([(None,), (None,)], "a double")
    assert exact_quantiles(allnull, ["a"], [0.5])["a"] == [None]


def test_curate_matches_pandas(spark):
    rng = np.random.default_rng(1)
    n = 400
    pdf = pd.DataFrame({
        "a": rng.normal(50, 10, n).round(1), "b": rng.integers(0, 4, n).astype(float),
        "c": rng.exponential(100, n).round(2), "d": rng.normal(0, 1, n), "t": rng.integers(0, 2, n),
    })
    pdf.loc[::17, "a"] = np.nan
    pdf.loc[::23, "c"] = np.nan
    pdf.loc[5, "c"] = 1e6                         # outlier
    pdf.loc[7, "d"] = -1.0                        # d + 1 == 0 -> NULL ratio
    pdf = pd.concat([pdf, pdf.iloc[:30]], ignore_index=True)   # duplicates
    df = spark.createDataFrame(pdf.astype({"t": "int64"}).replace({np.nan: None}),
                               "a double, b double, c double, d double, t long")
    out = prep.curate(df, features=["a", "b", "c", "d"], label="t", clip_cols=["a", "c"], k=3.0,
                      product=("a", "b"), ratio=("c", "d"), derived=("ab", "cd"),
                      materialize_as="persist").toPandas()
    # pandas reference semantics (label not imputed; division by zero -> NULL)
    p = pdf.copy()
    p[["a", "b", "c", "d"]] = p[["a", "b", "c", "d"]].fillna(p[["a", "b", "c", "d"]].median())
    p = p.drop_duplicates()
    for c in ["a", "c"]:
        q1, q3 = p[c].quantile([0.25, 0.75])
        p[c] = p[c].clip(q1 - 3 * (q3 - q1), q3 + 3 * (q3 - q1))
    p["ab"] = p["a"] * p["b"]
    p["cd"] = (p["c"] / (p["d"] + 1)).replace([np.inf, -np.inf], np.nan)
    cols = ["a", "b", "c", "d", "ab", "cd"]
    for c in cols:
        s = p[c].std(ddof=0)
        p[c] = (p[c] - p[c].mean()) / (s if s != 0 else 1)
    key = cols + ["t"]
    a = out[key].sort_values(key).reset_index(drop=True)
    b = p[key].sort_values(key).reset_index(drop=True)
    assert len(a) == len(b)
    assert np.allclose(a[cols].to_numpy(float), b[cols].to_numpy(float), atol=1e-9, equal_nan=True)


def test_winsorize_keeps_rows_and_nulls(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(None,), (1e9,)], "x double")
    out = prep.winsorize_iqr(df, ["x"], k=0.5)
    assert out.count() == 102
    assert out.where(F.col("x").isNull()).count() == 1
    assert out.agg(F.max("x")).first()[0] < 1e9


def test_standardize_zero_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    r = prep.standardize(df, ["a", "b"]).collect()
    assert [x.b for x in r] == [0.0, 0.0, 0.0]
    assert abs(sum(x.a for x in r)) < 1e-12


def test_preparation_survives_its_json_and_fits_on_the_training_side(spark):
    df = spark.createDataFrame([(float(i % 50), float(i % 7) if i % 9 else None, float(i % 3), float(i % 5), i % 2) for i in range(300)]
                               + [(1e6, 1.0, 1.0, 1.0, 1)], "a double, b double, c double, d double, t int")
    kw = dict(features=["a", "b", "c", "d"], label="t", clip_cols=["a"], product=("a", "b"), ratio=("c", "d"), derived=("ab", "cd"))
    out, saved = prep.curate(df, **kw, return_preparation=True, fit_on=lambda t: t.withColumn("is_test", F.col("d") == 4.0))
    again = prep.Preparation.from_json(saved.to_json())
    assert again == saved
    train = out.where("NOT is_test")
    for c in saved.feature_columns:
        m = train.agg(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).first()
        assert abs(m.m) < 1e-9 and abs(m.s - 1) < 1e-9
    raw = again.apply(df)
    assert raw.count() == 301 and raw.where(" OR ".join(f"{c} IS NULL" for c in saved.feature_columns)).isEmpty()
    # a prepared raw row is a row of the curated table
    assert raw.select(*saved.feature_columns).distinct().exceptAll(out.select(*saved.feature_columns).distinct()).isEmpty()
