"""Quality by co-training (operator 2): a text-content view and a page-metadata view.

Both views are computed in one pass over all texts: the content view describes words and
characters (variety, repetition, symbols, digits, word lengths), the metadata view describes
the page (source, language, length, lines and their layout) and looks at no words.

1. Each view trains a logistic regression (``pyspark.ml``) on the labelled training rows.
2. In each round each classifier scores the unlabelled documents; those it is most sure of
   (the outermost ``SHARE`` of its scores, split between the labels as the training labels
   are) become pseudo-labelled rows of the other view, with weight ``TRUST``.  Both are
   trained again.
3. On training rows kept apart, a logistic regression of one input calibrates each view and
   one of both calibrated views combines them; it scores every document.

Held-out rows (crc32 of the id, mod 5, is 0) give no labels and no pseudo-labels.

Defined results: null and empty texts have all-zero content features and are scored like
others; null source or language is a category of its own; repeated rows are scored alike;
without labelled rows of both labels every score is the share of good labels (0.5 without
any); an empty table gives no rows; other columns are ignored.  Whole texts are read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._frames import read, stage

ROUNDS = 3
SHARE = 0.1                   # of the unlabelled documents that a view labels for the other, each round
TRUST = 0.3
SOURCES, LANGS = 16, 8        # hashed categories

_LETTER = re.compile(r"[^\W\d_]+")
_DIGIT = re.compile(r"\d")
_ODD = re.compile(r"[^\w\s.,;:!?'\"()-]")
_UPPER = re.compile(r"[A-ZÀ-Þ]")
_END = re.compile(r"[.!?]")


def content_view(text: str | None) -> list[float]:
    text = text or ""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * 18
    lower = [w.lower() for w in words]
    counts = Counter(lower)
    top = counts.most_common(5)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / n
    letters = sum(map(len, _LETTER.findall(text)))
    odd, digits = len(_ODD.findall(text)), len(_DIGIT.findall(text))
    again = sum(a == b for a, b in zip(lower, lower[1:]))
    bigrams = len(set(zip(lower, lower[1:])))
    alone = sum(not any(c.isalnum() for c in w) for w in words)
    tails = sum(not w[-1].isalnum() for w in words)
    runs = sum(len(w) > 1 and w[-1] == w[-2] and not w[-1].isalnum() for w in words)
    short = sum(x <= 3 for x in lengths)
    return [len(counts) / n, top[0][1] / n, sum(c for _, c in top) / n, again / n, bigrams / max(1, n - 1),
            mean, math.sqrt(sum((x - mean) ** 2 for x in lengths) / n), letters / chars, odd / chars, digits / chars,
            len(_UPPER.findall(text)) / chars, len(_END.findall(text)) / n, alone / n, tails / n, runs / n, short / n,
            text.count("|") / n, math.log1p(n / (1 + len(counts)))]


def metadata_view(text: str | None, lang: str | None, source: str | None) -> list[float]:
    text = text or ""
    lines = text.split("\n")
    sizes = [len(x) for x in lines]
    blank = sum(not x.strip() for x in lines) / len(lines)
    mean = sum(sizes) / len(lines)
    once = len(set(lines)) / len(lines)
    layout = [math.log1p(len(text)), math.log1p(len(lines)), math.log1p(mean), math.log1p(max(sizes)), blank, once,
              sum(x < 40 for x in sizes) / len(lines), sum(x.startswith(("-", "*", "#", "|")) for x in lines) / len(lines),
              text.count("http") / len(lines), text.count("@") / len(lines), text.count("<") / len(lines)]
    one = [0.0] * (SOURCES + LANGS)
    one[zlib.crc32(("s" + (source or "")).encode()) % SOURCES] = 1.0
    one[SOURCES + zlib.crc32(("l" + (lang or "")).encode()) % LANGS] = 1.0
    return layout + one


def _views(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"id": pdf["id"], "a": [content_view(t) for t in pdf["text"]],
                            "b": [metadata_view(*x) for x in zip(pdf["text"], pdf["lang"], pdf["source"])]})


def _regression(**kw) -> LogisticRegression:
    return LogisticRegression(labelCol="y", weightCol="weight", maxIter=25, **kw)


def _score(model, df: DataFrame, out: str) -> DataFrame:
    """``df`` with the model's log-odds of good as ``out``."""
    kept = df.columns
    p = F.greatest(F.least(vector_to_array("probability")[1], F.lit(1 - 1e-9)), F.lit(1e-9))
    return model.transform(df).select(*kept, F.log(p / (1 - p)).alias(out))


def _given_away(scored: DataFrame, column: str, good: float) -> DataFrame:
    """The unlabelled rows a view is surest of, as pseudo-labelled rows (y, weight)."""
    low, high = SHARE * (1 - good), 1 - SHARE * good
    cut = scored.agg(F.percentile_approx(column, [low, high], 1000).alias("q")).first()["q"]
    if cut is None:
        return scored.limit(0).withColumn("y", F.lit(0.0)).withColumn("weight", F.lit(TRUST))
    return scored.where((F.col(column) <= min(cut[0], 0.0)) | (F.col(column) >= max(cut[1], 0.0))) \
        .withColumn("y", (F.col(column) > 0).cast("double")).withColumn("weight", F.lit(TRUST))


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """labels: (id, quality).  Returns id, score (0 to 1, higher: better) for each row of docs."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"))
    views = stage(rows.mapInPandas(_views, "id long, a array<double>, b array<double>"), "qua-views")
    views = views.select("id", array_to_vector("a").alias("a"), array_to_vector("b").alias("b"))
    fold = F.crc32(F.col("id").cast("string").cast("binary")) % 5
    known = labels.select(F.col("id").cast("long").alias("id"), F.col("quality").cast("double").alias("y")) \
        .where(F.col("y").isin(0.0, 1.0) & F.col("id").isNotNull()).dropDuplicates(["id"])
    data = stage(views.join(known, "id", "left").withColumn("fold", F.coalesce(fold, F.lit(0))), "qua-data")
    labelled = data.where("y IS NOT NULL AND fold <> 0").withColumn("weight", F.lit(1.0))
    shares = {r["y"]: r["n"] for r in labelled.where("fold > 1").groupBy("y").agg(F.count("*").alias("n")).collect()}
    held = {r["y"] for r in labelled.where("fold = 1").select("y").distinct().collect()}
    if len(shares) < 2 or len(held) < 2:
        n = sum(shares.values())
        return data.select("id", F.lit(shares.get(1.0, 0) / n if n else 0.5).alias("score"))
    good = shares[1.0] / sum(shares.values())
    pool = data.where("y IS NULL AND fold <> 0").select("id", "a", "b")
    train = labelled.where("fold > 1").select("id", "a", "b", "y", "weight")
    models = {v: _regression(featuresCol=v, regParam=1e-3).fit(train) for v in "ab"}
    for k in range(ROUNDS):
        scored = stage(_score(models["b"], _score(models["a"], pool, "sa"), "sb"), f"qua-round-{k}")
        given = {"b": _given_away(scored, "sa", good), "a": _given_away(scored, "sb", good)}
        models = {v: _regression(featuresCol=v, regParam=1e-3).fit(train.unionByName(given[v].select(*train.columns)))
                  for v in "ab"}
    # calibrate each view, then both together, on training rows that neither view has seen
    both = stage(_score(models["b"], _score(models["a"], data, "sa"), "sb").select(
        "id", "y", "fold", F.array("sa").alias("sa"), F.array("sb").alias("sb")), "qua-scored")
    both = both.select("id", "y", "fold", array_to_vector("sa").alias("sa"), array_to_vector("sb").alias("sb"), F.lit(1.0).alias("weight"))
    apart = both.where("y IS NOT NULL AND fold = 1")
    for v in "ab":
        both = _score(_regression(featuresCol=f"s{v}").fit(apart), both, f"c{v}")
    both = both.withColumn("views", array_to_vector(F.array("ca", "cb")))
    final = _regression(featuresCol="views", regParam=1e-4).fit(both.where("y IS NOT NULL AND fold = 1"))
    return final.transform(both).select("id", vector_to_array("probability")[1].alias("score"))


def op2_cotraining_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")
    found = scores(read(spark, sf_dir, "documents"), labels)
    held_out = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return found.select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"), (F.col("score") >= 0.5).alias("kept"))
