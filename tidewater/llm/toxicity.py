"""Toxicity scores by weak supervision (operator 8).

1. Lexicons.  On a bounded sample of labelled training rows (``SAMPLE`` rows of each label,
   the least by hash; a documented parameter), document counts of words and of word
   beginnings (4 to 6 letters) give the terms that lean toxic and hardly occur in clean rows.
2. Voters.  The terms are dealt over many word and prefix lists; with a list of common
   insults, writing patterns and voters for absence, each voter says toxic, clean or nothing
   about each document.  One pass over all texts makes the votes and the terms found.
3. Label model.  Votes are counted by pattern over all documents.  Expectation-maximisation
   (Spark aggregates over the patterns) estimates the accuracy of each voter, half supervised:
   the labelled sample of step 1 gives the starting accuracies, and each round takes the mean
   of a voter's accuracy there and its expected accuracy over all rows.  The expected
   within-class covariances give the correlations between voters, and correlated voters share
   their weight.  The result is a posterior for each pattern of votes.
4. Classifier.  A linear classifier (``pyspark.ml`` logistic regression, all documents) is
   trained on the posterior labels, with the terms found as inputs.  Its probability is the score.

Labels are used in steps 1 and 3 and never from held-out rows; labels, language, source and
id are never inputs of a score.

Defined results: null and empty texts get the classifier's score of a text without terms;
repeated rows are scored alike; without any labelled row of either label the lexicons are
the common insults alone, and if all posterior labels agree the posterior is the score; an
empty table gives no rows; other columns are ignored.  Whole texts are read, however long.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ._frames import read, stage

SAMPLE = 6_000                # labelled rows of each label that lexicons are mined from
WORD_LISTS, PREFIX_LISTS = 8, 6
PREFIXES = (4, 5, 6, 7)
EM_ROUNDS = 12
TOXIC, CLEAN = 1, 2           # votes; 0 abstains

#: Common English insults (a fixed public vocabulary).
INSULTS = ("idiot moron stupid dumb loser scum trash garbage pathetic worthless disgusting clown "
           "fool imbecile cretin vermin filth jerk creep liar coward").split()

_LETTERS = re.compile(r"[^\W\d_]+")
_SHOUT = re.compile(r"[!?]{2,}")
_CAPS = re.compile(r"\b[A-Z]{4,}\b")
_STRETCH = re.compile(r"([^\W\d_])\1{3,}")
_MASKED = re.compile(r"\b[^\W\d_]+[*#@$]{2,}[^\W\d_]+")


def terms_of(text: str | None, bases: frozenset | None = None) -> set[str]:
    """Words of a text in lower case; their beginnings as ``beginning-``, and as
    ``beginning-2``, ``beginning-3`` if so many different words begin like that.
    bases: the beginnings to look for (all by default)."""
    words = set(_LETTERS.findall((text or "").lower()))
    begun: dict[str, int] = {}
    for w in words:
        for n in PREFIXES:
            if len(w) < n:
                break
            b = w[:n]
            if bases is None or b in bases:
                begun[b] = begun.get(b, 0) + 1
    for b, k in begun.items():
        words.add(b + "-")
        if k > 1:
            words.add(b + "-2")
            if k > 2:
                words.add(b + "-3")
    return words


def _term_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(pdf["text"], pdf["toxic"]):
            for t in terms_of(text):
                counts.setdefault(t, [0, 0])[toxic] += 1
        yield pd.DataFrame({"term": list(counts), "toxic": [c[1] for c in counts.values()],
                            "clean": [c[0] for c in counts.values()]})


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def sample_labels(labels: DataFrame) -> tuple[list, dict[int, float]]:
    """A bounded sample of training labels, SAMPLE rows of each, and for each label how many
    training rows one row of the sample stands for."""
    train = labels.where(F.col("toxic").isin(0, 1) & F.col("id").isNotNull()).where(~held_out("id")).distinct()
    there = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.xxhash64(F.lit("sample"), "id")
    rows = [r for y in (0, 1) for r in train.where(F.col("toxic") == y).orderBy(draw, "id").limit(SAMPLE).collect()]
    return rows, {y: n / min(n, SAMPLE) for y, n in there.items()}


def mine_lexicon(docs: DataFrame, rows: list) -> list[str]:
    """All terms that lean toxic in a bounded sample of training labels, so their number is bounded
    by the sample's words.  docs: (id, text)."""
    sizes = {y: sum(r["toxic"] == y for r in rows) for y in (0, 1)}
    if not all(sizes.values()):
        return []
    sample = docs.sparkSession.createDataFrame(rows, "id long, toxic int")  # at most 2 * SAMPLE rows: broadcast
    # distinct texts: copies are no further evidence
    counts = stage(docs.join(F.broadcast(sample), "id").select("text", "toxic").distinct()
                   .mapInPandas(_term_rows, "term string, toxic long, clean long"), "tox-terms") \
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # likelihood-ratio test of independence (24: p of about 1e-6, as very many terms are tested)
    share = sizes[1] / (sizes[0] + sizes[1])
    n, a, b = F.col("toxic") + F.col("clean"), F.col("toxic"), F.col("clean")
    g = 2 * (a * F.log(a / (n * share)) + F.when(b > 0, b * F.log(b / (n * (1 - share)))).otherwise(0.0))
    lift = ((a + 0.5) / (sizes[1] + 1)) / ((b + 0.5) / (sizes[0] + 1))
    lean = counts.where("toxic > 0").withColumn("lift", lift).where((g >= 24) & (F.col("lift") >= 8))
    order = [F.desc(F.col("term").contains("-")), F.desc(F.col("toxic") - F.col("clean")), F.desc("lift"), "term"]
    return [r["term"] for r in lean.orderBy(*order).collect()]


def _list_of(term: str) -> int:
    n = zlib.crc32(term.partition("-")[0].encode())
    return WORD_LISTS + n % PREFIX_LISTS if "-" in term else n % WORD_LISTS


N_LISTS = WORD_LISTS + PREFIX_LISTS
VOTERS = N_LISTS + 14


def _bases(lexicon) -> frozenset:
    return frozenset(t.partition("-")[0] for t in lexicon if "-" in t)


def votes_of(text: str | None, lexicon: dict[str, int], insults: frozenset, bases: frozenset) -> tuple[list[int], list[str]]:
    """Votes of all voters on one text, and the lexicon terms found in it."""
    text = text or ""
    terms = terms_of(text, bases)
    found = [t for t in terms if t in lexicon]
    votes = [0] * VOTERS
    for t in found:
        votes[lexicon[t]] = TOXIC
    words = sum("-" not in t for t in terms)
    named = sum("-" not in t for t in found)
    begun, again = len(found) - named, sum(t[-1] in "23" for t in found)
    insult = not insults.isdisjoint(terms)
    shout = bool(_SHOUT.search(text)) or len(_CAPS.findall(text)) >= 3
    v = N_LISTS
    votes[v] = TOXIC if insult else 0
    votes[v + 1] = TOXIC if named >= 2 else CLEAN if not named else 0
    votes[v + 2] = TOXIC if begun >= 2 else CLEAN if not begun else 0
    votes[v + 3] = TOXIC if named + begun and 50 * (named + begun) > words else CLEAN if not found else 0
    votes[v + 4] = TOXIC if shout and found else 0
    votes[v + 5] = CLEAN if not insult and not found else 0
    votes[v + 6] = TOXIC if _STRETCH.search(text) and found else 0
    votes[v + 7] = TOXIC if _MASKED.search(text) and found else 0
    votes[v + 8] = CLEAN if len({lexicon[t] for t in found}) <= 1 and not insult else TOXIC if insult and found else 0
    votes[v + 9] = TOXIC if len({lexicon[t] for t in found}) >= 3 else 0
    votes[v + 10] = TOXIC if again else CLEAN
    kinds = len({t.partition("-")[0] for t in found}) + insult
    votes[v + 11] = TOXIC if kinds >= 4 else CLEAN if kinds <= 1 else 0
    votes[v + 12] = TOXIC if 20 * kinds > words else CLEAN if 200 * kinds < words else 0
    votes[v + 13] = CLEAN if not insult and not again and named <= 1 else 0
    return votes, found + ["insult+"] * insult


def _vote(lexicon: list[str]):
    lists = {t: _list_of(t) for t in lexicon}
    insults, bases = frozenset(INSULTS), _bases(lexicon)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            both = [votes_of(t, lists, insults, bases) for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf["id"], "votes": ["".join(map(str, b[0])) for b in both],
                                "found": [b[1] for b in both]})
    return run


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of votes and of products of two votes, weighted by the expected class counts."""
    for pdf in batches:
        votes = np.column_stack([np.ones(len(pdf)), *(pdf[f"s{j}"] for j in range(VOTERS))])
        for c, w in ((1, pdf["n"] * pdf["p"]), (0, pdf["n"] * (1 - pdf["p"]))):
            m = (votes * w.to_numpy()[:, None]).T @ votes
            i, j = np.indices(m.shape)
            yield pd.DataFrame({"c": c, "i": i.ravel(), "j": j.ravel(), "m": m.ravel()})


def _correlations(scored: DataFrame) -> dict[tuple[int, int], float]:
    """Correlation of the votes of each two voters within a class, the mean of both classes."""
    out = dict.fromkeys(((i, j) for i in range(VOTERS) for j in range(i + 1, VOTERS)), 0.0)
    rows = scored.mapInPandas(_moments, "c int, i int, j int, m double").groupBy("c", "i", "j").agg(F.sum("m").alias("m"))
    size = VOTERS + 1
    sums = {c: np.zeros((size, size)) for c in (0, 1)}
    for r in rows.collect():  # 2 * (VOTERS + 1) ** 2 numbers
        sums[r["c"]][r["i"], r["j"]] = r["m"]
    for m in sums.values():
        if m[0, 0] > 0:
            mean = m[0] / m[0, 0]
            cov = m / m[0, 0] - np.outer(mean, mean)
            sd = np.sqrt(np.maximum(np.diag(cov), 0))
            for i, j in out:
                if sd[i + 1] > 1e-6 and sd[j + 1] > 1e-6:
                    out[i, j] += 0.5 * cov[i + 1, j + 1] / (sd[i + 1] * sd[j + 1])
    return out


def label_model(patterns: DataFrame, stands_for: dict[int, float] | None = None) -> tuple[Column, dict]:
    """patterns: (votes string, toxic int or null, n).  Returns the posterior of toxic as a
    column over ``votes`` and what was estimated: prior, accuracies, correlations.  Rows with
    a label (of the training sample; stands_for: rows that one of them stands for) give each
    voter's accuracy there, which counts as much as its expected accuracy over all rows."""
    weight = F.lit(0.0)
    for y, w in (stands_for or {}).items():
        weight = F.when(F.col("toxic") == y, F.lit(float(w))).otherwise(weight)
    v = [F.substring("votes", j + 1, 1) for j in range(VOTERS)]
    sign = [F.when(x == str(TOXIC), 1.0).when(x == str(CLEAN), -1.0).otherwise(0.0) for x in v]
    prior, accuracy, share = 0.1, [0.8] * VOTERS, [1.0] * VOTERS

    def posterior() -> Column:
        logit = F.lit(math.log(prior / (1 - prior)))
        for j in range(VOTERS):
            logit = logit + sign[j] * (share[j] * math.log(accuracy[j] / (1 - accuracy[j])))
        return 1 / (1 + F.exp(-logit))

    patterns = stage(patterns.select("votes", "n", "toxic", (F.col("n") * weight).alias("known"), *(s.alias(f"s{j}") for j, s in enumerate(sign))), "tox-patterns")
    sign = [F.col(f"s{j}") for j in range(VOTERS)]

    seen = patterns.agg(*(F.sum(F.when(s != 0, F.col("known"))).alias(f"n{j}") for j, s in enumerate(sign)), *(
        F.sum(F.when((s > 0) == (F.col("toxic") == 1), F.col("known")).otherwise(0.0) * F.abs(s)).alias(f"r{j}")
        for j, s in enumerate(sign))).first()
    known = [((seen[f"r{j}"] or 0.0) + 8) / ((seen[f"n{j}"] or 0.0) + 10) for j in range(VOTERS)]
    accuracy = [min(0.99, max(0.5, a)) for a in known]

    def estimate() -> None:
        nonlocal prior, accuracy
        p = F.col("p")
        got = patterns.withColumn("p", posterior()).agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * p).alias("t"),
            *(F.sum(F.when(s != 0, F.col("n"))).alias(f"n{j}") for j, s in enumerate(sign)),
            *(F.sum(F.when(s != 0, F.col("n") * F.when(s > 0, p).otherwise(1 - p))).alias(f"r{j}")
              for j, s in enumerate(sign))).first()
        if got["n"]:
            prior = min(0.5, max(0.005, got["t"] / got["n"]))
            expected = [((got[f"r{j}"] or 0.0) + 8) / ((got[f"n{j}"] or 0) + 10) for j in range(VOTERS)]
            accuracy = [min(0.99, max(0.5, (e + k) / 2)) for e, k in zip(expected, known)]

    for _ in range(EM_ROUNDS):
        estimate()
    corr = _correlations(patterns.withColumn("p", posterior()))
    share = [1 / (1 + sum(max(0.0, r) for k, r in corr.items() if j in k and r > 0.1)) for j in range(VOTERS)]
    for _ in range(3):
        estimate()
    votes = [F.substring("votes", j + 1, 1) for j in range(VOTERS)]
    sign = [F.when(x == str(TOXIC), 1.0).when(x == str(CLEAN), -1.0).otherwise(0.0) for x in votes]
    return posterior(), {"prior": prior, "accuracy": accuracy, "correlation": corr, "share": share}


def fit(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[str, float], float]:
    """docs: (id, text); labels: (id, toxic).  Returns the documents' rows (id, found terms),
    and the classifier: a weight for each term, and the intercept."""
    rows, stands_for = sample_labels(labels)
    lexicon = mine_lexicon(docs, rows)
    voted = stage(docs.mapInPandas(_vote(lexicon), "id long, votes string, found array<string>"), "tox-votes")
    known = docs.sparkSession.createDataFrame(rows, "id long, toxic int")  # bounded, as above
    posterior, _ = label_model(voted.join(F.broadcast(known), "id", "left").groupBy("votes", "toxic")
                               .agg(F.count("*").alias("n")), stands_for)
    vocabulary = [*lexicon, "insult+"]
    bag = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="found", outputCol="features").setBinary(True)
    data = stage(bag.transform(voted.withColumn("p", posterior)).select(
        "features", (F.col("p") >= 0.5).cast("double").alias("label"),
        (F.abs(2 * F.col("p") - 1) + 0.001).alias("weight")), "tox-features")
    classes = [r[0] for r in data.select("label").distinct().collect()]
    if len(classes) < 2:
        return voted, {}, 4.0 if classes == [1.0] else -4.0
    model = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=60, standardization=False).fit(data)
    return voted, dict(zip(vocabulary, map(float, model.coefficients))), float(model.intercept)


def _probability(weights: dict[str, float], intercept: float, found: list[str]) -> float:
    x = intercept + sum(sorted(weights.get(t, 0.0) for t in found))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, x))))


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs: any columns; labels: (id, toxic).  Returns id, score (0 to 1) for each row of docs."""
    voted, weights, intercept = fit(_narrow(docs, id_col, text_col), _clean_labels(labels))

    @F.pandas_udf(DoubleType())
    def score(found: pd.Series) -> pd.Series:
        return pd.Series([_probability(weights, intercept, f) for f in found], dtype=float)
    return voted.select("id", score("found").alias("score"))


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def _clean_labels(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "toxic")


def op8_toxicity_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scores(read(spark, sf_dir, "documents"), labels_of(spark, sf_dir))
    return stage(found.select(F.col("id").alias("doc_id"), F.coalesce(held_out("id"), F.lit(False)).alias("held_out"),
                              "score", (F.col("score") >= 0.5).cast("int").alias("predicted")), "tox-result")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows scored 0.5 or more; all columns, in one pass without a shuffle."""
    _, weights, intercept = fit(_narrow(docs, id_col, text_col), _clean_labels(labels))
    insults, bases = frozenset(INSULTS), _bases(weights)

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            terms = terms_of(text, bases)
            found = [t for t in terms if t in weights] + ["insult+"] * (not insults.isdisjoint(terms))
            out.append(_probability(weights, intercept, found))
        return pd.Series(out, dtype=float)
    return docs.where(score(F.col(text_col)) < 0.5)
