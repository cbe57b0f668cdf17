"""Text quality by regularised quadratic discriminant analysis.

A document's statistics (lengths, character classes, repetition) are put on unbounded scales
and modelled by one Gaussian per class, whose covariance is shrunk towards the pooled one and
its diagonal. A score is the class posterior: the difference of the two log densities, each a
Mahalanobis distance through a Cholesky factor that is computed once.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from orderlens.llm.corpus import fold, id_and_text
from orderlens.workspace import stored

#: Part of a class covariance that comes from the pooled one, and part of that from its diagonal.
POOLED, DIAGONAL = 0.2, 0.1
#: Added to every variance, so that a constant statistic does no harm.
LEAST_VARIANCE = 1e-3

FEATURES = (
    "log_chars", "log_words", "mean_word", "long_words", "upper", "digits", "symbols", "marks",
    "accents", "spaces", "log_lines", "distinct_words", "top_word", "repeat_next", "distinct_pairs",
    "end_marks",
)


def statistics(text: str) -> list[float]:
    """The transformed statistics of one whole text, in the order of FEATURES."""
    n, words = len(text), text.split()
    count = Counter(words)
    w = len(words)
    letters = sum(map(len, re.findall(r"[^\W\d_]+", text)))
    upper = sum(map(len, re.findall(r"[A-Z]+", text)))
    digits = sum(map(len, re.findall(r"\d+", text)))
    marks = text.count(".") + text.count(",")
    white = n - sum(map(len, words))
    pairs = len(set(zip(words, words[1:])))
    repeats = sum(a == b for a, b in zip(words, words[1:]))

    def share(part: float, whole: float) -> float:
        """A share on the logit scale, drawn in by half an occurrence on either side."""
        p = (part + 0.5) / (whole + 1.0)
        return float(np.log(max(p, 1e-6) / max(1 - p, 1e-6)))

    return [
        np.log1p(n), np.log1p(w), np.log1p((n - white) / max(w, 1)),
        share(sum(c for word, c in count.items() if len(word) > 12), w),
        share(upper, letters), share(digits, n), share(n - letters - digits - marks - white, n),
        share(marks, n), share(letters - len(re.findall(r"[A-Za-z]", text)), letters), share(white, n),
        np.log1p(text.count("\n")), share(len(count), w), share(max(count.values(), default=0), w),
        share(repeats, w), share(pairs, w), share(sum(word[-1] in ".!?" for word in words), w),
    ]


@F.pandas_udf(ArrayType(DoubleType()))
def statistics_of(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics(t or "") for t in texts])


def with_statistics(documents: DataFrame) -> DataFrame:
    """doc_id and features of every row (a missing text counts as empty), stored once."""
    rows = id_and_text(documents)
    return stored(rows.select("doc_id", statistics_of("text").alias("features")), "quality-features")


@dataclass(frozen=True)
class Discriminant:
    """Per class 0 and 1: log prior, mean, inverse Cholesky factor and log determinant."""

    prior: tuple[float, float]
    mean: np.ndarray
    whiten: np.ndarray
    log_det: tuple[float, float]


def moments(examples: DataFrame, width: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per class: number, sum and sum of products of the features, added up by Spark."""
    x = F.col("features")
    products = F.array(*(x[i] * x[j] for i in range(width) for j in range(i, width)))
    values = F.concat(F.array(F.lit(1.0)), x, products)
    summed = (
        examples.select(F.col("label").cast("int").alias("label"), F.posexplode(values).alias("at", "value"))
        .groupBy("label", "at").agg(F.sum("value").alias("value")).collect()
    )  # a number of rows that depends on the features only
    out = {}
    for label in (0, 1):
        flat = np.zeros(1 + width + width * (width + 1) // 2)
        for row in summed:
            if row["label"] == label:
                flat[row["at"]] = row["value"]
        square = np.zeros((width, width))
        square[np.triu_indices(width)] = flat[1 + width :]
        out[label] = (flat[0], flat[1 : 1 + width], square + np.triu(square, 1).T)
    return out


def learn(features: DataFrame, labels: DataFrame, width: int = len(FEATURES)) -> Discriminant:
    """Fit on the rows of ``labels`` (doc_id, label 0 or 1) that have features.

    Rows with a null id or label teach nothing; repeated rows count as often as they occur. A
    class without rows gets the pooled mean and covariance, so that it tells nothing.
    """
    known = labels.where("label in (0, 1)").select("doc_id", "label")
    sums = moments(features.join(known, "doc_id"), width)
    total = sums[0][0] + sums[1][0]
    mean, cov = np.zeros((2, width)), np.zeros((2, width, width))
    pooled, overall = np.zeros((width, width)), np.zeros(width)
    if total:
        overall = (sums[0][1] + sums[1][1]) / total
    for k, (n, s, ss) in sums.items():
        mean[k] = s / n if n else overall
        cov[k] = ss / n - np.outer(mean[k], mean[k]) if n else 0
        pooled += cov[k] * n / max(total, 1)
    whiten, log_det = np.zeros((2, width, width)), [0.0, 0.0]
    for k, (n, _, _) in sums.items():
        own = cov[k] if n else pooled
        # the fewer rows a class has, the more its covariance leans on the pooled one
        lean = max(POOLED, min(1.0, width / max(n, 1)))
        mixed = (1 - lean) * own + lean * pooled
        mixed = (1 - DIAGONAL) * mixed + DIAGONAL * np.diag(np.diag(mixed)) + LEAST_VARIANCE * np.eye(width)
        factor = np.linalg.cholesky(mixed)
        whiten[k] = np.linalg.inv(factor)
        log_det[k] = 2 * float(np.log(np.diag(factor)).sum())
    prior = tuple(float(np.log((sums[k][0] + 1) / (total + 2))) for k in (0, 1))
    return Discriminant(prior, mean, whiten, (log_det[0], log_det[1]))


def density_difference(x: np.ndarray, model: Discriminant) -> np.ndarray:
    """Log posterior odds of class 1 for rows of features."""
    logs = []
    for k in (0, 1):
        z = (x - model.mean[k]) @ model.whiten[k].T
        logs.append(model.prior[k] - 0.5 * (model.log_det[k] + (z * z).sum(axis=1)))
    return logs[1] - logs[0]


def score(features: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id, score (0 to 1, the probability of label 1) and predicted of every row."""
    shared = features.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def posterior(rows: pd.Series) -> pd.Series:
        odds = density_difference(np.array(rows.tolist(), float), shared.value)
        return pd.Series(1 / (1 + np.exp(-np.clip(odds, -500, 500))))

    scored = features.select("doc_id", posterior("features").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id, 3) == 1, F.lit(False))


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document; learned from the labels of documents that are not held out.

    A missing text counts as empty and is scored like any other; without any labels every
    score is 0.5. Repeated rows each get their score.
    """
    features = with_statistics(documents)
    known = labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    scored = score(features, learn(features, known))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
