"""Toxicity: a linear classifier over words and their beginnings, learned from toxic examples and unlabelled text.

Non-negative positive-unlabelled learning: the risk of calling a clean text
toxic is not measured on labelled clean texts but as the risk on unlabelled
text minus the share that the class prior gives to toxic texts, and never
below zero.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from larderspark.llm.common import bounded_sample, fold, one_text, training_labels
from larderspark.session import cut_lineage

#: Confirmed toxic and unlabelled documents to learn from, at most (chosen by hash).
POSITIVES, UNLABELLED = 3_000, 9_000
#: Words and beginnings that may carry a weight, those that tell the two samples apart best.
WORDS = 1_500
#: Lengths of the beginnings of words that count besides whole words (inflected forms).
BEGINNINGS = (3, 4, 5, 6)
THRESHOLD = 0.5
FOLDS, HELD_OUT = 5, 0

WORD = re.compile(r"\w+")


def words_of(text: str | None) -> set[str]:
    """The distinct words of one whole text, lower case, and their beginnings (``^abc``); none for null."""
    words = set(WORD.findall((text or "").lower()))
    return words.union(*({"^" + w[:n] for w in words if len(w) > n} for n in BEGINNINGS))


@dataclass
class Weights:
    bias: float
    words: dict[str, float]

    def score(self, text: str | None) -> float:
        raw = self.bias + sum(self.words[w] for w in words_of(text) & self.words.keys())
        return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))


@F.pandas_udf(ArrayType(StringType()))
def words_column(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: sorted(words_of(t)))


def minimise(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-3
) -> tuple[np.ndarray, float]:
    """Weights and bias of least non-negative risk, logistic loss, by Adam on whole matrices.

    ``positive`` and ``unlabelled`` are 0/1 matrices, a row per document.
    """
    width = positive.shape[1]
    w = np.zeros(width + 1)
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    squash = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def gradient(x, slope):
        return np.append(slope @ x, slope.sum()) / len(x)

    for step in range(1, steps + 1):
        zp, zu = positive @ w[:-1] + w[-1], unlabelled @ w[:-1] + w[-1]
        as_clean_u, as_clean_p = np.logaddexp(0, zu).mean(), np.logaddexp(0, zp).mean()
        of_p = prior * gradient(positive, squash(zp))  # of the loss of calling the positives clean
        of_u = gradient(unlabelled, squash(zu)) - of_p
        if as_clean_u - prior * as_clean_p < 0:
            g = -of_u  # climb out of a negative risk
        else:
            g = prior * gradient(positive, squash(zp) - 1) + of_u
        g[:-1] += decay * w[:-1]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g**2
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def fit_model(
    docs: DataFrame, labels: DataFrame, prior: float | None = None,
    positives: int = POSITIVES, unlabelled: int = UNLABELLED,
) -> Weights:
    """Weights from bounded samples of the learning folds.

    ``prior`` is the share of toxic documents; unset, that of the labelled
    rows of the learning folds. Without a toxic example all scores are near 0.
    Of documents with equal ids the one of the least text digest is learned from. Only word counts of the sample (the
    best WORDS of them) and lists of word numbers, at most a row per sampled id, reach the driver.
    """
    usable = training_labels(labels, "toxic", FOLDS, HELD_OUT)
    if prior is None:
        prior = usable.agg(F.avg("label")).first()[0]
    toxic = bounded_sample(usable.filter("label = 1"), positives, "doc_id").select("doc_id")
    texts = docs.select("doc_id", "text")
    learning = texts.filter(fold("doc_id", FOLDS) != HELD_OUT)
    sample = cut_lineage(
        one_text(texts.join(F.broadcast(toxic), "doc_id"), "doc_id").withColumn("p", F.lit(1))
        .unionByName(one_text(bounded_sample(learning, unlabelled, "doc_id", "text"), "doc_id").withColumn("p", F.lit(0)))
        .select("p", words_column("text").alias("words")),
        "toxic-sample",
    )
    sizes = {r["p"]: r["count"] for r in sample.groupBy("p").count().collect()}
    if not prior or not sizes.get(1) or not sizes.get(0):
        return Weights(-30.0, {})
    rate = lambda p: F.sum(F.when(F.col("p") == p, 1).otherwise(0)) / sizes[p]
    best = (
        sample.select("p", F.explode("words").alias("word")).groupBy("word")
        .agg(F.count("*").alias("n"), rate(1).alias("among_p"), rate(0).alias("among_u"))
        .filter("n >= 5")
        .orderBy(((F.col("among_p") - F.col("among_u")) / F.sqrt(F.col("among_p") + F.col("among_u"))).desc(), "word")
        .limit(WORDS)
    )
    vocabulary = [r["word"] for r in best.select("word").collect()]
    number = {w: i for i, w in enumerate(vocabulary)}

    @F.pandas_udf(ArrayType(IntegerType()))
    def numbers(lists: pd.Series) -> pd.Series:
        return lists.map(lambda ws: [number[w] for w in ws if w in number])

    rows = sample.select("p", numbers("words").alias("at")).toPandas()
    matrix = np.zeros((len(rows), len(vocabulary)), np.float32)
    for i, at in enumerate(rows["at"]):
        matrix[i, np.asarray(at, int)] = 1
    p = rows["p"].to_numpy() == 1
    weights, bias = minimise(matrix[p], matrix[~p], float(prior))
    return Weights(bias, {w: float(x) for w, x in zip(vocabulary, weights) if abs(x) > 1e-6})


def with_score(docs: DataFrame, model: Weights, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the toxicity (0 to 1) of every whole text in column ``into``.

    All columns are kept; one named ``into`` is replaced. Null, empty and
    wordless texts get the score of a text without words. No shuffle.
    """

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(model.score).astype(float)

    return docs.withColumn(into, score(F.col(text)))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    return with_score(docs.select("doc_id", "text"), fit_model(docs, labels)).select(
        "doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
