"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from larderspark.llm import gbt
from larderspark.llm.common import bounded_sample, fold, one_text, spare, training_labels

#: Labelled documents that a model is fitted on, at most (chosen by hash).
TRAINING_ROWS = 20_000
#: A document is kept (predicted 1) from this score on.
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2


def statistics(text: str | None) -> list[float]:
    """The document statistics of one whole text; null counts as empty.

    Sizes, shares of character kinds, word lengths, and how often words and
    lines repeat. None of them looks at single words.
    """
    text = text or ""
    n = len(text)
    words, lines = text.split(), text.split("\n")
    w = max(len(words), 1)
    upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lower = sum(map(text.count, "abcdefghijklmnopqrstuvwxyz"))
    digits = sum(map(text.count, "0123456789"))
    symbols = sum(map(text.count, "#$%&*@^~<>{}[]\\=+_`"))
    ends = sum(map(text.count, ".!?"))
    bars, bangs, commas = text.count("|"), text.count("!"), text.count(",")
    beyond = n - len(text.encode("ascii", "ignore"))
    chars = max(n, 1)
    same = sum(a == b for a, b in zip(words, words[1:]))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    distinct, distinct_lines = len(set(words)), len(set(lines))
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), float(sizes.mean()), float(sizes.std()),
        float(sizes.max()), upper / chars, lower / chars, digits / chars, symbols / chars, beyond / chars,
        ends / w, bars / w, bangs / w, commas / w, distinct / w, distinct / w * np.log1p(len(words)),
        same / w, distinct_lines / len(lines), len(words) / len(lines), symbols / w, digits / w,
    ]


FEATURES = len(statistics(""))


@F.pandas_udf(ArrayType(DoubleType()))
def statistics_column(texts: pd.Series) -> pd.Series:
    return texts.map(statistics)


def fit_model(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> gbt.Trees:
    """Trees from at most about ``rows`` labelled documents outside the held-out fold.

    The sample of labels is bounded, so it may be broadcast. Of documents with
    equal ids the one of the least text digest is taken, so at most a row per
    label, with statistics only, comes to the driver. Without usable labels
    the score is 0.5.
    """
    chosen = bounded_sample(training_labels(labels, "quality", FOLDS, HELD_OUT), rows, "doc_id")
    sample = (
        one_text(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "doc_id", "label")
        .select(statistics_column("text").alias("x"), "label").toPandas()
    )
    x = np.array(sample["x"].tolist()).reshape(-1, FEATURES)
    return gbt.fit(x, sample["label"].to_numpy(float))


def with_score(docs: DataFrame, model: gbt.Trees, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the quality (0 to 1) of every whole text in column ``into``.

    All columns are kept; one named ``into`` is replaced. Null and empty texts
    are scored like any other (by the statistics of an empty text). Equal texts
    get equal scores. No shuffle.
    """

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model.score(np.array([statistics(t) for t in texts])))

    return docs.withColumn(into, score(F.col(text)))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    model = fit_model(docs, labels)
    return with_score(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents scored at the threshold or above, with all their columns.

    Rows are judged one by one, by their text only: null ids and repeated rows
    change nothing, and a null or empty text is scored as an empty one.
    """
    into = spare(docs, "quality_score")
    return with_score(docs, fit_model(docs, labels), into=into).filter(F.col(into) >= THRESHOLD).drop(into)
