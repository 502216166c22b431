"""Language identification: known words first, then ever shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderspark.llm.common import drawn, fold

#: Documents of a language that the model is learned from, at most (chosen by hash of id and text).
LANGUAGE_ROWS = 1_250
#: A word, or an n-gram, is known if the sample has it so often.
LEAST_WORDS, LEAST_GRAMS = 2, 3
LONGEST_GRAM = 5
SMOOTHING = 0.5
#: Words that a task remembers the scores of, at most, besides the known ones.
REMEMBERED = 200_000
UNDETERMINED = "und"
FOLDS, HELD_OUT = 4, 2

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> Counter:
    """Words of one whole text (runs of letters, lower case) and how often each occurs."""
    return Counter(w for w in WORD.findall((text or "").lower()) if any(map(str.isalpha, w)))


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word between boundary marks; single characters without marks."""
    marked = word if n == 1 else f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    """``words`` and ``grams[n]`` give row numbers of ``logs``, whose columns are ``languages``."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[int, dict[str, int]]
    logs: np.ndarray

    def unseen(self, word: str) -> np.ndarray:
        """Log probabilities of the longest n-grams of the word that the model has, averaged; zeros for none."""
        for n in range(LONGEST_GRAM, 0, -1):
            known = [self.grams[n][g] for g in grams(word, n) if g in self.grams[n]]
            if known:
                return self.logs[known].mean(0)
        return np.zeros(len(self.languages))


def predict(model: Model, texts: pd.Series) -> pd.DataFrame:
    """(lang_pred, score) per text: the likeliest language and its posterior over equal priors."""
    words, rows, extra = model.words, model.logs, {}
    more: list[np.ndarray] = []
    out = []
    for text in texts:
        counts = words_of(text)
        if not counts or not model.languages:
            out.append((UNDETERMINED, 0.0))
            continue
        total = np.zeros(len(model.languages))
        known, times = [], []
        for word, n in counts.items():
            at = words.get(word)
            if at is not None:
                known.append(at), times.append(n)
                continue
            at = extra.get(word)
            if at is None:
                if len(more) >= REMEMBERED:
                    extra, more = {}, []
                at = extra[word] = len(more)
                more.append(model.unseen(word))
            total += n * more[at]
        if known:
            total += np.asarray(times) @ rows[known]
        share = np.exp(total - total.max())
        best = int(total.argmax())
        out.append((model.languages[best], float(share[best] / share.sum())))
    return pd.DataFrame(out, columns=["lang_pred", "score"])


def language_sample(usable: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows of every language, all of a rarer one; repeated rows count once in a sample.

    The shares follow from the counts per language (a model has a column for
    each, so they are few and may be broadcast).
    """
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"))
    known = usable.join(F.broadcast(counts), "lang")
    few = known.filter(F.col("n") <= rows)
    some = known.filter((F.col("n") > rows) & drawn(F.lit(float(rows)) / F.col("n"), "doc_id", "text"))
    return few.unionByName(some.dropDuplicates(["lang", "doc_id", "text"])).drop("n")


def fit_model(docs: DataFrame, rows: int = LANGUAGE_ROWS) -> Model:
    """Log frequencies per language from at most about ``rows`` documents of each, outside the held-out fold.

    Documents with a null language or text teach nothing. Tasks count words
    and n-grams of their batches; sums of the known ones (bounded by the
    sample) reach the driver.
    """
    usable = docs.select("doc_id", "text", "lang").filter("lang is not null and text is not null").filter(
        fold("doc_id", FOLDS) != HELD_OUT
    )

    def count(batches):
        for batch in batches:
            sums: dict[tuple, int] = {}
            for lang, texts in batch.groupby("lang")["text"]:
                words: Counter = Counter()
                for t in texts:
                    words.update(words_of(t))
                for word, times in words.items():
                    sums[(lang, 0, word)] = times
                    for n in range(1, LONGEST_GRAM + 1):
                        for g in grams(word, n):
                            sums[(lang, n, g)] = sums.get((lang, n, g), 0) + times
            yield pd.DataFrame([(*k, v) for k, v in sums.items()], columns=["lang", "n", "unit", "times"])

    counted = (
        language_sample(usable, rows).select("text", "lang")
        .mapInPandas(count, "lang string, n int, unit string, times long")
        .groupBy("lang", "n", "unit").agg(F.sum("times").alias("times"))
    )
    least = F.when(F.col("n") == 0, LEAST_WORDS).otherwise(LEAST_GRAMS)
    sums = counted.filter(F.col("times") >= least).toPandas()
    languages = sorted(sums["lang"].unique())
    tables: list[dict[str, int]] = []
    logs = []
    at = 0
    for n in range(LONGEST_GRAM + 1):
        table = sums[sums["n"] == n].pivot_table(index="unit", columns="lang", values="times", fill_value=0)
        table = table.reindex(columns=languages, fill_value=0)
        counts = table.to_numpy(float).reshape(len(table), len(languages)) + SMOOTHING
        logs.append(np.log(counts / counts.sum(0)) if len(table) else counts)
        tables.append({u: at + i for i, u in enumerate(table.index)})
        at += len(table)
    return Model(languages, tables[0], dict(enumerate(tables[1:], 1)), np.concatenate(logs))


def with_language(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct (lang_pred, score) for every whole text in column ``into``.

    All columns are kept; one named ``into`` is replaced. A text that is null
    or has no letter is ``und`` with score 0; so is every text if the model
    has no language. The least name wins a tie. No shuffle.
    """
    parts = (model.languages, model.words, model.grams, model.logs)
    sent = docs.sparkSession.sparkContext.broadcast(parts)  # plain containers: workers need not import this package

    @F.pandas_udf("lang_pred string, score double")
    def language(texts: pd.Series) -> pd.DataFrame:
        return predict(Model(*sent.value), texts)

    return docs.withColumn(into, language(F.col(text)))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``."""
    model = fit_model(docs)
    return with_language(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "language.lang_pred", "language.score"
    )
