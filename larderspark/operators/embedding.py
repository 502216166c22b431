"""Document and query embeddings."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderspark.functions import text, vectors
from larderspark.functions.binding import let

DOCUMENT_CHARS = 1200
QUERY_CHARS = 512
HASH_DIMENSION = 64
ERROR_SAMPLES = 5


def hashed_vector(c: Column, dimension: int = HASH_DIMENSION) -> Column:
    """Counts of hashed words: the built-in encoder that needs no model."""
    words = F.filter(F.split(text.collapse(F.lower(c)), " "), lambda w: w != "")
    buckets = F.transform(
        words, lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint") % dimension)
    positions = F.sequence(F.lit(0).cast("bigint"), F.lit(dimension - 1).cast("bigint"))
    # array_remove is one native pass per position, a lambda per word is not
    return let(buckets, lambda bs: F.transform(
        positions, lambda d: (F.size(bs) - F.size(F.array_remove(bs, d))).cast("double")))


def embed_native(df: DataFrame, id_column: str, c: Column, dimension: int = HASH_DIMENSION,
                 keep: Sequence[str] = ()) -> DataFrame:
    """id, unit-length hashed vector and a null error; no shuffle, no Python."""
    unit = let(hashed_vector(c, dimension), lambda v: vectors.scale(v, vectors.norm(v)))
    return df.select(id_column, *keep, unit.alias("embedding"),
                     F.lit(None).cast("string").alias("error"))


Encoder = Callable[[Sequence[str]], Sequence[Sequence[float]]]


def embed_with(df: DataFrame, id_column: str, c: Column, make_encoder: Callable[[], Encoder],
               batch: int = 64) -> DataFrame:
    """Embeddings from a pluggable encoder, loaded once per task.

    Texts go to the encoder in batches. When a batch fails its texts are tried
    one by one, so a failing text gets a message in ``error`` and no vector.
    """
    kind = df.schema[id_column].dataType
    schema = T.StructType([
        T.StructField(id_column, kind), T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("error", T.StringType()),
    ])

    def one_by_one(encoder: Encoder, texts: Sequence[str]) -> list[tuple]:
        out = []
        for value in texts:
            try:
                out.append((list(encoder([value])[0]), None))
            except Exception as error:  # noqa: BLE001 - recorded per text
                out.append((None, str(error) or type(error).__name__))
        return out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = make_encoder()
        for frame in frames:
            done: list[tuple] = []
            for lo in range(0, len(frame), batch):
                texts = frame["_text"].iloc[lo:lo + batch].tolist()
                try:
                    found = [(list(v), None) for v in encoder(texts)]
                    if len(found) != len(texts):
                        raise ValueError("encoder returned another number of vectors")
                except Exception:  # noqa: BLE001 - find the failing texts
                    found = one_by_one(encoder, texts)
                done.extend(found)
            yield pd.DataFrame({id_column: frame[id_column],
                                "embedding": [v for v, _ in done], "error": [e for _, e in done]})

    return df.select(id_column, c.alias("_text")).mapInPandas(run, schema)


def document_input(c: Column, max_chars: int = DOCUMENT_CHARS) -> Column:
    return text.truncate(c, max_chars)


def embed_documents(df: DataFrame, id_column: str, text_column: str, max_chars: int = DOCUMENT_CHARS,
                    make_encoder: Callable[[], Encoder] | None = None) -> DataFrame:
    """Vectors of documents by the given encoder or the built-in one."""
    value = document_input(F.col(text_column), max_chars)
    if make_encoder is None:
        return embed_native(df, id_column, value)
    return embed_with(df, id_column, value, make_encoder)


def embed_queries(queries: DataFrame, max_chars: int = QUERY_CHARS,
                  make_encoder: Callable[[], Encoder] | None = None) -> DataFrame:
    """The query table with a ``vector``; blank queries get none."""
    value = text.truncate(text.strip(F.col("query")), max_chars)
    asked = queries.filter(text.strip(F.col("query")) != "")
    done = (embed_native(asked, "query_id", value) if make_encoder is None
            else embed_with(asked, "query_id", value, make_encoder))
    return queries.join(
        done.select("query_id", F.col("embedding").alias("vector")), "query_id", "left")


def join_embeddings(documents: DataFrame, embedded: DataFrame, key: str) -> DataFrame:
    """Documents that have a vector; failed ones drop out."""
    good = embedded.filter(F.col("embedding").isNotNull()).select(key, "embedding")
    return documents.join(good, key)


def remaining(documents: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Documents not embedded yet."""
    return documents.join(done.select(key), key, "left_anti")


def resume(documents: DataFrame, done: DataFrame, key: str, text_column: str,
           max_chars: int = DOCUMENT_CHARS, make_encoder: Callable[[], Encoder] | None = None) -> DataFrame:
    """Old vectors plus those of the documents that were missing."""
    todo = remaining(documents, done, key)
    new = embed_documents(todo, key, text_column, max_chars, make_encoder)
    return done.unionByName(join_embeddings(todo.select(key), new, key).select(*done.columns))


def manifest(embedded: DataFrame, id_column: str, model: str, total: int | None = None) -> DataFrame:
    """One row: totals, failures, vector size and at most five error samples."""
    failed = F.col("error").isNotNull()
    counts = embedded.agg(
        F.count(F.lit(1)).alias("products_total"),
        F.count_if(F.col("embedding").isNotNull()).alias("products_embedded"),
        F.count_if(failed).alias("errors"),
        F.max(F.size("embedding")).alias("vector_size"),
    )
    first = embedded.filter(failed).orderBy(id_column).limit(ERROR_SAMPLES)
    samples = first.agg(F.array_sort(F.collect_list(
        F.concat_ws(": ", F.col(id_column).cast("string"), "error"))).alias("error_samples"))
    row = counts.unionByName(samples, allowMissingColumns=True)
    merged = row.agg(*[F.max(c).alias(c) for c in row.columns])
    if total is not None:
        merged = merged.withColumn("products_total", F.lit(total).cast("bigint"))
    return merged.withColumn("model", F.lit(model))
