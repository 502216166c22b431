"""Incremental forms of the upsert and of the embedding resume.

Both give the result of the batch operator. Neither keeps streaming state: the
table itself is the state, so a replayed batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from larderspark.operators import embedding
from larderspark.operators.dedup import keep_first
from larderspark.operators.upsert import last_wins
from larderspark.sources import tables


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files of a folder, as a stream."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


def files_of_batch(spark: SparkSession, path: str, schema: T.StructType, batches: int = 3) -> int:
    """Files per micro-batch that take what lies in a folder in at most ``batches``: each of them reads the table again."""
    return max(1, -(-len(spark.read.schema(schema).parquet(path).inputFiles()) // batches))


def upsert_stream(changes: DataFrame, table: str, keys: Sequence[str], order: Sequence[Column | str],
                  checkpoint: str) -> StreamingQuery:
    """Upsert every micro-batch into a keyed table until the input is read.

    ``order`` puts the winner of equal keys in a batch first. A batch rewrites
    the buckets of its keys only; processing it twice writes the same rows again.
    """
    def apply(batch: DataFrame, _: int) -> None:
        tables.apply(last_wins(batch, keys, order), table, keys)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def embed_stream(documents: DataFrame, key: str, text_column: str, out: str, checkpoint: str,
                 max_chars: int = embedding.DOCUMENT_CHARS,
                 make_encoder: Callable[[], embedding.Encoder] | None = None) -> StreamingQuery:
    """Embed documents not embedded yet and append them, batch by batch.

    Each batch goes to its own folder, written in overwrite mode: a batch that
    is retried after a failure replaces its files instead of adding them again.
    """
    schema = T.StructType([
        T.StructField(key, documents.schema[key].dataType),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ])

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        target = f"{out}/batch={number}"
        done = read_embedded(spark, out, schema)
        earlier = done.filter(F.col("batch") < number)
        todo = embedding.remaining(keep_first(batch, [key], [F.desc_nulls_last(text_column)]), earlier, key)
        new = embedding.embed_documents(todo, key, text_column, max_chars, make_encoder)
        new.filter(F.col("embedding").isNotNull()).select(*schema.names).write.mode("overwrite").parquet(target)

    return (
        documents.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_embedded(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """All embedded rows with the number of the batch that wrote them."""
    from larderspark.sources.readers import read_optional

    full = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])
    return read_optional(spark, out, full).select(*full.names)
