"""Append-only run ledger."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderspark import schemas

RUNNING, SUCCEEDED, FAILED = "running", "succeeded", "failed"


def record(spark: SparkSession, path: str, run_id: str, source: str, status: str,
           row_count: int = 0, notes: dict[str, object] | None = None) -> None:
    """Append one ledger row. Rows are never updated."""
    row = [(run_id, source, status, row_count, json.dumps(notes or {}))]
    (
        spark.createDataFrame(row, "run_id string, source string, status string, row_count bigint, notes string")
        .withColumn("event_at", F.current_timestamp())
        .coalesce(1).write.mode("append").parquet(path)
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RUN_LEDGER).parquet(path)


def run_logged(spark: SparkSession, path: str, source: str, job: Callable[[], int],
               notes: dict[str, object] | None = None) -> int:
    """Run ``job`` (returns its row count) between a start and a finish row.

    A failure is recorded with its message and raised again.
    """
    run_id = str(uuid.uuid4())
    record(spark, path, run_id, source, RUNNING, 0, notes)
    try:
        rows = job()
    except Exception as error:
        record(spark, path, run_id, source, FAILED, 0, {"error": str(error)})
        raise
    record(spark, path, run_id, source, SUCCEEDED, rows, {"rows": rows})
    return rows


def latest_runs(ledger: DataFrame, tie_break: str | None = None) -> DataFrame:
    """One row per run: newest status, row count and notes, start and finish."""
    order = F.struct("event_at", tie_break) if tie_break else F.col("event_at")
    newest = F.max_by(F.struct("status", "row_count", "notes", "event_at"), order)
    rows = ledger.groupBy("run_id", "source").agg(
        newest.alias("newest"), F.min("event_at").alias("started_at")
    )
    return rows.select(
        "run_id", "source", "newest.status", "newest.row_count", "newest.notes", "started_at",
        F.when(F.col("newest.status") != RUNNING, F.col("newest.event_at")).alias("finished_at"),
    )
