"""Writers: CSV and keyed exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header that reads back unchanged (spaces, quotes, line breaks)."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_sorted(df: DataFrame, path: str, key: Sequence[str], mode: str = "overwrite",
                 partition_by: Sequence[str] = ()) -> None:
    """Parquet clustered by key: ranges per file, sorted inside, for min-max skipping."""
    clustered = df.repartitionByRange(*key).sortWithinPartitions(*key)
    writer = clustered.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)

