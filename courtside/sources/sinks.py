"""Table sinks that a rerun cannot double: whole partitions, and appends keyed by their batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

#: Rows that a file holds at most.
ROWS_PER_FILE = 5_000_000


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> None:
    """Replace the partitions that ``df`` has rows of and leave the others as they are.

    Rows are brought together by partition first, so that a partition has few files; a large partition
    is spread over tasks by its size. An empty ``df`` changes nothing.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def append_batch(df: DataFrame, path: str, batch: int, key: str = "batch_id", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Add ``df`` to the table as batch number ``batch``; the same batch written again replaces itself.

    The number is a column ``key`` of the table that is read back; one of that name in ``df`` is left out.
    """
    writer = df.drop(key).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    writer.parquet(f"{path.rstrip('/')}/{key}={batch}")
