"""Append-only lake sink: one path and one checkpoint per table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

AVAILABLE_NOW = "available_now"
# Fixed value: the interval between two micro-batches.
DEFAULT_TRIGGER = "10 seconds"


def lake_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def checkpoint_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/.checkpoints/{table}"


def append_to_lake(
    rows: DataFrame,
    root: str,
    table: str,
    *,
    trigger: str = DEFAULT_TRIGGER,
    file_format: str = "parquet",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Start a query that appends the rows to the table's path.

    With the file sink every input record is written once across restarts, as
    long as readers open the table's path and not single files below it.
    ``trigger`` is an interval, or ``available_now`` to take what is there and
    stop.
    """
    writer = (
        rows.writeStream.format(file_format)
        .outputMode("append")
        .queryName(table)
        .option("path", lake_path(root, table))
        .option("checkpointLocation", checkpoint_path(root, table))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return triggered(writer, trigger).start()


def triggered(writer: DataStreamWriter, trigger: str) -> DataStreamWriter:
    """The writer with its trigger: an interval, or ``available_now``."""
    return writer.trigger(availableNow=True) if trigger == AVAILABLE_NOW else writer.trigger(processingTime=trigger)
