"""The change log as readable messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rowtide.operators.decode import render_messages
from rowtide.sources.kafka import subscribe
from rowtide.streaming.sink import DEFAULT_TRIGGER


def messages(records: DataFrame, topics: Sequence[str], *, stamp: bool = True) -> DataFrame:
    """One message per record of the listed topics, in a ``message`` column."""
    return render_messages(subscribe(records, topics), stamp)


def start_printing_monitor(records: DataFrame, topics: Sequence[str], checkpoint: str, *, trigger: str = DEFAULT_TRIGGER) -> StreamingQuery:
    """Print every message of every micro-batch, line breaks and all.

    The driver holds the messages of one partition at a time. For more than a
    person reads, ``start_text_monitor`` lets the executors write them.
    """

    def show(batch: DataFrame, _: int) -> None:
        for row in batch.toLocalIterator():
            print(row["message"], flush=True)

    return (
        messages(records, topics)
        .select("message")
        .writeStream.foreachBatch(show)
        .queryName("monitor")
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=trigger)
        .start()
    )


def start_text_monitor(
    records: DataFrame,
    topics: Sequence[str],
    path: str,
    checkpoint: str,
    *,
    trigger: str = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """Append the messages to text files; resumes from its checkpoint."""
    return (
        messages(records, topics)
        .select("message")
        .writeStream.format("text")
        .outputMode("append")
        .queryName("monitor")
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=trigger)
        .start(path)
    )
