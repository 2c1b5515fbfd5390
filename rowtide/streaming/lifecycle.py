"""Start-up signal, waiting, stopping and progress of streaming queries."""

from __future__ import annotations

import time
from collections.abc import Iterable, Iterator
from contextlib import ExitStack, contextmanager
from threading import Condition

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryListener,
    StreamingQueryProgress,
)
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from rowtide.errors import StreamNotReady

# Where a batch began and ended in each of its sources, in the source's own notation.
SOURCE_SCHEMA = StructType(
    [StructField(c, StringType()) for c in ("description", "start_offset", "end_offset", "latest_offset")]
)
PROGRESS_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("run_id", StringType()),
        StructField("name", StringType()),
        StructField("timestamp", StringType()),
        StructField("batch_id", LongType()),
        StructField("num_input_rows", LongType()),
        StructField("input_rows_per_second", DoubleType()),
        StructField("processed_rows_per_second", DoubleType()),
        StructField("sources", ArrayType(SOURCE_SCHEMA)),
    ]
)


def wait_until_ready(queries: Iterable[StreamingQuery], timeout: float | None = None, pause: float = 0.05) -> None:
    """Return once the start position of every query is fixed.

    A query that was merely started may not have read its position yet; records
    written before it does would be lost with a ``latest`` start. The position
    is fixed when the first batch is planned, however long that batch then
    takes, or when a query without input has reported that. ``timeout`` is in
    seconds; by default there is none.
    """
    deadline = None if timeout is None else time.monotonic() + timeout
    for query in queries:
        while query.lastProgress is None and not query.status["isDataAvailable"]:
            if not query.isActive:
                query.awaitTermination()  # raises the query's own error
                break
            if deadline is not None and time.monotonic() > deadline:
                raise StreamNotReady(f"no start position of {query.name} in {timeout} s")
            time.sleep(pause)


def await_any(spark: SparkSession, timeout: float | None = None) -> None:
    """Block until one of the session's queries stops or fails; a failure is raised.

    A query that ended earlier counts too, until ``spark.streams.resetTerminated()``.
    """
    if timeout is None:
        spark.streams.awaitAnyTermination()
    else:
        spark.streams.awaitAnyTermination(int(timeout))


def finish(queries: Iterable[StreamingQuery]) -> None:
    """Wait for bounded queries to end; the first failure is raised."""
    for query in queries:
        query.awaitTermination()


@contextmanager
def stopping(queries: list[StreamingQuery]) -> Iterator[list[StreamingQuery]]:
    """Stop the queries on leaving, also after an error or an interrupt."""
    with ExitStack() as stack:
        for query in queries:
            stack.callback(query.stop)
        yield queries


def drain(queries: Iterable[StreamingQuery], timeout: float | None = None, pause: float = 0.05) -> None:
    """Stop the queries, each once the batch it is in the middle of is committed.

    A query between two batches stops at once. ``timeout`` in seconds is for all
    of them together; what still runs then is stopped in its batch, which the
    next start does again.
    """
    waiting = {query: _last_batch(query) for query in queries}
    deadline = None if timeout is None else time.monotonic() + timeout
    while waiting:
        for query, before in list(waiting.items()):
            late = deadline is not None and time.monotonic() > deadline
            # A report comes after the commit of its batch.
            done = not query.isActive or not query.status["isTriggerActive"] or _last_batch(query) != before
            if done or late:
                query.stop()
                del waiting[query]
        if waiting:
            time.sleep(pause)


def _last_batch(query: StreamingQuery) -> tuple[int, str] | None:
    report = query.lastProgress
    return None if report is None else (report.batchId, report.timestamp)


@contextmanager
def draining(queries: list[StreamingQuery], timeout: float | None = None) -> Iterator[list[StreamingQuery]]:
    """Like ``stopping``, but on leaving by itself or by an interrupt the running batches are committed first.

    After any other error the queries are stopped at once.
    """
    with stopping(queries):
        try:
            yield queries
        except KeyboardInterrupt:
            drain(queries, timeout)
            raise
        drain(queries, timeout)


class ProgressLog(StreamingQueryListener):
    """Every progress report of the session's queries, appended to a Parquet table.

    A query itself keeps about its last 100 reports. This listener gets each of
    them and writes them out in parts of ``part``, so what the driver holds
    stays small however long the queries run.
    """

    def __init__(self, spark: SparkSession, path: str, part: int = 500):
        self.spark, self.path, self.part = spark, path, part
        self.waiting: list[tuple] = []
        self.ended: set[str] = set()
        self.changed = Condition()

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        with self.changed:
            self.waiting.append(report_row(event.progress))
            if len(self.waiting) >= self.part:
                self._write()

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def _write(self) -> None:
        if self.waiting:
            self.spark.createDataFrame(self.waiting, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
            self.waiting = []

    def frame(self, queries: Iterable[StreamingQuery] = (), timeout: float = 60.0) -> DataFrame:
        """All reports so far, one row per micro-batch.

        Of the ``queries`` that have ended, the last report is waited for: it
        comes before the message that the query ended.
        """
        over = {str(q.runId) for q in queries if not q.isActive}
        with self.changed:
            if not self.changed.wait_for(lambda: over <= self.ended, timeout):
                raise StreamNotReady(f"no end message of {sorted(over - self.ended)} in {timeout} s")
            # Without a report there still is a table to read.
            rows = self.waiting
            self.waiting = []
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.path)


@contextmanager
def logging_progress(spark: SparkSession, path: str) -> Iterator[ProgressLog]:
    """A progress log that listens until the block ends."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)


def report_row(p: StreamingQueryProgress) -> tuple:
    return (
        str(p.id),
        str(p.runId),
        p.name,
        p.timestamp,
        p.batchId,
        p.numInputRows,
        float(p.inputRowsPerSecond),
        float(p.processedRowsPerSecond),
        [(s.description, s.startOffset, s.endOffset, s.latestOffset) for s in p.sources],
    )
