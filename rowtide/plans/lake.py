"""Topic-to-lake jobs: one independent stream per table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowtide.operators.decode import PERMISSIVE, decode, quarantine
from rowtide.operators.encode import KAFKA_SCHEMA
from rowtide.sources.kafka import subscribe
from rowtide.specs import TableSpec, topic_of
from rowtide.streaming.batches import BATCH, read_batches, write_batch
from rowtide.streaming.sink import DEFAULT_TRIGGER, append_to_lake, checkpoint_path, lake_path, triggered

DAY = "kafka_date"
QUARANTINE = "quarantine"
MALFORMED_SUFFIX = "_malformed"


def start_table_job(
    records: DataFrame,
    spec: TableSpec,
    root: str,
    *,
    trigger: str = DEFAULT_TRIGGER,
    coerce: bool = False,
    keep_meta: bool = False,
    keep_source: bool = False,
    on_malformed: str = PERMISSIVE,
    by_day: bool = False,
) -> StreamingQuery:
    """Decode one table's record stream and append it to the lake.

    ``keep_source`` keeps key, topic, partition and offset, without which the
    table cannot be replayed.

    ``by_day`` adds the broker date as a partition column, so that readers of a
    time range open only its files.
    """
    rows = decode(records, spec, coerce=coerce, keep_meta=keep_meta, keep_source=keep_source, on_malformed=on_malformed)
    rows, days = dated(rows, by_day)
    return append_to_lake(rows, root, spec.name, trigger=trigger, partition_by=days)


def dated(rows: DataFrame, by_day: bool) -> tuple[DataFrame, Sequence[str]]:
    """The rows, with their broker date if that is to be a partition column, and the partition columns."""
    return (rows.withColumn(DAY, F.to_date("kafka_timestamp")), (DAY,)) if by_day else (rows, ())


def start_split_job(
    records: DataFrame,
    spec: TableSpec,
    root: str,
    *,
    trigger: str = DEFAULT_TRIGGER,
    coerce: bool = False,
    keep_meta: bool = False,
    keep_source: bool = False,
    by_day: bool = False,
) -> StreamingQuery:
    """Decode one table's record stream, and set its malformed records apart as they came, in one read of the topic.

    Each micro-batch is kept while its two outputs are written, to a folder with
    the batch's number below the table's path and below the path beside it for
    malformed records. A batch run again after a failure replaces what it had not
    committed and leaves alone what it had, so no record is lost or there twice;
    ``split_rows`` and ``split_malformed`` read what is committed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            good, broken = quarantine(kept)
            rows, days = dated(decode(good, spec, coerce=coerce, keep_meta=keep_meta, keep_source=keep_source), by_day)
            write_batch(rows, lake_path(root, spec.name), batch_id, days)
            write_batch(broken, malformed_path(root, spec), batch_id)
        finally:
            kept.unpersist()

    name = f"{spec.name}_split"
    writer = records.writeStream.foreachBatch(write).queryName(name).option("checkpointLocation", checkpoint_path(root, name))
    return triggered(writer, trigger).start()


def malformed_path(root: str, spec: TableSpec) -> str:
    return lake_path(root, f"{spec.name}{MALFORMED_SUFFIX}")


def split_rows(spark: SparkSession, root: str, spec: TableSpec, *, by_day: bool = False, **options: bool) -> DataFrame:
    """The decoded rows of all committed batches with their ``batch``; options as given to ``start_split_job``."""
    rows, _ = dated(decode(spark.createDataFrame([], KAFKA_SCHEMA), spec, **options), by_day)
    return read_batches(spark, lake_path(root, spec.name), rows.schema)


def split_malformed(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The malformed records of all committed batches, as they came, with their ``batch``."""
    return read_batches(spark, malformed_path(root, spec), KAFKA_SCHEMA)


def split_offsets(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """batch, topic, partition, offset of every record taken by a ``start_split_job`` that keeps the source."""
    rows = split_rows(spark, root, spec, keep_source=True)
    place = ("topic", "partition", "offset")
    good = rows.select(BATCH, *[F.col(f"kafka_{c}").alias(c) for c in place])
    return good.unionAll(split_malformed(spark, root, spec).select(BATCH, *place))


def start_all(
    source: Callable[[str], DataFrame],
    specs: Iterable[TableSpec],
    root: str,
    *,
    topic: Callable[[str], str] = topic_of,
    **options,
) -> list[StreamingQuery]:
    """Start one job per table. ``source(topic)`` gives that topic's record stream.

    With Kafka each job subscribes to its own topic; over a stored log the
    records are narrowed to the topic before anything is decoded. With
    ``on_malformed="quarantine"`` the jobs are those of ``start_split_job``. Each job runs
    in a scheduler pool of its own, so that under fair scheduling a large batch
    of one table does not hold up the others. If a job cannot be started, the
    ones before it are stopped.
    """
    jobs = []
    with ExitStack() as started:
        for spec in specs:
            name = topic(spec.name)
            records = subscribe(source(name), [name])
            with scheduler_pool(records, spec.name):
                if options.get("on_malformed") == QUARANTINE:
                    chosen = {k: v for k, v in options.items() if k != "on_malformed"}
                    jobs.append(start_split_job(records, spec, root, **chosen))
                else:
                    jobs.append(start_table_job(records, spec, root, **options))
                started.callback(jobs[-1].stop)
        started.pop_all()
    return jobs


@contextmanager
def scheduler_pool(df: DataFrame, name: str) -> Iterator[None]:
    """Work started inside belongs to the named scheduler pool."""
    context = df.sparkSession.sparkContext
    context.setLocalProperty("spark.scheduler.pool", name)
    try:
        yield
    finally:
        context.setLocalProperty("spark.scheduler.pool", None)
