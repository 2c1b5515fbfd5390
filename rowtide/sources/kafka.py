"""Kafka source options, and the same positions over a stored log."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators.encode import KAFKA_SCHEMA

# The position codes of Spark's Kafka source in a JSON offset map.
LATEST_CODE = -1
EARLIEST_CODE = -2

Offsets = Mapping[str, Mapping[int, int]]


def kafka_options(
    servers: str,
    topics: Sequence[str],
    *,
    starting: str | Offsets = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of ``format("kafka")`` for one or several topics.

    ``starting`` counts only for a new checkpoint; a restarted query goes on
    where it stopped. The default reads a topic from its beginning, so nothing
    written before the first batch is missed. ``max_offsets_per_trigger`` bounds
    a batch, and ``min_partitions`` lets several tasks share one large topic
    partition.
    """
    if not topics:
        raise ValueError("no topics")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting if isinstance(starting, str) else offsets_json(starting),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def offsets_json(starts: Offsets) -> str:
    return json.dumps({topic: {str(p): o for p, o in parts.items()} for topic, parts in starts.items()})


def kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A stream of records; needs the Kafka connector package."""
    return spark.readStream.format("kafka").options(**options).load()


def append_log(records: DataFrame, path: str) -> None:
    """Append records to a stored log, one folder per topic, so that a reader opens only its topics."""
    records.write.mode("append").partitionBy("topic").parquet(path)


def stored_stream(
    spark: SparkSession,
    path: str,
    *,
    max_files_per_trigger: int | None = None,
    ignore_missing_files: bool = False,
) -> DataFrame:
    """A stream over a stored log; new files are new records."""
    reader = spark.readStream.schema(KAFKA_SCHEMA).option("ignoreMissingFiles", str(ignore_missing_files).lower())
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path).select(*KAFKA_SCHEMA.names)


def subscribe(log: DataFrame, topics: Sequence[str]) -> DataFrame:
    """The records of the listed topics."""
    return log.where(F.col("topic").isin(list(topics)))


def from_offsets(log: DataFrame, starts: Offsets, *, others: str = "earliest") -> DataFrame:
    """A stored log from given positions on, per topic partition.

    Partitions without a start are read from the beginning, or not at all with
    ``others="latest"``. The condition is on plain columns, so the Parquet scan
    skips row groups below the positions.
    """
    if others not in ("earliest", "latest"):
        raise ValueError(f"others: {others!r}")
    wanted: Column = F.lit(False)
    named: Column = F.lit(False)
    for topic, parts in starts.items():
        for partition, offset in parts.items():
            here = (F.col("topic") == topic) & (F.col("partition") == partition)
            named = named | here
            if offset == LATEST_CODE:
                continue
            wanted = wanted | (here if offset == EARLIEST_CODE else here & (F.col("offset") >= offset))
    return log.where(wanted if others == "latest" else wanted | ~named)
