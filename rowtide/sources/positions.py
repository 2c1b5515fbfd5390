"""A stored log read in batches, with the reader's positions committed together with the rows they belong to."""

from __future__ import annotations

import uuid
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rowtide.operators.encode import KAFKA_SCHEMA
from rowtide.sources.commits import last_commit, put_commit, read_commit, read_commits, read_or_empty
from rowtide.sources.kafka import LATEST_CODE, Offsets, from_offsets

COMMITS, ROWS, PART = "_commits", "rows", "part"
RUN = "run"


def committed_positions(spark: SparkSession, root: str) -> Offsets | None:
    """The next offset of every topic partition, as the last run committed it; None before the first run."""
    number = last_commit(spark, f"{root}/{COMMITS}")
    return _positions(spark, root, number) if number else None


def consume(log: DataFrame, root: str, *, starting: str | Offsets = "earliest") -> bool:
    """Take what the log has beyond the committed positions; False if that is nothing or another reader was first.

    ``starting`` counts only where nothing is committed: ``earliest``, ``latest``
    (only what comes after the first run), or an offset by topic partition, the
    others from the beginning. A partition that is new after the first run is
    read from its beginning. The rows and the new positions become visible in one
    commit, so each record is taken once: a run that fails before its commit
    leaves rows that nobody reads, and the next one takes them again. Of two
    readers of one ``root`` that run side by side one commits, and the other
    takes nothing.

    The range is fixed before anything is read, by one row for each topic
    partition, so records that arrive meanwhile wait for the next run.
    """
    spark = log.sparkSession
    number = last_commit(spark, f"{root}/{COMMITS}")
    positions = {t: dict(parts) for t, parts in (_positions(spark, root, number) if number else {}).items()}
    first = number == 0
    asked = {} if isinstance(starting, str) or not first else {t: dict(p) for t, p in starting.items()}
    given = {t: {p: max(o, 0) for p, o in parts.items() if o != LATEST_CODE} for t, parts in asked.items()}
    start = {t: {**given.get(t, {}), **positions.get(t, {})} for t in {*given, *positions}}
    waiting = from_offsets(log, start) if start else log
    ends: Offsets = {}
    for r in waiting.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end")).collect():
        ends.setdefault(r.topic, {})[r.partition] = r.end
    if not ends and not (first and starting == "latest"):
        return False
    skipped = {(t, p) for t, parts in ends.items() for p in parts if first and (starting == "latest" or asked.get(t, {}).get(p) == LATEST_CODE)}
    taken = [(t, p, e) for t, parts in ends.items() for p, e in parts.items() if (t, p) not in skipped]
    part = f"{number + 1}.{uuid.uuid4().hex}"
    below = [(F.col("topic") == t) & (F.col("partition") == p) & (F.col("offset") < e) for t, p, e in taken]
    if below:
        waiting.where(reduce(or_, below)).select(*KAFKA_SCHEMA.names).write.parquet(f"{root}/{ROWS}/{PART}={part}")
    reached = {t: {**start.get(t, {}), **ends.get(t, {})} for t in {*start, *ends}}
    return put_commit(spark, f"{root}/{COMMITS}", number + 1, {PART: part, "positions": reached})


def consumed(spark: SparkSession, root: str) -> DataFrame:
    """The records of all committed runs, with the number of their ``run``."""
    commits = read_commits(spark, f"{root}/{COMMITS}", StructType([StructField("number", LongType()), StructField(PART, StringType())]))
    rows = read_or_empty(spark, f"{root}/{ROWS}", StructType([*KAFKA_SCHEMA.fields, StructField(PART, StringType())]))
    return rows.join(commits.withColumnRenamed("number", RUN), PART).select(*KAFKA_SCHEMA.names, RUN)


def _positions(spark: SparkSession, root: str, number: int) -> Offsets:
    found = read_commit(spark, f"{root}/{COMMITS}", number)["positions"]
    return {topic: {int(p): o for p, o in parts.items()} for topic, parts in found.items()}
