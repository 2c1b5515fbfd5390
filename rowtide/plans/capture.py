"""Table states to a change log, and the log back to a table state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.operators.changes import change_feed, flatten, snapshot_reads
from rowtide.operators.encode import to_records
from rowtide.specs import TableSpec, topic_of


def snapshot_log(df: DataFrame, spec: TableSpec, *, partitions: int = 1) -> DataFrame:
    """The initial log of a table: one ``r`` record per row, at sequence 0."""
    rows = flatten(snapshot_reads(df, spec), spec.name).withColumn("_sequence", F.lit(0))
    return to_records(rows, spec.key, topic_of(spec.name), "_sequence", tombstones=True, partitions=partitions)


def change_log(
    old: DataFrame,
    new: DataFrame,
    spec: TableSpec,
    sequence: int,
    *,
    partitions: int = 1,
    trusted_keys: bool = False,
) -> DataFrame:
    """The records that lead from one state to the next, deletes with tombstones.

    All changes of one step share a sequence, since a key changes at most once in
    it; ``sequence`` must grow from step to step.
    """
    changes = change_feed(old, new, spec, trusted_keys=trusted_keys)
    rows = flatten(changes, spec.name).withColumn("_sequence", F.lit(sequence))
    return to_records(rows, spec.key, topic_of(spec.name), "_sequence", tombstones=True, partitions=partitions)
