"""An initial snapshot taken while the table goes on changing, and its change log, as one log."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.errors import SchemaError
from rowtide.functions.typed import cols, quoted
from rowtide.operators.changes import flatten, snapshot_reads
from rowtide.session import stored
from rowtide.specs import TableSpec

Chunk = TypeVar("Chunk")
CHUNK, LOW, HIGH = "chunk", "low", "high"


def read_in_chunks(
    spark: SparkSession,
    chunks: Iterable[Chunk],
    read: Callable[[Chunk], DataFrame],
    position: Callable[[], int],
) -> tuple[DataFrame, DataFrame]:
    """The rows of a live table chunk by chunk, and the log positions before and after each chunk was read.

    ``read`` gives the rows of a chunk, such as a range of keys of a relational
    table; each chunk is read by a job of its own and stored at once. ``position``
    asks how far the table's log has come. Gives the rows with their ``chunk``
    number, and one row (chunk, low, high) per chunk.
    """
    parts, windows = [], []
    for number, chunk in enumerate(chunks):
        low = position()
        parts.append(stored(read(chunk).withColumn(CHUNK, F.lit(number)), "chunk"))
        windows.append((number, low, position()))
    if not parts:
        raise SchemaError("no chunks")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows, spark.createDataFrame(windows, f"{CHUNK} int, {LOW} long, {HIGH} long")


def cut_over(reads: DataFrame, windows: DataFrame, changes: DataFrame, spec: TableSpec, position: str) -> DataFrame:
    """Chunk reads and changes as one flattened log, ordered by ``position``; replayed, it gives the table.

    ``reads`` has the table's columns and ``chunk``, ``windows`` a row (chunk,
    low, high) per chunk, ``changes`` flattened rows with the position of each.
    A chunk was read at some time between its two positions. So it has every
    change up to ``low`` and none after ``high``, and of those in between nobody
    knows. A read whose key was changed in between is dropped, since the log has
    what came of it; any other read stands at ``high`` as an ``r`` row, behind
    the changes it has seen and before the ones it has not.

    A key is read once at most. The reads are joined with the positions of the
    changes by an inner join, in which adaptive execution splits the partition of
    a key with very many changes, and that join leaves one row per key.
    """
    if not spec.key:
        raise SchemaError(f"{spec.name}: a cut-over needs a key")
    key = list(spec.key)
    placed = reads.join(windows.select(CHUNK, F.col(LOW).alias("_low"), F.col(HIGH).alias("_high")), CHUNK)
    at = changes.select(*cols(key), F.col(quoted(position)).alias("_at"))
    met = at.join(placed.select(*cols(key), "_low", "_high"), key).where((F.col("_at") > F.col("_low")) & (F.col("_at") <= F.col("_high")))
    kept = placed.join(met.select(*cols(key)).distinct(), key, "left_anti")
    # The position travels beside the envelope, whatever the table's columns are called.
    envelopes = snapshot_reads(kept.select(*cols(spec.columns), "_high"), spec, carry=["_high"])
    rows = flatten(envelopes, spec.name, carry=["_high"]).withColumnRenamed("_high", position)
    return rows.unionByName(changes.select(*cols(rows.columns)))
