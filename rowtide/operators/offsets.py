"""Offsets a log should have and has not."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PLACE = ["topic", "partition"]
SPAN = 1_000_000


def lost_ranges(log: DataFrame, since: Mapping[str, Mapping[int, int]] | None = None, *, span: int = SPAN) -> DataFrame:
    """topic, partition, first, last, lost: every stretch of offsets missing between two of the same topic partition.

    ``since`` names the offset a partition should begin with, such as the
    position a reader had committed; what is missing before the first offset
    that is there counts as well. Repeated offsets are no matter. Rows without a
    topic, a partition or an offset are left out.

    Offsets are looked at in ranges of ``span``, so no task sorts more than that
    of one partition. Gaps inside a range come from its neighbours in order, gaps
    between ranges from their lowest and highest offsets, one row for a range.
    """
    known = log.select(*PLACE, "offset").where(F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull())
    ranged = known.withColumn("_range", F.floor(F.col("offset") / F.lit(span)))
    within = Window.partitionBy(*PLACE, "_range").orderBy("offset")
    inside = ranged.select(*PLACE, F.lag("offset").over(within).alias("_before"), F.col("offset").alias("_after"))

    edges = ranged.groupBy(*PLACE, "_range").agg(F.min("offset").alias("_after"), F.max("offset").alias("_highest"))
    previous = F.lag("_highest").over(Window.partitionBy(*PLACE).orderBy("_range"))
    starts = [(t, p, o) for t, parts in (since or {}).items() for p, o in parts.items()]
    expected = log.sparkSession.createDataFrame(starts, "topic string, partition int, _since long")
    between = edges.withColumn("_before", previous).join(expected, PLACE, "left")
    between = between.select(*PLACE, F.coalesce("_before", F.col("_since") - 1).alias("_before"), "_after")

    gaps = inside.unionByName(between).where(F.col("_after") - F.col("_before") > 1)
    return gaps.select(
        *PLACE,
        (F.col("_before") + 1).alias("first"),
        (F.col("_after") - 1).alias("last"),
        (F.col("_after") - F.col("_before") - 1).alias("lost"),
    )
