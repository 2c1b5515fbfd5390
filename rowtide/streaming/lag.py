"""How far a stream has come: positions by topic partition and batch, set against the ends of the log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.streaming.batches import BATCH

PLACE = ["topic", "partition"]
# The layout of a position in the reports of a stream that reads topics.
OFFSETS = "map<string,map<string,bigint>>"


def batch_positions(taken: DataFrame) -> DataFrame:
    """batch, topic, partition, start, end of the offsets that each batch took, the end exclusive."""
    return taken.groupBy(BATCH, *PLACE).agg(F.min("offset").alias("start"), (F.max("offset") + 1).alias("end"))


def reported_positions(reports: DataFrame) -> DataFrame:
    """The same from progress reports of streams that read topics, with the query's run, its name and the ``latest`` end then known.

    Sources that report no offsets by partition, such as files, give no rows.
    """
    sources = reports.select("run_id", "name", F.col("batch_id").alias(BATCH), F.explode("sources").alias("source"))
    parsed = sources.select(
        "run_id",
        "name",
        BATCH,
        *[F.from_json(f"source.{field}", OFFSETS).alias(field) for field in ("start_offset", "end_offset", "latest_offset")],
    )
    topics = parsed.select("*", F.explode("end_offset").alias("topic", "ends"))
    places = topics.select("*", F.explode("ends").alias("place", "end"))

    def offset(field: str):
        return F.try_element_at(F.try_element_at(F.col(field), F.col("topic")), F.col("place"))

    # A partition that is new in a batch is read from its beginning.
    start, known = F.coalesce(offset("start_offset"), F.lit(0).cast("long")), offset("latest_offset")
    return places.select("run_id", "name", BATCH, "topic", F.col("place").cast("int").alias("partition"), start.alias("start"), "end", known.alias("latest"))


def log_ends(log: DataFrame) -> DataFrame:
    """topic, partition, log_end of a stored log, the end exclusive."""
    return log.groupBy(*PLACE).agg((F.max("offset") + 1).alias("log_end"))


def lag(positions: DataFrame, ends: DataFrame) -> DataFrame:
    """batch, topic, partition, position, lag: after each batch, the offsets that were still to come in each partition.

    Every partition has a row for every batch from the first to the last, also
    where a batch took nothing of it: then its position is the one before.
    Before anything of a partition was taken its position is null, and the lag
    counts from offset 0. The input has one row per batch and partition, so the
    result is as small as the progress reports.
    """
    first, last = positions.agg(F.min(BATCH), F.max(BATCH)).first()
    batches = F.array().cast("array<bigint>") if first is None else F.sequence(F.lit(first), F.lit(last))
    grid = ends.select(*PLACE, "log_end", F.explode(batches).alias(BATCH))
    known = grid.join(positions.select(BATCH, *PLACE, "end"), [BATCH, *PLACE], "left")
    so_far = Window.partitionBy(*PLACE).orderBy(BATCH).rowsBetween(Window.unboundedPreceding, 0)
    position = F.max("end").over(so_far)
    return known.select(BATCH, *PLACE, "log_end", position.alias("position")).select(
        BATCH, *PLACE, "position", (F.col("log_end") - F.coalesce("position", F.lit(0))).alias("lag")
    )
