"""Before-images from a log that has only the rows after each change."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.errors import SchemaError
from rowtide.functions import records as rec
from rowtide.functions.typed import cols, quoted
from rowtide.operators.replay import gone
from rowtide.specs import TableSpec

SPAN = 1_000_000


def before_images(rows: DataFrame, spec: TableSpec, order: str, *, span: int = SPAN) -> DataFrame:
    """Envelopes (``op``, ``before``, ``after``, and the order column) from flattened log rows.

    ``before`` is the row the same key had by the change before, NULL for its
    first one and behind a delete; ``after`` is NULL for a delete. ``op`` is the
    row's ``__op`` where it has one, else what the images say.

    ``order`` names a long column without NULLs that no two changes of a key
    share, such as the offset. A key's changes are cut into ranges of ``span``
    order values, so no task sorts more than ``span`` changes of a key, however
    many it has. The last image of each range, one row found by a map-side
    aggregation, is carried into the key's next range.
    """
    if not spec.key:
        raise SchemaError(f"{spec.name}: images need a key")
    marked = gone(rows.columns)
    # Images travel in a struct of their own, so that an absent one is told from none at all.
    log = rows.select(
        *[F.col(quoted(k)).alias(f"_k{i}") for i, k in enumerate(spec.key)],
        F.col(quoted(order)).cast("long").alias("_order"),
        F.floor(F.col(quoted(order)) / F.lit(span)).alias("_range"),
        (F.col(rec.OP) if rec.OP in rows.columns else F.lit(None).cast("string")).alias("op"),
        F.struct(F.when(~marked, F.struct(*cols(spec.columns))).alias("row")).alias("_image"),
    )
    key = [f"_k{i}" for i in range(len(spec.key))]
    lasts = log.groupBy(*key, "_range").agg(F.max_by("_image", "_order").alias("_last"))
    earlier = F.lag("_last").over(Window.partitionBy(*key).orderBy("_range"))
    carried = lasts.select(*key, "_range", earlier.alias("_image")).where(F.col("_image").isNotNull())
    carried = carried.withColumns({"_order": F.lit(None).cast("long"), "op": F.lit(None).cast("string")})
    # What is carried has no order and comes first.
    within = Window.partitionBy(*key, "_range").orderBy(F.col("_order").asc_nulls_first())
    known = log.unionByName(carried).withColumn("before", F.lag("_image").over(within)["row"])
    after = F.col("_image.row")
    found = F.when(after.isNull(), "d").when(F.col("before").isNull(), "c").otherwise("u")
    return known.where(F.col("_order").isNotNull()).select(
        F.coalesce("op", found).alias("op"), "before", after.alias("after"), F.col("_order").alias(order)
    )
