"""Keyed inserts: typing, primary-key checks, accepted and rejected rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions.typed import bad_columns, cols, quoted, typed_columns
from rowtide.session import stored
from rowtide.specs import TableSpec

REASON = "reject_reason"
BAD_TYPE = "bad_type"
NULL_KEY = "null_key"
KEY_EXISTS = "key_exists"
REPEATED = "repeated_in_batch"
AMBIGUOUS = "ambiguous_arrival"


def key_clashes(df: DataFrame, key: Sequence[str], count: str = "copies") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*cols(key)).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)


def classify_types(incoming: DataFrame, spec: TableSpec, carry: Sequence[str] = ()) -> DataFrame:
    """Text rows plus ``bad_columns`` and ``reject_reason`` (bad type, NULL key or NULL).

    The text is left as it came, so that a rejected row can be looked at.
    """
    flagged = incoming.select(*cols(spec.columns), *cols(carry), bad_columns(spec.schema).alias("bad_columns"))
    reason = F.when(F.size("bad_columns") > 0, BAD_TYPE).when(_no_key(spec.key), NULL_KEY)
    return flagged.withColumn(REASON, reason)


def classify_keys(
    existing: DataFrame,
    incoming: DataFrame,
    spec: TableSpec,
    arrival: Sequence[str] = (),
    given: str | None = None,
) -> DataFrame:
    """Typed incoming rows plus ``reject_reason``: NULL for the rows an insert would accept.

    ``given`` names a column of ``incoming`` with the reasons found before; such
    a row keeps its reason, and its key counts for nothing.

    A key that the table already holds is rejected. Among rows of the batch with
    the same key the first in ``arrival`` order is accepted, as if the rows were
    inserted one by one; without ``arrival`` no row is the first, so all of them
    are rejected. Rows that tie for first place are all rejected as ambiguous.

    Runs two jobs at once. The first groups the batch's key and arrival columns.
    The second scans the table for its key columns, without a shuffle while the
    batch's keys are few enough to be broadcast, and gives the keys something is
    wrong with. Both results are stored in the shared work folder. The returned
    frame joins the batch with the second: few keys are broadcast, many are
    joined by a shuffle in which a partition with a hot key is split between
    tasks. So the batch is read twice, whatever is wrong with its rows.
    """
    key = list(spec.key)
    before = F.col(given) if given else F.lit(None).cast("string")
    shown = [c for c in incoming.columns if c != given]
    if not key:
        return incoming.select(*cols(shown), before.alias(REASON))
    keyed = incoming.where(~_no_key(key) & before.isNull())

    batch = stored(_batch_keys(keyed, key, list(arrival)), "batch-keys")
    verdicts = batch.join(_known(existing, batch, key), key, "left").withColumn("_exists", F.col("_known").isNotNull())
    problems = stored(verdicts.where(F.col("_exists") | (F.col("_rows") > 1)), "problem-keys")

    first = F.lit(True)
    for column in arrival:
        first = first & F.col(quoted(column)).eqNullSafe(F.col(f"_first.{quoted(column)}"))
    reason = (
        F.when(before.isNotNull(), before)
        .when(_no_key(key), NULL_KEY)
        .when(F.col("_exists"), KEY_EXISTS)
        .when((F.col("_rows") > 1) & ~first, REPEATED)
        .when(F.col("_first_rows") > 1, AMBIGUOUS if arrival else REPEATED)
    )
    # A NULL key matches nothing, and stays.
    return incoming.join(problems, key, "left").select(*cols(shown), reason.alias(REASON))


def insertable(
    existing: DataFrame,
    incoming_text: DataFrame,
    spec: TableSpec,
    arrival: Sequence[str] = (),
) -> DataFrame:
    """Text rows to typed rows plus ``reject_reason``, by type first and then by key.

    Columns of rejected rows that are not of the declared type are NULL here;
    ``classify_types`` shows their text.
    """
    flagged = classify_types(incoming_text, spec, carry=arrival)
    typed = flagged.select(*typed_columns(spec.schema), *cols(arrival), REASON)
    return classify_keys(existing, typed, spec, arrival, given=REASON)


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col(REASON).isNull()).drop(REASON)


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where(F.col(REASON).isNotNull())


def _no_key(key: Sequence[str]) -> Column:
    return reduce(or_, [c.isNull() for c in cols(key)], F.lit(False))


def _batch_keys(keyed: DataFrame, key: list[str], arrival: list[str]) -> DataFrame:
    """One row per key of the batch: first arrival, number of rows at it, rows in all."""
    if not arrival:
        counted = keyed.groupBy(*cols(key)).agg(F.count(F.lit(1)).alias("_rows"))
        return counted.withColumn("_first_rows", F.col("_rows"))
    # Copies with equal arrival are counted first, so the smallest arrival comes
    # with the number of rows that share it.
    per_arrival = keyed.groupBy(*cols(key), *cols(arrival)).agg(F.count(F.lit(1)).alias("_n"))
    smallest = F.min(F.struct(F.struct(*cols(arrival)).alias("at"), F.col("_n").alias("n")))
    batch = per_arrival.groupBy(*cols(key)).agg(smallest.alias("_min"), F.sum("_n").alias("_rows"))
    return batch.select(*cols(key), F.col("_min.at").alias("_first"), F.col("_min.n").alias("_first_rows"), "_rows")


def _known(existing: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """The keys of the batch that the table holds, marked ``_known``."""
    # The table on the left: the batch's keys are the side Spark may broadcast.
    found = existing.select(*cols(key)).join(batch.select(*cols(key)), key, "left_semi").distinct()
    return found.withColumn("_known", F.lit(True))
