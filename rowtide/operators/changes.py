"""Row changes as envelopes (before, after, op), and their flattened form."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.errors import SchemaError
from rowtide.functions import records as rec
from rowtide.functions.typed import cols
from rowtide.specs import TableSpec


def change_feed(old: DataFrame, new: DataFrame, spec: TableSpec, *, trusted_keys: bool = False) -> DataFrame:
    """Net changes between two snapshots of a table: ``op``, ``before``, ``after``.

    Unchanged rows are dropped. A new key is ``c``, a gone key ``d``, any other
    difference ``u``; a changed key is a ``d`` and a ``c``. Both images carry
    every column. Changes that cancelled out between the snapshots cannot be
    seen.

    By default both snapshots go through one aggregation on the key, and a NULL
    or repeated key fails the job. Copies of a key are combined before the
    shuffle, so a key with very many copies is found without being gathered in
    one task. ``trusted_keys`` says that the keys are known to be unique and not
    NULL; a full join on the key then does the same without the check, somewhat
    faster, and without a shuffle if both tables are bucketed alike by the key.
    """
    if not spec.key:
        raise SchemaError(f"{spec.name}: a change feed needs a key")
    paired = _joined(old, new, spec) if trusted_keys else _aggregated(old, new, spec)
    # An absent row is a NULL struct; a row of NULLs is not.
    op = F.when(F.col("before").isNull(), "c").when(F.col("after").isNull(), "d").otherwise("u")
    return paired.where(~F.col("before").eqNullSafe(F.col("after"))).select(op.alias("op"), "before", "after")


def snapshot_reads(df: DataFrame, spec: TableSpec, carry: Sequence[str] = ()) -> DataFrame:
    """Every existing row as an envelope with operation ``r``; ``carry`` names other columns to keep."""
    after = F.struct(*cols(spec.columns))
    return df.select(
        F.lit("r").alias("op"),
        F.lit(None).cast(spec.schema).alias("before"),
        after.alias("after"),
        *cols(carry),
    )


def include_tables(envelopes: DataFrame, tables: Sequence[str], column: str = "table") -> DataFrame:
    """Keep the listed tables only."""
    return envelopes.where(F.col(column).isin(list(tables)))


def flatten(envelopes: DataFrame, table: str | Column, carry: Sequence[str] = ()) -> DataFrame:
    """Envelope to row: the new image, or the old one of a delete, plus metadata columns.

    Adds ``__op``, ``__table`` and ``__deleted`` (``'true'`` for a delete, else
    ``'false'``). ``carry`` names envelope columns to keep, such as an offset.
    """
    named = F.lit(table) if isinstance(table, str) else table
    return envelopes.select(
        F.coalesce("after", "before").alias("row"),
        F.col("op").alias(rec.OP),
        named.alias(rec.TABLE),
        F.when(F.col("op") == "d", "true").otherwise("false").alias(rec.DELETED),
        *cols(carry),
    ).select("row.*", rec.OP, rec.TABLE, rec.DELETED, *cols(carry))


def _joined(old: DataFrame, new: DataFrame, spec: TableSpec) -> DataFrame:
    row = F.struct(*cols(spec.columns))
    before = old.select(*cols(spec.key), row.alias("before"))
    after = new.select(*cols(spec.key), row.alias("after"))
    return before.join(after, list(spec.key), "full")


def _aggregated(old: DataFrame, new: DataFrame, spec: TableSpec) -> DataFrame:
    row, absent = F.struct(*cols(spec.columns)), F.lit(None).cast(spec.schema)
    before = old.select(*cols(spec.key), row.alias("before"), absent.alias("after"))
    after = new.select(*cols(spec.key), absent.alias("before"), row.alias("after"))
    paired = (
        before.unionAll(after)
        .groupBy(*cols(spec.key))
        .agg(
            F.first("before", ignorenulls=True).alias("before"),
            F.first("after", ignorenulls=True).alias("after"),
            F.greatest(F.count("before"), F.count("after")).alias("_copies"),
        )
    )
    no_key = reduce(or_, [c.isNull() for c in cols(spec.key)])
    shown = F.to_json(F.struct(*cols(spec.key)))
    return paired.where(
        F.when(no_key, F.raise_error(F.lit("NULL in the key")))
        .when(F.col("_copies") > 1, F.raise_error(F.concat(F.lit("repeated key: "), shown)))
        .otherwise(F.lit(True))
    )
