"""A change log applied in order: the current state of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    MapType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from rowtide.functions import records as rec
from rowtide.functions.typed import cols, from_text, quoted
from rowtide.operators.decode import META_FIELDS, decode
from rowtide.session import stored
from rowtide.specs import TableSpec


def latest(log: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key.

    An aggregation, not a sort over the key: each task first keeps one row per
    key of its own input, so a key that holds a large part of the log reaches
    the shuffle as one row per task. Should ``order`` repeat within a key, the
    other columns decide.
    """
    rest = [c for c in log.columns if c not in set(key) | set(order)]
    row = F.struct(*cols([*order, *rest]))
    # The largest row by order first; rows with maps or variants in them have no
    # order of their own.
    comparable = all(_comparable(log.schema[c].dataType) for c in rest)
    last = F.max(row) if comparable else F.max_by(row, F.struct(*cols(order)))
    state = log.groupBy(*cols(key)).agg(last.alias("_last")).select(*cols(key), "_last.*")
    return state.select(*cols(log.columns))


def _comparable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_comparable(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return _comparable(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))


def replay_rows(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current state from flattened rows: the last row of a key unless ``__op`` or ``__deleted`` says it is gone.

    ``__op``, ``__table``, ``__deleted`` and the order columns are dropped.
    """
    state = latest(rows, key, order)
    return state.where(~gone(state.columns)).drop(*META_FIELDS, *order)


def gone(columns: Sequence[str]) -> Column:
    """Whether a row is a delete: by its operation, or by the flag a delete is rewritten to."""
    marks = [F.col(rec.OP) == "d"] if rec.OP in columns else []
    if rec.DELETED in columns:
        marks.append(F.col(rec.DELETED) == "true")
    return reduce(or_, [F.coalesce(m, F.lit(False)) for m in marks], F.lit(False))


def replay(records: DataFrame, spec: TableSpec, *, coerce: bool = True) -> DataFrame:
    """Current state of a table from the raw records of its topic.

    The key of each record is parsed to the key columns, so that a key is the
    same however its JSON is spelled; of the values only those of the last
    records are parsed. Order is the offset, which holds because a key stays in
    one partition. A record without a key, or a last record that gives no key
    column, fails the job: it cannot be told which row it stands for.
    """
    return _rows(_last_records(records, spec, coerce), spec, coerce)


def apply_changes(state: DataFrame, records: DataFrame, spec: TableSpec, *, coerce: bool = True) -> DataFrame:
    """A known state of a table moved on by the records that came after it.

    Only the records are grouped; the last of each key are stored at once in the
    shared work folder. The state keeps the rows whose key none of them names, by
    an anti join. While the named keys are few enough to be broadcast, the state
    is read once and not shuffled, nor is it if it is bucketed by the key.
    """
    last = stored(_last_records(records, spec, coerce), "last-records")
    unusable = F.raise_error(F.lit(f"{spec.name}: a record's key gives no key column"))
    # In the columns and not in a filter: a join's own test for NULL keys would come before that.
    named = last.select(*[F.when(F.col(RAW_KEY).isNotNull(), unusable).otherwise(F.col(f"{KEY}.{quoted(k)}")).alias(k) for k in spec.key])
    kept = state.select(*cols(spec.columns)).join(named, list(spec.key), "left_anti")
    return kept.unionByName(_rows(last, spec, coerce))


def changed_rows(records: DataFrame, spec: TableSpec, offset: str, mark: str, *, coerce: bool = True) -> DataFrame:
    """The last record of every key as a typed row, with its ``offset`` and a ``mark``: whether it takes the key away.

    Key columns come from the record's key, so a tombstone has them too. The last
    records are stored in the shared work folder.
    """
    last = stored(_last_records(records, spec, coerce), "last-records")
    unusable = F.raise_error(F.lit(f"{spec.name}: a record's key gives no key column"))
    found = F.when(F.col(RAW_KEY).isNotNull(), unusable).otherwise(F.col(KEY))
    # The layout of a log, as far as decoding needs it.
    log = last.select(found.alias("key"), "value", "offset", "timestamp", F.lit(None).alias("topic"), F.lit(None).alias("partition"))
    empty = rec.is_tombstone(F.col("value"))
    rows = decode(log.where(~empty), spec, coerce=coerce, keep_meta=True, keep_source=True)
    # A value that gives no key column is no row of the table.
    broken = F.raise_error(F.lit(f"{spec.name}: last record of a key gives no key column"))
    usable = F.when(_no_key(spec), broken).otherwise(gone(META_FIELDS))
    rest = [c for c in spec.columns if c not in spec.key]
    key = [F.col(f"kafka_key.{quoted(k)}").alias(k) for k in spec.key]
    kept = rows.select(*key, *cols(rest), F.col("kafka_offset").alias(offset), usable.alias(mark))
    bare = log.where(empty).select(
        *[F.col(f"key.{quoted(k)}").alias(k) for k in spec.key],
        *[F.lit(None).cast(spec.schema[c].dataType).alias(c) for c in rest],
        F.col("offset").alias(offset),
        F.lit(True).alias(mark),
    )
    return kept.unionByName(bare).select(*cols([*spec.columns, offset, mark]))


# The key columns of a record as one struct, and its raw key where that gives none.
KEY, RAW_KEY = "_key", "_raw_key"


def _last_records(records: DataFrame, spec: TableSpec, coerce: bool) -> DataFrame:
    unkeyed = F.raise_error(F.lit("record without a key"))
    keyed = records.where(F.when(F.col("key").isNull(), unkeyed).otherwise(F.lit(True)))
    rest = [F.col("offset"), F.col("value"), F.col("timestamp")]
    if not spec.key:
        last = latest(keyed.select(F.col("key").alias(RAW_KEY), *rest), [RAW_KEY], ["offset"])
        return last.withColumn(KEY, F.lit(None))
    key = StructType([spec.schema[k] for k in spec.key])
    text = StructType([StructField(k, StringType()) for k in spec.key])
    # One struct from one parse, so that the columns do not each parse the key again.
    parsed = F.from_json(rec.as_text(F.col("key")), text if coerce else key)

    def typed(found: Column) -> Column:
        fields = [from_text(found[k], spec.schema[k].dataType) if coerce else found[k] for k in spec.key]
        missing = reduce(or_, [f.isNull() for f in fields], found.isNull())
        return F.struct(
            F.when(~missing, F.struct(*[f.alias(k) for f, k in zip(fields, spec.key)])).alias(KEY),
            F.when(missing, F.col("key")).alias(RAW_KEY),
        )

    named = keyed.select(rec.once(parsed, typed).alias("_both"), *rest).select("_both.*", *rest)
    return latest(named, [KEY, RAW_KEY], ["offset"])


def _rows(last: DataFrame, spec: TableSpec, coerce: bool) -> DataFrame:
    """The table rows of the last records: no tombstones, no deletes."""
    rows = decode(last.where(~rec.is_tombstone(F.col("value"))), spec, coerce=coerce, keep_meta=True)
    row = F.when(~gone(META_FIELDS), F.struct(*cols(spec.columns)))
    if spec.key:
        unusable = F.raise_error(F.lit(f"{spec.name}: last record of a key gives no key column"))
        row = F.when(_no_key(spec), unusable).otherwise(row)
    # Spark moves a plain filter on parsed fields below the parsing, and so would
    # parse twice. The element of an exploded array is tested where it is.
    return rows.select(F.explode(F.array(row)).alias("row")).where(F.col("row").isNotNull()).select("row.*")


def _no_key(spec: TableSpec) -> Column:
    return reduce(or_, [c.isNull() for c in cols(spec.key)])
