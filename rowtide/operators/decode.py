"""Change records to typed rows, and the untyped view of the same records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rowtide.functions import records as rec
from rowtide.functions import render
from rowtide.functions.typed import quoted, typed_columns
from rowtide.specs import TableSpec

PERMISSIVE = "permissive"
FAILFAST = "failfast"
TAG = "tag"
MALFORMED = "malformed"

META_FIELDS = (rec.OP, rec.TABLE, rec.DELETED)
SOURCE_FIELDS = ("key", "topic", "partition", "offset")


def decode(
    records: DataFrame,
    spec: TableSpec,
    *,
    coerce: bool = False,
    keep_meta: bool = False,
    keep_source: bool = False,
    on_malformed: str = PERMISSIVE,
) -> DataFrame:
    """Typed rows of one table's change records, stamped with broker and processing time.

    Works on a batch or a stream in the layout of Spark's Kafka source and needs
    no shuffle. By default only the declared columns survive, a number that
    arrives as text in a numeric column is NULL, and a record that is no JSON
    object (or a tombstone) gives a row of NULLs.

    coerce        read every field as text and cast, so ``"89.99"`` is 89.99
    keep_meta     also keep ``__op``, ``__table`` and ``__deleted``
    keep_source   also keep key, topic, partition and offset, as ``kafka_<name>``
    on_malformed  ``failfast`` stops at the first record that is no JSON object;
                  ``tag`` gives it a row of NULLs with its text in ``malformed``,
                  a column that is NULL for all others, in the same pass
    """
    if on_malformed not in (PERMISSIVE, FAILFAST, TAG):
        raise ValueError(f"on_malformed: {on_malformed!r}")
    text = rec.as_text(F.col("value"))
    if on_malformed == FAILFAST:
        failure = F.raise_error(F.concat(F.lit("malformed record: "), text))
        text = F.when(rec.is_malformed(F.col("value")), failure).otherwise(text)

    meta = [StructField(name, StringType()) for name in META_FIELDS] if keep_meta else []
    declared = spec.as_text() if coerce else spec.schema
    row = F.from_json(text, StructType(declared.fields + meta))

    source = [F.col(f"`{name}`").alias(f"kafka_{name}") for name in SOURCE_FIELDS]
    tag = F.when(rec.is_malformed(F.col("value")), rec.as_text(F.col("value"))).alias(MALFORMED)
    kept = records.select(
        row.alias("row"),
        *(source if keep_source else []),
        F.col("timestamp").alias("kafka_timestamp"),
        *([tag] if on_malformed == TAG else []),
    )
    declared_fields = StructType(spec.schema.fields + meta)
    fields = typed_columns(declared_fields, "row") if coerce else cols_of("row", declared_fields.names)
    if on_malformed == TAG:
        # What a broken text holds before its break is no row.
        fields = [F.when(F.col(MALFORMED).isNull(), f).alias(name) for f, name in zip(fields, declared_fields.names)]
    return kept.select(*fields, *kept.columns[1:], F.current_timestamp().alias("processed_at"))


def cols_of(struct: str, names: list[str]) -> list[Column]:
    return [F.col(f"{struct}.{quoted(n)}").alias(n) for n in names]


def quarantine(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into (JSON objects and tombstones, malformed records); both keep the raw columns."""
    broken = rec.is_malformed(F.col("value"))
    return records.where(~broken), records.where(broken)


def describe(records: DataFrame) -> DataFrame:
    """Untyped decode: operation label, table name and the fields as (name -> variant) maps.

    Adds ``key_fields``, ``is_tombstone``, ``table``, ``op_label`` and ``record``
    (NULL for a tombstone) to the raw columns. A malformed record has no fields;
    use ``quarantine`` or ``decode(on_malformed="failfast")`` to deal with it.
    """
    fields = records.withColumn("fields", rec.json_map(F.col("value")))
    table = F.coalesce(rec.meta_field(F.col("fields"), rec.TABLE), rec.table_of_topic(F.col("topic")))
    return (
        fields.withColumn("key_fields", rec.json_map(F.col("key")))
        .withColumn("is_tombstone", rec.is_tombstone(F.col("value")))
        .withColumn("table", table)
        .withColumn("op_label", rec.op_label(rec.meta_field(F.col("fields"), rec.OP)))
        .withColumn("record", rec.strip_metadata(F.col("fields")))
        .drop("fields")
    )


def record_fields(described: DataFrame, carry: list[str]) -> DataFrame:
    """The fields of described records one per row: the carried columns, ``name`` and ``item``.

    A record without fields gives no row.
    """
    # A plain explode makes Spark test the map for emptiness in a filter below,
    # which would parse every record twice more.
    fields = described.select(*carry, F.explode_outer("record").alias("name", "item"))
    return fields.where(F.col("name").isNotNull())


def render_messages(records: DataFrame, stamp: bool = True) -> DataFrame:
    """One ``message`` text per record, followed by a rule; adds one column.

    A tombstone is one line with its topic, a malformed record (its key no JSON,
    or its value no JSON object) one line with its text; any other record shows
    table, operation, key and the fields. ``stamp=False`` leaves out the
    wall-clock time.
    """
    time = F.concat(F.lit("["), rec.iso_millis(F.current_timestamp()), F.lit("]")) if stamp else F.lit("")
    gap = " " if stamp else ""
    shown = F.col("_shown")
    tombstone = F.concat(time, F.lit("["), F.col("topic"), F.lit("] TOMBSTONE | key="), shown["key"])
    change = F.concat(
        time,
        F.lit(f"{gap}["),
        F.coalesce(shown["table"], rec.table_of_topic(F.col("topic"))),
        F.lit("] "),
        rec.op_label(shown["op"]),
        F.lit("\n  key   : "),
        shown["key"],
        F.lit("\n  record: "),
        shown["record"],
    )
    text = F.coalesce(rec.as_text(F.col("value")), F.lit("None"))
    malformed = F.concat(time, F.lit("["), F.col("topic"), F.lit("] MALFORMED | key="), shown["key"], F.lit(" value="), text)
    body = F.when(shown["kind"] == render.TOMBSTONE, tombstone).when(shown["kind"] == render.CHANGE, change).otherwise(malformed)
    read = records.withColumn("_shown", render.shown_record()(F.col("key"), F.col("value")))
    return read.withColumn("message", F.concat(F.lit("\n"), body, F.lit("\n" + render.RULE))).drop("_shown")
