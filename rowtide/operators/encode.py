"""Rows to change records in the layout of Spark's Kafka source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from rowtide.functions import records as rec
from rowtide.functions.typed import cols

# The layout of Spark's Kafka source.
KAFKA_SCHEMA = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("timestampType", IntegerType()),
    ]
)

# NULL columns are written as JSON nulls, not left out, and times with their
# microseconds, which to_json would cut.
ENCODE_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def json_bytes(names: Sequence[str]) -> Column:
    return F.to_json(F.struct(*cols(names)), ENCODE_OPTIONS).cast("binary")


def to_records(
    rows: DataFrame,
    key: Sequence[str],
    topic: str | Column,
    sequence: str,
    *,
    timestamp: Column | None = None,
    tombstones: bool = False,
    partitions: int = 1,
) -> DataFrame:
    """JSON change records with the key columns as key and all other columns as value.

    ``sequence`` names a long column that orders the changes of a key; it gives
    the offset and stays out of the value. With ``tombstones`` every flattened
    delete is followed by a record with the same key and no value, and offsets
    are ``2 * sequence`` and ``2 * sequence + 1``. A key always falls into the
    same partition.
    """
    values = [c for c in rows.columns if c != sequence]
    named = F.lit(topic) if isinstance(topic, str) else topic
    stamp = F.current_timestamp() if timestamp is None else timestamp.cast("timestamp")
    order = F.col(sequence).cast("long")
    encoded = rows.select(
        json_bytes(key).alias("key"),
        json_bytes(values).alias("value"),
        named.alias("topic"),
        F.pmod(F.xxhash64(*cols(key)), F.lit(partitions)).cast("int").alias("partition"),
        order.alias("offset"),
        stamp.alias("timestamp"),
        F.lit(0).alias("timestampType"),
        *([F.col(rec.OP).alias("_op")] if tombstones else []),
    )
    if tombstones:
        pair = F.array(F.col("value"), F.lit(None).cast("binary"))
        copies = F.when(F.col("_op") == "d", pair).otherwise(F.array("value"))
        rest = [c for c in KAFKA_SCHEMA.names if c != "value"]
        encoded = encoded.select(*rest, F.posexplode(copies).alias("_nth", "value")).withColumn(
            "offset", F.col("offset") * 2 + F.col("_nth")
        )
    return encoded.select(*KAFKA_SCHEMA.names)
