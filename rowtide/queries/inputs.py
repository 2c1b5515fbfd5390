"""The given tables in the roles of the change-data lake: states, envelopes, records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators.encode import json_bytes
from rowtide.specs import TableSpec, topic_of

EVENTS_TOPIC = topic_of("events")

KEYS = {
    "customer": ("c_custkey",),
    "part": ("p_partkey",),
    "orders": ("o_orderkey",),
    "events": ("event_id",),
    "lineitem": ("l_orderkey", "l_linenumber"),
}

# Operation code of an event type; ``x`` is a code no table change has.
EVENT_OPS = {"signup": "c", "view": "r", "click": "u", "error": "d", "purchase": "x"}
EVENT_OP_SQL = """case event_type when 'signup' then 'c' when 'view' then 'r' when 'click' then 'u'
    when 'error' then 'd' when 'purchase' then 'x' end"""

# Parts of a log by broker date, each appended by itself, so that a batch takes one.
LOG_DAYS = ((None, "2024-01-09"), ("2024-01-09", "2024-01-16"), ("2024-01-16", "2024-01-23"), ("2024-01-23", None))
BATCH_OF_EVENT_SQL = """cast(case when ts < timestamp '2024-01-09' then 0 when ts < timestamp '2024-01-16' then 1
    when ts < timestamp '2024-01-23' then 2 else 3 end as bigint)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spec_of(df: DataFrame, name: str) -> TableSpec:
    return TableSpec(name, df.schema, KEYS[name])


def within(since: str | None, until: str | None) -> Column:
    """Records with a broker date in a range, open where it has no end."""
    at = F.to_date("timestamp").cast("string")
    return (at >= since if since else F.lit(True)) & (at < until if until else F.lit(True))


def event_op() -> Column:
    op = F.lit(None).cast("string")
    for kind, code in EVENT_OPS.items():
        op = F.when(F.col("event_type") == kind, code).otherwise(op)
    return op


def event_records(
    events: DataFrame,
    value: Column,
    *,
    key: Sequence[str] | Column = ("event_id",),
    topic: str | Column = EVENTS_TOPIC,
    partition: Column | None = None,
) -> DataFrame:
    """The event stream as a change log with the given value bytes: id as offset, ts as broker time."""
    return events.select(
        (key.cast("binary") if isinstance(key, Column) else json_bytes(key)).alias("key"),
        value.cast("binary").alias("value"),
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
        (F.lit(0) if partition is None else partition).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def event_envelopes(events: DataFrame) -> DataFrame:
    """Every event as an envelope: an update raised the value by one, a delete has no new row."""
    row = F.struct(*events.columns)
    op = event_op()
    older = F.struct(*[(F.col(c) - 1).alias(c) if c == "value" else F.col(c) for c in events.columns])
    return events.select(
        op.alias("op"),
        F.when(op == "u", older).when(op == "d", row).alias("before"),
        F.when(op != "d", row).alias("after"),
        F.col("event_id").alias("sequence"),
    )


def order_states(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two states of the order table that together hold every order.

    Earlier: the orders placed before 2000. Later: all orders, without the
    finished ones from before 1996, and with the pending ones from before 2000
    finished.
    """
    placed = F.col("o_orderdate")
    earlier = orders.where(placed < F.lit("2000-01-01").cast("timestamp_ntz"))
    archived = (F.col("o_orderstatus") == "F") & (placed < F.lit("1996-01-01").cast("timestamp_ntz"))
    finished = (F.col("o_orderstatus") == "P") & (placed < F.lit("2000-01-01").cast("timestamp_ntz"))
    status = F.when(finished, "F").otherwise(F.col("o_orderstatus"))
    later = orders.where(~archived).withColumn("o_orderstatus", status)
    return earlier, later


ORDER_STATES_SQL = """
earlier as (select * from orders where o_orderdate < timestamp '2000-01-01'),
later as (
  select * replace (case when o_orderstatus = 'P' and o_orderdate < timestamp '2000-01-01'
                         then 'F' else o_orderstatus end as o_orderstatus)
  from orders
  where not (o_orderstatus = 'F' and o_orderdate < timestamp '1996-01-01'))
"""
