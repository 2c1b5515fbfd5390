"""Change feeds, envelopes, JSON records and replay."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.records import topic_name
from rowtide.operators import changes, images
from rowtide.operators.cutover import cut_over
from rowtide.operators.encode import to_records
from rowtide.operators.replay import apply_changes as move_on
from rowtide.operators.replay import latest, replay, replay_rows
from rowtide.plans.capture import change_log, snapshot_log
from rowtide.queries.inputs import (
    EVENT_OP_SQL,
    EVENTS_TOPIC,
    ORDER_STATES_SQL,
    event_envelopes,
    event_op,
    order_states,
    spec_of,
    table,
)
from rowtide.specs import TOPIC_PREFIX, TOPIC_SCHEMA, TableSpec

CAPTURED = ("customer", "part", "orders")


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net changes between two order states, with both images."""
    orders = table(spark, sf_dir, "orders")
    feed = changes.change_feed(*order_states(orders), spec_of(orders, "orders"))
    images = [
        F.col(f"{image}.{c}").alias(f"{image}_{c.removeprefix('o_')}")
        for image in ("before", "after")
        for c in orders.columns
    ]
    return feed.select("op", *images)


def snapshot_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return changes.flatten(changes.snapshot_reads(part, spec_of(part, "part")), "part")


def include_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of four tables, narrowed to the captured ones and routed to their topics."""
    ids = {"customer": "c_custkey", "part": "p_partkey", "orders": "o_orderkey", "supplier": "s_suppkey"}
    parts = [
        table(spark, sf_dir, name).select(F.lit(name).alias("table"), F.col(key).alias("id"))
        for name, key in ids.items()
    ]
    listed = changes.include_tables(reduce(DataFrame.unionAll, parts), CAPTURED)
    return listed.withColumn("topic", topic_name(TOPIC_PREFIX, TOPIC_SCHEMA, F.col("table")))


def unwrap_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.flatten(event_envelopes(table(spark, sf_dir, "events")), "events")


def delete_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log with a record without a value behind every delete."""
    rows = changes.flatten(event_envelopes(table(spark, sf_dir, "events")), "events", carry=["sequence"])
    records = to_records(rows, ["event_id"], EVENTS_TOPIC, "sequence", tombstones=True)
    return records.select(
        F.col("key").cast("string").alias("key"), "topic", "offset", F.col("value").cast("string").alias("value")
    )


def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").withColumn("sequence", F.col("c_custkey"))
    records = to_records(customer, ["c_custkey"], "customer", "sequence")
    return records.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def replay_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log keyed by user: the last event of every user, unless it is a delete."""
    events = table(spark, sf_dir, "events")
    rows = events.withColumn("__op", event_op()).withColumn("sequence", F.col("event_id"))
    log = to_records(rows, ["user_id"], EVENTS_TOPIC, "sequence", timestamp=F.col("ts"))
    return replay(log, TableSpec("events", events.schema, ("user_id",)))


def replay_deleted_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log without operations: a delete has only the flag that deletes are rewritten to."""
    events = table(spark, sf_dir, "events")
    rows = events.withColumn("__deleted", F.when(event_op() == "d", "true").otherwise("false"))
    log = to_records(rows.withColumn("sequence", F.col("event_id")), ["user_id"], EVENTS_TOPIC, "sequence")
    return replay(log, TableSpec("events", events.schema, ("user_id",)))


def replay_key_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log, every second key with spaces in its JSON."""
    events = table(spark, sf_dir, "events")
    rows = events.withColumn("__op", event_op()).withColumn("sequence", F.col("event_id"))
    log = to_records(rows, ["user_id"], EVENTS_TOPIC, "sequence")
    spaced = F.replace(F.col("key").cast("string"), F.lit(":"), F.lit(" : ")).cast("binary")
    odd = F.col("offset").bitwiseAND(2) > 0
    return replay(log.withColumn("key", F.when(odd, spaced).otherwise(F.col("key"))), TableSpec("events", events.schema, ("user_id",)))


def replay_line_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as versions of their key: the last one by ship date and the other columns."""
    lines = table(spark, sf_dir, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    return latest(lines, key, ["l_shipdate", *[c for c in lines.columns if c not in {*key, "l_shipdate"}]])


def replay_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first state as read records, the changes as JSON records, replayed: the second state."""
    orders = table(spark, sf_dir, "orders")
    spec = spec_of(orders, "orders")
    earlier, later = order_states(orders)
    log = snapshot_log(earlier, spec).unionAll(change_log(earlier, later, spec, 1))
    return replay(log, spec)


def apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first state moved on by the records of the changes: the second state."""
    orders = table(spark, sf_dir, "orders")
    spec = spec_of(orders, "orders")
    earlier, later = order_states(orders)
    return move_on(earlier, change_log(earlier, later, spec, 1), spec)


def before_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events keyed by user as a log of after-rows, with the row each one replaced."""
    events = table(spark, sf_dir, "events")
    rows = events.withColumn("__op", event_op()).withColumn("position", F.col("event_id"))
    envelopes = images.before_images(rows, TableSpec("events", events.schema, ("user_id",)), "position", span=1000)
    shown = [F.col(f"{image}.{c}").alias(f"{image}_{c}") for image in ("before", "after") for c in events.columns]
    return envelopes.select("position", "op", *shown)


def snapshot_cut_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read in eight chunks while they change: chunk reads and changes as one log, replayed to the final state."""
    orders = table(spark, sf_dir, "orders")
    spec = spec_of(orders, "orders")
    earlier, later = order_states(orders)
    feed = changes.change_feed(earlier, later, spec)
    key = F.coalesce("after.o_orderkey", "before.o_orderkey")
    moves = feed.withColumn("position", F.pmod(F.xxhash64(key), F.lit(10_000)) + 1)
    # A chunk was read at some time between its two positions, which overlap those of the next chunk.
    chunk = F.pmod(key, F.lit(8)).cast("int")
    seen = moves.select(chunk.alias("chunk"), F.when(F.col("position") <= chunk * 1000 + 1700, F.col("after")).otherwise(F.col("before")).alias("row"))
    moved = moves.select(key.alias("o_orderkey"))
    still = earlier.join(moved, "o_orderkey", "left_anti").select(F.pmod("o_orderkey", F.lit(8)).cast("int").alias("chunk"), F.struct(*orders.columns).alias("row"))
    reads = seen.where(F.col("row").isNotNull()).unionAll(still).select("chunk", "row.*")
    windows = spark.range(8).select(F.col("id").cast("int").alias("chunk"), (F.col("id") * 1000).alias("low"), (F.col("id") * 1000 + 3000).alias("high"))
    log = changes.flatten(moves, "orders", carry=["position"])
    return replay_rows(cut_over(reads, windows, log, spec, "position"), spec.key, ["position"])


QUERIES = {
    "change_feed": change_feed,
    "snapshot_reads": snapshot_reads,
    "include_list": include_list,
    "unwrap_envelope": unwrap_envelope,
    "delete_tombstones": delete_tombstones,
    "json_encode": json_encode,
    "replay_state": replay_state,
    "replay_deleted_flag": replay_deleted_flag,
    "replay_key_spelling": replay_key_spelling,
    "replay_line_versions": replay_line_versions,
    "replay_round_trip": replay_round_trip,
    "apply_changes": apply_changes,
    "before_images": before_images,
    "snapshot_cut_over": snapshot_cut_over,
}

EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
ORDER_COLUMNS = ("orderkey", "custkey", "orderstatus", "totalprice", "orderdate", "orderpriority")

LAST_EVENTS_SQL = """
    select event_id, ts, user_id, event_type, value, props
    from (select *, row_number() over (partition by user_id order by event_id desc) as nth from events)
    where nth = 1 and event_type <> 'error'"""

SQL = {
    "change_feed": f"""
        with {ORDER_STATES_SQL}
        select case when b.o_orderkey is null then 'c' when a.o_orderkey is null then 'd' else 'u' end as op,
               {", ".join(f"b.o_{c} as before_{c}" for c in ORDER_COLUMNS)},
               {", ".join(f"a.o_{c} as after_{c}" for c in ORDER_COLUMNS)}
        from earlier b full join later a on a.o_orderkey = b.o_orderkey
        where {" or ".join(f"a.o_{c} is distinct from b.o_{c}" for c in ORDER_COLUMNS)}""",
    "snapshot_reads": "select *, 'r' as __op, 'part' as __table, 'false' as __deleted from part",
    "include_list": """
        with ids as (
          select 'customer' as "table", c_custkey as id from customer
          union all select 'part', p_partkey from part
          union all select 'orders', o_orderkey from orders
          union all select 'supplier', s_suppkey from supplier)
        select "table", id, 'dbserver1.public.' || "table" as topic
        from ids where "table" in ('customer', 'part', 'orders')""",
    "unwrap_envelope": f"""
        select *, {EVENT_OP_SQL} as __op, 'events' as __table,
               case when event_type = 'error' then 'true' else 'false' end as __deleted
        from events""",
    "delete_tombstones": f"""
        select '{{"event_id":' || event_id || '}}' as key, 'dbserver1.public.events' as topic,
               event_id * 2 as "offset",
               '{{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","user_id":' ||
               user_id || ',"event_type":"' || event_type || '","value":' || value || ',"props":' ||
               cast(to_json(props) as varchar) || ',"__op":"' || {EVENT_OP_SQL} || '","__table":"events","__deleted":"' ||
               case when event_type = 'error' then 'true' else 'false' end || '"}}' as value
        from events
        union all
        select '{{"event_id":' || event_id || '}}', 'dbserver1.public.events', event_id * 2 + 1, null
        from events where event_type = 'error'""",
    "json_encode": """
        select '{"c_custkey":' || c_custkey || '}' as key,
               cast(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey,
                             'c_acctbal': c_acctbal, 'c_mktsegment': c_mktsegment}) as varchar) as value
        from customer""",
    "replay_state": LAST_EVENTS_SQL,
    "replay_deleted_flag": LAST_EVENTS_SQL,
    "replay_key_spelling": LAST_EVENTS_SQL,
    "replay_line_versions": """
        select * exclude (nth)
        from (select *, row_number() over (
                partition by l_orderkey, l_linenumber
                order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc,
                         l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc) as nth
              from lineitem)
        where nth = 1""",
    "replay_round_trip": f"with {ORDER_STATES_SQL} select * from later",
    "apply_changes": f"with {ORDER_STATES_SQL} select * from later",
    "before_images": f"""
        with log as (
          select *, {EVENT_OP_SQL} as op, event_type <> 'error' as held,
                 lag(event_id) over by_user as prior_id, lag(event_type) over by_user as prior_type
          from events window by_user as (partition by user_id order by event_id))
        select log.event_id as position, op,
               {", ".join(f"b.{c} as before_{c}" for c in EVENT_COLUMNS)},
               {", ".join(f"case when held then log.{c} end as after_{c}" for c in EVENT_COLUMNS)}
        from log left join events b on b.event_id = prior_id and prior_type <> 'error'""",
    "snapshot_cut_over": f"with {ORDER_STATES_SQL} select * from later",
}
