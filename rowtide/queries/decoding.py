"""Typed and untyped decoding of change records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from rowtide.functions.records import is_tombstone
from rowtide.operators import decode as dec
from rowtide.operators.changes import flatten
from rowtide.operators.encode import KAFKA_SCHEMA, to_records
from rowtide.operators.offsets import lost_ranges as find_lost
from rowtide.plans.monitor import messages
from rowtide.queries.inputs import (
    BATCH_OF_EVENT_SQL,
    EVENT_OP_SQL,
    EVENT_OPS,
    EVENTS_TOPIC,
    LOG_DAYS,
    event_envelopes,
    event_op,
    event_records,
    spec_of,
    table,
    within,
)
from rowtide.session import work_dir
from rowtide.sources.kafka import EARLIEST_CODE, LATEST_CODE, append_log, from_offsets
from rowtide.sources.positions import PART, ROWS, consume, consumed
from rowtide.specs import TableSpec, topic_of

PROPS = TableSpec("events", StructType([StructField("k", IntegerType())]))


def naive(column: str):
    return F.col(column).cast("timestamp_ntz").alias(column)


def typed_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON text of the events as records of a log, decoded to the declared type."""
    records = event_records(table(spark, sf_dir, "events"), F.col("props"))
    rows = dec.decode(records, PROPS, keep_source=True)
    return rows.select(F.col("kafka_offset").alias("event_id"), "k", naive("kafka_timestamp"))


def part_prices(spark: SparkSession, sf_dir: str, coerce: bool) -> DataFrame:
    """Parts whose price travels as JSON text although it is declared as a double."""
    part = table(spark, sf_dir, "part")
    on_wire = part.withColumn("p_retailprice", F.col("p_retailprice").cast("string"))
    records = to_records(on_wire.withColumn("sequence", F.col("p_partkey")), ["p_partkey"], "part", "sequence")
    rows = dec.decode(records, spec_of(part, "part"), coerce=coerce)
    return rows.drop("kafka_timestamp", "processed_at")


def decode_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_prices(spark, sf_dir, coerce=False)


def decode_coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_prices(spark, sf_dir, coerce=True)


def decode_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without their closing brace for one kind of event: set apart with their text, the rest decoded."""
    cut = F.when(F.col("event_type") == "error", F.rtrim("props", F.lit("}"))).otherwise(F.col("props"))
    rows = dec.decode(event_records(table(spark, sf_dir, "events"), cut), PROPS, keep_source=True, on_malformed=dec.TAG)
    return rows.select(F.col("kafka_offset").alias("event_id"), "k", F.col(dec.MALFORMED).alias("broken_text"))


def decode_keep_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened events through JSON and back, with operation, table and delete flag."""
    events = table(spark, sf_dir, "events")
    rows = flatten(event_envelopes(events), "events", carry=["sequence"])
    records = to_records(rows, ["event_id"], EVENTS_TOPIC, "sequence", timestamp=F.col("ts"))
    decoded = dec.decode(records, spec_of(events, "events"), keep_meta=True)
    return decoded.withColumn("kafka_timestamp", naive("kafka_timestamp")).drop("processed_at")


def tombstone_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No value, empty bytes and a JSON null for three kinds of events."""
    kind = F.col("event_type")
    value = (
        F.when(kind == "error", F.lit(None).cast("string"))
        .when(kind == "purchase", F.lit(""))
        .when(kind == "signup", F.lit("null"))
        .otherwise(F.col("props"))
    )
    records = event_records(table(spark, sf_dir, "events"), value)
    return records.select(F.col("offset").alias("event_id"), is_tombstone(F.col("value")).alias("is_tombstone"))


def op_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of known, unknown and absent operation codes (absent where the value is below 10)."""
    op = F.when(F.col("value") >= 10, event_op())
    value = F.to_json(F.struct("event_id", op.alias("__op")))
    described = dec.describe(event_records(table(spark, sf_dir, "events"), value))
    return described.select(F.col("offset").alias("event_id"), "op_label")


def table_of_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table name from the record where it has one (clicks), else from the topic."""
    named = F.when(F.col("event_type") == "click", F.lit("clicks"))
    value = F.to_json(F.struct("event_id", named.alias("__table")))
    topic = F.concat(F.lit(topic_of("")), F.col("event_type"))
    described = dec.describe(event_records(table(spark, sf_dir, "events"), value, topic=topic))
    return described.select(F.col("offset").alias("event_id"), "topic", "table")


def flat_event_records(spark: SparkSession, sf_dir: str, tombstones: bool = False) -> DataFrame:
    rows = flatten(event_envelopes(table(spark, sf_dir, "events")), "events", carry=["sequence"])
    return to_records(rows, ["event_id"], EVENTS_TOPIC, "sequence", tombstones=tombstones)


def strip_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields that are left, one per row, as JSON text."""
    described = dec.describe(flat_event_records(spark, sf_dir)).withColumnRenamed("offset", "event_id")
    fields = dec.record_fields(described, ["event_id"])
    return fields.select("event_id", "name", F.try_variant_get("item", "$", "string").alias("value"))


def render_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record as its printed message, without the time; deletes with their tombstones."""
    shown = messages(flat_event_records(spark, sf_dir, tombstones=True), [EVENTS_TOPIC], stamp=False)
    return shown.select("offset", "message")


def render_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of records with nested fields and with keys that are no objects: a number, a text, a list, a broken one."""
    events = table(spark, sf_dir, "events")
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    key = (
        F.when(kind == "signup", user)
        .when(kind == "view", F.concat(F.lit('"user '), user, F.lit('"')))
        .when(kind == "click", F.concat(F.lit("["), user, F.lit(", true, null]")))
        .when(kind == "error", F.concat(F.lit('{"user": '), user))
        .otherwise(F.concat(F.lit('{"user": {"id": '), user, F.lit(', "of": "a"}}')))
    )
    value = F.concat(
        F.lit('{"z": {"props": '), "props", F.lit(', "user": ['), user, F.lit(', "\\u017c", {}], "a": 1e20}, "event": '),
        F.col("event_id").cast("string"), F.lit(', "small": 1.5e-7, "__op": "u", "none": [], "__table": "seen"}'),
    )
    return messages(event_records(events, value, key=key), [EVENTS_TOPIC], stamp=False).select("offset", "message")


def lost_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with a partition per kind of event, where each kind's offsets leave out those of the others."""
    kind = F.array_position(F.array(*[F.lit(k) for k in EVENT_OPS]), F.col("event_type")) - 1
    records = event_records(table(spark, sf_dir, "events"), F.col("props"), partition=kind)
    since = {EVENTS_TOPIC: {p: 0 for p in range(len(EVENT_OPS))}}
    return find_lost(records, since, span=1000)


def consume_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that grows in four parts, read in as many runs; one run fails after its rows were written."""
    root = work_dir(spark, "consume")
    records = event_records(table(spark, sf_dir, "events"), F.col("props"))
    for n, (since, until) in enumerate(LOG_DAYS):
        append_log(records.where(within(since, until)), f"{root}/log")
        log = spark.read.schema(KAFKA_SCHEMA).parquet(f"{root}/log")
        if n == 2:
            # What a failed run leaves: rows without a commit.
            log.write.parquet(f"{root}/reader/{ROWS}/{PART}={n + 1}.failed")
        consume(log, f"{root}/reader", starting="earliest" if n == 0 else "latest")
    return consumed(spark, f"{root}/reader").select("run", "partition", "offset", F.col("value").cast("string").alias("value"))


def from_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with a partition per kind of event: one read from an offset, one not at all, the rest from the beginning."""
    kind = F.array_position(F.array(*[F.lit(k) for k in EVENT_OPS]), F.col("event_type")) - 1
    records = event_records(table(spark, sf_dir, "events"), F.col("props"), partition=kind)
    starts = {EVENTS_TOPIC: {0: 500, 1: EARLIEST_CODE, 2: LATEST_CODE}}
    return from_offsets(records, starts).select("partition", "offset")


QUERIES = {
    "typed_decode": typed_decode,
    "decode_declared": decode_declared,
    "decode_coerced": decode_coerced,
    "decode_malformed": decode_malformed,
    "decode_keep_meta": decode_keep_meta,
    "tombstone_flag": tombstone_flag,
    "op_label": op_label,
    "table_of_topic": table_of_topic,
    "strip_metadata": strip_metadata,
    "render_message": render_message,
    "from_offset": from_offset,
    "render_nested": render_nested,
    "lost_ranges": lost_ranges,
    "consume_committed": consume_committed,
}

SQL = {
    "typed_decode": """
        select event_id, try_cast(json_extract_string(props, '$.k') as integer) as k, ts as kafka_timestamp
        from events""",
    "decode_declared": "select * replace (cast(null as double) as p_retailprice) from part",
    "decode_coerced": "select * from part",
    "decode_malformed": """
        with cut as (
          select event_id, case when event_type = 'error' then rtrim(props, '}') else props end as text
          from events)
        select event_id,
               case when json_valid(text) then try_cast(json_extract_string(text, '$.k') as integer) end as k,
               case when not json_valid(text) then text end as broken_text
        from cut""",
    "decode_keep_meta": f"""
        select *, {EVENT_OP_SQL} as __op, 'events' as __table,
               case when event_type = 'error' then 'true' else 'false' end as __deleted, ts as kafka_timestamp
        from events""",
    "tombstone_flag": "select event_id, event_type in ('error', 'purchase', 'signup') as is_tombstone from events",
    "op_label": f"""
        with ops as (select event_id, case when value >= 10 then {EVENT_OP_SQL} else '?' end as op from events)
        select event_id, case op when 'c' then 'INSERT' when 'u' then 'UPDATE' when 'd' then 'DELETE'
                                 when 'r' then 'READ (snapshot)' else 'UNKNOWN (' || op || ')' end as op_label
        from ops""",
    "table_of_topic": """
        select event_id, 'dbserver1.public.' || event_type as topic,
               case when event_type = 'click' then 'clicks' else event_type end as "table"
        from events""",
    "strip_metadata": """
        select event_id, 'event_id' as name, cast(event_id as varchar) as value from events
        union all select event_id, 'ts', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') from events
        union all select event_id, 'user_id', cast(user_id as varchar) from events
        union all select event_id, 'event_type', event_type from events
        union all select event_id, 'value', regexp_replace(cast(value as varchar), '\\.0$', '') from events
        union all select event_id, 'props', props from events""",
    "render_message": f"""
        select event_id * 2 as "offset",
               chr(10) || '[events] ' ||
               case event_type when 'signup' then 'INSERT' when 'view' then 'READ (snapshot)' when 'click' then 'UPDATE'
                               when 'error' then 'DELETE' else 'UNKNOWN (x)' end ||
               chr(10) || '  key   : {{''event_id'': ' || event_id || '}}' || chr(10) || '  record: {{' || chr(10) ||
               '    "event_id": ' || event_id || ',' || chr(10) ||
               '    "ts": "' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '",' || chr(10) ||
               '    "user_id": ' || user_id || ',' || chr(10) ||
               '    "event_type": "' || event_type || '",' || chr(10) ||
               '    "value": ' || value || ',' || chr(10) ||
               '    "props": ' || cast(to_json(props) as varchar) || chr(10) || '}}' ||
               chr(10) || repeat('-', 80) as message
        from events
        union all
        select event_id * 2 + 1,
               chr(10) || '[dbserver1.public.events] TOMBSTONE | key={{''event_id'': ' || event_id || '}}' ||
               chr(10) || repeat('-', 80)
        from events where event_type = 'error'""",
    "from_offset": """
        with log as (
          select cast(list_position(['signup', 'view', 'click', 'error', 'purchase'], event_type) - 1 as integer)
                   as partition, event_id as "offset" from events)
        select * from log where (partition <> 0 or "offset" >= 500) and partition <> 2""",
    "render_nested": """
        with parts as (
          select *, cast(user_id as varchar) as u, event_type = 'error' as broken from events),
        keys as (
          select *, case event_type when 'signup' then u when 'view' then 'user ' || u
                                    when 'click' then '[' || u || ', True, None]' when 'error' then '{"user": ' || u
                                    else '{''user'': {''id'': ' || u || ', ''of'': ''a''}}' end as shown
          from parts)
        select event_id as "offset",
               case when broken
                    then chr(10) || '[dbserver1.public.events] MALFORMED | key=' || shown || ' value={"z": {"props": ' || props ||
                         ', "user": [' || u || ', "\\u017c", {}], "a": 1e20}, "event": ' || event_id ||
                         ', "small": 1.5e-7, "__op": "u", "none": [], "__table": "seen"}'
                    else concat_ws(chr(10), '', '[seen] UPDATE', '  key   : ' || shown, '  record: {', '    "z": {',
                         '        "props": {', '            "k": ' || json_extract_string(props, '$.k'), '        },',
                         '        "user": [', '            ' || u || ',', '            "ż",', '            {}', '        ],',
                         '        "a": 1e+20', '    },', '    "event": ' || event_id || ',', '    "small": 1.5e-07,',
                         '    "none": []', '}') end || chr(10) || repeat('-', 80) as message
        from keys""",
    "lost_ranges": """
        with log as (
          select cast(list_position(['signup', 'view', 'click', 'error', 'purchase'], event_type) - 1 as integer)
                   as "partition", event_id from events),
        pairs as (
          select "partition", event_id as after,
                 coalesce(lag(event_id) over (partition by "partition" order by event_id), -1) as before from log)
        select 'dbserver1.public.events' as topic, "partition", before + 1 as "first", after - 1 as "last",
               after - before - 1 as lost
        from pairs where after - before > 1""",
    "consume_committed": f"""
        select {BATCH_OF_EVENT_SQL} + 1 as run, 0 as "partition", event_id as "offset", props as value from events""",
}
