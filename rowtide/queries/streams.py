"""Streams from a change log into the lake."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators.encode import KAFKA_SCHEMA, json_bytes, to_records
from rowtide.plans.lake import split_malformed, split_offsets, split_rows, start_all, start_split_job, start_table_job
from rowtide.operators.replay import replay_rows
from rowtide.queries.decoding import PROPS
from rowtide.queries.inputs import (
    BATCH_OF_EVENT_SQL,
    EVENT_OPS,
    EVENTS_TOPIC,
    LOG_DAYS,
    event_op,
    event_records,
    spec_of,
    table,
    within,
)
from rowtide.session import work_dir
from rowtide.sources.kafka import append_log, stored_stream
from rowtide.specs import TableSpec, topic_of
from rowtide.streaming.lag import batch_positions, lag, log_ends
from rowtide.streaming.lifecycle import finish, logging_progress, stopping
from rowtide.streaming.sink import AVAILABLE_NOW, lake_path
from rowtide.streaming.state import replayed_table, start_replay_job

FANNED_OUT = ("customer", "part", "orders")
# Files of the log of the progress query, each a micro-batch.
PROGRESS_FILES = 12


def event_stream(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, TableSpec]:
    """The event table as a stream of JSON records."""
    schema = table(spark, sf_dir, "events").schema
    # A pattern, since a stream takes a plain path for a folder.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/{{events.parquet}}")
    return event_records(events, json_bytes(schema.names)), TableSpec("events", schema, ("event_id",))


def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: JSON change records decoded, stamped and appended to the lake, read back."""
    records, spec = event_stream(spark, sf_dir)
    root = work_dir(spark, "append")
    finish([start_table_job(records, spec, root, trigger=AVAILABLE_NOW)])
    return lake_rows(spark, root, spec)


def lake_rows(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    rows = spark.read.parquet(lake_path(root, spec.name))
    return rows.select(
        *spec.columns,
        F.col("kafka_timestamp").cast("timestamp_ntz").alias("kafka_timestamp"),
        F.col("processed_at").isNotNull().alias("processed"),
    )


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two parts of the log with a restart in between and one after: each record once."""
    events = table(spark, sf_dir, "events")
    records = event_records(events, json_bytes(events.columns))
    root = work_dir(spark, "restart")
    spec = spec_of(events, "events")
    middle = F.lit("2024-01-16").cast("timestamp_ntz").cast("timestamp")
    for part in (F.col("timestamp") < middle, F.col("timestamp") >= middle, None):
        if part is not None:
            append_log(records.where(part), f"{root}/log")
        finish([start_table_job(stored_stream(spark, f"{root}/log"), spec, f"{root}/lake", trigger=AVAILABLE_NOW)])
    return lake_rows(spark, f"{root}/lake", spec)


def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log with three topics, three independent streams, three lake tables."""
    root = work_dir(spark, "fan-out")
    specs = {}
    for name in FANNED_OUT:
        rows = table(spark, sf_dir, name)
        specs[name] = spec_of(rows, name)
        key = specs[name].key
        log = to_records(rows.withColumn("sequence", F.col(key[0])), key, topic_of(name), "sequence")
        append_log(log, f"{root}/log")
    with stopping(
        start_all(lambda _: stored_stream(spark, f"{root}/log"), specs.values(), f"{root}/lake", trigger=AVAILABLE_NOW)
    ) as jobs:
        finish(jobs)
    stored = []
    for name, spec in specs.items():
        rows = spark.read.parquet(lake_path(f"{root}/lake", name))
        row_text = F.concat_ws("|", *[F.col(c).cast("string") for c in spec.columns])
        stored.append(rows.select(F.lit(name).alias("table_name"), F.col(spec.key[0]).alias("id"), row_text.alias("row")))
    return reduce(DataFrame.unionAll, stored)


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows taken in and batches with data, from all progress reports of a run over a log in many files."""
    events = table(spark, sf_dir, "events")
    root = work_dir(spark, "progress")
    append_log(event_records(events, json_bytes(events.columns)).repartition(PROGRESS_FILES, "offset"), f"{root}/log")
    records = stored_stream(spark, f"{root}/log", max_files_per_trigger=1)
    with logging_progress(spark, f"{root}/reports") as log:
        job = start_table_job(records, spec_of(events, "events"), f"{root}/lake", trigger=AVAILABLE_NOW)
        finish([job])
        reports = log.frame([job]).where(F.col("run_id") == str(job.runId))
    return reports.where("num_input_rows > 0").groupBy("name").agg(
        F.sum("num_input_rows").alias("input_rows"), F.count(F.lit(1)).alias("batches")
    )


def lake_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events keyed by user, streamed to the lake with key and offset, and replayed from there."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/{{events.parquet}}").withColumn("__op", event_op())
    records = event_records(events, json_bytes([*schema.names, "__op"]), key=["user_id"])
    spec = TableSpec("events", schema, ("user_id",))
    root = work_dir(spark, "lake-replay")
    finish([start_table_job(records, spec, root, trigger=AVAILABLE_NOW, keep_meta=True, keep_source=True)])
    rows = spark.read.parquet(lake_path(root, spec.name)).select(*spec.columns, "__op", "__deleted", "kafka_offset")
    return replay_rows(rows, spec.key, ["kafka_offset"])


def replay_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events keyed by user, their state kept by a stream that is stopped and started again in the middle."""
    events = table(spark, sf_dir, "events")
    rows = events.withColumn("__op", event_op()).withColumn("sequence", F.col("event_id"))
    records = to_records(rows, ["user_id"], EVENTS_TOPIC, "sequence", timestamp=F.col("ts"))
    spec = TableSpec("events", events.schema, ("user_id",))
    root = work_dir(spark, "replay-stream")
    for parts in (LOG_DAYS[:2], LOG_DAYS[2:]):
        for since, until in parts:
            append_log(records.where(within(since, until)), f"{root}/log")
        stream = stored_stream(spark, f"{root}/log", max_files_per_trigger=1)
        finish([start_replay_job(stream, spec, f"{root}/lake", trigger=AVAILABLE_NOW, merge_every=2)])
    return replayed_table(spark, f"{root}/lake", spec)


def broken_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a log with a partition for each kind; errors lack their closing brace."""
    cut = F.when(F.col("event_type") == "error", F.rtrim("props", F.lit("}"))).otherwise(F.col("props"))
    kind = F.array_position(F.array(*[F.lit(k) for k in EVENT_OPS]), F.col("event_type")) - 1
    return event_records(table(spark, sf_dir, "events"), cut, partition=kind)


def append_files(records: DataFrame, topic: str, path: str, before: int, files: int) -> None:
    """Append records of one topic to a log of ``before`` files in ``files`` more, empty ones where records are too few.

    So a stream that takes as many files at a time takes the records in one
    batch, and as many tasks share the writing and the batch.
    """
    spark, folder = records.sparkSession, f"{path}/topic={topic}"
    rows = records.drop("topic")
    rows.repartition(files).write.mode("append").parquet(folder)
    # A task without rows writes no file, save the first one.
    written = len(spark.read.schema(KAFKA_SCHEMA).parquet(path).inputFiles()) - before
    for _ in range(files - written):
        rows.limit(0).coalesce(1).write.mode("append").parquet(folder)


def split_batches(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """That log taken in one batch for each of its parts, with a restart after the first; gives the log."""
    records = broken_events(spark, sf_dir)
    files = max(spark.sparkContext.defaultParallelism, records.rdd.getNumPartitions())
    for part, (since, until) in enumerate(LOG_DAYS):
        append_files(records.where(within(since, until)), EVENTS_TOPIC, f"{root}/log", part * files, files)
        stream = stored_stream(spark, f"{root}/log", max_files_per_trigger=files)
        if since is None or until is None:
            finish([start_split_job(stream, PROPS, f"{root}/lake", trigger=AVAILABLE_NOW, keep_source=True)])
    return spark.read.schema(KAFKA_SCHEMA).parquet(f"{root}/log")


def stream_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and malformed records of one stream, each in its own table, with the batch that brought them."""
    root = work_dir(spark, "split")
    split_batches(spark, sf_dir, root)
    rows = split_rows(spark, f"{root}/lake", PROPS, keep_source=True)
    broken = split_malformed(spark, f"{root}/lake", PROPS)
    none = F.lit(None)
    return rows.select("batch", F.col("kafka_offset").alias("event_id"), "k", none.cast("string").alias("broken_text")).unionAll(
        broken.select("batch", "offset", none.cast("int"), F.col("value").cast("string"))
    )


def stream_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every batch of that stream and every partition, the position it reached and how many offsets were to come."""
    root = work_dir(spark, "lag")
    log = split_batches(spark, sf_dir, root)
    return lag(batch_positions(split_offsets(spark, f"{root}/lake", PROPS)), log_ends(log))


QUERIES = {
    "stream_append": stream_append,
    "stream_restart": stream_restart,
    "stream_fan_out": stream_fan_out,
    "stream_progress": stream_progress,
    "lake_replay": lake_replay,
    "replay_stream": replay_stream,
    "stream_split": stream_split,
    "stream_lag": stream_lag,
}

LAKE_EVENTS_SQL = "select *, ts as kafka_timestamp, true as processed from events"

SQL = {
    "stream_append": LAKE_EVENTS_SQL,
    "stream_restart": LAKE_EVENTS_SQL,
    "stream_fan_out": """
        select 'customer' as table_name, c_custkey as id,
               concat_ws('|', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment) as row from customer
        union all
        select 'part', p_partkey, concat_ws('|', p_partkey, p_name, p_brand, p_type, p_size, p_retailprice) from part
        union all
        select 'orders', o_orderkey,
               concat_ws('|', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)
        from orders""",
    "stream_progress": f"""
        select 'events' as name, cast(count(*) as bigint) as input_rows, cast({PROGRESS_FILES} as bigint) as batches
        from events""",
    "replay_stream": """
        select event_id, ts, user_id, event_type, value, props
        from (select *, row_number() over (partition by user_id order by event_id desc) as nth from events)
        where nth = 1 and event_type <> 'error'""",
    "stream_split": f"""
        with cut as (
          select {BATCH_OF_EVENT_SQL} as batch, event_id,
                 case when event_type = 'error' then rtrim(props, '}}') else props end as text
          from events)
        select batch, event_id,
               case when json_valid(text) then try_cast(json_extract_string(text, '$.k') as integer) end as k,
               case when not json_valid(text) then text end as broken_text
        from cut""",
    "stream_lag": f"""
        with log as (
          select {BATCH_OF_EVENT_SQL} as batch, event_id,
                 cast(list_position(['signup', 'view', 'click', 'error', 'purchase'], event_type) - 1 as integer) as part
          from events),
        ends as (select part, max(event_id) + 1 as log_end from log group by part),
        grid as (select part, log_end, unnest(range(0, 4)) as batch from ends),
        reached as (
          select grid.part, grid.batch, log_end, max(event_id) + 1 as position
          from grid left join log on log.part = grid.part and log.batch <= grid.batch
          group by all)
        select batch, 'dbserver1.public.events' as topic, part as "partition", position,
               log_end - coalesce(position, 0) as lag
        from reached""",
    "lake_replay": """
        select event_id, ts, user_id, event_type, value, props
        from (select *, row_number() over (partition by user_id order by event_id desc) as nth from events)
        where nth = 1 and event_type <> 'error'""",
}
