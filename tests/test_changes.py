"""Change feeds, envelopes, records and replay."""

import datetime
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from rowtide.errors import SchemaError
from rowtide.operators import changes
from rowtide.operators.decode import decode
from rowtide.operators.encode import KAFKA_SCHEMA, to_records
from rowtide.operators.replay import apply_changes, latest, replay, replay_rows
from rowtide.plans.capture import change_log, snapshot_log
from rowtide.specs import SHOP_TABLES, TableSpec

SPARK_ERRORS = (PySparkException, Py4JJavaError)
SPEC = TableSpec(
    "t",
    StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("price", DoubleType())]),
    ("id",),
)
FEW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows, spec=SPEC):
    return spark.createDataFrame(rows, spec.schema)


def feed(spark, old, new, **options):
    rows = changes.change_feed(frame(spark, old), frame(spark, new), SPEC, **options).collect()
    return sorted((r.op, tuple(r.before) if r.before else None, tuple(r.after) if r.after else None) for r in rows)


@pytest.mark.parametrize("trusted", [False, True])
def test_change_feed(spark, trusted):
    old = [(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (4, None, None), (5, "e", float("nan"))]
    new = [(1, "a", 1.0), (2, "b", 2.0), (4, None, None), (5, "e", float("nan")), (6, None, None)]
    assert feed(spark, old, new, trusted_keys=trusted) == [
        ("c", None, (6, None, None)),
        ("d", (3, "c", 3.0), None),
        ("u", (2, "b", None), (2, "b", 2.0)),
    ]


@pytest.mark.parametrize("trusted", [False, True])
def test_a_changed_key_is_a_delete_and_a_create(spark, trusted):
    assert [r[0] for r in feed(spark, [(1, "a", 1.0)], [(2, "a", 1.0)], trusted_keys=trusted)] == ["c", "d"]


@pytest.mark.parametrize("rows", [[(1, "a", 1.0), (1, "a", 1.0)], [(None, "a", 1.0)]])
@pytest.mark.parametrize("side", [0, 1])
def test_bad_keys_fail(spark, rows, side):
    states = [[(9, "z", 9.0)], [(9, "z", 9.0)]]
    states[side] = states[side] + rows
    with pytest.raises(SPARK_ERRORS):
        feed(spark, *states)


def test_a_very_common_key_fails_without_being_gathered(spark):
    copies = spark.range(50_000).select(F.lit(1).alias("id"), F.lit("x").alias("name"), F.lit(1.0).alias("price"))
    df = changes.change_feed(copies, frame(spark, []), SPEC)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_first" in plan and "Join" not in plan and "Window" not in plan
    with pytest.raises(SPARK_ERRORS):
        df.collect()


def test_change_feed_has_one_shuffle(spark):
    df = changes.change_feed(frame(spark, [(1, "a", 1.0)]), frame(spark, [(2, "a", 1.0)]), SPEC)
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_a_feed_needs_a_key(spark):
    with pytest.raises(SchemaError):
        changes.change_feed(frame(spark, []), frame(spark, []), TableSpec("t", SPEC.schema))


def test_compound_key(spark):
    spec = TableSpec("t", SPEC.schema, ("id", "name"))
    old, new = frame(spark, [(1, "a", 1.0), (1, "b", 1.0)]), frame(spark, [(1, "a", 2.0), (2, "b", 1.0)])
    assert sorted(r.op for r in changes.change_feed(old, new, spec).collect()) == ["c", "d", "u"]


def test_snapshot_flatten_and_include(spark):
    reads = changes.snapshot_reads(frame(spark, [(1, "a", 1.0)]), SPEC)
    row = reads.first()
    assert (row.op, row.before, tuple(row.after)) == ("r", None, (1, "a", 1.0))
    flat = changes.flatten(reads, "t").first()
    assert flat.asDict() == {"id": 1, "name": "a", "price": 1.0, "__op": "r", "__table": "t", "__deleted": "false"}
    tables = spark.createDataFrame([("a",), ("b",), ("c",)], "table string")
    assert sorted(r.table for r in changes.include_tables(tables, ["a", "c"]).collect()) == ["a", "c"]


def test_records_of_a_delete(spark):
    envelopes = changes.change_feed(frame(spark, [(3, "c", None)]), frame(spark, []), SPEC)
    rows = changes.flatten(envelopes, "t").withColumn("n", F.lit(7))
    records = to_records(rows, ["id"], "p.s.t", "n", tombstones=True)
    assert [(f.name, f.dataType) for f in records.schema] == [(f.name, f.dataType) for f in KAFKA_SCHEMA]
    got = sorted((r.offset, bytes(r.key), r.value and bytes(r.value).decode()) for r in records.collect())
    assert got == [
        (14, b'{"id":3}', '{"id":3,"name":"c","price":null,"__op":"d","__table":"t","__deleted":"true"}'),
        (15, b'{"id":3}', None),
    ]


def test_a_key_stays_in_its_partition(spark):
    rows = spark.range(200).select((F.col("id") % 20).cast("int").alias("id"), F.col("id").alias("n"))
    records = to_records(rows, ["id"], "t", "n", partitions=5)
    spread = records.groupBy("key").agg(F.count_distinct("partition").alias("parts"), F.max("partition").alias("p"))
    assert {r.parts for r in spread.collect()} == {1}
    assert spread.select("p").distinct().count() > 1


WIDE = StructType(
    [
        StructField("id", LongType()),
        StructField("text", StringType()),
        StructField("real", DoubleType()),
        StructField("flag", BooleanType()),
        StructField("amount", DecimalType(18, 4)),
        StructField("naive", TimestampNTZType()),
        StructField("zoned", TimestampType()),
    ]
)
moments = st.datetimes(datetime.datetime(1900, 1, 1), datetime.datetime(2199, 1, 1))
wide_rows = st.lists(
    st.tuples(
        st.integers(-(2**63), 2**63 - 1),
        st.none() | st.text(st.characters(codec="utf-8", exclude_categories=("Cs",)), max_size=12),
        st.none() | st.floats(allow_nan=False),
        st.none() | st.booleans(),
        st.none() | st.decimals(-(10**13), 10**13, places=4),
        st.none() | moments,
        st.none() | moments,
    ),
    max_size=15,
)


@FEW
@given(wide_rows)
def test_decode_inverts_encode(spark, rows):
    spec = TableSpec("t", WIDE, ("id",))
    df = spark.createDataFrame(rows, WIDE)
    records = to_records(df.withColumn("n", F.col("id")), ["id"], "t", "n")
    back = decode(records, spec).select(*WIDE.names)
    key = lambda r: repr(tuple(r))
    assert sorted(map(tuple, back.collect()), key=key) == sorted(map(tuple, df.collect()), key=key)


state = st.dictionaries(
    st.integers(0, 12), st.tuples(st.none() | st.text("aąż'\"\\,{}", max_size=4), st.none() | st.floats(-9, 9)), max_size=10
)


@FEW
@given(state, state, state)
def test_replay_inverts_the_feed(spark, first, second, third):
    """Two steps of changes on a snapshot, replayed from shuffled JSON records."""
    a, b, c = (frame(spark, [(k, *v) for k, v in s.items()]) for s in (first, second, third))
    log = snapshot_log(a, SPEC).unionAll(change_log(a, b, SPEC, 1)).unionAll(change_log(b, c, SPEC, 2))
    got = sorted(map(tuple, replay(log, SPEC).collect()))
    assert got == sorted((k, *v) for k, v in third.items())
    if third:
        assert replay(log.orderBy(F.rand(7)), SPEC).count() == len(third)


@FEW
@given(state, state)
def test_applied_changes_give_the_new_state(spark, first, second):
    a, b = (frame(spark, [(k, *v) for k, v in s.items()]) for s in (first, second))
    moved = apply_changes(a, change_log(a, b, SPEC, 1), SPEC)
    assert sorted(map(tuple, moved.collect())) == sorted((k, *v) for k, v in second.items())


def test_apply_changes_record_by_record(spark, records):
    state = frame(spark, [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (4, None, None)])
    log = records(
        ('{"id":1}', '{"id":1,"name":"a2","price":9.5,"__op":"u"}'),
        ('{"id":2}', None),
        ('{"id":3}', '{"id":3,"name":"c","__op":"d"}'),
        ('{"id":5}', '{"id":5,"name":"e","__op":"c"}'),
        ('{"id":6}', '{"id":6,"__op":"d"}'),
    )
    wanted = [(1, "a2", 9.5), (4, None, None), (5, "e", None)]
    for coerce in (False, True):
        assert sorted(map(tuple, apply_changes(state, log, SPEC, coerce=coerce).collect())) == wanted
    with pytest.raises(SPARK_ERRORS):
        apply_changes(state, records(("{}", None)), SPEC).collect()


def test_a_large_state_is_not_shuffled_for_few_changes(spark, records, tmp_path):
    rows = spark.range(20_000).select(F.col("id").cast("int"), F.lit("x").alias("name"), F.lit(1.0).alias("price"))
    rows.write.parquet(str(tmp_path / "state"))
    moved = apply_changes(spark.read.parquet(str(tmp_path / "state")), records(('{"id":7}', None)), SPEC)
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert moved.count() == 19_999


def test_replay_without_tombstones(spark, records):
    log = records(
        ('{"id":1}', '{"id":1,"name":"a","price":"1.5","__op":"c"}'),
        ('{"id":2}', '{"id":2,"name":"b","__op":"r"}'),
        ('{"id":1}', '{"id":1,"name":"a2","price":"2.5","__op":"u"}'),
        ('{"id":2}', '{"id":2,"name":"b","__op":"d","__deleted":"true"}'),
        ('{"id":3}', '{"id":3,"name":"no op"}'),
    )
    assert sorted(map(tuple, replay(log, SPEC).collect())) == [(1, "a2", 2.5), (3, "no op", None)]
    assert [r.price for r in replay(log, SPEC, coerce=False).orderBy("id").collect()] == [None, None]


def test_a_deleted_key_can_come_back(spark, records):
    log = records(
        ('{"id":1}', '{"id":1,"name":"a","__op":"c"}'),
        ('{"id":1}', '{"id":1,"name":"a","__op":"d"}'),
        ('{"id":1}', None),
        ('{"id":1}', '{"id":1,"name":"again","__op":"c"}'),
    )
    assert [r.name for r in replay(log, SPEC).collect()] == ["again"]


def test_replay_needs_keys(records):
    with pytest.raises(SPARK_ERRORS):
        replay(records((None, "{}")), SPEC).collect()


@pytest.mark.parametrize("value", ["{cut", '{"id":"x","name":"a"}', '{"name":"a"}', "42"])
def test_replay_fails_on_a_last_record_without_a_row(records, value):
    with pytest.raises(SPARK_ERRORS):
        replay(records(('{"id":1}', value)), SPEC).collect()
    later = records(('{"id":1}', value), ('{"id":1}', '{"id":1}'))
    assert replay(later, SPEC).count() == 1


def test_replay_rows(spark):
    rows = spark.createDataFrame(
        [(1, "a", "c", 1, 5), (1, "b", "u", 2, 0), (2, "c", "c", 1, 1), (2, "c", "d", 1, 2), (3, "x", None, 1, 1)],
        "id int, name string, __op string, day int, n int",
    )
    got = replay_rows(rows, ["id"], ["day", "n"])
    assert got.columns == ["id", "name"]
    assert sorted(map(tuple, got.collect())) == [(1, "b"), (3, "x")]


def test_latest_against_brute_force(spark):
    """A third of all rows on one key."""
    rng = random.Random(5)
    rows = [(0 if rng.random() < 0.33 else rng.randrange(1, 300), n, rng.random()) for n in range(5000)]
    rng.shuffle(rows)
    wanted = {}
    for key, n, x in rows:
        wanted[key] = max(wanted.get(key, (-1, 0)), (n, x))
    df = spark.createDataFrame(rows, "k int, n int, x double").repartition(8)
    got = latest(df, ["k"], ["n"])
    assert {r.k: (r.n, r.x) for r in got.collect()} == wanted
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_latest_of_rows_without_an_order(spark):
    df = spark.createDataFrame([(1, 1, {"a": "x"}), (1, 2, {"a": "y"})], "k int, n int, m map<string,string>")
    assert [r.m for r in latest(df, ["k"], ["n"]).collect()] == [{"a": "y"}]


def test_replay_parses_each_key_once_and_only_the_last_values(spark, records):
    log = records(('{"id":1}', "{}"))
    plan = replay(log, SPEC)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Aggregate", 1)
    assert above.count("from_json(") == 1 and below.count("from_json(") == 1


@pytest.mark.parametrize("mark", ['"__deleted":"true"', '"__op":"d"', '"__op":"u","__deleted":"true"'])
def test_either_mark_deletes(spark, records, mark):
    log = records(('{"id":1}', '{"id":1,"name":"a"}'), ('{"id":2}', '{"id":2,"name":"b"}'), ('{"id":1}', '{"id":1,"name":"a",%s}' % mark))
    assert [r.id for r in replay(log, SPEC).collect()] == [2]
    assert [r.id for r in apply_changes(frame(spark, [(1, "x", 1.0)]), log, SPEC).collect()] == [2]
    rows = spark.createDataFrame([(1, "a", "false", 1), (1, "a", "true", 2), (2, "b", None, 1)], "id int, name string, __deleted string, n int")
    assert [tuple(r) for r in replay_rows(rows, ["id"], ["n"]).collect()] == [(2, "b")]


@pytest.mark.parametrize("coerce", [True, False])
def test_a_key_is_the_same_however_it_is_spelled(spark, records, coerce):
    log = records(('{"id":1}', '{"id":1,"name":"a"}'), ('{ "id": 1 }', '{"id":1,"name":"b"}'), ('{"more":0,"id":1}', '{"id":1,"name":"c"}'))
    assert [(r.id, r.name) for r in replay(log, SPEC, coerce=coerce).collect()] == [(1, "c")]
    moved = apply_changes(frame(spark, [(1, "x", 1.0), (2, "y", 2.0)]), log, SPEC, coerce=coerce)
    assert sorted((r.id, r.name) for r in moved.collect()) == [(1, "c"), (2, "y")]


def test_compound_keys_in_any_order(spark, records):
    spec = TableSpec("t", SPEC.schema, ("id", "name"))
    log = records(('{"id":1,"name":"a"}', '{"id":1,"name":"a","price":1}'), ('{"name":"a","id":1}', '{"id":1,"name":"a","price":2}'))
    assert [r.price for r in replay(log, spec).collect()] == [2.0]


def test_shop_tables_round_trip(spark):
    spec = SHOP_TABLES["zamowienia"]
    old = spark.createDataFrame([(1, "1", "2", "ul. Długa 5, Łódź", "2024-03-01")], spec.schema)
    new = spark.createDataFrame([(1, "1", "2", "ul. Nowa 1", "2024-03-01"), (2, None, "9", "", "x")], spec.schema)
    log = snapshot_log(old, spec).unionAll(change_log(old, new, spec, 1))
    assert sorted(map(tuple, replay(log, spec).collect())) == sorted(map(tuple, new.collect()))
    assert {r.topic for r in log.collect()} == {"dbserver1.public.zamowienia"}


def test_bucketed_tables_are_compared_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, price in (("bucketed_old", 1.0), ("bucketed_new", 2.0)):
            df = spark.range(100).select(F.col("id").cast("int"), F.lit("x").alias("name"), F.lit(price).alias("price"))
            df.write.bucketBy(4, "id").sortBy("id").saveAsTable(name, mode="overwrite")
        old, new = spark.table("bucketed_old"), spark.table("bucketed_new")
        df = changes.change_feed(old, new, SPEC, trusted_keys=True)
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.where("op = 'u'").count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_replay_of_a_stream(spark, records, tmp_path):
    """In complete mode every batch gives the state after all records so far."""
    from rowtide.sources.kafka import append_log, stored_stream

    log = str(tmp_path / "log")
    append_log(records(('{"id":1}', '{"id":1,"name":"a","__op":"c"}'), ('{"id":2}', '{"id":2,"__op":"c"}')), log)
    job = (
        replay(stored_stream(spark, log), SPEC)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("replayed")
        .option("checkpointLocation", str(tmp_path / "check"))
        .start()
    )
    try:
        job.processAllAvailable()
        assert sorted(r.id for r in spark.table("replayed").collect()) == [1, 2]
        later = records(*[("{}", "{}")] * 5, ('{"id":1}', '{"id":1,"name":"b","__op":"u"}'), ('{"id":2}', None))
        append_log(later.where("offset >= 5"), log)
        job.processAllAvailable()
        assert sorted(map(tuple, spark.table("replayed").collect())) == [(1, "b", None)]
    finally:
        job.stop()
