"""Decoding, record by record."""

import datetime
import math

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from rowtide.functions import records as rec
from rowtide.operators import decode as dec
from rowtide.plans.monitor import messages
from rowtide.specs import SHOP_TABLES, TableSpec

SPARK_ERRORS = (PySparkException, Py4JJavaError)

SMALL = TableSpec(
    "albumy",
    StructType(
        [
            StructField("idAlbumu", IntegerType()),
            StructField("tytul", StringType()),
            StructField("cena", DoubleType()),
        ]
    ),
    ("idAlbumu",),
)

NOTHING = (None, None, None)

# (value, declared types, all text then cast)
EDGE_CASES = [
    ('{"idAlbumu":1,"tytul":"T","cena":1.5}', (1, "T", 1.5), (1, "T", 1.5)),
    ('{"idAlbumu":1,"tytul":"T","cena":"89.99"}', (1, "T", None), (1, "T", 89.99)),
    ('{"idAlbumu":1,"cena":"NaN"}', (1, None, math.nan), (1, None, math.nan)),
    ('{"idAlbumu":1,"cena":"Infinity"}', (1, None, math.inf), (1, None, math.inf)),
    ('{"idAlbumu":1,"cena":"-INF"}', (1, None, -math.inf), (1, None, -math.inf)),
    ('{"idAlbumu":"1","tytul":"T"}', (None, "T", None), (1, "T", None)),
    ('{"idAlbumu":3000000000,"tytul":"T"}', (None, "T", None), (None, "T", None)),
    ('{"idAlbumu":1.0,"tytul":"T"}', (None, "T", None), (None, "T", None)),
    ('{"idAlbumu":1,"tytul":13}', (1, "13", None), (1, "13", None)),
    ('{"idAlbumu":1,"tytul":{"x":1}}', (1, '{"x":1}', None), (1, '{"x":1}', None)),
    ('{"IDALBUMU":1,"Tytul":"T"}', NOTHING, NOTHING),
    ('{"idAlbumu":1,"more":true,"__op":"c"}', (1, None, None), (1, None, None)),
    ('{"before":null,"after":{"idAlbumu":1}}', NOTHING, NOTHING),
    ('{"idAlbumu":1,"cena":"abc"}', (1, None, None), (1, None, None)),
    ('{"idAlbumu":1', NOTHING, NOTHING),
    ("not json", NOTHING, NOTHING),
    ("null", NOTHING, NOTHING),
    ("42", NOTHING, NOTHING),
    ("[1,2]", NOTHING, NOTHING),
    ("", NOTHING, NOTHING),
    (None, NOTHING, NOTHING),
]


def same(a, b):
    return all(x == y or (isinstance(x, float) and isinstance(y, float) and x != x and y != y) for x, y in zip(a, b))


@pytest.mark.parametrize("coerce", [False, True])
def test_edge_cases(records, coerce):
    df = dec.decode(records(*[(None, v) for v, *_ in EDGE_CASES]), SMALL, coerce=coerce, keep_source=True)
    rows = {r.kafka_offset: r for r in df.collect()}
    for i, (value, declared, coerced) in enumerate(EDGE_CASES):
        got = (rows[i].idAlbumu, rows[i].tytul, rows[i].cena)
        wanted = coerced if coerce else declared
        assert same(got, wanted), value


def test_lake_layout(records):
    df = dec.decode(records(("{}", "{}")), SHOP_TABLES["albumy"])
    assert df.dtypes == [
        ("idAlbumu", "int"),
        ("tytul", "string"),
        ("wykonawca", "string"),
        ("gatunek", "string"),
        ("wytwornia", "string"),
        ("dataWydania", "string"),
        ("cena", "double"),
        ("kafka_timestamp", "timestamp"),
        ("processed_at", "timestamp"),
    ]


def test_times(records):
    row = dec.decode(records(("{}", None)), SMALL).first()
    assert row.kafka_timestamp == datetime.datetime(2024, 3, 1, 9, 30, 0, 125000)
    assert row.processed_at is not None


def test_processing_time_is_one_constant(records):
    df = dec.decode(records(*[("{}", "{}")] * 50), SMALL)
    assert df.select("processed_at").distinct().count() == 1


@pytest.mark.parametrize("coerce", [False, True])
def test_keep_meta_and_source(records, coerce):
    value = '{"idAlbumu":1,"__op":"d","__table":"albumy","__deleted":"true"}'
    row = dec.decode(records(('{"idAlbumu":1}', value)), SMALL, coerce=coerce, keep_meta=True, keep_source=True).first()
    assert (row["__op"], row["__table"], row["__deleted"]) == ("d", "albumy", "true")
    assert bytes(row.kafka_key) == b'{"idAlbumu":1}'
    assert (row.kafka_topic, row.kafka_partition, row.kafka_offset) == ("dbserver1.public.albumy", 0, 0)


BROKEN = ['{"a":1', "text", "42", "[1]", '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}', "{'a':1}", b'{"a":"\xff"}']
FINE = ['{"a":1}', ' {"a":1} ', "{}", "", None, "null", '{"cena":"x"}']


def test_quarantine(records):
    good, bad = dec.quarantine(records(*[(None, v) for v in BROKEN + FINE]))
    assert sorted(r.offset for r in bad.collect()) == list(range(len(BROKEN)))
    assert sorted(r.offset for r in good.collect()) == list(range(len(BROKEN), len(BROKEN) + len(FINE)))


@pytest.mark.parametrize("coerce", [False, True])
def test_tagged_in_one_pass(records, coerce):
    df = dec.decode(records(*[(None, v) for v in BROKEN + FINE]), SMALL, coerce=coerce, keep_source=True, on_malformed=dec.TAG)
    rows = {r.kafka_offset: r for r in df.collect()}
    assert [i for i, r in sorted(rows.items()) if r.malformed is not None] == list(range(len(BROKEN)))
    assert all(rows[i].idAlbumu is None and rows[i].tytul is None for i in range(len(BROKEN)))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2 and plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


@pytest.mark.parametrize("value", BROKEN)
def test_failfast(records, value):
    with pytest.raises(SPARK_ERRORS):
        dec.decode(records((None, value)), SMALL, on_malformed=dec.FAILFAST).collect()


def test_failfast_lets_other_type_errors_pass(records):
    df = dec.decode(records(*[(None, v) for v in FINE]), SMALL, on_malformed=dec.FAILFAST)
    assert df.count() == len(FINE)


def test_unknown_policy(records):
    with pytest.raises(ValueError):
        dec.decode(records(("{}", "{}")), SMALL, on_malformed="drop")


@pytest.mark.parametrize(
    "value,label",
    [
        ('{"__op":"c"}', "INSERT"),
        ('{"__op":"u"}', "UPDATE"),
        ('{"__op":"d"}', "DELETE"),
        ('{"__op":"r"}', "READ (snapshot)"),
        ('{"__op":"t"}', "UNKNOWN (t)"),
        ('{"__op":""}', "UNKNOWN ()"),
        ("{}", "UNKNOWN (?)"),
        ('{"__op":null}', "UNKNOWN (?)"),
    ],
)
def test_op_label(records, value, label):
    assert dec.describe(records((None, value))).first().op_label == label


def test_table_fallback(records):
    log = records((None, '{"__table":"x"}'), (None, "{}"), (None, "{}", "plain"), (None, '{"__table":null}'))
    tables = {r.offset: r.table for r in dec.describe(log).collect()}
    assert tables == {0: "x", 1: "albumy", 2: "plain", 3: "albumy"}


def test_tombstones(records):
    log = records((None, None), (None, ""), (None, "null"), (None, " null "), (None, "{}"), (None, "x"))
    flags = {r.offset: r.t for r in log.select("offset", rec.is_tombstone(F.col("value")).alias("t")).collect()}
    assert flags == {0: True, 1: True, 2: True, 3: True, 4: False, 5: False}


def test_stripping_keeps_order_and_types(records):
    value = '{"b":1,"__op":"c","a":"1","n":null,"__x":2,"t":true,"_y":1.5}'
    record = dec.describe(records((None, value))).select(F.to_json("record")).first()[0]
    assert record == '{"b":1,"a":"1","n":null,"t":true,"_y":1.5}'


def test_fields_as_rows(records):
    log = records((None, '{"b":1,"__op":"c","a":"1"}'), (None, "{}"), (None, None), (None, "x"))
    fields = dec.record_fields(dec.describe(log), ["offset"])
    assert [(r.offset, r.name) for r in fields.collect()] == [(0, "b"), (0, "a")]
    plan = fields._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_message(records):
    value = (
        '{"idKlienta":9,"imie":"Zoë \\"Z\\"","n":null,"d":1.0,"e":1e5,"i":12345678901234567890,"__op":"c",'
        '"__table":"klienci","__deleted":"false"}'
    )
    shown = messages(records(('{"idKlienta":9}', value)), ["dbserver1.public.albumy"], stamp=False)
    assert shown.first().message == (
        "\n[klienci] INSERT\n  key   : {'idKlienta': 9}\n  record: {\n"
        '    "idKlienta": 9,\n    "imie": "Zoë \\"Z\\"",\n    "n": null,\n    "d": 1.0,\n    "e": 100000.0,\n'
        '    "i": 12345678901234567890\n}\n' + "-" * 80
    )


def test_message_of_a_tombstone_and_an_empty_record(records):
    log = records(('{"a":"x","b":null,"c":true}', None), (None, '{"__op":"u"}'))
    texts = [r.message for r in messages(log, ["dbserver1.public.albumy"], stamp=False).orderBy("offset").collect()]
    assert texts[0] == (
        "\n[dbserver1.public.albumy] TOMBSTONE | key={'a': 'x', 'b': None, 'c': True}\n" + "-" * 80
    )
    assert texts[1] == "\n[albumy] UPDATE\n  key   : None\n  record: {}\n" + "-" * 80


def test_message_of_a_malformed_record(records):
    log = records(('{"a":1}', "{broken"), (None, "42"))
    texts = [r.message for r in messages(log, ["dbserver1.public.albumy"], stamp=False).orderBy("offset").collect()]
    assert texts[0].startswith("\n[dbserver1.public.albumy] MALFORMED | key={'a': 1} value={broken\n")
    assert "key=None value=42" in texts[1]


@pytest.mark.parametrize("text", ["plain", "it's", 'say "x"', "it's \"x\"", "a\\b", "line\nbreak", "zażółć"])
def test_key_text_reads_as_a_literal(records, text):
    import json

    shown = messages(records((json.dumps({"k": text}), None)), ["dbserver1.public.albumy"], stamp=False).first()
    assert f"key={ {'k': text}!r}" in shown.message


def test_stamped_message(records):
    import re

    text = messages(records(("{}", "{}")), ["dbserver1.public.albumy"]).first().message
    assert re.match(r"\n\[\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}\] \[albumy\] UNKNOWN", text)
    text = messages(records(("{}", None)), ["dbserver1.public.albumy"]).first().message
    assert re.match(r"\n\[\d{4}-\d\d-\d\dT[\d:]+\.\d{3}\]\[dbserver1\.public\.albumy\] TOMBSTONE", text)


def test_decode_plan_has_no_shuffle_and_one_parse(records, spark):
    df = dec.decode(records(("{}", "{}")), SHOP_TABLES["albumy"], coerce=True)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
