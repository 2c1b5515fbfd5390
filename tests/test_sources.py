import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from rowtide.errors import SchemaError
from rowtide.sources import connect, files, kafka, tables
from rowtide.specs import TableSpec, spec_from_header

SPARK_ERRORS = (PySparkException, Py4JJavaError)


def put(path, text, name="t.csv"):
    file = path / name
    file.write_text(text, encoding="utf-8")
    return str(file)


def test_csv_quotes_diacritics_and_empty_cells(spark, tmp_path):
    path = put(tmp_path, 'idZ,adres,uwagi\n1,"ul. Długa 5, Łódź","mówi ""tak"""\n2,,0500\n')
    rows = files.read_csv_text(spark, path).collect()
    assert [tuple(r) for r in rows] == [
        ("1", "ul. Długa 5, Łódź", 'mówi "tak"'),
        ("2", None, "0500"),
    ]


def test_csv_backslash_is_plain_text(spark, tmp_path):
    path = put(tmp_path, 'a,b\n"x\\",y\n')
    assert tuple(files.read_csv_text(spark, path).first()) == ("x\\", "y")


def test_csv_header_types(spark, tmp_path):
    path = put(tmp_path, "idA,cena\n1,65.50\nx,95.00\n")
    spec = files.csv_specs(spark, {"t": path})["t"]
    assert [tuple(r) for r in files.read_csv_table(spark, path, spec).collect()] == [(1, "65.50"), (None, "95.00")]


def test_csv_columns_are_checked_by_name(spark, tmp_path):
    path = put(tmp_path, "a,b\n1,2\n")
    with pytest.raises(SPARK_ERRORS):
        files.read_csv_text(spark, path, ["b", "a"]).collect()


@pytest.mark.parametrize("line", ["1", "1,2,3"])
def test_csv_line_of_wrong_width_fails(spark, tmp_path, line):
    path = put(tmp_path, f"a,b\n{line}\n")
    with pytest.raises(SPARK_ERRORS):
        files.read_csv_text(spark, path).collect()


def test_csv_line_break_in_a_cell(spark, tmp_path):
    path = put(tmp_path, 'a,b\n1,"x\ny"\n')
    with pytest.raises(SPARK_ERRORS):
        files.read_csv_text(spark, path).collect()
    assert tuple(files.read_csv_text(spark, path, multiline=True).first()) == ("1", "x\ny")


def test_csv_two_id_columns(spark, tmp_path):
    with pytest.raises(SchemaError):
        files.csv_specs(spark, {"t": put(tmp_path, "idA,idB\n1,2\n")})


def test_create_table_is_idempotent(spark, tmp_path, capsys):
    spec = spec_from_header("made_once", ["idA", "b c"])
    tables.create_table(spark, spec, str(tmp_path / "made_once"))
    tables.show_tables(spark, ["made_once", "not_there"])
    shown = capsys.readouterr().out
    assert "The table is empty" in shown
    assert "Cannot read table not_there" in shown

    rows = spark.createDataFrame([("x", 1)], "`b c` string, idA int")
    tables.append_table(rows, spec)
    tables.create_table(spark, spec, str(tmp_path / "made_once"))
    assert [tuple(r) for r in tables.scan(spark, "made_once").collect()] == [(1, "x")]
    tables.show_tables(spark, ["made_once"])
    assert "x" in capsys.readouterr().out


def test_kafka_options():
    options = kafka.kafka_options("h:1", ["a", "b"], max_offsets_per_trigger=10, min_partitions=4)
    assert options == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "10",
        "minPartitions": "4",
    }
    assert kafka.kafka_options("h:1", ["a"], starting="latest")["startingOffsets"] == "latest"
    starts = kafka.kafka_options("h:1", ["a"], starting={"a": {0: 5, 1: kafka.EARLIEST_CODE}})
    assert json.loads(starts["startingOffsets"]) == {"a": {"0": 5, "1": -2}}
    with pytest.raises(ValueError):
        kafka.kafka_options("h:1", [])


def test_from_offsets(records):
    log = records(*[(f"{i}", "{}", "ab"[i % 2]) for i in range(10)])
    kept = kafka.from_offsets(log, {"a": {0: 4}})
    assert sorted(r.offset for r in kept.collect()) == [1, 3, 4, 5, 6, 7, 8, 9]
    kept = kafka.from_offsets(log, {"a": {0: 4}}, others="latest")
    assert sorted(r.offset for r in kept.collect()) == [4, 6, 8]
    kept = kafka.from_offsets(log, {"a": {0: kafka.LATEST_CODE}})
    assert sorted(r.offset for r in kept.collect()) == [1, 3, 5, 7, 9]
    kept = kafka.from_offsets(log, {"a": {0: kafka.EARLIEST_CODE}}, others="latest")
    assert sorted(r.offset for r in kept.collect()) == [0, 2, 4, 6, 8]
    with pytest.raises(ValueError):
        kafka.from_offsets(log, {}, others="now")


def test_subscribe(records):
    log = records(("1", "{}", "a"), ("2", "{}", "b"), ("3", "{}", "c"))
    assert sorted(r.topic for r in kafka.subscribe(log, ["a", "c"]).collect()) == ["a", "c"]


def test_s3a_options():
    conf = connect.s3a_options({"S3_ENDPOINT": "http://h:1", "S3_ACCESS_KEY": "k", "S3_SECRET_KEY": "s"})
    assert conf == {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.endpoint": "http://h:1",
        "spark.hadoop.fs.s3a.access.key": "k",
        "spark.hadoop.fs.s3a.secret.key": "s",
    }
    assert "spark.hadoop.fs.s3a.access.key" not in connect.s3a_options({})


def test_jdbc_options():
    env = {"POSTGRES_DB": "d", "POSTGRES_USER": "u", "POSTGRES_PASSWORD": "p"}
    options = connect.jdbc_options(env, "albumy")
    assert options["url"] == "jdbc:postgresql://localhost:5432/d"
    assert (options["dbtable"], options["user"], options["password"]) == ("albumy", "u", "p")
    assert "partitionColumn" not in options
    split = connect.jdbc_options(
        {**env, "POSTGRES_HOST": "h"}, "t", partition_column="id", bounds=(1, 9), partitions=3
    )
    assert split["url"].startswith("jdbc:postgresql://h:5432/")
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "id", "1", "9", "3",
    )
    with pytest.raises(ValueError):
        connect.jdbc_options(env, "t", partition_column="id")
    with pytest.raises(KeyError):
        connect.jdbc_options({}, "t")


def test_quoted_names(spark):
    from rowtide.operators.profile import profile

    df = spark.createDataFrame([(1, None), (2, "x")], "`a.b` int, `c``d` string")
    assert [tuple(r) for r in profile(df).collect()] == [(0, "a.b", "int", 2, 2), (1, "c`d", "string", 1, 2)]
    assert TableSpec("t", df.schema, ("a.b",)).columns == ["a.b", "c`d"]
