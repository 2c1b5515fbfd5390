"""The log of the split stream: a batch for each part, written and taken by several tasks."""

import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

import oracle
from rowtide.queries.streams import SQL, split_batches, stream_lag, stream_split

KINDS = ("signup", "view", "click", "error", "purchase")
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def events(days):
    return [
        (i, datetime.datetime(2024, 1, day, 12), i % 7, KINDS[i % 5], float(i), f'{{"k": {i % 50}}}') for i, day in enumerate(days)
    ]


@pytest.fixture
def tables(spark, tmp_path):
    def build(days):
        folder = tmp_path / "tables"
        spark.createDataFrame(events(days), EVENTS).write.parquet(f"{folder}/events.parquet")
        return str(folder)

    return build


def sql_rows(folder, name):
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{folder}/events.parquet/*.parquet')")
    return con, SQL[name]


@pytest.mark.parametrize("query", [stream_split, stream_lag])
def test_parts_with_few_rows_or_none_are_batches(spark, tables, query):
    """None between the 9th and the 15th, one row from the 16th to the 22nd."""
    folder = tables([2] * 40 + [17] + [25, 26, 27] * 10)
    assert oracle.compare(query(spark, folder), *sql_rows(folder, query.__name__)) == []


def test_several_tasks_write_a_part_and_take_a_batch(spark, tables, tmp_path):
    folder = tables([2, 10, 17, 25] * 50)
    root = str(tmp_path / "work")
    log = split_batches(spark, folder, root)
    places = log.select(F.dayofmonth("timestamp").alias("day"), F.input_file_name().alias("file")).distinct().collect()
    per_day = {day: [p.file for p in places if p.day == day] for day in (2, 10, 17, 25)}
    assert {len(files) for files in per_day.values()} == {spark.sparkContext.defaultParallelism}
    assert len({p.file for p in places}) == len(places)
