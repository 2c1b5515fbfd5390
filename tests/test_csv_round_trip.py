"""CSV text in Python's own writer's form, read back cell by cell."""

import csv

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rowtide.queries.tables import write_csv
from rowtide.sources.files import read_csv_text

SLOW = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
cell = st.text("aą,;'\"\\ \t0.#", max_size=6)
lined = st.text("aą,\"\\ \n", max_size=6)


def in_order(rows):
    """Sorted rows; an empty cell is NULL."""
    return sorted([tuple(c or None for c in row) for row in rows], key=lambda r: [c or "" for c in r])


def rows_of(cells):
    return st.lists(st.tuples(cells, cells, cells), min_size=1, max_size=8)


@pytest.mark.parametrize("multiline", [False, True])
@SLOW
@given(data=st.data())
def test_reads_what_another_writer_wrote(spark, tmp_path_factory, multiline, data):
    rows = data.draw(rows_of(lined if multiline else cell))
    path = tmp_path_factory.mktemp("csv") / "t.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f, lineterminator="\n", quoting=csv.QUOTE_ALL)
        writer.writerow(["id", "a b", "c"])
        writer.writerows(rows)
    got = read_csv_text(spark, str(path), multiline=multiline)
    assert got.columns == ["id", "a b", "c"]
    assert in_order(got.collect()) == in_order(rows)


@SLOW
@given(rows_of(cell))
def test_round_trip(spark, tmp_path_factory, rows):
    df = spark.createDataFrame(rows, "id string, a string, c string")
    path = write_csv(df, str(tmp_path_factory.mktemp("csv") / "t"))
    assert in_order(read_csv_text(spark, path, df.columns).collect()) == in_order(rows)
