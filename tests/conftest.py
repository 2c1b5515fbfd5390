import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from rowtide import build_session

    session = build_session(
        "tests",
        master="local[4]",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def records(spark):
    """Builds a record frame from (key, value, topic, offset) tuples."""
    import datetime

    from rowtide.operators.encode import KAFKA_SCHEMA

    def as_bytes(x):
        return x.encode() if isinstance(x, str) else x

    def build(*rows, topic="dbserver1.public.albumy"):
        stamp = datetime.datetime(2024, 3, 1, 9, 30, 0, 125000)
        full = []
        for i, row in enumerate(rows):
            key, value = row[0], row[1]
            name = row[2] if len(row) > 2 else topic
            full.append((as_bytes(key), as_bytes(value), name, 0, i, stamp, 0))
        return spark.createDataFrame(full, KAFKA_SCHEMA)

    return build
