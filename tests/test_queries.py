"""Every query of the library against its SQL, on the smallest tables."""

import __spark_entry__ as contract
import pytest

import oracle
from rowtide.queries import all_queries, all_sql


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_sql(spark, sf_dir, con, name):
    df = contract.queries()[name](spark, sf_dir)
    assert oracle.compare(df, con, contract.oracle_sql()[name]) == []


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 1000
    assert "processed" in df.columns


def test_every_query_has_sql():
    assert set(all_sql()) == set(all_queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
