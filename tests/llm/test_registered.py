"""The corpus queries are there when the folder is: a broken import would hide them all."""

import __spark_entry__ as contract
from rowtide.llm.queries import llm_queries, llm_sql


def test_every_corpus_query_is_registered():
    names = set(contract.queries())
    assert {q.split("_")[0] for q in llm_queries()} == {f"op{n}" for n in range(1, 14)}
    assert set(llm_queries()) | {"pipeline"} <= names
    assert set(llm_sql()) <= set(contract.oracle_sql())
