"""Checked queries: every operator over the given tables, each with its SQL where SQL can say it."""

from rowtide.queries import changes, decoding, streams, tables

MODULES = (tables, changes, decoding, streams)


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
