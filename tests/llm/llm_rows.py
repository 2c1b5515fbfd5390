"""Rows of a frame in an order of their own."""


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
