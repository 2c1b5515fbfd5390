"""Change records as the texts a reader sees."""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from rowtide.functions.records import META_PREFIX, MISSING_OP, OP, TABLE

# Tasks carry this module's code with them, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Indent of a record's fields and the line between two messages.
INDENT = 4
RULE = "-" * 80

TOMBSTONE, CHANGE, MALFORMED = "tombstone", "change", "malformed"
SHOWN = "kind string, key string, record string, op string, `table` string"


def shown(key: bytes | None, value: bytes | None) -> tuple[str, str | None, str | None, str | None, str | None]:
    """kind, key text, record text, operation and table of one record.

    Any JSON is taken as a key, only an object as a value. Fields keep their
    order, nested ones too; numbers are shown in their shortest form.
    """
    try:
        key_text = str(loaded(key))
    except (ValueError, RecursionError):
        return MALFORMED, None if key is None else bytes(key).decode("utf-8", "replace"), None, None, None
    try:
        fields = loaded(value)
    except (ValueError, RecursionError):
        return MALFORMED, printable(key_text), None, None, None
    if fields is None:
        return TOMBSTONE, printable(key_text), None, None, None
    if not isinstance(fields, dict):
        return MALFORMED, printable(key_text), None, None, None
    kept = {name: item for name, item in fields.items() if not name.startswith(META_PREFIX)}
    text = json.dumps(kept, ensure_ascii=False, indent=INDENT)
    op, table = fields.get(OP), fields.get(TABLE)
    # A JSON null counts as absent.
    return (
        CHANGE,
        printable(key_text),
        printable(text),
        MISSING_OP if op is None else printable(str(op)),
        None if table is None else printable(str(table)),
    )


def loaded(raw: bytes | None) -> object:
    return json.loads(bytes(raw).decode("utf-8")) if raw else None


def printable(text: str) -> str:
    """Half a surrogate pair, which JSON can spell, is no text: a question mark."""
    return text.encode("utf-8", "replace").decode("utf-8")


def shown_record() -> Callable[[Column, Column], Column]:
    """``shown`` over Arrow batches. How numbers and nested fields look is JSON's affair, which no built-in function has."""

    @F.pandas_udf(SHOWN)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for keys, values in batches:
            rows = [shown(k, v) for k, v in zip(keys, values)]
            yield pd.DataFrame(rows, columns=["kind", "key", "record", "op", "table"], dtype=object)

    return run
