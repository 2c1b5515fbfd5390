"""Column expressions over raw change records (key and value bytes, topic)."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operation codes and their labels, and the label for any other code.
OP_LABELS = {
    "c": "INSERT",
    "u": "UPDATE",
    "d": "DELETE",
    "r": "READ (snapshot)",
}
UNKNOWN_LABEL = "UNKNOWN (%s)"
MISSING_OP = "?"

# Prefix and names of the metadata fields inside a record's value.
META_PREFIX = "__"
OP = "__op"
TABLE = "__table"
DELETED = "__deleted"

JSON_OBJECTS = "array<map<string,variant>>"


def once(costly: Column, use: Callable[[Column], Column]) -> Column:
    """``use(costly)`` with the costly expression evaluated once, however often it is used."""
    return F.transform(F.array(costly), use)[0]


def as_text(raw: Column) -> Column:
    return raw.cast("string")


def is_tombstone(value: Column) -> Column:
    """No value: NULL, no bytes, or the JSON text ``null``."""
    text = F.trim(as_text(value))
    return value.isNull() | (F.length(value) == 0) | F.coalesce(text == "null", F.lit(False))


def is_malformed(value: Column) -> Column:
    """Neither a tombstone nor a JSON object in valid UTF-8."""
    text = as_text(value)
    broken = ~F.is_valid_utf8(text) | json_map(value).isNull()
    return ~is_tombstone(value) & broken


def json_map(raw: Column) -> Column:
    """Untyped decode of a JSON object; NULL when there are no bytes or no object.

    Field order and field types are kept. A value nested below the top level is
    kept too, but its own fields come out sorted by name.
    """
    # from_json stops after the first complete object. Read as the only element
    # of an array, text with anything behind the object does not parse.
    listed = F.concat(F.lit("["), as_text(raw), F.lit("]"))
    objects = F.from_json(listed, JSON_OBJECTS, {"allowSingleQuotes": "false"})
    return once(objects, lambda found: F.when(F.size(found) == 1, found[0]))


def strip_metadata(fields: Column) -> Column:
    """Drop the top-level fields whose name starts with ``__``; keep types and order."""
    return F.map_filter(fields, lambda name, _: ~name.startswith(META_PREFIX))


def meta_field(fields: Column, name: str) -> Column:
    """Text of one metadata field; NULL when absent or JSON null."""
    return F.try_variant_get(F.try_element_at(fields, F.lit(name)), "$", "string")


def op_label(op: Column, labels: Mapping[str, str] = OP_LABELS) -> Column:
    """Readable label of an operation code; a missing code counts as ``?``."""
    code = F.coalesce(op, F.lit(MISSING_OP))
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.try_element_at(table, code), F.format_string(UNKNOWN_LABEL, code))


def table_of_topic(topic: Column) -> Column:
    """Last dot-separated part of the topic."""
    return F.substring_index(topic, ".", -1)


def topic_name(prefix: str, schema: str, table: Column) -> Column:
    return F.concat_ws(".", F.lit(prefix), F.lit(schema), table)


def iso_millis(moment: Column) -> Column:
    """Wall-clock text such as ``2024-03-01T09:30:00.125``, in the session zone."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSS")
