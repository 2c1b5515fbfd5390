"""Table descriptions: names, types and keys, declared or read off a header."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from rowtide.errors import SchemaError


@dataclass(frozen=True)
class TableSpec:
    """A table's name, its nullable schema and its primary-key columns."""

    name: str
    schema: StructType
    key: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        missing = [k for k in self.key if k not in self.schema.names]
        if missing:
            raise SchemaError(f"{self.name}: key columns {missing} are not in the schema")

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def as_text(self) -> StructType:
        """The same columns, all as strings: the form in which CSV and JSON text arrive."""
        return StructType([StructField(c, StringType()) for c in self.columns])


def spec_from_header(name: str, header: Sequence[str]) -> TableSpec:
    """Types from column names: ``id…`` in any case is the integer key, the rest is text.

    A second ``id…`` column would be a second primary key, so it is an error.
    """
    keys = [h for h in header if h.lower().startswith("id")]
    if len(keys) > 1:
        raise SchemaError(f"{name}: more than one key column: {keys}")
    if len(set(header)) != len(header):
        raise SchemaError(f"{name}: repeated column names in {list(header)}")
    fields = [StructField(h, IntegerType() if h in keys else StringType()) for h in header]
    return TableSpec(name, StructType(fields), tuple(keys))


# Names, columns and declared types of the shop tables, and the
# topic prefix and schema under which their changes are published.
SHOP_COLUMNS = {
    "albumy": {
        "idAlbumu": IntegerType(),
        "tytul": StringType(),
        "wykonawca": StringType(),
        "gatunek": StringType(),
        "wytwornia": StringType(),
        "dataWydania": StringType(),
        "cena": DoubleType(),
    },
    "klienci": {
        "idKlienta": IntegerType(),
        "imie": StringType(),
        "nazwisko": StringType(),
        "telefon": StringType(),
        "email": StringType(),
    },
    "zamowienia": {
        "idZamowienia": IntegerType(),
        "KlientId": StringType(),
        "AlbumId": StringType(),
        "adresDostawy": StringType(),
        "dataZlozeniaZamowienia": StringType(),
    },
}
TOPIC_PREFIX = "dbserver1"
TOPIC_SCHEMA = "public"

# The declared tables; their keys follow from their headers.
SHOP_TABLES = {
    name: TableSpec(
        name,
        StructType([StructField(column, kind) for column, kind in columns.items()]),
        spec_from_header(name, list(columns)).key,
    )
    for name, columns in SHOP_COLUMNS.items()
}


def topic_of(table: str, prefix: str = TOPIC_PREFIX, schema: str = TOPIC_SCHEMA) -> str:
    """Topic of a table: ``<prefix>.<schema>.<table>``."""
    return f"{prefix}.{schema}.{table}"
