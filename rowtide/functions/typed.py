"""Text to declared types."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType, StructType


# Fixed value: the text a database column of a floating type takes. Spark's cast
# alone also takes the suffixes of literals, such as 12d and 12f.
FLOATING_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)\s*$"


def from_text(raw: Column, kind: DataType) -> Column:
    """Text as the type; NULL where it is no such value."""
    if isinstance(kind, StringType):
        return raw
    if isinstance(kind, (FloatType, DoubleType)):
        return F.when(raw.rlike(FLOATING_TEXT), raw.try_cast(kind))
    return raw.try_cast(kind)


def typed_columns(schema: StructType, source: str | None = None, strict: Collection[str] = ()) -> list[Column]:
    """One cast per declared column; text that is no such value becomes NULL.

    ``source`` names a struct column holding the text fields. In a ``strict``
    column such text fails the job instead.
    """
    out = []
    for field in schema:
        name = quoted(field.name) if source is None else f"{source}.{quoted(field.name)}"
        raw = F.col(name)
        cast = from_text(raw, field.dataType)
        if field.name in strict and cast is not raw:
            message = F.concat(F.lit(f"{field.name}: no {field.dataType.simpleString()}: "), raw)
            cast = F.when(raw.isNotNull() & cast.isNull(), F.raise_error(message)).otherwise(cast)
        out.append(cast.alias(field.name))
    return out


def bad_columns(schema: StructType) -> Column:
    """Names of the columns whose text cannot be read as the declared type."""
    checks = [
        F.when(F.col(quoted(f.name)).isNotNull() & from_text(F.col(quoted(f.name)), f.dataType).isNull(), f.name)
        for f in schema
        if not isinstance(f.dataType, StringType)
    ]
    if not checks:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*checks))


def quoted(name: str) -> str:
    """A column name safe to resolve: dots and backticks in it are literal."""
    return "`" + name.replace("`", "``") + "`"


def cols(names: Sequence[str]) -> list[Column]:
    return [F.col(quoted(n)) for n in names]


def as_text_frame(df: DataFrame) -> DataFrame:
    """Every column as a string, the form in which a CSV or a prompt delivers rows."""
    return df.select(*[F.col(quoted(c)).cast("string").alias(c) for c in df.columns])
