"""Catalog tables: create, scan, display."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from rowtide.errors import SchemaError
from rowtide.functions.typed import cols, quoted
from rowtide.operators.profile import display
from rowtide.specs import TableSpec


def create_table(spark: SparkSession, spec: TableSpec, location: str | None = None) -> None:
    """Create the Parquet table unless it exists; an existing one is left alone."""
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in spec.schema)
    place = " LOCATION '" + location.replace("'", "\\'") + "'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(spec.name)} ({columns}) USING parquet{place}")


def append_table(df: DataFrame, spec: TableSpec) -> None:
    """Append rows, bound by column name whatever the order of the stored table's columns."""
    stored = df.sparkSession.table(quoted(spec.name)).columns
    if set(stored) != set(spec.columns):
        raise SchemaError(f"{spec.name}: stored columns {stored} are not {spec.columns}")
    # insertInto binds by position.
    df.select(*cols(stored)).write.mode("append").insertInto(quoted(spec.name))


def scan(spark: SparkSession, name: str) -> DataFrame | None:
    """All rows of a table, or None when there is no such table."""
    return spark.table(quoted(name)) if spark.catalog.tableExists(quoted(name)) else None


def scan_all(spark: SparkSession, names: Iterable[str]) -> dict[str, DataFrame | None]:
    return {name: scan(spark, name) for name in names}


def show_tables(spark: SparkSession, names: Iterable[str], rows: int = 20) -> None:
    """Display the tables in turn; a missing one is reported and the rest still shown."""
    for name, df in scan_all(spark, names).items():
        if df is None:
            print(f"[ERROR] Cannot read table {name}: no such table")
        else:
            display(df, name, rows)
