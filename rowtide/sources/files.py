"""CSV and Parquet scans."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rowtide.functions.typed import typed_columns
from rowtide.specs import TableSpec, spec_from_header

# RFC quoting: a quote inside a quoted cell is doubled, not backslashed.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}

# Columns that say which block of which file a row was read from.
BLOCK_FILE, BLOCK_START = "load_file", "load_start"


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file; Spark reads the first line only."""
    return spark.read.options(**CSV_OPTIONS).csv(path).columns


def read_csv_text(
    spark: SparkSession,
    path: str,
    header: list[str] | None = None,
    *,
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header, every cell as its text, an empty cell as NULL.

    Columns are checked against the header by name, and a line with too few or
    too many cells fails the read. A line break inside a quoted cell needs
    ``multiline``, which keeps Spark from splitting a file between tasks;
    without it such a line fails instead of being read wrongly.
    """
    names = csv_header(spark, path) if header is None else header
    schema = StructType([StructField(name, StringType()) for name in names])
    return (
        spark.read.schema(schema)
        .options(**CSV_OPTIONS, enforceSchema="false", mode="FAILFAST", multiLine=str(multiline).lower())
        .csv(path)
    )


def read_csv_table(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    *,
    multiline: bool = False,
    strict: Collection[str] = (),
    blocks: bool = False,
) -> DataFrame:
    """CSV read as the declared types; text that is no such value becomes NULL.

    In a ``strict`` column such text fails the read. ``blocks`` adds the path of
    a row's file and where the block of the file begins that it was read with.
    """
    text = read_csv_text(spark, path, spec.columns, multiline=multiline)
    origin = {BLOCK_FILE: "file_path", BLOCK_START: "file_block_start"} if blocks else {}
    placed = [F.col(f"_metadata.{field}").alias(name) for name, field in origin.items()]
    return text.select(*typed_columns(spec.schema, strict=strict), *placed)


def csv_specs(spark: SparkSession, files: Mapping[str, str]) -> dict[str, TableSpec]:
    """Header-driven specs for a (table -> CSV path) map."""
    return {table: spec_from_header(table, csv_header(spark, path)) for table, path in files.items()}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
