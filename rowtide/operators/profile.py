"""Table profile and bounded display."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.typed import quoted


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, non-NULL count and the table's row count.

    A single aggregation over the table, whatever its number of columns.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(quoted(c))).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(dtype).alias("data_type"),
            F.col(f"n{i}").alias("non_null"),
            F.col("rows").alias("row_count"),
        )
        for i, (name, dtype) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*lines)))


def display(df: DataFrame, title: str, rows: int = 20) -> None:
    """Print a heading, at most ``rows`` rows, and how many of how many that are."""
    print(f"--- {title} ---")
    held = df.count()
    if not held:
        print("[INFO] The table is empty.")
    else:
        df.show(rows, truncate=False)
        print(f"[INFO] {min(rows, held)} of {held} rows.")
