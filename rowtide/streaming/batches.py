"""Tables written batch by batch: a batch counts once it is committed, and a batch run again changes nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from rowtide.sources.commits import is_taken, put_commit, read_commits, read_or_empty

BATCH = "batch"
COMMITS = "_commits"
NUMBERS = StructType([StructField("number", LongType())])


def write_batch(rows: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> bool:
    """Write the rows of a micro-batch to its own folder and commit it; False if that was done before.

    A batch that failed half-way left a folder without a commit. Run again, it
    replaces the folder; a committed one is not touched.
    """
    spark = rows.sparkSession
    if is_taken(spark, f"{path}/{COMMITS}", batch_id):
        return False
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{BATCH}={batch_id}")
    return put_commit(spark, f"{path}/{COMMITS}", batch_id, {})


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all committed batches and the number of their ``batch``; none before the first."""
    numbered = StructType([*schema.fields, StructField(BATCH, LongType())])
    return read_or_empty(spark, path, numbered).join(committed(spark, path), BATCH, "left_semi")


def committed(spark: SparkSession, path: str) -> DataFrame:
    """The numbers of the committed batches, as ``batch``."""
    return read_commits(spark, f"{path}/{COMMITS}", NUMBERS).withColumnRenamed("number", BATCH)
