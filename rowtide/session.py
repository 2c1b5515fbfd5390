"""Session setup and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2"
S3A_PACKAGE = "org.apache.hadoop:hadoop-aws:3.4.2"

# Correctness needs the fixed zone. Adaptive execution re-plans joins and
# partition counts from the sizes it sees; fair scheduling keeps streams of one
# session from waiting for each other. spark.sql.shuffle.partitions is left to
# the cluster.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str,
    *,
    master: str | None = None,
    packages: tuple[str, ...] = (),
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """One builder for every job: base settings, connector packages, then ``conf``.

    ``conf`` wins over the base settings; pass ``s3a_options(os.environ)`` for an
    object store.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if packages:
        settings["spark.jars.packages"] = ",".join(packages)
    settings.update(conf or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can reach.

    Without that setting the context's checkpoint folder is used, and without
    that there is none: a folder of one machine would be lost to the others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/rowtide/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows, written to the shared work folder at once and read back.

    For a small result that decides how a large table is joined: read back, its
    size is known when the join is planned, so Spark broadcasts it if it fits
    and need not shuffle the large table to find out. It also is computed once
    only, and survives the loss of an executor.
    """
    path = f"{work_dir(df.sparkSession, purpose)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
