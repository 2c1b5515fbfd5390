"""Connection options read from environment variables; no secret is ever a literal."""

from __future__ import annotations

from collections.abc import Mapping


def s3a_options(env: Mapping[str, str]) -> dict[str, str]:
    """Spark settings for an S3-compatible object store.

    Reads S3_ENDPOINT, S3_ACCESS_KEY and S3_SECRET_KEY. Without keys the
    cluster's own credential provider is used.
    """
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": "true",
    }
    named = {
        "S3_ENDPOINT": "spark.hadoop.fs.s3a.endpoint",
        "S3_ACCESS_KEY": "spark.hadoop.fs.s3a.access.key",
        "S3_SECRET_KEY": "spark.hadoop.fs.s3a.secret.key",
    }
    conf.update({setting: env[name] for name, setting in named.items() if env.get(name)})
    return conf


def jdbc_options(
    env: Mapping[str, str],
    table: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of ``format("jdbc")`` for a PostgreSQL table.

    Reads POSTGRES_HOST (default ``localhost``), POSTGRES_DB, POSTGRES_USER and
    POSTGRES_PASSWORD; the port is 5432. Give a numeric column, its bounds and a
    number of partitions to read a large table with several tasks.
    """
    missing = [n for n in ("POSTGRES_DB", "POSTGRES_USER", "POSTGRES_PASSWORD") if not env.get(n)]
    if missing:
        raise KeyError(f"not set: {', '.join(missing)}")
    options = {
        "url": f"jdbc:postgresql://{env.get('POSTGRES_HOST') or 'localhost'}:5432/{env['POSTGRES_DB']}",
        "driver": "org.postgresql.Driver",
        "dbtable": table,
        "user": env["POSTGRES_USER"],
        "password": env["POSTGRES_PASSWORD"],
        "fetchsize": str(fetch_size),
    }
    split = (partition_column, bounds, partitions)
    if any(x is not None for x in split):
        if any(x is None for x in split):
            raise ValueError("partition_column, bounds and partitions go together")
        low, high = bounds
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return options
