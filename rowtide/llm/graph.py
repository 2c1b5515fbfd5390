"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import store


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node; root is the smallest node it reaches.

    ``links`` has two columns of one orderable type. Alternates the large-star
    and small-star steps until nothing changes, which takes about log(nodes)
    rounds. A step is a minimum per node (reduced before the shuffle) joined
    back to the links, so that a node with very many links is split by adaptive
    execution; neighbours are never gathered in a row. Each round is written to
    the shared folder, which cuts the lineage. Null ends and self-links are
    ignored; no links give no rows.
    """
    a, b = links.columns
    links = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    tree = store(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "links",
    )
    seen = checksum(tree)
    while True:
        tree = store(small_star(large_star(tree)), "links")
        now = checksum(tree)
        if now == seen:
            return roots(tree)
        seen = now


def large_star(tree: DataFrame) -> DataFrame:
    both = tree.unionAll(tree.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.where(F.col("v") > F.col("u")).join(low, "u")
    return moved.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(tree: DataFrame) -> DataFrame:
    low = tree.groupBy("u").agg(F.min("v").alias("m"))
    moved = tree.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def checksum(tree: DataFrame) -> tuple:
    row = tree.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def roots(tree: DataFrame) -> DataFrame:
    """At the end each node has one link, to its root."""
    own = tree.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return tree.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(own)
