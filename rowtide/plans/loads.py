"""Loads of several tables in one commit, and keyed inserts into them.

A load writes below ``<root>/<table>/load_part=<id and a unique part>`` and is
visible once a commit in ``<root>/load_commits`` names that folder, for all its
tables at once. An aborted load leaves files that no reader looks at.

Several writers may run side by side. A commit takes the number after the last
one its writer has seen. If another writer took it, the keys are checked again
against what is committed by then, and the next number is tried: of two
writers of one key, one is accepted.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from rowtide.errors import LoadError
from rowtide.functions.typed import cols
from rowtide.operators import inserts
from rowtide.sources.commits import last_commit, put_commit, read_commits, read_or_empty
from rowtide.sources.files import BLOCK_FILE, BLOCK_START, csv_specs, read_csv_table
from rowtide.specs import TableSpec

COMMITS = "load_commits"
PART = "load_part"
# Where a row stood when it was loaded, besides its block: the number of its commit and its place in the pass.
NUMBER, ROW = "load_number", "load_row"
ORDINAL = "ordinal"
COMMIT_SCHEMA = StructType(
    [
        StructField("number", LongType()),
        StructField("load_id", StringType()),
        StructField(PART, StringType()),
        StructField("tables", ArrayType(StringType())),
    ]
)
LOADED = [
    StructField(inserts.REASON, StringType()),
    StructField(BLOCK_FILE, StringType()),
    StructField(BLOCK_START, LongType()),
    StructField(ROW, LongType()),
    StructField(PART, StringType()),
]


def commits(spark: SparkSession, root: str) -> DataFrame:
    """The committed loads, numbered in their order."""
    return read_commits(spark, f"{root}/{COMMITS}", COMMIT_SCHEMA)


def is_committed(spark: SparkSession, root: str, load_id: str) -> bool:
    return not commits(spark, root).where(F.col("load_id") == load_id).isEmpty()


def read_table(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The rows of all committed loads of a table; none when it was never loaded."""
    return _committed(spark, root, spec, "left_semi").select(*cols(spec.columns))


def read_in_order(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The rows of ``read_table`` and ``ordinal``, which numbers them from 1 in the order they were loaded.

    Loads count in the order of their commits, the files of a load in the order
    of their paths, rows as they stand in their file. Rows keep the block of a
    file they came from and their place in the task that read it, so the ordinal
    is a sum over the blocks before, one row each, and no row is sorted. Rows of
    an insert come in the order its tasks wrote them, and its rejected rows
    leave gaps.
    """
    rows = _committed(spark, root, spec, "inner")
    block = [NUMBER, BLOCK_FILE, BLOCK_START]
    blocks = rows.groupBy(*block).agg(F.min(ROW).alias("_first"), (F.max(ROW) - F.min(ROW) + 1).alias("_rows"))
    earlier = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    ordinal = F.col("_before") + F.col(ROW) - F.col("_first") + 1
    return rows.join(blocks, block).select(*cols(spec.columns), ordinal.alias(ORDINAL))


def load_csv_tables(
    spark: SparkSession,
    files: Mapping[str, str],
    root: str,
    load_id: str,
    *,
    specs: Mapping[str, TableSpec] | None = None,
    multiline: bool = False,
) -> bool:
    """Load (table -> CSV path) in one commit, once; False when the id is committed already.

    Types come from the headers unless ``specs`` is given. A key that is missing,
    not of its type, repeated, or already in a table fails the load for all
    tables, and so does any other cell that is not of its column's type.
    """
    _check_id(load_id)
    seen = last_commit(spark, f"{root}/{COMMITS}")
    if is_committed(spark, root, load_id):
        return False
    specs = specs or csv_specs(spark, files)
    part = _new_part(load_id)

    def stage(table: str) -> None:
        spec = specs[table]
        # Bad keys are counted below, for a message that covers the whole load.
        strict = set(spec.columns) - set(spec.key)
        rows = read_csv_table(spark, files[table], spec, multiline=multiline, strict=strict, blocks=True)
        _stage(rows.withColumn(ROW, F.monotonically_increasing_id()), root, table, part)

    # One job for each table, side by side: a small table does not wait for a large one.
    with ThreadPoolExecutor(max(1, len(files))) as pool:
        list(pool.map(stage, files))

    def checked() -> str | None:
        if is_committed(spark, root, load_id):
            return None
        problems = _key_problems(spark, root, [specs[table] for table in files], part)
        if problems:
            raise LoadError("; ".join(problems))
        return part

    return _commit(spark, root, load_id, list(files), seen, checked) is not None


def insert_rows(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    incoming_text: DataFrame,
    load_id: str,
    arrival: Sequence[str] = (),
) -> DataFrame:
    """Insert text rows into a loaded table; returns the rejected rows with their reason.

    The judged batch is written once, rejected rows with their reason, which
    readers of the table leave out. So accepted and rejected rows come from one
    evaluation, also when a task is run again.
    """
    _check_id(load_id)
    seen = last_commit(spark, f"{root}/{COMMITS}")

    def judged() -> str:
        if is_committed(spark, root, load_id):
            raise LoadError(f"load {load_id} is committed already")
        part = _new_part(load_id)
        verdicts = inserts.insertable(read_table(spark, root, spec), incoming_text, spec, arrival)
        placed = verdicts.withColumns(
            {
                BLOCK_FILE: F.lit(""),
                BLOCK_START: F.spark_partition_id().cast("long"),
                ROW: F.monotonically_increasing_id(),
            }
        )
        _stage(placed, root, spec.name, part)
        return part

    part = _commit(spark, root, load_id, [spec.name], seen, judged)
    kinds = {f.name: f for f in [*incoming_text.schema, *spec.schema, LOADED[0]]}
    kept = StructType([kinds[c] for c in [*spec.columns, *arrival, inserts.REASON]])
    return inserts.rejected(spark.read.schema(kept).parquet(_part_path(root, spec.name, part)))


def _committed(spark: SparkSession, root: str, spec: TableSpec, how: str) -> DataFrame:
    """The accepted rows of all committed loads, with what places them."""
    rows = read_or_empty(spark, f"{root}/{spec.name}", StructType([*spec.schema.fields, *LOADED]))
    return rows.where(F.col(inserts.REASON).isNull()).join(commits(spark, root).select(F.col("number").alias(NUMBER), PART), PART, how)


def _check_id(load_id: str) -> None:
    """An id is part of a folder's name, so it has only what a name keeps as it is."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", load_id):
        raise LoadError(f"load id {load_id!r} is not made of letters, digits, dot, dash and underscore")


def _new_part(load_id: str) -> str:
    """A folder value of its own for every try; no id makes it a name that means something else."""
    return f"{load_id}.{uuid.uuid4().hex}"


def _part_path(root: str, table: str, part: str) -> str:
    return f"{root}/{table}/{PART}={part}"


def _stage(df: DataFrame, root: str, table: str, part: str) -> None:
    df.write.mode("overwrite").parquet(_part_path(root, table, part))


def _commit(
    spark: SparkSession,
    root: str,
    load_id: str,
    tables: list[str],
    seen: int,
    checked: Callable[[], str | None],
) -> str | None:
    """Commit the part that ``checked`` found good, with the number after ``seen``.

    ``seen`` was read before the check, so a number that is still free means
    that nothing was committed in between. Otherwise the check runs again. None
    when there is nothing to commit.
    """
    while True:
        part = checked()
        if part is None:
            return None
        if put_commit(spark, f"{root}/{COMMITS}", seen + 1, {"load_id": load_id, PART: part, "tables": tables}):
            return part
        seen = last_commit(spark, f"{root}/{COMMITS}")


def _key_problems(spark: SparkSession, root: str, specs: list[TableSpec], part: str) -> list[str]:
    """What is wrong with the staged keys, counted for all tables in one job."""
    counts = []
    for spec in specs:
        if not spec.key:
            continue
        key = cols(spec.key)
        staged = spark.read.schema(spec.schema).parquet(_part_path(root, spec.name, part))
        per_key = staged.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        missing = reduce(or_, [k.isNull() for k in key])
        held = read_table(spark, root, spec).select(*key)
        known = held.join(per_key.where(~missing).select(*key), list(spec.key), "left_semi")
        counts.append(
            per_key.agg(
                F.lit(spec.name).alias("table"),
                F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("missing"),
                F.count_if(~missing & (F.col("n") > 1)).alias("repeated"),
                F.lit(0).cast("long").alias("known"),
            )
        )
        none = F.lit(0).cast("long")
        counts.append(known.agg(F.lit(spec.name), none, none, F.count(F.lit(1))))
    if not counts:
        return []
    problems = []
    for r in reduce(DataFrame.unionAll, counts).where("missing + repeated + known > 0").collect():
        found = {"rows without a usable key": r.missing, "repeated keys": r.repeated, "keys already loaded": r.known}
        problems += [f"{r.table}: {n} {what}" for what, n in found.items() if n]
    return problems
