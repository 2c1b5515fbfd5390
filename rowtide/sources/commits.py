"""Numbered commits: small JSON files, each number taken once, by whoever creates its file first."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def put_commit(spark: SparkSession, folder: str, number: int, content: Mapping) -> bool:
    """Create the commit of that number; False if there is one.

    Its text tells it from any other, so a writer that lost the answer to its
    own request recognises its commit.
    """
    text = json.dumps({**content, "number": number, "writer": uuid.uuid4().hex})
    fs, path = _file(spark, folder, number)
    if fs.getScheme() == "file":
        return _put_local(path.toUri().getPath(), text)
    try:
        # Exclusive on a distributed file system; on an object store the option asks for a conditional write.
        out = fs.createFile(path).overwrite(False).opt("fs.option.create.conditional.overwrite", "true").recursive().build()
        out.write(bytearray(text, "utf-8"))
        out.close()
    except Py4JJavaError:
        if not fs.exists(path):
            raise
        return read_commit(spark, folder, number) == json.loads(text)
    return True


def _put_local(path: str, text: str) -> bool:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    draft = f"{os.path.dirname(path)}/_{uuid.uuid4().hex}"
    with open(draft, "x", encoding="utf-8") as f:
        f.write(text)
    try:
        # A link appears with its whole content, and only if the name is free.
        os.link(draft, path)
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)
    return True


def last_commit(spark: SparkSession, folder: str) -> int:
    """The highest number; 0 if there is none. Numbers have no gaps, so a few looks are enough."""
    low, high = 0, 1
    while _exists(spark, folder, high):
        low, high = high, 2 * high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if _exists(spark, folder, middle) else (low, middle)
    return low


def is_taken(spark: SparkSession, folder: str, number: int) -> bool:
    return _exists(spark, folder, number)


def read_commit(spark: SparkSession, folder: str, number: int) -> dict:
    """The content of one commit."""
    _, path = _file(spark, folder, number)
    return json.loads(spark.read.option("wholetext", "true").text(path.toString()).first().value)


def read_commits(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """All commits, one row each; none where nothing was ever committed."""
    return read_or_empty(spark, folder, schema, "json")


def read_or_empty(spark: SparkSession, path: str, schema: StructType, kind: str = "parquet") -> DataFrame:
    try:
        return spark.read.schema(schema).format(kind).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _file(spark: SparkSession, folder: str, number: int):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{number:012d}.json")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _exists(spark: SparkSession, folder: str, number: int) -> bool:
    fs, path = _file(spark, folder, number)
    return fs.exists(path)
