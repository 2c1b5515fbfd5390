"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.session import work_dir

# What separates words in every contract here: space and the controls 0x09 to 0x0D.
# bytes.split() without arguments splits at exactly these.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def words_of(text: str | None) -> list[bytes]:
    """The words of a whole text, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_count(text: Column) -> Column:
    """Words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def fold(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % buckets


def held_out(doc_id: Column, buckets: int, remainder: int) -> Column:
    """Whether the row is kept from learning; a row without an id is."""
    return F.coalesce(fold(doc_id, buckets) == remainder, F.lit(True))


def store(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared work folder and read back: lineage ends here."""
    path = f"{work_dir(df.sparkSession, purpose)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"



def parts_of(texts: list[str | None], characters: int = 1 << 20) -> Iterator[list[str | None]]:
    """The texts in order, in lists of about so many characters; a longer text is a list of its own."""
    part: list[str | None] = []
    size = 0
    for t in texts:
        if part and size + len(t or "") > characters:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t or "")
    if part:
        yield part


def text_udf(score: Callable[[list[str | None]], dict[str, Sequence]], schema: str) -> Callable[[Column], Column]:
    """A column function over whole texts in Arrow batches.

    ``score`` gets lists of bounded size, so what it holds at once does not
    depend on the rows of a batch.
    """

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out: dict[str, list] = {}
            for part in parts_of([t if isinstance(t, str) else None for t in texts]):
                for name, values in score(part).items():
                    out.setdefault(name, []).extend(values)
            yield pd.DataFrame(out or score([]))

    return run


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    *,
    buckets: int,
    remainder: int,
    max_rows: int,
) -> DataFrame:
    """Text, label and weight of at most ``max_rows`` labelled rows that are not held out, one for each id.

    The rows are the first by a hash of their id, the same at each run; a class
    gets half of the room, so that a rare class is not lost; ``weight`` is how
    many labelled rows of its class a row stands for. Only the chosen ids, at
    most ``max_rows`` of three numbers, are broadcast to the scan of the texts.
    """
    usable = labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"), buckets, remainder)
    )
    one = usable.groupBy("doc_id").agg(F.max("label").alias("label"))
    held = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    halves = []
    for k in (0, 1):
        rows, most = held.get(k, 0), max_rows // 2
        half = first_by_hash(one.where(F.col("label") == k), ["doc_id"], rows, most)
        halves.append(half.withColumn("weight", F.lit(rows / max(1, min(rows, most)))))
    chosen = F.broadcast(store(halves[0].unionAll(halves[1]), "labels"))
    found = documents.select("doc_id", "text").join(chosen, "doc_id")
    # Rows that repeat an id are one: the text with the smallest digest, whatever their order.
    kept = found.groupBy("doc_id", "label", "weight").agg(F.min_by("text", F.md5("text")).alias("text"))
    return kept.select("doc_id", "text", "label", "weight")


def first_by_hash(rows: DataFrame, keys: Sequence[str], total: int, most: int) -> DataFrame:
    """The first ``most`` of ``total`` rows in the order of a hash of their ``keys``.

    Of many rows those beyond the hash that about half as many again pass are
    left out first, so that the task which orders the rest gets few of them.
    """
    by = F.xxhash64(*keys)
    share = (1.5 * most + 1000) / max(1, total)
    if share < 1:
        rows = rows.where(by < F.lit(int(share * (1 << 64)) - (1 << 63)))
    return rows.orderBy(by, *keys).limit(most)


def spread_join(left: DataFrame, right: DataFrame, on: str, copies: int = 16) -> DataFrame:
    """An inner join on a column unique in ``right``: a key that many rows of ``left`` share is dealt to several tasks."""
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*[c for c in left.columns if c != on]), F.lit(copies)).cast("int"))
    every = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return salted.join(every, [on, "_salt"]).drop("_salt")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * np.clip(x, -60, 60)))


def fit_logistic(x: np.ndarray, y: np.ndarray, *, l2: float = 1e-3, weight: np.ndarray | None = None, rounds: int = 40) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; the last one is the intercept, not penalised."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    c = np.ones(len(z)) if weight is None else weight
    ridge = np.full(z.shape[1], l2 * c.sum())
    ridge[-1] = 1e-9 * max(1.0, c.sum())

    def loss(v: np.ndarray) -> float:
        m = z @ v
        return float(c @ (np.logaddexp(0, m) - y * m) + 0.5 * (ridge * v) @ v)

    now = loss(w)
    for _ in range(rounds):
        p = sigmoid(z @ w)
        gradient = z.T @ (c * (p - y)) + ridge * w
        hessian = (z * (c * p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        scale = 1.0
        while scale > 1e-6 and loss(w - scale * step) > now:
            scale /= 2
        w = w - scale * step
        was, now = now, loss(w)
        if was - now < 1e-9 * max(1.0, abs(was)):
            break
    return w


def logit(p: float) -> float:
    return math.log(p / (1 - p))


def merge_labels(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Add the links ``left``-``right`` to component labels (the smallest index), in place."""
    while True:
        a, b = label[left], label[right]
        open_ = a != b
        if not open_.any():
            return
        left, right = left[open_], right[open_]
        low, high = np.minimum(a[open_], b[open_]), np.maximum(a[open_], b[open_])
        np.minimum.at(label, high, low)
        while True:
            after = label[label]
            if (after == label).all():
                break
            label[:] = after
