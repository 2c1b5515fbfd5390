"""Quality by pairwise ranking (Bradley-Terry).

The loss is summed over all pairs of a good and a bad labelled row, whatever
their number, in passes over the rows: a function of two scores that is smooth
on the length of a cell is given to rounding by its values at the Chebyshev
points of the cells. So a pass leaves, for each class and cell, sums of the
rows' numbers at those points, and the pairs are pairs of points.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.polynomial.chebyshev import chebvander
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import fit_logistic, held_out, logit, sigmoid, store, text_udf, words_of

FEATURES = (
    "words",
    "word_bytes",
    "capitals",
    "symbols",
    "bars",
    "shouts",
    "digits",
    "odd_bytes",
    "marked_words",
    "repeats_next",
    "distinct",
    "top_word",
    "copied_lines",
    "line_words",
)

SYMBOLS = tuple(b"#*$%&<>@^~=+\\_{}[]")
WORD_END = np.isin(np.arange(256), list(b"*#$%&|<>!"))

# Points of a cell. In cells one wide the logistic function, whose poles are pi away, is exact to about 12.6 ** -14.
POINTS = np.cos((2 * np.arange(14) + 1) * np.pi / 28)
POLYNOMIALS = chebvander(POINTS, 13).T * np.where(np.arange(14) == 0, 1, 2)[:, None] / 14
# Cells of the fit of the slope, which is at most 20.
NARROW = 1 / 32
# Parts of a range of scores that are counted at once.
PARTS = 1024


def features(text: str | None) -> list[float]:
    """Style of one whole text as numbers between about 0 and 1; nothing in it depends on the text's topic."""
    words = words_of(text)
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    joined = b" ".join(words)
    count = np.bincount(np.frombuffer(joined, np.uint8), minlength=256).tolist()
    length = max(1, len(joined) - n + 1)
    capitals = sum(count[65:91])
    letters = max(1, capitals + sum(count[97:123]))
    tally = Counter(words)
    same_next = sum(map(operator.eq, words, words[1:]))
    # A word ends before a space, and at the end.
    byte = np.frombuffer(joined + b" ", np.uint8)
    marked = int(np.count_nonzero(WORD_END[byte[:-1]] & (byte[1:] == 32)))
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    return [
        min(1.0, math.log1p(n) / 10),
        min(1.0, length / n / 20),
        max(0.0, capitals / letters - 0.1),
        min(1.0, sum(count[c] for c in SYMBOLS) / n),
        min(1.0, count[124] / n),
        min(1.0, count[33] / n),
        sum(count[48:58]) / length,
        (sum(count[:9]) + sum(count[14:32]) + count[127]) / length,
        marked / n,
        same_next / n,
        # A longer text repeats more of its words: compare with the root of its length.
        min(1.0, len(tally) / n**0.8),
        max(tally.values()) / n,
        1.0 - len(set(lines)) / max(1, len(lines)),
        min(1.0, n / max(1, len(lines)) / 200),
    ]


@dataclass(frozen=True)
class QualityModel:
    """Scores of texts; ``cut`` is the raw score at the quantile of the rejection rate, where the score is ``at_cut``."""

    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    cut: float
    steep: float
    at_cut: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        # Row by row in the same order, so that a score does not depend on the rows beside it.
        return ((rows - self.centre) / self.scale * self.weights).sum(axis=1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.steep * (self.raw(rows) - self.cut) + logit(self.at_cut))

    def column(self, text: Column) -> Column:
        """The score of a whole text, null and empty ones included."""

        def run(texts: list[str | None]) -> dict[str, np.ndarray]:
            rows = np.array([features(t) for t in texts], float).reshape(len(texts), len(FEATURES))
            return {"score": self.score(rows)}

        return text_udf(run, "score double")(text).getField("score")


def quantile_cut(raw: np.ndarray, weight: np.ndarray, rate: float) -> float:
    """A value with ``rate`` of the weight below it: the quantile of the scores.

    Every value between two neighbouring scores is that; taken is one nearer to
    the lower, so that clean texts of a new kind stay.
    """
    order = np.argsort(raw, kind="stable")
    below = np.cumsum(weight[order])
    k = int(np.searchsorted(below, rate * below[-1] * (1 + 1e-12), side="right"))
    return between(raw[order][max(k - 1, 0)], raw[order][min(k, len(raw) - 1)])


def between(low: float, high: float) -> float:
    return float(low + 0.35 * (high - low))


def fit_pairs(
    rows: np.ndarray, label: np.ndarray, *, at_cut: float, pairs: int, seed: int, l2: float, weight: np.ndarray | None = None
) -> QualityModel:
    """Bradley-Terry scores from compared pairs of a few rows at hand; ``fit_quality`` compares all pairs of a table.

    P(i preferred to j) = sigmoid(s_i - s_j), s linear in the features. Every document of the rarer class meets others of the other class in turn
    until ``pairs`` comparisons are made. The cut is the quantile of the scores
    at the share of documents labelled 0, with ``weight`` the labelled rows that
    each one stands for. Without both classes there is nothing to compare and
    all scores are equal, above the threshold.
    """
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    centre, scale = rows.mean(0) if len(rows) else np.zeros(len(FEATURES)), np.ones(len(FEATURES))
    if not len(good) or not len(bad):
        return QualityModel(np.zeros(len(FEATURES)), centre, scale, -1.0, 1.0, at_cut)
    scale = np.maximum(rows.std(0), 0.02)
    z = (rows - centre) / scale
    rng = np.random.default_rng(seed)
    count = min(pairs, len(good) * len(bad))
    i = rng.permuted(np.resize(good, count))
    j = np.resize(rng.permutation(bad), count)
    # Each pair once in either order: a symmetric problem, so the intercept is zero.
    diff = z[i] - z[j]
    both = np.concatenate([diff, -diff])
    won = np.concatenate([np.ones(count), np.zeros(count)])
    weights = fit_logistic(both, won, l2=l2)[:-1]
    raw = z @ weights
    weight = np.ones(len(raw)) if weight is None else weight
    cut = quantile_cut(raw, weight, weight[bad].sum() / weight.sum())
    steep = fit_logistic((raw - cut)[:, None], label.astype(float), l2=1e-4)[0]
    return QualityModel(weights, centre, scale, cut, float(np.clip(steep, 0.05, 20)), at_cut)


def labelled_features(documents: DataFrame, labels: DataFrame, *, buckets: int, remainder: int) -> DataFrame:
    """Label and features ``f`` of every labelled row that is not held out, one for each id."""
    usable = labels.select(F.col("doc_id").alias("doc_id"), F.col("quality").cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"), buckets, remainder)
    )
    one = usable.groupBy("doc_id").agg(F.max("label").alias("label"))
    style = text_udf(lambda texts: {"f": [features(t) for t in texts]}, "f array<double>")
    learned = documents.select("doc_id", "text").where(~held_out(F.col("doc_id"), buckets, remainder))
    styled = learned.select("doc_id", style(F.col("text")).getField("f").alias("f"), F.md5("text").alias("digest"))
    # Rows that repeat an id are one: the text with the smallest digest, whatever their order; without one, no text.
    kept = styled.groupBy("doc_id").agg(F.min_by("f", "digest").alias("f"))
    empty = F.array(*[F.lit(x) for x in features(None)])
    return kept.join(one, "doc_id").select("label", F.coalesce("f", empty).alias("f"))


def rows_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("f").flatten().to_numpy().reshape(-1, len(FEATURES))


def sums_at_points(
    table: DataFrame, task: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], width: float
) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By label: points on the scale of scores, and the sums there of every row's numbers.

    ``task`` gives scores and numbers of some rows. For a function that is
    smooth on the length ``width``, the sum of function times numbers over the
    rows is that over the points. Each task adds up its own rows, and those
    sums are added for each class and cell; the driver gets them for the cells
    that hold a score.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            label = batch.column("label").to_numpy()
            score, numbers = task(rows_of(batch))
            cell = np.floor(score / width).astype(np.int64)
            shares = chebvander(2 * (score / width - cell) - 1, len(POINTS) - 1) @ POLYNOMIALS
            for key in set(zip(label.tolist(), cell.tolist())):
                here = (label == key[0]) & (cell == key[1])
                total[key] = total.get(key, 0.0) + shares[here].T @ numbers[here]
        if total:
            label, cell = zip(*total)
            yield pa.RecordBatch.from_pydict(
                {"label": pa.array(label, pa.int32()), "cell": pa.array(cell, pa.int64()), "sums": [t.tobytes() for t in total.values()]}
            )

    def merged(group: pa.Table) -> pa.Table:
        # In an order of their own, so that the sum does not depend on which task ended first.
        total = np.sum([np.frombuffer(s) for s in sorted(group.column("sums").to_pylist())], axis=0)
        return group.slice(0, 1).set_column(2, "sums", pa.array([total.tobytes()], pa.binary()))

    schema = "label int, cell long, sums binary"
    got = table.mapInArrow(partial, schema).groupBy("label", "cell").applyInArrow(merged, schema).collect()
    found = {}
    for label in (0, 1):
        cells = sorted((r.cell, bytes(r.sums)) for r in got if r.label == label)
        at = np.concatenate([(cell + (POINTS + 1) / 2) * width for cell, _ in cells])
        found[label] = at, np.concatenate([np.frombuffer(s).reshape(len(POINTS), -1) for _, s in cells])
    return found


def pair_loss(
    sums: dict[int, tuple[np.ndarray, np.ndarray]], weights: np.ndarray, l2: float
) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean over all pairs of -log P(good preferred to bad) with its penalty, and its first and second derivatives.

    The numbers of a row are one, its features, and their products by twos.
    """
    (low, bad), (high, good) = sums[0], sums[1]
    k = len(weights)
    pairs = good[:, 0].sum() * bad[:, 0].sum()
    loss, gradient, hessian = 0.0, np.zeros(k), np.zeros((k, k))
    # Some good points against all bad ones at once.
    for at in range(0, len(high), 256):
        some = good[at : at + 256]
        apart = low[None, :] - high[at : at + 256, None]
        wrong = sigmoid(apart)
        bend = wrong * (1 - wrong)
        loss += some[:, 0] @ np.logaddexp(0, apart) @ bad[:, 0]
        gradient += (some[:, 0] @ wrong) @ bad[:, 1 : k + 1] - (wrong @ bad[:, 0]) @ some[:, 1 : k + 1]
        cross = some[:, 1 : k + 1].T @ bend @ bad[:, 1 : k + 1]
        squares = (some[:, 0] @ bend) @ bad[:, k + 1 :] + (bend @ bad[:, 0]) @ some[:, k + 1 :]
        hessian += squares.reshape(k, k) - cross - cross.T
    return (
        float(loss / pairs + 0.5 * l2 * weights @ weights),
        gradient / pairs + l2 * weights,
        hessian / pairs + l2 * np.eye(k),
    )


def least_pair_loss(table: DataFrame, centre: np.ndarray, scale: np.ndarray, l2: float, rounds: int = 40) -> np.ndarray:
    """The weights with the least loss over all pairs, by Newton's method; a pass over the rows for each step."""

    def at(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def task(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            z = (rows - centre) / scale
            products = (z[:, :, None] * z[:, None, :]).reshape(len(z), -1)
            return z @ weights, np.column_stack([np.ones(len(z)), z, products])

        return pair_loss(sums_at_points(table, task, 1.0), weights, l2)

    weights = np.zeros(len(centre))
    now, gradient, hessian = at(weights)
    for _ in range(rounds):
        step, part = np.linalg.solve(hessian, gradient), 1.0
        tried = at(weights - step)
        while part > 1e-6 and tried[0] > now:
            part /= 2
            tried = at(weights - part * step)
        if tried[0] > now:
            break
        weights = weights - part * step
        was, (now, gradient, hessian) = now, tried
        if was - now < 1e-9 * was:
            break
    return weights


def neighbours(scores: DataFrame, k: int) -> tuple[float, float]:
    """The k-th smallest ``raw`` and the next one, by counting in ranges that get narrower; ``k`` is 1 at least and less than the rows."""
    low, high = scores.agg(F.min("raw"), F.max("raw")).first()
    before = 0
    while low < high:
        place = F.least(F.floor((F.col("raw") - low) / (high - low) * PARTS), F.lit(PARTS - 1))
        counts = scores.where(F.col("raw").between(low, high)).groupBy(place.alias("place"))
        parts = sorted(counts.agg(F.count(F.lit(1)).alias("n"), F.min("raw").alias("least"), F.max("raw").alias("most")).collect())
        for i, part in enumerate(parts):
            if before + part.n == k:
                return part.most, parts[i + 1].least
            if before + part.n > k:
                low, high = part.least, part.most
                break
            before += part.n
    return low, high


def fit_quality(
    documents: DataFrame,
    labels: DataFrame,
    *,
    threshold: float = 0.3,
    buckets: int = 5,
    remainder: int = 0,
    l2: float = 1e-4,
) -> QualityModel:
    """A model from all pairs of a good and a bad labelled row that are not held out; every such row counts.

    Bradley-Terry scores: P(i preferred to j) = sigmoid(s_i - s_j), s linear in
    the features, with the least loss over all pairs. The cut is the quantile of
    all scores at the share of rows labelled 0. Features are computed once, and
    stored; sums of them come to the driver, no row does. Without both classes
    there is nothing to compare and all scores are equal, above the threshold.
    """
    table = store(labelled_features(documents, labels, buckets=buckets, remainder=remainder), "quality-features")
    each = [F.col("f")[k] for k in range(len(FEATURES))]
    bad, good, *stats = table.agg(
        F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1), *map(F.avg, each), *map(F.stddev_pop, each)
    ).first()
    if not bad or not good:
        return QualityModel(np.zeros(len(each)), np.zeros(len(each)), np.ones(len(each)), -1.0, 1.0, threshold)
    centre, scale = np.array(stats[: len(each)]), np.maximum(stats[len(each) :], 0.02)
    weights = least_pair_loss(table, centre, scale, l2)
    raw = QualityModel(weights, centre, scale, 0.0, 1.0, threshold).raw

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"raw": raw(rows_of(batch))})

    cut = between(*neighbours(store(table.mapInArrow(scored, "raw double"), "quality-scores"), bad))
    sums = sums_at_points(table, lambda rows: (raw(rows) - cut, np.ones((len(rows), 1))), NARROW)
    at = np.concatenate([sums[k][0] for k in (0, 1)])
    label = np.repeat([0.0, 1.0], [len(sums[k][0]) for k in (0, 1)])
    steep = fit_logistic(at[:, None], label, l2=1e-4, weight=np.concatenate([sums[k][1][:, 0] for k in (0, 1)]))[0]
    return QualityModel(weights, centre, scale, cut, float(np.clip(steep, 0.05, 20)), threshold)


def quality_scores(documents: DataFrame, labels: DataFrame, *, threshold: float = 0.3, **fit) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 if score >= ``threshold``) of every row of ``documents``.

    Scores look at the whole text only. Null, empty and blank texts have the
    score of a text without words; equal texts have equal scores; repeated rows
    give repeated rows; a null id counts as held out. Empty tables give no
    rows, and without labels every document scores above the threshold. Other
    columns are ignored, whatever their names.
    """
    model = fit_quality(documents, labels, threshold=threshold, **fit)
    scored = documents.select("doc_id", model.column(F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), fit.get("buckets", 5), fit.get("remainder", 0)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, labels: DataFrame, *, threshold: float = 0.3, **fit) -> DataFrame:
    """The rows of ``documents``, unchanged, whose quality score reaches the threshold.

    Decided by the whole text alone: rows with equal texts stay or go together,
    also where their doc_id is null or repeats, and null, empty and blank texts
    by the score of a text without words. Without labels every row stays. An
    empty table gives no rows; all columns are kept, whatever their names.
    """
    model = fit_quality(documents, labels, threshold=threshold, **fit)
    return documents.where(model.column(documents["text"]) >= threshold)
