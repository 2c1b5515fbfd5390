"""Quality rules learned from labels: hashed n-grams, logistic regression, fixed thresholds."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import fit_logistic, held_out, labelled_sample, sigmoid, text_udf, words_of

SYMBOLS = tuple(b"#*$%&|<>")
MIX = np.uint64(0x9E3779B97F4A7C15)
OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


def repeated_in_windows(ids: np.ndarray, size: int = 3) -> int:
    """Words in windows of ``size`` that the text has twice or more, the first of them included."""
    n = len(ids) - size + 1
    if n < 2:
        return 0
    base = int(ids.max()) + 1
    key = ids[:n].astype(np.int64)
    for k in range(1, size):
        # Numbered anew, the windows so far are fewer than the words: the next product is exact for any text.
        key = np.unique(key, return_inverse=True)[1] if base ** (k + 1) >= 1 << 62 else key
        key = key * base + ids[k : k + n]
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[inverse] > 1
    covered = np.zeros(len(ids), bool)
    for k in range(size):
        covered[k : k + n] |= twice
    return int(covered.sum())


def copied_lines(text: str | None) -> int:
    """Lines with a word that equal an earlier line."""
    if not text:
        return 0
    seen: set[bytes] = set()
    again = 0
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        if line.split():
            again += line in seen
            seen.add(line)
    return again


def base_counts(text: str | None, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    if not words:
        return 0, 0, 0, 0, 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    joined = b"".join(words)
    # Code points are the bytes that do not continue one.
    chars = len(joined) - int(np.count_nonzero((np.frombuffer(joined, np.uint8) & 0xC0) == 0x80))
    symbols = sum(joined.count(s) for s in SYMBOLS)
    return len(words), chars, symbols, copied_lines(text), repeated_in_windows(ids)


def grams(words: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and weights of a text: hashed words, word pairs and 2- to 4-grams of code points.

    Each kind has a share of one in the text, whatever its length. A pair of
    equal words is one feature, whatever the word.
    """
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    shift = np.uint64(64 - bits)
    one = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    kinds = [one * MIX]
    if len(words) > 1:
        pair = (one[:-1] * OTHER + one[1:]) * MIX
        pair[one[:-1] == one[1:]] = OTHER
        kinds.append(pair)
    text = (b" " + b" ".join(words) + b" ").decode("utf-8", "surrogatepass")
    data = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    code = data
    for size in (2, 3, 4):
        if len(data) < size:
            break
        code = code[: len(data) - size + 1] * np.uint64(0x110001) + data[size - 1 :]
        kinds.append((code + np.uint64(size << 40)) * MIX * OTHER)
    return np.concatenate([(k >> shift).astype(np.int64) for k in kinds]), np.concatenate([np.full(len(k), 1.0 / len(k)) for k in kinds])


def counted(words: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    number, weight = grams(words, bits)
    kept, inverse = np.unique(number, return_inverse=True)
    return kept, np.bincount(inverse, weight, len(kept))


@dataclass(frozen=True)
class RuleModel:
    """Weights of the hashed n-grams, and slope and intercept of the calibration."""

    bits: int
    weights: np.ndarray
    intercept: float
    slope: float
    offset: float

    def margin(self, words: list[bytes]) -> float:
        number, weight = grams(words, self.bits)
        return float(self.weights[number] @ weight) + self.intercept

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * margins + self.offset)


def fit_sparse(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, bits: int, *, rounds: int, l2: float, rate: float) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse rows by adaptive gradient steps over all of them; classes weigh the same."""
    width = 1 << bits
    weights, intercept = np.zeros(width), 0.0
    if len(set(label.tolist())) < 2:
        return weights, intercept
    at = np.repeat(np.arange(len(rows), dtype=np.int32), [len(n) for n, _ in rows])
    number = np.concatenate([n for n, _ in rows])
    value = np.concatenate([v for _, v in rows])
    share = np.where(label == 1, 0.5 / label.sum(), 0.5 / (len(label) - label.sum()))
    past, past_intercept = np.full(width, 1e-8), 1e-8
    for _ in range(rounds):
        margin = np.bincount(at, weights[number] * value, len(rows)) + intercept
        error = share * (sigmoid(margin) - label)
        gradient = np.bincount(number, error[at] * value, width) + l2 * weights
        past += gradient**2
        weights -= rate * gradient / np.sqrt(past)
        step = error.sum()
        past_intercept += step**2
        intercept -= rate * step / np.sqrt(past_intercept)
    return weights, float(intercept)


def fit_rules(
    documents: DataFrame,
    labels: DataFrame,
    *,
    bits: int = 16,
    max_train_rows: int = 2_000,
    buckets: int = 5,
    remainder: int = 0,
    rounds: int = 120,
    l2: float = 1e-5,
    rate: float = 0.3,
) -> RuleModel:
    """A model from at most ``max_train_rows`` labelled rows that are not held out.

    The n-grams are hashed and counted on the executors; 2**``bits`` bounds
    what one text sends. A quarter of the rows, by hash, is left out of the
    regression and calibrates its margins to probabilities. Without both
    classes every probability is one half.
    """
    sample = labelled_sample(documents, labels, "quality", buckets=buckets, remainder=remainder, max_rows=max_train_rows)

    def run(texts: list[str | None]) -> dict:
        both = [counted(words_of(t), bits) for t in texts]
        return {"number": [n.astype(np.int32) for n, _ in both], "value": [v.astype(np.float32) for _, v in both]}

    hashed = text_udf(run, "number array<int>, value array<float>")
    part_of = F.pmod(F.xxhash64("doc_id"), F.lit(4)).alias("part")
    got = sample.select(part_of, "doc_id", "label", hashed(F.col("text")).alias("g")).select("part", "doc_id", "label", "g.number", "g.value").toArrow()
    got = got.sort_by([("doc_id", "ascending")])
    rows = [(n.values.to_numpy(), v.values.to_numpy()) for n, v in zip(got["number"], got["value"])]
    label, part = got["label"].to_numpy().astype(int), got["part"].to_numpy()
    learn = [r for r, p in zip(rows, part) if p]
    weights, intercept = fit_sparse(learn, label[part > 0], bits, rounds=rounds, l2=l2, rate=rate)
    check = np.array([weights[n] @ v + intercept for (n, v), p in zip(rows, part) if not p])
    truth = label[part == 0].astype(float)
    slope, offset = 1.0, 0.0
    if len(set(truth.tolist())) == 2:
        balanced = np.where(truth == 1, 0.5 / truth.sum(), 0.5 / (len(truth) - truth.sum())) * len(truth)
        slope, offset = fit_logistic(check[:, None], truth, l2=1e-3, weight=balanced)
    return RuleModel(bits, weights, intercept, float(max(slope, 1e-3)), float(offset))


def rule_columns(text: Column, model: RuleModel) -> Column:
    """A struct of the base counts and the probability of good quality, for whole texts in Arrow batches."""

    def run(texts: list[str | None]) -> dict:
        count, margin = [], []
        for t in texts:
            words = words_of(t)
            count.append(base_counts(t, words))
            margin.append(model.margin(words))
        columns = zip(*count) if count else [()] * 5
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        return {**dict(zip(names, columns)), "probability": model.probability(np.array(margin))}

    return text_udf(run, "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, probability double")(text)


def quality_rules(
    documents: DataFrame,
    labels: DataFrame,
    *,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    min_probability: float = 0.3,
    **fit,
) -> DataFrame:
    """doc_id, the base counts, base_failed, probability, kept of every row of ``documents``.

    ``kept`` is false where the base rules fail, else whether the calibrated
    probability reaches ``min_probability``. Null, empty and blank texts have
    no words, and so fail. Whole texts are counted and scored. Repeated rows
    give repeated rows, a null doc_id stays null and is never learned from.
    Empty tables give no rows; without labels the model keeps what the base
    rules keep. Other columns are ignored.
    """
    model = fit_rules(documents, labels, **fit)
    scored = documents.select("doc_id", rule_columns(F.col("text"), model).alias("r")).select("doc_id", "r.*")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= min_probability))
