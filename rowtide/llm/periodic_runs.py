"""Runs of repeating words, by an enhanced suffix array and the branching-tandem test.

Texts are handled in parts of bounded size inside a map-only pass. All texts of
a part share one suffix array, over word ids of their own, so that nothing
matches across texts:

1. prefix doubling sorts the suffixes; a round looks at those only that are not
   told apart yet, and keeps their ranks, from which the LCP array follows;
2. the LCP array splits into intervals; of the two sides that an LCP value of
   depth d separates, the suffixes i of the smaller are tested: is suffix i + d
   or i - d on the other side, by the inverse suffix array? Then a square of
   period d starts at the smaller of the two, and the word behind it breaks it
   (it is branching: the two suffixes differ after d words);
3. such a square ends a run. Rotating it to the left while the words d apart are
   equal gives where the run starts; squares of several periods that give one
   stretch are merged to the smallest.

No tree is built: intervals are borders found by jumping over larger LCP values.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import words_of

# A run has this many words at least, and this many periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4


class SuffixArray:
    """Suffixes of several sequences in one array: order, inverse and LCP of neighbours, none across sequences."""

    def __init__(self, symbol: np.ndarray, end: np.ndarray):
        """``symbol`` numbers the words so that no two sequences share one; ``end`` is where each word's sequence ends."""
        n = len(symbol)
        order = np.argsort(symbol, kind="stable")
        head, rank = heads(symbol[order]), np.empty(n, np.int64)
        rank[order] = head
        # Ranks by the first 2**k words, of the suffixes that round k could not tell apart.
        levels = []
        step = 1
        where = np.flatnonzero(grouped(head))
        while len(where):
            active = order[where]
            levels.append((active, rank[active]))
            after = active + step
            inside = after < end[active]
            behind = np.zeros(len(active), np.int64)
            behind[inside] = rank[after[inside]] + 1
            sort = np.lexsort((behind, rank[active]))
            active, behind = active[sort], behind[sort]
            old = rank[active]
            # A group keeps its places; its members share the place of the first of them.
            new = heads(old, behind)
            order[where] = active
            rank[active] = where[new]
            where = where[grouped(new)]
            step *= 2
        self.order, self.inverse = order, rank
        self.lcp = self._lcp(levels, end)

    def _lcp(self, levels: list[tuple[np.ndarray, np.ndarray]], end: np.ndarray) -> np.ndarray:
        """By the kept ranks: from the longest step down, neighbours with equal ranks have a step's words in common."""
        n = len(self.order)
        lcp = np.zeros(n, np.int64)
        left, right = self.order[:-1], self.order[1:]
        for k in range(len(levels) - 1, -1, -1):
            position, rank = levels[k]
            known = np.full(n, -1, np.int64)
            known[position] = rank
            a, b = left + lcp[1:], right + lcp[1:]
            inside = (a < end[left]) & (b < end[right])
            rank_a, rank_b = known[np.where(inside, a, 0)], known[np.where(inside, b, 0)]
            lcp[1:][inside & (rank_a >= 0) & (rank_a == rank_b)] += 1 << k
        return lcp


def heads(*keys: np.ndarray) -> np.ndarray:
    """For sorted keys, the place of the first of each one's group of equals."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(n), 0))


def grouped(head: np.ndarray) -> np.ndarray:
    """Which places share their head with a neighbour."""
    same = head[1:] == head[:-1]
    out = np.zeros(len(head), bool)
    out[1:] |= same
    out[:-1] |= same
    return out


def nearest_smaller(value: np.ndarray, ties: bool) -> np.ndarray:
    """For each place with a positive value, the nearest place to the left with a smaller one (``ties``: or an equal one).

    Every place jumps to where the place it looks at looks, all at once, until
    it sees a smaller value; place 0 holds a zero.
    """
    look = np.maximum(np.arange(len(value)) - 1, 0)
    open_ = np.flatnonzero(value > 0)
    while len(open_):
        seen = value[look[open_]]
        open_ = open_[seen > value[open_] if ties else seen >= value[open_]]
        look[open_] = look[look[open_]]
    return look


def branching_squares(suffixes: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the squares whose next word breaks them, or that end with their sequence."""
    lcp, order, inverse = suffixes.lcp, suffixes.order, suffixes.inverse
    n = len(lcp)
    split = np.flatnonzero(lcp > 0)
    if not len(split):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # The split at k parts the suffixes [low, k) from [k, high), all with lcp[k] words in common.
    low = nearest_smaller(lcp, ties=True)[split]
    backward = np.append(lcp, 0)[::-1]
    high = n - nearest_smaller(backward, ties=False)[n - split]
    depth = lcp[split]
    left_smaller = split - low <= high - split
    start, size = np.where(left_smaller, low, split), np.where(left_smaller, split - low, high - split)
    other_from, other_to = np.where(left_smaller, split, low), np.where(left_smaller, high, split)
    found, periods = [], []
    # In pieces, so that what is listed at once stays near the size of the text.
    listed = np.cumsum(size)
    cut = np.searchsorted(listed, np.arange(0, listed[-1], max(n, 1 << 16)), side="left")
    for a, b in zip(cut, [*cut[1:], len(split)]):
        if a == b:
            continue
        node = np.repeat(np.arange(a, b), size[a:b])
        offset = np.arange(len(node)) - np.repeat(np.cumsum(size[a:b]) - size[a:b], size[a:b])
        i, d = order[start[node] + offset], depth[node]
        for j, first in ((i + d, i), (i - d, i - d)):
            inside = (j >= 0) & (j < n)
            place = inverse[np.where(inside, j, 0)]
            hit = inside & (place >= other_from[node]) & (place < other_to[node])
            found.append(first[hit])
            periods.append(d[hit])
    return np.concatenate(found), np.concatenate(periods)


def rotated(symbol: np.ndarray, begin: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """The starts moved to the left as long as the word passed equals the one a period on, not beyond ``begin``."""
    start = start.copy()
    open_ = np.flatnonzero(start > begin)
    width = 1
    while len(open_):
        # The next words to the left of each, twice as many each time.
        count = np.minimum(width, start[open_] - begin[open_])
        first = np.cumsum(count) - count
        step = np.arange(int(count.sum())) - np.repeat(first, count)
        at = np.repeat(start[open_], count) - 1 - step
        equal = symbol[at] == symbol[at + np.repeat(period[open_], count)]
        moved = np.minimum.reduceat(np.where(equal, np.repeat(count, count), step), first)
        start[open_] -= moved
        open_ = open_[(moved == count) & (start[open_] > begin[open_])]
        width *= 2
    return start


def runs_of(symbol: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and then period; ``begin`` and ``end`` bound each word's sequence."""
    first, period = branching_squares(SuffixArray(symbol, end))
    stop = first + 2 * period
    # A run needs room to the left of the square that ends it. A square is found once or twice.
    room = stop - begin[first] >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    squares = np.unique(np.stack([stop[room], period[room]], axis=1), axis=0)
    found = [np.zeros((0, 3), np.int64)]
    while len(squares):
        # Of each end the smallest period. Its multiples whose squares lie in the same stretch give that stretch again.
        lead = grouped_first(squares[:, 0])
        stop, period = squares[lead, 0], squares[lead, 1]
        square = stop - 2 * period
        start = rotated(symbol, begin[square], square, period)
        found.append(np.stack([start, stop, period], axis=1))
        own = np.searchsorted(stop, squares[:, 0])
        again = (squares[:, 1] % period[own] == 0) & (2 * squares[:, 1] <= (stop - start)[own])
        squares = squares[~again]
    runs = np.concatenate(found)
    runs = runs[runs[:, 1] - runs[:, 0] >= np.maximum(LEAST_WORDS, LEAST_PERIODS * runs[:, 2])]
    # One stretch is one run, with its smallest period.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[grouped_first(runs[:, 0], runs[:, 1])]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return runs[:, 0], runs[:, 1] - runs[:, 0], runs[:, 2]


def grouped_first(*keys: np.ndarray) -> np.ndarray:
    """The places where a group of equal sorted keys begins."""
    return np.flatnonzero(heads(*keys) == np.arange(len(keys[0])))


def planted(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The words, or for one id in ten with their tail replaced by a repeating stretch of it, as the contract has it."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[: n - a]


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def described(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """n_runs, the four numbers of the strongest run, the digest of all, the digest of the words that are left."""
    best = None
    gone = bytearray(len(words))
    for run in runs:
        start, length, period = run
        # Exactly compared: length / period by cross products. Runs come by start and then period.
        if best is None or length * best[2] > best[1] * period:
            best = run
        gone[start + period : start + length] = b"\x01" * (length - period)
    kept = words if best is None else [w for w, g in zip(words, gone) if not g]
    strongest = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return len(runs), *strongest, sha256(listed.encode()), sha256(b" ".join(kept))


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, found in one suffix array."""
    counts = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.cumsum(counts) - counts
    words = pa.array([w for ws in texts for w in ws], pa.large_binary()).dictionary_encode()
    number = words.indices.to_numpy().astype(np.int64)
    text = np.repeat(np.arange(len(texts)), counts)
    start, length, period = runs_of(text * max(1, len(words.dictionary)) + number, first[text], (first + counts)[text])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for t, s, n, p in zip(text[start].tolist(), start.tolist(), length.tolist(), period.tolist()):
        out[t].append((s - int(first[t]), n, p))
    return out


def periodic_runs(documents: DataFrame, *, plant: bool = False, part_words: int = 150_000) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256 of every document.

    A run is a stretch of consecutive words with smallest period q and at least
    ``max(6, 4 * q)`` words that no neighbouring word extends. ``start``,
    ``length`` and ``period`` are those of the run with the greatest length /
    period (ties: smallest start, then period). The collapsed text keeps of each
    run its first q words and every word in no run.

    ``plant`` first repeats the tail of one document in ten (by crc32 of the
    doc_id), as the contract of the query wants it.

    Null, empty and blank texts have no words and no run: nulls, and the digests
    of the empty text. With ``plant``, a null doc_id plants nothing. Rows that
    repeat a doc_id are judged on their own. A text is never cut: one of more
    than ``part_words`` words is a part of its own. An empty table gives no rows.
    Other columns are ignored.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    numbers = ["n_runs", "start", "length", "period", "exponent_milli"]
    digests = ["runs_sha256", "collapsed_sha256"]

    def part(ids: list, texts: list[list[bytes]], like: pa.DataType) -> pa.RecordBatch:
        rows = list(zip(*(described(w, r) for w, r in zip(texts, runs_of_texts(texts)))))
        columns = [pa.array(ids, like), *(pa.array(c, pa.int64()) for c in rows[:5]), *(pa.array(c, pa.string()) for c in rows[5:])]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", *numbers, *digests])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids: list = []
            texts: list[list[bytes]] = []
            size = 0
            like = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = words_of(text.as_py())
                words = planted(doc_id, words) if plant else words
                if texts and size + len(words) > part_words:
                    yield part(ids, texts, like)
                    ids, texts, size = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                size += len(words)
            if texts:
                yield part(ids, texts, like)

    schema = ", ".join([f"doc_id {kind}", *(f"{c} long" for c in numbers), *(f"{c} string" for c in digests)])
    return documents.select(F.col("doc_id"), F.col("text")).mapInArrow(scan, schema)
