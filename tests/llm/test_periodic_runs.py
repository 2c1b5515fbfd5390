"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowtide.llm.periodic_runs import SuffixArray, periodic_runs, planted, runs_of_texts


def plain_runs(words):
    """(start, length, period) of all runs, period by period."""
    found = {}
    for period in range(1, len(words) // 4 + 1):
        i = 0
        while i + period < len(words):
            if words[i] != words[i + period]:
                i += 1
                continue
            start = i
            while i + period < len(words) and words[i] == words[i + period]:
                i += 1
            stop = i + period
            if stop - start >= max(6, 4 * period):
                found.setdefault((start, stop), period)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    """The contract's columns, straight from its text."""
    words = (text or "").encode().split()
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()
    strongest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc_id, len(runs), *strongest, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=50), max_size=4))
def test_runs_equal_plain_search(texts):
    assert runs_of_texts(texts) == [plain_runs(t) for t in texts]


def test_runs_of_nested_repeats():
    rng = random.Random(3)
    for _ in range(200):
        words = [b"%d" % rng.randrange(3) for _ in range(rng.randint(1, 4))]
        for _ in range(rng.randint(1, 3)):
            words = words * rng.randint(1, 6) + [b"%d" % rng.randrange(3) for _ in range(rng.randint(0, 2))]
        assert runs_of_texts([words]) == [plain_runs(words)]


def test_suffix_array():
    rng = random.Random(8)
    for _ in range(100):
        symbol = np.array([rng.randrange(3) for _ in range(rng.randint(1, 60))])
        n = len(symbol)
        sorted_ = SuffixArray(symbol, np.full(n, n))
        order = sorted(range(n), key=lambda i: symbol[i:].tolist())
        assert sorted_.order.tolist() == order
        assert [order[r] for r in sorted_.inverse] == list(range(n))
        common = [0]
        for a, b in zip(order, order[1:]):
            k = 0
            while max(a, b) + k < n and symbol[a + k] == symbol[b + k]:
                k += 1
            common.append(k)
        assert sorted_.lcp.tolist() == common


def test_long_repeats_take_little_time():
    assert runs_of_texts([[b"a"] * 200_000]) == [[(0, 200_000, 1)]]
    assert runs_of_texts([[b"%d" % (i % 1000) for i in range(100_000)]]) == [[(0, 100_000, 1000)]]


def test_planted_tail():
    doc_id = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    words = [b"%d" % i for i in range(97)]
    got = planted(doc_id, words)
    g = zlib.crc32(str(doc_id).encode()) // 10
    a, n = g % 97, 97
    p = 1 + (n - a) // (3 + g % 8)
    assert got == [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_rows_equal_plain_rows(spark, documents, odd_rows, clashing):
    rng = random.Random(4)
    rows = [r for r in odd_rows if r[0] != 6]
    for i in range(100, 260):
        words = [rng.choice("ab cd ef gh ij".split()) for _ in range(rng.randint(1, 80))]
        rows.append((i, " ".join(words), "en", "a"))
    rows.append((400, "so " * 9 + "far so far so far so far so far end", "en", "a"))
    got = periodic_runs(clashing(documents(rows)), plant=True, part_words=500)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((plain_row(r[0], r[1]) for r in rows), key=repr)
    assert sum(r.n_runs > 0 for r in got.collect()) > 5


def test_long_text_is_whole(spark, documents):
    text = " ".join(["w%d" % i for i in range(3000)] + ["tail", "of", "it"] * 2000)
    row = periodic_runs(documents([(1, text, "en", "a")]), part_words=100).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (1, 3000, 6000, 3, 2000_000)


def test_empty_table(spark):
    got = periodic_runs(spark.createDataFrame([], "doc_id long, text string"))
    assert got.collect() == []


@pytest.mark.parametrize("copies", [1, 40])
def test_repeated_rows(spark, documents, copies):
    rows = [(5, "la " * 12, "en", "a")] * copies
    got = periodic_runs(documents(rows)).collect()
    assert [tuple(r)[:6] for r in got] == [(5, 1, 0, 12, 1, 12000)] * copies
