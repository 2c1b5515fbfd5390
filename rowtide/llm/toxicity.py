"""Toxicity: a learned lexicon, matched with misspellings, weighed by context."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import fit_logistic, held_out, labelled_sample, sigmoid, store, text_udf

# Words that introduce what somebody else said, of general use in four languages. Others are learned from labels.
REPORTING = frozenset(
    "called calls quote quoted quoting said says word wrote term sagte sagt schrieb nannte zitiert wort "
    "dit disait écrit appelé cite mot dijo dice escribió llamó cita palabra".split()
)

OPEN, CLOSE, BOTH = "“", "”", '"'
SEPARATORS = {ord(c): " " for c in ".,;:!?()[]{}<>|/\\…—–¿¡"}
QUOTES = {ord(c): f" {OPEN} " for c in "“„«"} | {ord(c): f" {CLOSE} " for c in "”»"} | {ord('"'): f' {BOTH} '}
SPLIT = SEPARATORS | QUOTES
EDGES = "*#$%&@~^_-+='`’‘"

EXACT, STEM, FUZZY = 1, 2, 3


def tokens(text: str | None) -> list[str]:
    """Lower-case words of a whole text; quotation marks are words of their own."""
    return text.lower().translate(SPLIT).split() if text else []


# Automaton


@dataclass(frozen=True)
class Trie:
    """Children by symbol, and for each node the errors of the word and of the stem that end there (-1: none does), their
    strength, and the most errors allowed below it. ``swaps`` has the nodes in the middle of two swapped letters, by the
    letter that comes too early; they have one child and no errors of their own.
    """

    children: list[dict[str, int]]
    word: list[int]
    stem: list[int]
    below: list[int]
    word_strength: list[float]
    stem_strength: list[float]
    swaps: list[dict[str, list[int]]]
    middle: set[int]

    def add(self) -> int:
        for column, value in ((self.children, {}), (self.word, -1), (self.stem, -1), (self.below, 0), (self.word_strength, 0.0), (self.stem_strength, 0.0), (self.swaps, {})):
            column.append(value)
        return len(self.children) - 1


def trie_of(words: Iterable[str], stems: Iterable[str], errors: dict[str, int], strength: dict[str, float], stem_errors: dict[str, int], swaps: bool) -> Trie:
    trie = Trie([], [], [], [], [], [], [], set())
    trie.add()

    def walk(term: str, most: int) -> int:
        node = 0
        trie.below[0] = max(trie.below[0], most)
        for c in term:
            if c not in trie.children[node]:
                trie.children[node][c] = trie.add()
            node = trie.children[node][c]
            trie.below[node] = max(trie.below[node], most)
        return node

    for w in words:
        node = walk(w, errors.get(w, 0))
        trie.word[node] = max(trie.word[node], errors.get(w, 0))
        trie.word_strength[node] = strength.get(w, 1.0)
    for s in stems:
        node = walk(s, stem_errors.get(s, 0))
        trie.stem[node] = stem_errors.get(s, 0)
        trie.stem_strength[node] = strength.get(s + "*", 1.0)
    for node in range(len(trie.children) if swaps else 0):
        for x, first in list(trie.children[node].items()):
            for y, second in list(trie.children[first].items()):
                if x != y and trie.below[second]:
                    between = trie.add()
                    trie.children[between][x] = second
                    trie.below[between] = trie.below[second]
                    trie.middle.add(between)
                    trie.swaps[node].setdefault(y, []).append(between)
    return trie


@dataclass(frozen=True)
class Automaton:
    """The Levenshtein automata of all terms, intersected with their trie and made deterministic.

    ``step[state, symbol]`` is the next state, ``kind[state]`` what a word that
    ends there is, ``strength[state]`` and ``term[state]`` are its strongest
    term, met with ``used[state]`` errors. A set of (trie node, errors so far)
    is one state; ``symbol`` numbers the letters of the lexicon, 0 is any other.
    """

    step: np.ndarray
    kind: np.ndarray
    strength: np.ndarray
    term: np.ndarray
    used: np.ndarray
    letters: str
    width: int

    def kinds(self, words: Sequence[str]) -> np.ndarray:
        """What each word is."""
        return self.kind[self.ends(words)]

    def ends(self, words: Sequence[str]) -> np.ndarray:
        """The state in which each word ends, all words moved through the automaton together."""
        if not len(words) or not self.width:
            return np.zeros(len(words), np.int32)
        # Longer words than any term with its errors differ from it in what is kept too.
        code = np.array(words, f"U{self.width}").view(np.uint32).reshape(len(words), self.width)
        symbol = np.zeros(1 << 16, np.int32)
        for k, c in enumerate(self.letters):
            if ord(c) < 1 << 16:
                symbol[ord(c)] = k + 1
        state = np.full(len(words), 1, np.int32)
        for k in range(self.width):
            c = code[:, k]
            moved = self.step[state, symbol[np.minimum(c, 0xFFFF)]]
            state = np.where(c == 0, state, moved)
        return state


def automaton_of(
    words: Sequence[str],
    stems: Sequence[str],
    errors: dict[str, int],
    *,
    strength: dict[str, float] | None = None,
    stem_errors: dict[str, int] | None = None,
    swaps: bool = False,
) -> Automaton:
    """State 0 is dead, 1 the start. The lexicon is bounded, and so are the states.

    ``strength`` has words, and stems with a star; a term without one has 1.
    ``stem_errors`` are those of a beginning of the word. With ``swaps`` two
    neighbouring letters in the wrong order are one error.
    """
    stem_errors = stem_errors or {}
    trie = trie_of(words, stems, errors, strength or {}, stem_errors, swaps)

    def beyond(node: int) -> int:
        """The place behind the stem that ends at ``node``: whatever follows stays there. It is its own inverse."""
        return -1 - node

    def closed(states: set[tuple[int, int]]) -> frozenset:
        """With letters of the term left out, and without what a state of fewer errors at the same node covers."""
        least: dict[int, int] = {}
        todo = sorted(states, key=lambda s: s[1])
        while todo:
            node, used = todo.pop(0)
            if node in least and least[node] <= used:
                continue
            least[node] = used
            if node >= 0 and node not in trie.middle and used < trie.below[node]:
                todo += [(child, used + 1) for child in trie.children[node].values() if used + 1 <= trie.below[child]]
        # Of the stems that are met, and of those met with errors, the strongest is enough.
        met = sorted((n for n in least if n < 0), key=lambda n: (-trie.stem_strength[beyond(n)], n))
        for n in [n for n in met if not least[n]][1:] + [n for n in met if least[n]][1:]:
            del least[n]
        return frozenset(least.items())

    def move(states: frozenset, c: str) -> frozenset:
        out: set[tuple[int, int]] = set()
        for node, used in states:
            if node < 0:
                out.add((node, used))
                continue
            if trie.stem[node] >= used:
                out.add((beyond(node), min(used, 1)))
            child = trie.children[node].get(c)
            if child is not None and used <= trie.below[child]:
                out.add((child, used))
            if node in trie.middle:
                continue
            out.update((k, used + 1) for k in trie.swaps[node].get(c, ()) if used + 1 <= trie.below[k])
            if used < trie.below[node]:
                out.add((node, used + 1))
                out.update((k, used + 1) for x, k in trie.children[node].items() if x != c and used + 1 <= trie.below[k])
        return closed(out)

    names = {}
    for t in (*words, *(f"{t}*" for t in stems)):
        node = 0
        for c in t.removesuffix("*"):
            node = trie.children[node][c]
        names[node, t.endswith("*")] = t
    number_of = {t: k for k, t in enumerate((*words, *(f"{t}*" for t in stems)))}

    def kind(states: frozenset) -> tuple[int, float, int, int]:
        """The best kind (an exact word, then a stem), and strength, number and errors of the strongest term."""
        found = [(EXACT if used == 0 else FUZZY, trie.word_strength[node], names[node, False], used) for node, used in states if node >= 0 and trie.word[node] >= used]
        for node, used in states:
            at = beyond(node) if node < 0 else node
            if node < 0 or trie.stem[node] >= used:
                found.append((FUZZY if used else STEM, trie.stem_strength[at], names[at, True], used))
        if not found:
            return 0, 0.0, -1, 0
        strongest = max(found, key=lambda f: (f[1], f[2], -f[3]))
        return min(f[0] for f in found), strongest[1], number_of[strongest[2]], strongest[3]

    letters = "".join(sorted({c for t in (*words, *stems) for c in t}))
    number: dict[frozenset, int] = {frozenset(): 0}
    start = closed({(0, 0)})
    number.setdefault(start, 1)
    order, rows = [frozenset(), start], []
    done = 0
    while done < len(order):
        states = order[done]
        row = []
        for c in ("\0", *letters):
            after = move(states, c) if states else states
            if after not in number:
                number[after] = len(order)
                order.append(after)
            row.append(number[after])
        rows.append(row)
        done += 1
    width = max([*(len(t) + errors.get(t, 0) for t in words), *(len(t) + stem_errors.get(t, 0) for t in stems)], default=-1) + 1
    kinds, strengths, terms, used = zip(*map(kind, order))
    return Automaton(
        np.array(rows, np.int32),
        np.array(kinds, np.int8),
        np.array(strengths, float),
        np.array(terms, np.int32),
        np.array(used, np.int8),
        letters,
        width,
    )


# Hits and their context


@dataclass(frozen=True)
class Hit:
    kind: int
    word: str
    strength: float
    weight: float
    before: tuple[str, ...] = ()


def words_before(words: list[str], at: int, reach: int = 4) -> tuple[str, ...]:
    return tuple(w.strip(EDGES) for w in words[max(0, at - reach) : at])


def context_weight(words: list[str], at: int, reach: int = 8, reporting: frozenset = REPORTING) -> float:
    """1 for abuse, less inside quotation marks or after words that report speech."""
    weight = 1.0
    before, after = words[max(0, at - reach) : at], words[at + 1 : at + 1 + reach]
    opened = OPEN in before and CLOSE not in before[len(before) - before[::-1].index(OPEN) :]
    closed = CLOSE in after and OPEN not in after[: after.index(CLOSE)]
    # Plain marks are the same on both sides: an odd number of them before the word opens a quotation.
    plain = before.count(BOTH) % 2 == 1 and BOTH in after
    if (opened and closed) or plain:
        weight *= 0.25
    return weight * reported(words_before(words, at), reporting)


def reported(before: Iterable[str], reporting: frozenset) -> float:
    return 0.5 if reporting.intersection(before) else 1.0


def hits_of(
    texts: list[str | None], automaton: Automaton, ordinary: frozenset = frozenset(), reporting: frozenset = REPORTING
) -> list[tuple[int, list[Hit]]]:
    """Number of words and the hits of each text. Each distinct word of the batch is matched once."""
    lists = [tokens(t) for t in texts]
    distinct = sorted(set().union(*map(set, lists))) if lists else []
    bare = [w.strip(EDGES) for w in distinct]
    ends = automaton.ends(bare)
    kinds = automaton.kind[ends]
    known = {distinct[i]: (int(kinds[i]), bare[i], float(automaton.strength[ends[i]])) for i in np.flatnonzero(kinds).tolist() if bare[i] not in ordinary or kinds[i] != FUZZY}
    out = []
    for words in lists:
        found = [Hit(*known[w], context_weight(words, i, reporting=reporting), words_before(words, i)) for i, w in enumerate(words) if w in known]
        out.append((len(words), found))
    return out


def features(words: int, hits: list[Hit]) -> list[float]:
    """A hit counts with its weight times the strength of its term, so that a weak term says little by itself."""
    by_kind = defaultdict(float)
    for h in hits:
        by_kind[h.kind] += h.weight * h.strength
    weighed = sum(by_kind.values())
    return [
        *(math.log1p(by_kind[k]) for k in (EXACT, STEM, FUZZY)),
        math.log1p(sum({h.word: h.strength for h in hits if h.weight > 0.5}.values())),
        min(1.0, 20 * weighed / max(1, words)),
    ]


@dataclass(frozen=True)
class ToxicityModel:
    automaton: Automaton
    ordinary: frozenset
    weights: np.ndarray
    terms: tuple[str, ...]
    reporting: frozenset = REPORTING

    def score(self, texts: list[str | None]) -> np.ndarray:
        found = hits_of(texts, self.automaton, self.ordinary, self.reporting)
        rows = np.array([features(n, h) for n, h in found], float).reshape(len(texts), 5)
        return sigmoid(np.column_stack([rows, np.ones(len(rows))]) @ self.weights)

    def column(self, text: Column) -> Column:
        return text_udf(lambda texts: {"score": self.score(texts)}, "score double")(text).getField("score")


# Learning


def candidate_terms(text: str | None, shortest: int, longest: int) -> set[str]:
    """Words of a text, and their beginnings marked with a star."""
    out = set()
    for w in set(tokens(text)):
        w = w.strip(EDGES)
        if len(w) >= shortest and w.isalpha():
            out.add(w)
            out.update(w[:k] + "*" for k in range(shortest, min(longest, len(w) - 1) + 1))
    return out


def word_hash(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


def sketch_of(words: list[str], size: int = 256) -> np.ndarray:
    """The ``size`` lowest hashes of the runs of five words, in order; a shorter text is one run."""
    code = np.array([word_hash(w) for w in words], np.uint64)
    run = min(5, len(code))
    runs = np.zeros(max(0, len(code) - run + 1) if run else 0, np.uint64)
    for k in range(run):
        runs = runs * np.uint64(0x9E3779B97F4A7C15) + code[k : k + len(runs)]
    runs = (runs ^ (runs >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique((runs ^ (runs >> np.uint64(32))) >> np.uint64(1)).astype(np.int64)[:size]


def similarity(a: np.ndarray, b: np.ndarray, size: int = 256) -> float:
    """Jaccard similarity of what two sketches are of: exact up to ``size`` runs in both together, else estimated from so many."""
    both = np.union1d(a, b)[:size]
    return len(np.intersect1d(np.intersect1d(a, b), both)) / len(both) if len(both) else 1.0


def near_copies(sketches: Sequence[np.ndarray], least: float = 0.8) -> list[int]:
    """The texts that have ``least`` similarity or more with one that stays, taken in order.

    Only texts that share four of their 16 lowest hashes (or all, of fewer) are
    compared; of those as similar as 0.8 one in ten million pairs does not.
    """
    holders: dict[int, list[int]] = defaultdict(list)
    copies = []
    for i, sketch in enumerate(sketches):
        low = sketch[:16].tolist()
        shared: Counter = Counter()
        for h in low:
            shared.update(holders.get(h, ()))
        if any(similarity(sketch, sketches[j]) >= least for j, n in shared.most_common() if n >= min(4, len(low))):
            copies.append(i)
        else:
            for h in low:
                holders[h].append(i)
    return copies


def apart(sample: DataFrame) -> DataFrame:
    """Text and label, without those of a label that are copies: equal words, or four fifths of the runs of five words.

    What goes is fixed by digests of the texts. Of a text, 256 numbers reach the driver.
    """
    spark = sample.sparkSession

    def marks(texts: list[str | None]) -> dict:
        words = [tokens(t) for t in texts]
        return {
            "digest": [hashlib.md5(" ".join(w).encode("utf-8", "surrogatepass")).hexdigest() for w in words],
            "sketch": [sketch_of(w).tolist() for w in words],
        }

    marked = sample.select("label", "text", text_udf(marks, "digest string, sketch array<long>")(F.col("text")).alias("m"))
    one = marked.groupBy("label", "m.digest").agg(F.min("text").alias("text"), F.min("m.sketch").alias("sketch"))
    one = store(one, "toxic-texts")
    found = one.select("label", "digest", "sketch").toArrow().sort_by([("label", "ascending"), ("digest", "ascending")])
    gone = []
    for label in (0, 1):
        rows = found.filter(pc.equal(found["label"], label))
        sketches = [v.values.to_numpy() for v in rows["sketch"]]
        gone += [(label, rows["digest"][i].as_py()) for i in near_copies(sketches)]
    return one.join(F.broadcast(spark.createDataFrame(gone, "label int, digest string")), ["label", "digest"], "left_anti").select("text", "label")


def learned_terms(sample: DataFrame, *, least: int, cover: int) -> dict[str, float]:
    """Words and stems that mark toxic texts of the sample, chosen until they cover its toxic texts, and their strength.

    How many toxic and other texts have a term is counted on Spark. The strength
    of a term is the logarithm of how many times as frequent it is in toxic
    texts, over that of the strongest. Weighed are the terms in ``least`` toxic
    texts or more that are not there by chance. They are taken greedily, as long
    as one adds something: each next term has the most strength in texts that do
    not have ``cover`` terms yet; of equal ones a word goes before a stem and a
    long stem before a short. The sample bounds both the terms and the texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, other = Counter(), Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                (toxic if label else other).update(candidate_terms(text, 4, 7))
            term = sorted(set(toxic) | set(other))
            yield pa.RecordBatch.from_arrays(
                [pa.array(term, pa.string()), pa.array([toxic[t] for t in term], pa.int64()), pa.array([other[t] for t in term], pa.int64())],
                names=["term", "toxic", "other"],
            )

    total = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not total.get(1):
        return {}
    counted = sample.select("text", "label").mapInArrow(run, "term string, toxic long, other long")
    rate = F.log((F.col("toxic") + 0.5) / (total[1] + 1.0)) - F.log((F.col("other") + 0.5) / (total.get(0, 0) + 1.0))
    terms = store(counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")), "terms")
    # So many terms are tried that some are in toxic texts only by chance: the share of toxic texts
    # must be beyond what chance (by Chernoff's bound) gives to any of them once in twenty samples.
    share = total[1] / (total[1] + total.get(0, 0) + 1.0)
    bar = math.log(max(1, terms.count())) + 3.0
    both = F.col("toxic") + F.col("other")
    part = F.col("toxic") / both
    surprise = F.col("toxic") * F.log(part / share) + F.when(F.col("other") > 0, F.col("other") * F.log((1 - part) / (1 - share))).otherwise(0.0)
    chosen = (
        terms.withColumn("rate", rate)
        .where((F.col("toxic") >= least) & (F.col("rate") > 0))
        .where((part > share) & (surprise >= bar))
        .collect()
    )
    chosen.sort(key=lambda r: (-r["toxic"] * r["rate"], r["term"]))
    names = [r["term"] for r in chosen]
    rates = [r["rate"] for r in chosen]
    number = {t: k for k, t in enumerate(names)}
    of_text = text_udf(lambda texts: {"t": [sorted(number[t] for t in candidate_terms(x, 4, 7) if t in number) for x in texts]}, "t array<int>")
    texts = [r["t"] or [] for r in sample.where(F.col("label") == 1).select(of_text(F.col("text")).getField("t").alias("t")).collect()]
    having = defaultdict(set)
    for i, found in enumerate(texts):
        for k in found:
            having[k].add(i)
    need = [cover] * len(texts)
    taken: dict[str, float] = {}
    while having:
        gain = {k: rates[k] * sum(need[i] > 0 for i in v) for k, v in having.items()}
        best = max(gain, key=lambda k: (gain[k], not names[k].endswith("*"), len(names[k]), names[k]))
        if not gain[best]:
            break
        for i in having.pop(best):
            need[i] -= 1
        taken[names[best]] = rates[best] / max(rates)
        # What is covered by a taken stem as strong, or is a stem of a taken word in the same texts, adds nothing.
        taken_stem = names[best][:-1] if names[best].endswith("*") else None
        having = {
            k: v
            for k, v in having.items()
            if not (taken_stem and names[k].startswith(taken_stem) and rates[k] <= rates[best])
            and not (names[k].endswith("*") and names[best].startswith(names[k][:-1]) and gain[k] <= 1.2 * gain[best])
        }
    return taken


def misspelled(
    widest: Automaton,
    words: list[str],
    stems: list[str],
    strength: dict[str, float],
    errors: dict[str, int],
    seen: list[tuple[int, set[str]]],
    ordinary_rate: float,
) -> tuple[Automaton, frozenset]:
    """The automaton with as many errors as clean texts allow, and the ordinary words.

    ``seen`` has the label of each text and the words it uses itself, not in a
    quotation, that are near a term. A misspelling is an ordinary word if two
    clean texts or more use it, and not a smaller part of them than of the toxic
    texts. A term whose other misspellings are in two clean texts or more, and in
    more than ``ordinary_rate`` of them, loses an error, and so on. ``widest``
    has all ``errors``. Which terms lose some is found by leaving out its
    matches with more than they are allowed; the automaton is built again for
    what is left, where another term may be the one that is met, and looked at
    once more.
    """
    total = [sum(label == k for label, _ in seen) for k in (0, 1)]
    used = [Counter(w for label, ws in seen if label == k for w in ws) for k in (0, 1)]
    names = [*words, *(f"{t}*" for t in stems)]
    known = sorted(set(used[0]) | set(used[1]))
    errors = dict(errors)

    def narrowed(automaton: Automaton) -> tuple[bool, frozenset]:
        """Takes errors from terms until none has too many matches; whether one lost any, and the ordinary words."""
        lost = False
        ends = automaton.ends(known).tolist()
        while True:
            met = {w: (int(automaton.term[e]), int(automaton.used[e])) for w, e in zip(known, ends) if automaton.kind[e] == FUZZY}
            term = {w: t for w, (t, n) in met.items() if n <= errors[names[t]]}
            ordinary = frozenset(w for w in term if used[0][w] >= 2 and used[0][w] * total[1] >= used[1][w] * total[0])
            texts = Counter(t for label, ws in seen if not label for t in {term[w] for w in ws if w in term and w not in ordinary})
            often = [names[t] for t, n in texts.items() if n >= 2 and n > ordinary_rate * total[0] and errors[names[t]]]
            if not often:
                return lost, ordinary
            for t in often:
                errors[t] -= 1
            lost = True

    automaton = widest
    while True:
        lost, ordinary = narrowed(automaton)
        if not lost:
            return automaton, ordinary
        automaton = lexicon(words, stems, errors, strength)


def lexicon(words: list[str], stems: list[str], errors: dict[str, int], strength: dict[str, float]) -> Automaton:
    """The automaton of words and stems; a stem is named with a star."""
    return automaton_of(
        words, stems, {w: errors[w] for w in words}, strength=strength, stem_errors={t: errors[f"{t}*"] for t in stems}, swaps=True
    )


def learned_reporting(before: list[tuple[int, set[str]]], *, least: int) -> frozenset:
    """Words that stand before the lexicon's words where these are no abuse: in texts labelled clean, and not by chance.

    ``before`` has the label of each text with a hit, and the words before its
    hits outside quotation marks. As for terms, a word must be in ``least``
    clean texts or more, and a larger part of its texts must be clean than
    chance gives to any of the words once in twenty samples.
    """
    texts = Counter(label for label, _ in before)
    if not texts[0] or not texts[1]:
        return frozenset()
    share = texts[0] / (len(before) + 1.0)
    clean, toxic = (Counter(w for label, ws in before if label == k for w in ws if w.isalpha()) for k in (0, 1))
    bar = math.log(max(1, len(set(clean) | set(toxic)))) + 3.0
    out = set()
    for w, n in clean.items():
        part = n / (n + toxic[w])
        surprise = n * math.log(part / share) + (toxic[w] * math.log((1 - part) / (1 - share)) if toxic[w] else 0.0)
        if n >= least and part > share and surprise >= bar:
            out.add(w)
    return frozenset(out)


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    *,
    max_train_rows: int = 8_000,
    cover: int = 8,
    buckets: int = 5,
    remainder: int = 0,
    least: int = 3,
    errors_from: int = 4,
    two_from: int = 9,
    stem_errors_from: int = 6,
    ordinary_rate: float = 0.001,
) -> ToxicityModel:
    """Lexicon, ordinary words, reporting words and weights from at most ``max_train_rows`` labelled rows that are not held out.

    Words of ``errors_from`` letters and more are matched with one error, words
    of ``two_from`` with two, and words whose beginning is a stem of
    ``stem_errors_from`` with one error in it; swapped letters are one error.
    What clean texts have is told from a misspelling by ``misspelled``. Without
    both classes in the sample the weights are fixed ones.
    """
    sample = labelled_sample(documents, labels, "toxic", buckets=buckets, remainder=remainder, max_rows=max_train_rows)
    sample = store(sample, "toxic-sample")
    terms = learned_terms(apart(sample), least=least, cover=cover)
    stems = sorted(t[:-1] for t in terms if t.endswith("*"))
    words = sorted(t for t in terms if not t.endswith("*"))
    errors = {w: (len(w) >= errors_from) + (len(w) >= two_from) for w in words} | {f"{t}*": int(len(t) >= stem_errors_from) for t in stems}
    widest = lexicon(words, stems, errors, terms)

    def run(texts: list[str | None]) -> dict:
        # Quotation marks alone, for now: which words report speech is not known yet.
        found = hits_of(texts, widest, reporting=frozenset())
        return {
            "words": [n for n, _ in found],
            "word": [[h.word for h in hits] for _, hits in found],
            "weight": [[h.weight for h in hits] for _, hits in found],
            "before": [[list(h.before) for h in hits] for _, hits in found],
        }

    look = text_udf(run, "words long, word array<string>, weight array<double>, before array<array<string>>")
    got = sample.select("label", look(F.col("text")).alias("h")).select("label", "h.*").collect()
    known = sorted({w for r in got for w in r["word"]})
    exact = {w for w, k in zip(known, widest.kinds(known).tolist()) if k != FUZZY}
    places = [(r["label"], [b for w, weight, b in zip(r["word"], r["weight"], r["before"]) if weight > 0.5 and w in exact]) for r in got]
    reporting = REPORTING | learned_reporting([(label, set().union(*map(set, bs))) for label, bs in places if bs], least=least)
    weigh = [[weight * reported(b, reporting) for weight, b in zip(r["weight"], r["before"])] for r in got]
    seen = [(r["label"], {w for w, weight in zip(r["word"], own) if weight > 0.5}) for r, own in zip(got, weigh)]
    automaton, ordinary = misspelled(widest, words, stems, terms, errors, seen, ordinary_rate)
    # With fewer errors fewer words are hits, and none that was not.
    ends = automaton.ends(known)
    kept = {
        w: (int(automaton.kind[e]), w, float(automaton.strength[e]))
        for w, e in zip(known, ends.tolist())
        if automaton.kind[e] and (automaton.kind[e] != FUZZY or w not in ordinary)
    }
    rows = [features(r["words"], [Hit(*kept[w], weight) for w, weight in zip(r["word"], own) if w in kept]) for r, own in zip(got, weigh)]
    label = [r["label"] for r in got]
    weights = np.array([2.0, 2.0, 1.0, 1.0, 1.0, -3.0])
    if len(set(label)) == 2:
        x, y = np.array(rows), np.array(label, float)
        weights = fit_logistic(x, y, l2=1e-4)
        # Misspellings are rare in labels: a hit of any kind speaks for abuse, never against it.
        floor = np.array([0.5, 0.5, 0.35]) * max(weights[0], weights[1], 1.0)
        weights[:3] = np.maximum(weights[:3], floor)
        weights[3:5] = np.maximum(weights[3:5], 0)
    return ToxicityModel(automaton, ordinary, weights, tuple(terms), reporting)


def toxicity_scores(documents: DataFrame, labels: DataFrame, *, threshold: float = 0.5, **fit) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 if score >= ``threshold``) of every row of ``documents``.

    Scores look at the whole text only. Null, empty and blank texts have the
    score of a text without a hit. Equal texts have equal scores; repeated rows
    give repeated rows; a null id counts as held out. Terms are learned from the
    labels alone: without any, no text has a hit. An empty table gives no rows. Other columns
    are ignored.
    """
    model = fit_toxicity(documents, labels, **fit)
    scored = documents.select("doc_id", model.column(F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), fit.get("buckets", 5), fit.get("remainder", 0)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
