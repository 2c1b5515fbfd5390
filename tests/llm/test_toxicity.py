"""What the toxicity lexicon is learned from, and how its terms are matched."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from collections import Counter

import pytest

from rowtide.llm.toxicity import EXACT, FUZZY, STEM, automaton_of, context_weight, fit_toxicity, learned_reporting, lexicon, misspelled, near_copies, sketch_of, tokens, toxicity_scores

LABELS = "doc_id long, quality int, toxic int"


def prose(rng, n, words="alpha bravo carbon delta ember falcon granite harbor island juniper kettle lumen".split()):
    return [rng.choice(words) for _ in range(n)]


def labelled(spark, documents, toxic, clean):
    rows = [(i, " ".join(words), "en", "a") for i, words in enumerate([*toxic, *clean])]
    return documents(rows), spark.createDataFrame([(r[0], 1, int(r[0] < len(toxic))) for r in rows], LABELS)


def test_only_verified_copies_go():
    rng = random.Random(1)
    texts = [prose(rng, 120) for _ in range(6)]
    copy = list(texts[2])
    copy[60] = "zenith"
    # All share all their words, and so the word with the lowest hash; one alone is a copy.
    assert near_copies([sketch_of(t) for t in [*texts, copy]]) == [6]
    assert near_copies([sketch_of(t) for t in (["one"], ["two"], ["one"], [], "a b c d".split(), "a b c d e".split())]) == [2]


def test_sketches_give_the_similarity_of_all_runs():
    rng = random.Random(2)
    for changed in (0, 3, 6, 30):
        a = prose(rng, 100)
        b = list(a)
        for k in range(changed):
            b[3 * k] = f"other{k}"
        runs = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (a, b)]
        whole = len(runs[0] & runs[1]) / len(runs[0] | runs[1])
        assert (near_copies([sketch_of(a), sketch_of(b)]) == [1]) == (whole >= 0.8)


def test_terms_are_learned_from_texts_with_the_same_words(spark, documents):
    """One word in all texts left one text of each label; a term that clean texts have too was below the bar."""
    rng = random.Random(3)
    toxic = [[*prose(rng, 40), "grumbelfritz", *prose(rng, 40), *(["snarkel"] if k % 2 else [])] for k in range(60)]
    clean = [[*prose(rng, 80), *(["snarkel"] if k % 40 == 0 else [])] for k in range(400)]
    docs, labels = labelled(spark, documents, toxic, clean)
    terms = fit_toxicity(docs, labels).terms
    assert {"grumbelfritz", "snarkel"} <= set(terms)
    rows = toxicity_scores(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) == 1 and any(r["toxic"] for r in rows)


def test_copies_are_no_further_evidence(spark, documents):
    rng = random.Random(4)
    one = [*prose(rng, 100), "grumbelfritz"]
    toxic = [[*one[:k], "zenith", *one[k:]] for k in range(5, 45)]
    docs, labels = labelled(spark, documents, toxic, [prose(rng, 80) for _ in range(200)])
    assert "grumbelfritz" not in fit_toxicity(docs, labels).terms


def test_no_term_is_known_before_labels(spark, documents):
    texts = ["you are a stupid worthless idiot and a clown", "you are a very patient friend and a neighbour"]
    got = toxicity_scores(documents(texts), spark.createDataFrame([], LABELS)).collect()
    assert len({r["score"] for r in got}) == 1


def osa(a, b):
    """Levenshtein's distance where two neighbouring letters in the wrong order are one error."""
    d = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@settings(max_examples=80, deadline=None)
@given(
    st.sets(st.text("abc", min_size=3, max_size=6), min_size=1, max_size=4),
    st.sets(st.text("abc", min_size=3, max_size=5), max_size=3),
    st.lists(st.text("abcx", max_size=9), max_size=30),
    st.sampled_from([0, 1, 2]),
    st.sampled_from([0, 1]),
)
def test_automaton_with_swaps_and_errors_in_stems(words, stems, tried, most, in_stem):
    errors, stem_errors = {w: most for w in words}, {s: in_stem for s in stems}
    found = automaton_of(sorted(words), sorted(stems), errors, stem_errors=stem_errors, swaps=True).kinds(tried)

    def kind(t):
        if t in words:
            return EXACT
        if any(t.startswith(s) for s in stems):
            return STEM
        near = any(osa(t, w) <= most for w in words) or any(osa(t[:k], s) <= in_stem for s in stems for k in range(len(t) + 1))
        return FUZZY if near else 0

    assert found.tolist() == [kind(t) for t in tried]


def test_slips_that_were_missed(spark, documents):
    rng = random.Random(5)
    tails = ["bal", "nor", "tig", "wex", "mup", "dov", "sel", "rik", "hin", "goz"]
    toxic = [[*prose(rng, 60), "idiot", "scum", "worthless", "ventrux" + tails[k % 10]] for k in range(60)]
    quoting = [[*prose(rng, 60), "he", "said", '"idoit"', "again"]]
    docs, labels = labelled(spark, documents, toxic, [*(prose(rng, 60) for _ in range(300)), *quoting])
    model = fit_toxicity(docs, labels)
    tried = ["idoit", "scmu", "scuum", "wrothles", "worthlsse", "vnetruxqua", "ventuxqua", "harbor", "island"]
    assert [w in model.ordinary or not k for w, k in zip(tried, model.automaton.kinds(tried))] == [False] * 7 + [True] * 2


def test_rates_tell_ordinary_words_from_misspellings():
    strength = {"idiot": 1.0, "scum": 1.0}
    toxic = [(1, {"idiot", "scum"})] * 100
    errors = {"idiot": 1, "scum": 1}
    widest = lexicon(["idiot", "scum"], [], errors, strength)
    once = misspelled(widest, ["idiot", "scum"], [], strength, errors, [*toxic, (0, {"idoit"}), *[(0, set())] * 900], 0.001)
    assert "idoit" not in once[1] and once[0].kinds(["idoit"]).tolist() == [FUZZY]
    often = misspelled(widest, ["idiot", "scum"], [], strength, errors, [*toxic, *[(0, {"scumb"})] * 3, *[(0, set())] * 900], 0.001)
    assert often[1] == {"scumb"} and often[0].kinds(["scum", "scm"]).tolist() == [EXACT, FUZZY]
    # Every text has another word near the term: the term loses its error, the other does not.
    many = [(0, {"scum" + c}) for c in "abcdefgh"]
    lost = misspelled(widest, ["idiot", "scum"], [], strength, errors, [*toxic, *many, *[(0, set())] * 900], 0.001)
    assert lost[0].kinds(["scum", "scuma", "scm", "idoit"]).tolist() == [EXACT, 0, 0, FUZZY]


@settings(max_examples=40, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from([0, 0, 0, 1]), st.sets(st.text("abc", min_size=3, max_size=6), max_size=6)), min_size=4, max_size=40),
    st.sampled_from([0.0, 0.05, 0.3]),
)
def test_errors_dropped_by_a_filter_are_those_dropped_by_building_again(seen, rate):
    """Without stems, whose weaker ones an automaton forgets, both ways end with the same errors."""
    words, errors = ["abcab", "bcacb", "cab"], {"abcab": 2, "bcacb": 1, "cab": 1}
    strength = {"abcab": 1.0, "bcacb": 0.5, "cab": 0.25}
    got, ordinary = misspelled(lexicon(words, [], errors, strength), words, [], strength, errors, seen, rate)
    ends = got.ends([w for _, ws in seen for w in ws])
    clean = Counter()
    total = sum(not label for label, _ in seen)
    for label, ws in seen:
        if not label:
            e = got.ends(sorted(ws))
            clean.update({int(got.term[x]) for w, x in zip(sorted(ws), e) if got.kind[x] == FUZZY and w not in ordinary})
    # No term that may still be misspelled has too many matches, and no error was dropped from one that never had.
    used = {int(got.term[x]): 0 for x in ends if got.kind[x]}
    for t in used:
        n = clean[t]
        assert n < 2 or n <= rate * total
    if not any(not label for label, _ in seen):
        assert (got.step == lexicon(words, [], errors, strength).step).all()


@pytest.mark.parametrize("text", ["er sagte du bist ein grumbel", "il a dit que tu es grumbel", "el dijo que eres grumbel", "she wrote grumbel"])
def test_reported_speech_in_four_languages(text):
    words = tokens(text)
    assert context_weight(words, len(words) - 1) == 0.5
    assert context_weight(tokens("you are a grumbel"), 3) == 1.0


def test_reporting_words_are_learned_from_labels(spark, documents):
    """A word of no known language that stands before the term in clean texts only."""
    rng = random.Random(6)
    toxic = [[*prose(rng, 40), "grumbelfritz", *prose(rng, 20)] for _ in range(80)]
    clean = [prose(rng, 60) for _ in range(250)] + [[*prose(rng, 40), "vorquat", "grumbelfritz", *prose(rng, 20)] for _ in range(30)]
    docs, labels = labelled(spark, documents, toxic, clean)
    model = fit_toxicity(docs, labels)
    assert "vorquat" in model.reporting and "harbor" not in model.reporting and "grumbelfritz" in model.terms
    quoted, own = model.score(["harbor vorquat grumbelfritz", "harbor lumen grumbelfritz"])
    assert quoted < own


def test_words_before_clean_and_toxic_hits_alike_report_nothing():
    both = [(0, {"lumen"})] * 20 + [(1, {"lumen"})] * 20
    assert learned_reporting(both, least=3) == frozenset()
    assert learned_reporting([*both, *[(0, {"quat"})] * 20], least=3) == {"quat"}
    assert learned_reporting([(0, {"quat"})] * 20, least=3) == frozenset() == learned_reporting([], least=3)


def test_terms_go_on_until_none_adds_anything(spark, documents):
    """More terms than the old bound of 150 are taken where the labels show that many."""
    rng = random.Random(7)
    syllables = [a + b for a in "bdfgklmnprstvz" for b in "aeiou"]
    terms = ["".join(rng.sample(syllables, 4)) for _ in range(170)]
    toxic = [[*prose(rng, 12), terms[k % 170]] for k in range(4250)]
    clean = [prose(rng, 12) for _ in range(4000)]
    docs, labels = labelled(spark, documents, toxic, clean)
    taken = {t.rstrip("*") for t in fit_toxicity(docs, labels, two_from=99, errors_from=99, stem_errors_from=99).terms}
    assert sum(any(t.startswith(x) for x in taken) for t in terms) >= 165 and len(taken) > 150
