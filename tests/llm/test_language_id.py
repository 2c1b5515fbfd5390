"""Language identification: the model against a plain one, held-out accuracy, odd rows."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowtide.llm.language_id import fit_languages, grams, identify, letters

SF = "/root/testdata/sf0.01"


def plain_grams(text):
    """Letters in lower case, all else one space; 4-grams as strings, spaces before the text."""
    out = " "
    for c in text.lower():
        if c.isalpha():
            out += c
        elif out[-1] != " ":
            out += " "
    out = out if out[-1] == " " and len(out) > 1 else out + " "
    out = out if len(out.strip()) else " "
    full = "   " + out
    return [full[i : i + 4] for i in range(1, len(full) - 3)]


class Plain:
    """Interpolated Kneser-Ney by the textbook, on strings."""

    def __init__(self, texts):
        self.c = {4: Counter(g for t in texts for g in plain_grams(t))}
        for n in (3, 2, 1):
            self.c[n] = Counter(g[1:] for g in self.c[n + 1])
        self.d, self.total, self.kinds = {}, defaultdict(int), defaultdict(int)
        for n, c in self.c.items():
            n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
            d = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
            self.d[n] = min(0.95, max(0.05, d))
            for g, v in c.items():
                self.total[n, g[:-1]] += v
                self.kinds[n, g[:-1]] += 1

    def p(self, g):
        n = len(g)
        if n == 0:
            return 1 / 65536
        lower = self.p(g[1:])
        total = self.total.get((n, g[:-1]), 0)
        if not total:
            return lower
        return max(self.c[n][g] - self.d[n], 0) / total + self.d[n] * self.kinds[n, g[:-1]] / total * lower


def packed(g):
    return sum(ord(c) << (16 * (3 - i)) for i, c in enumerate(g))


def test_grams_are_those_of_the_text():
    texts = ["Ab c", "", None, "x", "1 2", "É-É", "  a"]
    keys, text = grams(texts, letters())
    for i, t in enumerate(texts):
        assert keys[text == i].tolist() == [packed(g) for g in plain_grams(t or "")]


def test_probabilities_equal_the_textbook(spark):
    by_lang = {"a": ["the cat sat on the mat", "the hat"], "b": ["der hund und die katze", "und der hut"]}
    rows = [(t, lang) for lang, texts in by_lang.items() for t in texts]
    model = fit_languages(spark.createDataFrame(rows, "text string, lang string"))
    tried = [g for t in ("the hund", "zebra", "katze hat") for g in plain_grams(t)]
    got, unsure = model.sent.log_probability(np.array([packed(g) for g in tried], np.uint64))
    assert not unsure.any()
    for k, lang in enumerate(model.sent.langs):
        plain = Plain(by_lang[lang])
        assert got[:, k] == pytest.approx([math.log(plain.p(g)) for g in tried], rel=1e-4)


@pytest.mark.parametrize("entries", [1, 12, 60])
def test_what_is_not_sent_is_looked_up(spark, entries):
    by_lang = {"a": ["the cat sat on the mat", "the hat"], "b": ["der hund und die katze", "und der hut"]}
    rows = [(t, lang) for lang, texts in by_lang.items() for t in texts]
    texts = ["the hund", "zebra the zebra", "katze hat", "", None, "der cat \u0416"]
    models = fit_languages(spark.createDataFrame(rows, "text string, lang string"), max_entries=entries)
    assert not models.sent_whole
    asked = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    got = {r["row"]: r["entropies"] for r in models.entropies(asked).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        if not t:
            assert got[i] is None
            continue
        tried = plain_grams(t)
        plain = [Plain(by_lang[lang]) for lang in models.sent.langs]
        assert got[i] == pytest.approx([-sum(math.log(m.p(g)) for g in tried) / len(tried) for m in plain], rel=1e-4)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, rows = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert rows == docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).count()
    assert right >= 0.97


def test_rejects_what_is_unlike_all(spark, documents):
    learned = [(i, f"the cat number {'abcdefghij'[i % 10] * 2} sat on the mat and then the dog came", "en", "s") for i in range(40)]
    found = identify(documents([*learned, (100, "qxz jjkw vvqz xkcd qqq zzzx", None, "s")])).where("doc_id = 100").first()
    assert found["lang_pred"] == "en" and found["rejected"]


def test_odd_rows(documents, odd_rows, clashing):
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in identify(clashing(documents(odd_rows))).collect()]
    assert len(got) == len(odd_rows)
    unknown = sorted(str(i) for i, lang, _ in got if lang == "und")
    assert unknown == sorted(["3", "None", "4", "5", "7"])
    assert all(0 <= s <= 1 for _, _, s in got)
    assert got.count(next(g for g in got if g[0] == 2)) == 2


def test_empty_and_unlabelled(documents):
    assert identify(documents([])).count() == 0
    got = identify(documents([(1, "some words", None, "a")])).first()
    assert (got["lang_pred"], got["score"]) == ("und", 0.0)
