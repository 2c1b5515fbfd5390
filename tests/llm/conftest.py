import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A document table from texts, or from (doc_id, text, lang, source) tuples."""

    def build(rows):
        full = []
        for i, r in enumerate(rows):
            doc_id, text, lang, source = r if isinstance(r, tuple) else (i, r, "en", f"src{i % 3}")
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCUMENTS)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, a very long text, ties, repeated rows."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    long_text = " ".join(rng.choice(words) for _ in range(30_000))
    plain = " ".join(words[:60])
    return [
        (1, plain, "en", "a"),
        (2, plain, "en", "a"),
        (2, plain, "en", "a"),
        (3, None, None, None),
        (None, plain + " end", None, "b"),
        (None, None, None, None),
        (4, "", "de", "b"),
        (5, " \n\t ", "de", None),
        (6, long_text, "en", "a"),
        (7, "%%% 12 !!", "fr", "c"),
        (8, "𐌰𐌱 日本語 Öäü", "de", "c"),
        (9, "one", "en", "c"),
    ]


@pytest.fixture(scope="session")
def clashing():
    """Adds columns whose names the operators use inside, or could."""
    from pyspark.sql import functions as F

    names = "label quality toxic held_out score size source_size target taken copies fp root node digest rank chunk kept n_words bin shard place n_tokens content slope mean gap edge part _row _id _key".split()

    def add(df):
        return df.withColumns({n: F.lit("x") for n in names if n not in df.columns})

    return add
