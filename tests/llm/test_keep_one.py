"""One row of each near-duplicate group, decided by row."""

import random

from rowtide.llm.simhash_dedup import keep_one


def prose(seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def test_rows_are_told_by_id_and_text(documents, clashing):
    a, b, c, d = (prose(k) for k in range(4))
    rows = [
        (1, a, "en", "s"),
        (1, a, "de", "t"),  # equal in id and text: one of the two stays
        (2, a, "en", "s"),  # a copy of 1
        (2, b, "en", "s"),  # another text under a dropped id stays
        (3, c, "en", "s"),
        (4, c, "en", "s"),
        (None, c, "en", "s"),  # without an id: stays
        (None, None, None, None),
        (5, None, "en", "s"),
        (6, "", "en", "s"),  # null and empty texts are one group
        (7, d, "en", "s"),
        (7, d.upper(), "en", "s"),  # one id, one group, two texts: one stays
    ]
    docs = clashing(documents(rows))
    got = keep_one(docs)
    assert got.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    sevens = [t for i, t in found if i == 7]
    assert len(sevens) == 1 and sevens[0].lower() == d
    assert [x for x in found if x[0] != 7] == sorted([(1, a), (2, b), (3, c), (None, c), (None, None), (5, None)], key=repr)


def test_nothing_to_drop(documents, spark):
    docs = documents([(k, prose(100 + k), "en", "s") for k in range(20)])
    assert sorted(r.doc_id for r in keep_one(docs).collect()) == list(range(20))
    assert keep_one(docs.limit(0)).count() == 0
