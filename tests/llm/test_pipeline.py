"""The stages one after another against brute force on the smallest tables."""

from collections import Counter, defaultdict

import __spark_entry__ as contract
import corpus_pipeline
from llm_rows import rows_of
from rowtide.llm.mixing import mix
from rowtide.llm.quality_ranker import quality_scores
from test_corpus import check_bins, plain_groups, removed

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "simhash", "substrings", "mixing", "packing"]
    before = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept[name] = corpus_pipeline.store(stage(spark, before, SF), f"test-{name}")
        assert kept[name].dtypes == docs.dtypes
        before = kept[name]

    scores = quality_scores(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r["doc_id"] for r in scores.where("score >= 0.3").collect()}
    assert {r[0] for r in rows_of(kept["quality"], "doc_id")} == good
    texts = dict(rows_of(kept["quality"], "doc_id", "text"))
    assert texts == {i: t for i, t in rows_of(docs, "doc_id", "text") if i in good}

    first = {d for d, _, low in plain_groups(list(texts.items())) if d == low}
    assert {r[0] for r in rows_of(kept["simhash"], "doc_id")} == first

    lost = {d: (n, k) for d, n, k, _ in removed([(i, texts[i].encode().split()) for i in sorted(first)], 13)}
    left = dict(rows_of(kept["substrings"], "doc_id", "text"))
    assert {i: len(t.encode().split()) for i, t in left.items()} == {i: n - k for i, (n, k) in lost.items()}
    assert all(left[i] == texts[i] for i, (_, k) in lost.items() if not k)

    taken = {r["doc_id"]: r["taken"] for r in mix(kept["substrings"]).collect()}
    words = Counter()
    for i, t in rows_of(kept["mixing"], "doc_id", "text"):
        words[i] += len(t.encode().split())
        assert left[i] == t or left[i].split()[: len(t.split())] == t.split()
    assert {i: n for i, n in taken.items() if n} == dict(words)

    pieces = [r.asDict() for r in corpus_pipeline.STAGES[-1][1](spark, kept["mixing"], SF).collect()]
    assert Counter(i for r in pieces for i in [r["doc_id"]] * r["n_words"]) == words
    same = defaultdict(lambda: len(same))
    check_bins([{**r, "cluster": same[" ".join(left[r["doc_id"]].lower().split())] if r["piece"] == 0 else object()} for r in pieces], 2048)


def test_run_is_registered_and_its_rows_are_the_corpus(spark):
    got = contract.queries()["pipeline"](spark, SF)
    assert {"doc_id", "row_id", "bin_id", "n_words", "start", "words"} <= set(got.columns)
    rows = got.collect()
    assert rows and not [r for r in rows if r.n_words and r.bin_id is None]
    windows, copies = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r.words.encode().split()) == r.n_words
        windows[r.bin_id].append(r)
        copies[r.row_id].append(r)
    for bin_id, pieces in windows.items():
        text = [w for r in sorted(pieces, key=lambda r: r.position or 0) for w in r.words.encode().split()]
        assert len(text) <= 2048
        if bin_id is not None:
            assert all(text[r.position : r.position + r.n_words] == r.words.encode().split() for r in pieces)
            assert len({r.doc_id for r in pieces}) == len(pieces)
    for pieces in copies.values():
        assert len({r.doc_id for r in pieces}) == 1
        whole = [w for r in sorted(pieces, key=lambda r: r.start) for w in r.words.encode().split()]
        assert all(whole[r.start : r.start + r.n_words] == r.words.encode().split() for r in pieces)
    # A document is there as often as it has rows that begin at its first word.
    times = Counter(r.doc_id for r in rows if r.start == 0)
    assert max(times.values()) == 2


def through(spark, docs, sf_dir):
    """What each stage gives for the rows that the one before gave."""
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.store(stage(spark, docs, sf_dir), f"odd-{name}")
        out.append(docs)
    return out


def test_odd_rows_through_all_stages(spark, documents, odd_rows, clashing):
    """Nulls in every column, empty and very long texts, repeated rows, extra columns of any name."""
    docs = clashing(documents(odd_rows))
    quality, simhash, substrings, mixing, packed = through(spark, docs, SF)
    assert all(stage.dtypes == docs.dtypes for stage in (quality, simhash, substrings, mixing))
    ids = Counter(r[0] for r in odd_rows)
    kept = Counter(r.doc_id for r in quality.collect())
    assert kept and all(kept[i] == ids[i] for i in kept)
    one = Counter(r.doc_id for r in simhash.collect())
    assert all(n == 1 for i, n in one.items() if i is not None) and one[None] == kept[None]
    assert Counter(r.doc_id for r in substrings.collect()) == one
    texts = [r.text for r in mixing.collect()]
    assert all(t and t.split() for t in texts)
    assert sum(len(t.encode().split()) for t in texts) == sum(r.n_words for r in packed.collect())


def test_no_rows_through_all_stages(spark, clashing):
    docs = clashing(spark.read.parquet(f"{SF}/documents.parquet").limit(0))
    for stage in through(spark, docs, SF):
        assert stage.collect() == []


def test_rows_without_any_text_or_label(spark, documents, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents([(k if k else None, t, None, None) for k, t in enumerate((None, "", " \n", None))])
    stages = through(spark, docs, str(tmp_path))
    assert stages[0].count() == 4
    # One of the group of rows without words, and the one without an id.
    assert sorted((r.doc_id for r in stages[1].collect()), key=str) == [1, None]
    assert stages[3].count() == stages[4].count() == 0
