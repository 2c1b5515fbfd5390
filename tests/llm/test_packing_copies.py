"""Copies of a document in context windows."""

import corpus_pipeline


def test_a_copy_that_mixing_cut_conflicts_with_the_whole_one(spark, documents):
    text = " ".join(f"word{k}" for k in range(300))
    rows = [(d, text.replace("word", f"w{d}x"), "en", f"s{d}") for d in range(20)]
    cut = [(d, " ".join(t.split()[:200]), lang, f"{source}-cut") for d, t, lang, source in rows]
    none = [(None, f"no id {k}", "en", f"n{k}") for k in range(3)]
    packed = corpus_pipeline.packing(spark, documents([*rows, *cut, *none]), "").collect()
    assert len(packed) == 43
    placed = [(r["bin_id"], r["doc_id"]) for r in packed if r["doc_id"] is not None]
    assert len(set(placed)) == len(placed) == 40
    # Rows without an id are copies of nothing.
    assert len({r["bin_id"] for r in packed if r["doc_id"] is None}) < 3


def test_bins_and_documents_are_rebuilt_from_the_pieces(documents, odd_rows, clashing):
    """Nothing but the result is needed: bins by position, documents by start, copies told apart."""
    from collections import Counter, defaultdict

    from rowtide.llm.packing import pack

    docs = clashing(documents(odd_rows))
    rows = pack(docs, capacity=100, same=docs["doc_id"], with_words=True).collect()
    bins, whole = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r["words"].split()) == r["n_words"]
        whole[r["row_id"], r["doc_id"]].append((r["start"], r["words"]))
        if r["bin_id"] is not None:
            bins[r["bin_id"]].append((r["position"], r["words"]))
    for pieces in bins.values():
        text = " ".join(w for _, w in sorted(pieces))
        starts = [0]
        for _, w in sorted(pieces):
            starts.append(starts[-1] + len(w.split()))
        assert [p for p, _ in sorted(pieces)] == starts[:-1] and len(text.split()) == starts[-1] <= 100
    got = Counter((d, " ".join(w for _, w in sorted(pieces))) for (_, d), pieces in whole.items())
    want = Counter((r[0], " ".join(w.decode() for w in (r[1] or "").encode().split())) for r in odd_rows)
    assert got == want and len(whole) == len(odd_rows)
