"""Token counts, substrings, mixing, SimHash groups and packing against brute force; odd rows."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import oracle
from llm_rows import rows_of
from rowtide.llm.common import merge_labels
from rowtide.llm.mixing import mix, repeated_documents
from rowtide.llm.packing import best_fit, pack
from rowtide.llm.queries import llm_queries, llm_sql
from rowtide.llm.simhash_dedup import fingerprint, keep_one, link_labels, near_groups, near_links, plant
from rowtide.llm.substring_dedup import cleaned_documents, pack as pack_ints, remove_repeats, unpack
from rowtide.llm.token_counts import count_tokens

SF = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("name", sorted(llm_sql()))
def test_query_matches_sql(spark, name):
    assert oracle.compare(llm_queries()[name](spark, SF), oracle.connect(SF), llm_sql()[name]) == []


# Token counts


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_are_the_library_s(spark, documents, odd_rows, file):
    path = public_tokenizers.path(file)
    texts = ["a<|endoftext|>b  c", " lead", "x\n\ny z", "<|STARTOFTEXT|>", "word " * 3000]
    rows = [*odd_rows, *((50 + i, t, "en", "s") for i, t in enumerate(texts))]
    if file.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        count = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    want = [(r[0], len((r[1] or "").encode()), count(r[1] or ""), count(r[1] or "") > 2048) for r in rows]
    got = count_tokens(documents(rows), path)
    assert rows_of(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)


def test_cache_is_used_and_appended(spark, documents, tmp_path):
    folder = f"file://{tmp_path}/cache"
    first = documents([(1, "some words", "en", "a"), (2, "some \n words", "en", "a")])
    count_tokens(first, WORD_BPE, cache=folder)
    stored = spark.read.parquet(folder)
    assert stored.count() == 1
    # A stored count is taken as it is; that shows it was not made again.
    stored.withColumn("n_tokens", F.lit(77).cast("long")).write.parquet(f"{folder}-2")
    more = documents([(1, "some words", "en", "a"), (3, "other", "en", "a"), (4, "other", "en", "a")])
    got = count_tokens(more, WORD_BPE, cache=f"{folder}-2")
    assert rows_of(got, "doc_id", "n_tokens") == [(1, 77), (3, 1), (4, 1)]
    assert spark.read.parquet(f"{folder}-2").count() == 2
    # Another tokenizer has its own counts.
    other = count_tokens(more, public_tokenizers.path("byte_bpe_50k.json"), cache=f"{folder}-2")
    assert 77 not in {r["n_tokens"] for r in other.collect()}


# Substrings


def removed(rows, size):
    low = {}
    for doc_id, words in rows:
        for i in range(len(words) - size + 1):
            key = tuple(words[i : i + size])
            low[key] = min(low.get(key, 1 << 62), 1 << 61 if doc_id is None else doc_id)
    out = []
    for doc_id, words in rows:
        gone = set()
        for i in range(len(words) - size + 1):
            if low[tuple(words[i : i + size])] < (1 << 61 if doc_id is None else doc_id):
                gone |= set(range(i, i + size))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def shared_texts(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 40))) for _ in range(12)]
    texts = []
    for _ in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 6))]
        texts.append(rng.choice([" ", "\n", "  "]).join(parts))
    return texts + texts[: n // 10]


@pytest.mark.parametrize("settings_", [{}, {"chunk_bytes": 2000}, {"chunk_bytes": 500, "depth": 1, "cells_per_window": 1}, {"depth": 3, "size": 5}, {"chunk_bytes": 600, "least_piece": 10**6}, {"chunk_bytes": 900, "least_piece": 10**6, "depth": 3, "size": 5, "cells_per_window": 1}])
def test_removes_what_smaller_documents_have(documents, settings_):
    texts = shared_texts(1, 120)
    random.Random(2).shuffle(texts)
    rows = [(i if i % 7 else i + 1, t, "en", "s") for i, t in enumerate(texts)]
    got = remove_repeats(documents(rows), **settings_)
    want = removed([(r[0], r[1].encode().split()) for r in rows], settings_.get("size", 13))
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept") == want


def test_more_chunks_than_buckets(spark, documents):
    """Spark's limit of buckets bounds the buckets, not the chunks; no table is left behind."""
    name = "spark.sql.sources.bucketing.maxBuckets"
    before = spark.conf.get(name)
    tables = {t.name for t in spark.catalog.listTables()}
    texts = shared_texts(4, 150)
    spark.conf.set(name, "5")
    try:
        got = remove_repeats(documents(texts), chunk_bytes=400)
        found = rows_of(got, "doc_id", "n_words", "n_removed", "kept")
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)
    assert found == removed([(i, t.encode().split()) for i, t in enumerate(texts)], 13)
    assert "SelectedBucketsCount: 5 out of 5" in plan
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_pieces_stay_large():
    """Windows in a piece on average, from 30 GB to 100 TB: the rows sent grow with the windows."""
    from rowtide.llm.substring_dedup import Plan

    held = {}
    for size in (0.5e9, 30e9, 300e9, 3e12, 100e12):
        windows, chunks = size / 6, size / (4 << 20)
        plan = Plan.of(13, 2, 4 * windows, windows / chunks, 512)
        assert 2 ** (plan.bits - plan.range_bits) <= 2**25
        first = windows / chunks / 2**plan.coarse_bits
        second = plan.group * windows / chunks / 2**plan.range_bits if plan.two_steps else first
        held[size] = (plan.two_steps, round(min(first, second)))
    assert [two for two, _ in held.values()] == [False, False, True, True, True]
    assert all(n >= 450 for _, n in held.values()), held


def test_substring_odd_rows(documents, odd_rows, clashing):
    got = remove_repeats(clashing(documents(odd_rows)), chunk_bytes=4000)
    want = removed([(r[0], (r[1] or "").encode().split()) for r in odd_rows], 13)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept") == want
    assert remove_repeats(documents([])).count() == 0


def test_cleaned_documents_keep_their_columns(documents, odd_rows, clashing):
    docs = clashing(documents(odd_rows))
    got = cleaned_documents(docs)
    assert got.columns == docs.columns and got.count() == len(odd_rows)
    by_id = {r["doc_id"]: r for r in got.where("doc_id is not null").collect()}
    assert by_id[1]["text"] == odd_rows[0][1] and by_id[2]["text"] == "" and by_id[2]["n_chars"] == 0
    assert by_id[3]["text"] is None and by_id[6]["text"] == odd_rows[8][1] and by_id[6]["label"] == "x"


@given(st.sets(st.integers(0, 2**32 - 1)))
def test_packed_numbers_round_trip(values):
    sorted_ = np.array(sorted(values), np.int64)
    assert unpack(pack_ints(sorted_), len(sorted_)).tolist() == sorted_.tolist()


# Mixing


def wanted_targets(sizes, weights, share, most):
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in full]
        level = max(0, total - sum(full.values())) / max(1e-300, sum(weight[s] for s in rest))
        over = [s for s in rest if weight[s] * level >= most * sizes[s]]
        if not over or not rest:
            return {s: full.get(s, weight[s] * level) for s in order}
        full.update({s: most * sizes[s] for s in over})


@pytest.mark.parametrize("share", [0.3, 1.5, 1.9, 3.0])
def test_mix_meets_its_targets(documents, share):
    rng = random.Random(4)
    names = ["b", "a", "Z", "é", None, "\U00010000", "￮", "none"]
    rows = [(i, None if (s := rng.choice(names)) == "none" else "w " * int(rng.paretovariate(1.2) * 5), "en", s) for i in range(1500)]
    got = mix(documents(rows), share=share).collect()
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["copies"] == -(-r["taken"] // r["size"]) if r["size"] else r["copies"] == 0
    for s in names:
        sizes[s] += 0
    want = wanted_targets(dict(sizes), (3, 1, 2), share, 2)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9, abs=1e-6)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    assert sum(r["taken"] != r["copies"] * r["size"] for r in got) <= len(names)


def test_rates_are_tilted_by_size(documents):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(1, 300), "en", "ab"[i % 2]) for i in range(4000)]
    got = [(r["size"], r["copies"]) for r in mix(documents(rows), share=0.5).collect() if r["source"] == "b"]
    short, long_ = [c for s, c in got if s < 60], [c for s, c in got if s > 240]
    assert np.mean(short) > np.mean(long_)


def test_mix_odd_rows(documents, odd_rows, clashing):
    docs = clashing(documents(odd_rows))
    first, again = (rows_of(mix(docs), "doc_id", "source", "size", "target", "taken") for _ in range(2))
    assert first == again and len(first) == len(odd_rows)
    assert mix(documents([])).count() == 0
    assert mix(documents([(1, None, "en", "a"), (2, "", "en", None)])).agg(F.sum("taken"), F.sum("target")).first()[:] == (0, 0.0)


def test_repeated_documents_hold_the_words(documents, odd_rows, clashing):
    docs = clashing(documents(odd_rows))
    taken = Counter()
    for r in mix(docs).collect():
        taken[r["doc_id"]] += r["taken"]
    out = repeated_documents(docs)
    assert out.columns == docs.columns
    held = Counter()
    for r in out.collect():
        held[r["doc_id"]] += len(r["text"].encode().split())
        assert r["n_chars"] == len(r["text"])
    assert {k: v for k, v in taken.items() if v} == dict(held)


# SimHash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_groups(rows, reach=2):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= reach:
                root[find(i)] = find(j)
    low = defaultdict(lambda: None)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[find(i)] = doc_id if low[find(i)] is None else min(low[find(i)], doc_id)
    return sorted(((d, f"{prints[i]:016x}", low[find(i)]) for i, (d, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("shard_rows", [2048, 16])
def test_groups_equal_all_pairs(documents, shard_rows):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randint(0, 500)}" for _ in range(rng.randint(0, 120))) for _ in range(150)]
    for t in list(texts):
        words = t.split()
        if words:
            words[rng.randrange(len(words))] = "CHANGED"
            texts += [" ".join(words), t.upper(), t.replace(" ", "\n")]
    rows = [(i if i % 11 else None, t, "en", "s") for i, t in enumerate(texts)]
    got = near_groups(documents(rows), shard_rows=shard_rows)
    assert rows_of(got, "doc_id", "fingerprint", "component_id") == plain_groups([r[:2] for r in rows])


def test_group_odd_rows(documents, odd_rows, clashing):
    docs = clashing(documents(odd_rows))
    got = near_groups(docs)
    assert rows_of(got, "doc_id", "fingerprint", "component_id") == plain_groups([r[:2] for r in odd_rows])
    assert near_groups(documents([])).count() == 0
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [1, 3, 6, 7, 8, 9]


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 2**32), st.integers(0, 4), st.integers(1, 3))
def test_every_pair_meets_in_a_shard(seed, depth, reach):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 40).astype(np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64))
    points = np.unique(np.concatenate([base, near]))
    row, shard, home = plant(points[:20], depth).route(points, reach)
    assert sorted(row[home].tolist()) == list(range(len(points)))
    at = defaultdict(set)
    for r, s, h in zip(row.tolist(), shard.tolist(), home.tolist()):
        at[r].add((s, h))
    for i in range(len(points)):
        for j in range(i):
            if int(points[i] ^ points[j]).bit_count() <= reach:
                mine = {s for s, h in at[i] if h} & {s for s, _ in at[j]} | {s for s, _ in at[i]} & {s for s, h in at[j] if h}
                assert mine


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 8))
def test_local_search_finds_all_links(seed, leaf):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 6).astype(np.uint64)
    points = np.unique(np.concatenate([base[rng.integers(0, 6, 60)] ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)), base]))
    label = link_labels(points, len(points), 2, leaf=leaf)
    whole = link_labels(points, len(points), 2, leaf=10_000)
    assert label.tolist() == whole.tolist()


@pytest.mark.parametrize(("shard_rows", "sample_rows"), [(64, 16), (16, 64), (40, 8)])
def test_divided_shards_lose_no_link(spark, shard_rows, sample_rows):
    rng = np.random.default_rng(shard_rows)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    flip = [base ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) for _ in range(3)]
    points = np.unique(np.concatenate([base, *flip]))
    values = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    links = near_links(values, 2, shard_rows=shard_rows, sample_rows=sample_rows).collect()
    at = {int(p): i for i, p in enumerate(points.view(np.int64))}
    label = np.arange(len(points))
    merge_labels(label, np.array([at[r["a"]] for r in links]), np.array([at[r["b"]] for r in links]))
    assert label.tolist() == link_labels(points, len(points), 2, leaf=10_000).tolist()


# Packing


def check_bins(rows, capacity):
    """Capacity, conflicts, and every word of every document once."""
    fill, clusters = Counter(), defaultdict(list)
    for r in rows:
        if r["bin_id"] is not None:
            assert r["position"] + r["n_words"] <= capacity
            fill[r["bin_id"]] += r["n_words"]
            clusters[r["bin_id"]].append(r["cluster"])
    assert all(v <= capacity for v in fill.values())
    assert all(len(c) == len(set(c)) for c in clusters.values())


def test_pack_holds_every_word_once(documents):
    rng = random.Random(9)
    texts = ["w%d " % rng.randint(0, 40) * rng.choice([1, 5, 90, 300, 700, 2500]) for _ in range(400)]
    docs = documents(texts)
    rows = pack(docs, capacity=512, shard_rows=100).collect()
    cluster = {i: " ".join(t.split()) for i, t in enumerate(texts)}
    check_bins([{**r.asDict(), "cluster": cluster[r["doc_id"]]} for r in rows], 512)
    words = defaultdict(list)
    for r in rows:
        words[r["doc_id"]] += range(r["start"], r["start"] + r["n_words"])
    assert all(sorted(words[i]) == list(range(len(t.split()))) for i, t in enumerate(texts))
    spans = defaultdict(list)
    for r in rows:
        spans[r["bin_id"]].append((r["position"], r["position"] + r["n_words"]))
    for s in spans.values():
        s.sort()
        assert all(a[1] == b[0] for a, b in zip(s, s[1:])) and s[0][0] == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 20), st.integers(0, 3), st.integers(0, 6)), max_size=40))
def test_each_piece_goes_to_the_tightest_compatible_bin(items):
    sizes, sources, clusters = ([x[k] for x in items] for k in range(3))
    order = sorted(range(len(items)), key=lambda i: -sizes[i])
    placed = best_fit(sizes, sources, clusters, 20, order)
    count, needed = Counter(sources), max(1, -(-sum(sizes) // 20))
    turn, bins = Counter(), []
    for i in order:
        lane = (sources[i], turn[sources[i]] % -(-2 * count[sources[i]] // needed))
        turn[sources[i]] += 1
        open_ = [b for b in bins if b["left"] >= sizes[i] and lane not in b["lanes"] and clusters[i] not in b["clusters"]]
        at, offset = placed[i]
        if open_:
            assert bins[at]["left"] == min(b["left"] for b in open_) and bins[at] in open_
        else:
            assert at == len(bins)
            bins.append({"left": 20, "lanes": set(), "clusters": set()})
        assert offset == 20 - bins[at]["left"]
        bins[at]["left"] -= sizes[i]
        bins[at]["lanes"].add(lane)
        bins[at]["clusters"].add(clusters[i])


def test_pack_odd_rows(documents, odd_rows, clashing):
    rows = pack(clashing(documents(odd_rows))).collect()
    held = Counter()
    for r in rows:
        held[r["doc_id"]] += r["n_words"]
    want = Counter()
    for r in odd_rows:
        want[r[0]] += len((r[1] or "").encode().split())
    assert held == want and sum(r["bin_id"] is None for r in rows) == 4
    copies = [r["bin_id"] for r in rows if r["doc_id"] in (1, 2)]
    assert len(set(copies)) == 3
    assert pack(documents([])).count() == 0


def test_hot_cluster_has_bins_of_its_own(documents):
    rows = pack(documents([("same text here" if i % 3 else f"text {i} here") for i in range(300)]), capacity=64, shard_rows=50).collect()
    per_bin = Counter(r["bin_id"] for r in rows if r["doc_id"] % 3)
    assert max(per_bin.values()) == 1
