"""SimHash near-duplicates, searched with vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import first_by_hash, merge_labels, spread_join, store
from rowtide.llm.graph import components


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of the XXH64 values of the word shingles, repeats included; 0 without a word."""
    # bytes.lower() changes A-Z only.
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    size = min(shingle, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    stop = ends[size - 1 :].tolist()
    start = [0, *(ends[: len(ends) - size] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    values = np.fromiter((digest(line[a:b], seed) for a, b in zip(start, stop)), np.uint64, len(stop))
    # Bits of equal weight side by side: 8 bytes of 8 bits, the least byte first.
    ones = np.zeros(64, np.int64)
    for part in range(0, len(values), 1 << 16):
        block = values[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, digest, fp) of every row; ``fp`` is the fingerprint as a signed long, ``digest`` that of the text."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
        return pd.Series(values.view(np.int64))

    return documents.select("doc_id", text_digest(documents["text"]).alias("digest"), run(documents["text"]).alias("fp"))


def text_digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


@dataclass(frozen=True)
class Tree:
    """A vantage-point tree over the fingerprint space: node k has children 2k+1 (within ``radius``) and 2k+2.

    The nodes below the last level are the shards. Every point of the space has
    one home shard; a ball around it overlaps further ones.
    """

    depth: int
    vantage: np.ndarray = field(repr=False)
    radius: np.ndarray = field(repr=False)

    @property
    def shards(self) -> int:
        return 1 << self.depth

    def route(self, points: np.ndarray, reach: int, home: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, shard and whether the shard is the row's home, for all shards a ball of ``reach`` may touch.

        Visits go to shards after the home shard only: of two points in
        different shards, the one in the earlier shard finds the other. Points
        that are not at ``home`` come as visitors from elsewhere.
        """
        row = np.arange(len(points))
        node = np.zeros(len(points), np.int64)
        home = np.ones(len(points), bool) if home is None else home
        for _ in range(self.depth):
            far = np.bitwise_count(points[row] ^ self.vantage[node]).astype(np.int64)
            inner = far <= self.radius[node]
            # By the triangle inequality no point beyond the radius is within reach of one closer than radius - reach.
            crosses = inner & (far > self.radius[node] - reach)
            # A visitor stays a query on both sides it overlaps; a home row sends one to the later side.
            back = ~inner & ~home & (far <= self.radius[node] + reach)
            row = np.concatenate([row, row[crosses], row[back]])
            child = 2 * node + np.where(inner, 1, 2)
            node = np.concatenate([child, 2 * node[crosses] + 2, 2 * node[back] + 1])
            home = np.concatenate([home, np.zeros(crosses.sum() + back.sum(), bool)])
        return row, node - (self.shards - 1), home


def plant(sample: np.ndarray, depth: int) -> Tree:
    """A tree whose radii are the medians of the sample's distances."""
    nodes = (1 << depth) - 1
    vantage, radius = np.zeros(max(1, nodes), np.uint64), np.full(max(1, nodes), 32, np.int64)

    def grow(node: int, points: np.ndarray) -> None:
        if node >= nodes or not len(points):
            return
        vantage[node] = points[0]
        far = np.bitwise_count(points ^ points[0]).astype(np.int64)
        radius[node] = int(np.median(far))
        inner = far <= radius[node]
        grow(2 * node + 1, points[inner])
        grow(2 * node + 2, points[~inner])

    grow(0, sample)
    return Tree(depth, vantage, radius)


def link_labels(points: np.ndarray, homes: int, reach: int, leaf: int = 1024) -> np.ndarray:
    """Labels of the components that links within ``reach`` make; the first ``homes`` points are searched, all search.

    A local vantage-point tree is descended with the points and the queries at
    once. Pairs already known to hang together are skipped, so that a dense
    group yields a spanning set of links and not all its pairs.
    """
    label = np.arange(len(points))

    def search(stored: np.ndarray, asking: np.ndarray, dull: int = 0) -> None:
        if not len(stored) or not len(asking):
            return
        if len(stored) <= leaf or dull > 3:
            for a in range(0, len(asking), leaf):
                for b in range(0, len(stored), leaf):
                    compare(asking[a : a + leaf], stored[b : b + leaf])
            return
        centre = points[stored[len(stored) // 2]]
        far = np.bitwise_count(points[stored] ^ centre).astype(np.int64)
        away = np.bitwise_count(points[asking] ^ centre).astype(np.int64)
        radius = int(np.median(far))
        inner = far <= radius
        dull = dull + 1 if inner.all() else 0
        search(stored[inner], asking[away <= radius + reach], dull)
        search(stored[~inner], asking[away > radius - reach], dull)

    def compare(asking: np.ndarray, stored: np.ndarray) -> None:
        near = np.bitwise_count(points[asking][:, None] ^ points[stored][None, :]) <= reach
        near &= label[asking][:, None] != label[stored][None, :]
        i, j = np.nonzero(near)
        if len(i):
            merge_labels(label, asking[i], stored[j])

    everyone = np.arange(len(points))
    search(everyone[:homes], everyone)
    return label


def levels_for(total: int, shard_rows: int) -> int:
    levels = 0
    while (shard_rows << levels) < total:
        levels += 1
    return levels


def divided(routed: DataFrame, step: int, expected: int, reach: int, sample_rows: int, block_rows: int = 1 << 16) -> DataFrame:
    """Each shard of ``routed`` (fp, shard, home) cut into 2 ** ``step`` by a tree of its own.

    A shard's tree is planted from about ``sample_rows`` of the ``expected``
    fingerprints at home in it, chosen by hash, and meets the shard's rows in
    blocks, so that no task holds a shard as a whole.
    """
    chance = min(1.0, sample_rows / expected)
    # Another hash for each round: what was chosen before is no sample of the next one.
    chosen = F.pmod(F.xxhash64("fp", F.lit(expected)), F.lit(1 << 40)) < int(chance * (1 << 40))

    def planted(group: pa.Table) -> pa.Table:
        points = np.sort(group.column("fp").to_numpy().view(np.uint64))
        tree = plant(np.random.default_rng(len(points)).permutation(points), step)
        return pa.table({"shard": group.column("shard")[:1], "vantage": [tree.vantage.view(np.int64)], "radius": [tree.radius]})

    trees = routed.where(F.col("home") & chosen).select("shard", "fp").groupBy("shard").applyInArrow(planted, "shard long, vantage array<long>, radius array<long>")
    blocks = max(1, -(-expected // block_rows))
    trees = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = routed.withColumn("block", F.pmod(F.xxhash64("fp"), F.lit(blocks)).cast("int"))

    def route(rows: pa.Table, own: pa.Table) -> pa.Table:
        points = rows.column("fp").to_numpy().view(np.uint64)
        if own.num_rows:
            vantage, radius = (np.array(own.column(c)[0].as_py(), np.int64) for c in ("vantage", "radius"))
            tree = Tree(step, vantage.view(np.uint64), radius)
        else:
            tree = plant(points[:0], step)
        row, part, home = tree.route(points, reach, rows.column("home").to_numpy())
        shard = (rows.column("shard").to_numpy()[row] << step) + part
        return pa.table({"fp": points[row].view(np.int64), "shard": shard.astype(np.int64), "home": home})

    key = ["shard", "block"]
    return dealt.groupBy(*key).cogroup(trees.groupBy(*key)).applyInArrow(route, "fp long, shard long, home boolean")


def near_links(values: DataFrame, reach: int, *, shard_rows: int = 2048, sample_rows: int = 8192) -> DataFrame:
    """Links (a, b) that connect every two distinct ``fp`` within ``reach`` bits, directly or through others.

    The first tree is planted from the first ``sample_rows`` fingerprints by
    hash and has at most ``sample_rows`` / 4 shards; it is the only thing sent
    to all tasks. Where shards of about ``shard_rows`` need more of them, each
    shard is divided by a tree of its own, until they do. Every fingerprint
    goes to its home shard and, as a query, to those its ball overlaps. Exact:
    pruning drops a shard only by the triangle inequality.
    """
    total = values.count()
    levels = levels_for(total, shard_rows)
    most = max(1, levels_for(sample_rows, 4))
    depth = min(levels, most)
    first = first_by_hash(values, ["fp"], total, sample_rows).collect() if depth else []
    tree = plant(np.array([r["fp"] for r in first], np.int64).view(np.uint64), depth)
    schema = "fp long, shard long, home boolean"

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            row, shard, home = tree.route(points, reach)
            yield pa.RecordBatch.from_arrays(
                [pa.array(points[row].view(np.int64)), pa.array(shard.astype(np.int64)), pa.array(home)],
                ["fp", "shard", "home"],
            )

    def link(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy()
        order = np.argsort(~group.column("home").to_numpy(), kind="stable")
        points = fp[order]
        label = link_labels(points.view(np.uint64), int(group.column("home").to_numpy().sum()), reach)
        linked = label != np.arange(len(label))
        return pa.table({"a": points[linked], "b": points[label[linked]]})

    routed = values.mapInArrow(route, schema)
    while depth < levels:
        step = min(levels - depth, most)
        routed = divided(store(routed, "shards"), step, shard_rows << (levels - depth), reach, sample_rows)
        depth += step
    return routed.groupBy("shard").applyInArrow(link, "a long, b long")


def near_groups(documents: DataFrame, *, shingle: int = 3, reach: int = 2, shard_rows: int = 2048) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of ``documents``.

    Documents link if their fingerprints differ in ``reach`` bits or fewer;
    ``component_id`` is the smallest doc_id reachable by links, itself
    included. Null, empty and blank texts have fingerprint zero and link like
    any other; rows with equal fingerprints are one node, however many; repeated
    rows give repeated rows. A null doc_id links like any other but is never
    the smallest, and a group of nulls only has a null component. Fewer words
    than a shingle make one shingle. An empty table gives no rows; other
    columns are ignored.
    """
    rows, rooted = rooted_rows(documents, shingle, reach, shard_rows)
    low = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    component = rooted.join(low, "root").select("fp", "component_id")
    return rows.join(component, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def rooted_rows(documents: DataFrame, shingle: int, reach: int, shard_rows: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest, fp) of every row, and (fp, smallest, root) of every fingerprint."""
    rows = store(fingerprints(documents, shingle), "fingerprints")
    nodes = store(rows.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "nodes")
    root = components(near_links(nodes.select("fp"), reach, shard_rows=shard_rows))
    rooted = nodes.join(root.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "smallest", F.coalesce("root", "fp").alias("root")
    )
    return rows, rooted


def keep_one(documents: DataFrame, *, shingle: int = 3, reach: int = 2, shard_rows: int = 2048) -> DataFrame:
    """One row of each group of ``documents``, unchanged: that of the smallest doc_id.

    Rows are told by doc_id and text. If rows of the smallest doc_id differ in
    their texts but not in their group, the one with the smallest digest stays;
    of rows equal in both, one does. Rows of one doc_id in different groups are
    decided on their own. A row without doc_id belongs to no group here and
    stays. Null and empty texts are one group. An empty table gives no rows; all
    columns are kept, whatever their names.
    """
    rows, rooted = rooted_rows(documents, shingle, reach, shard_rows)
    # A group may hold a large part of all rows: both joins deal its rows to several tasks.
    named = spread_join(rows.where(F.col("doc_id").isNotNull()), rooted.select("fp", "root"), "fp")
    members = named.groupBy("root", "doc_id", "digest").agg(F.count(F.lit(1)).alias("rows"))
    best = members.groupBy("root").agg(F.min(F.struct("doc_id", "digest")).alias("best"))
    judged = spread_join(members, best, "root").withColumn("kept", F.struct("doc_id", "digest") == F.col("best"))
    judged = store(
        judged.where(~F.col("kept") | (F.col("rows") > 1)).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "kept"), "simhash-judged"
    )

    def own(known: DataFrame) -> Column:
        return (documents["doc_id"] == known["_id"]) & (text_digest(documents["text"]) == known["_digest"])

    left = documents.join(judged, own(judged), "left_anti")
    repeated = judged.where("kept").drop("kept")
    if repeated.isEmpty():
        return left
    # The rest travels as one struct, so that no column of it can clash.
    key = [repeated["_id"].alias("_a"), repeated["_digest"].alias("_b")]
    boxed = documents.join(repeated, own(repeated)).select(*key, F.struct(*[documents[f"`{c}`"] for c in documents.columns]).alias("_row"))
    one = boxed.groupBy("_a", "_b").agg(F.first("_row").alias("_row"))
    return left.unionAll(one.select("_row.*"))
