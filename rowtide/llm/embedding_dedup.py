"""Near-duplicate vectors by collision counting on sorted projections."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import merge_labels, store
from rowtide.llm.graph import components


def normal_cdf(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def binomial_below(n: int, p: float, k: int) -> float:
    """P(fewer than k of n)."""
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k))


@dataclass(frozen=True)
class Collisions:
    """Window and count for pairs of unit vectors at cosine ``threshold`` or more.

    The difference of two projections on a Gaussian direction is normal with
    the distance of the vectors as its deviation. So a pair exactly at the
    threshold lies in the query's window with ``chance`` on each projection,
    closer pairs more often, and ``least`` is the largest count that such a
    pair reaches with probability ``recall``.
    """

    threshold: float
    projections: int
    recall: float
    window: float
    least: int

    @property
    def distance(self) -> float:
        return math.sqrt(2 - 2 * self.threshold)


def calibrated(threshold: float, projections: int, recall: float, widths: float = 1.5) -> Collisions:
    distance = math.sqrt(2 - 2 * threshold)
    chance = 2 * normal_cdf(widths) - 1
    least = projections
    while least > 1 and 1 - binomial_below(projections, chance, least) < recall:
        least -= 1
    return Collisions(threshold, projections, recall, widths * distance, least)


@dataclass(frozen=True)
class Grid:
    """Cells for a group of vectors too large for one: ``levels`` projections cut in steps, in ``tables`` ways."""

    levels: int
    tables: int

    def cells(self, unit: np.ndarray, seed: int, tables: int, distance: float) -> np.ndarray:
        """The cell of each vector in each of the first ``tables`` tables, one column each."""
        cells = np.zeros((len(unit), tables), np.uint64)
        if not self.levels or not tables:
            return cells.view(np.int64)
        dims = unit.shape[1]
        turn = directions(seed + 1, dims, self.levels * self.tables)[:, : self.levels * tables]
        shift = np.random.default_rng([seed + 2, dims]).random(self.levels * self.tables)[: self.levels * tables]
        steps = np.floor(projected(unit, turn) / (STEP * distance) + shift).astype(np.int64).view(np.uint64)
        for k in range(self.levels):
            cells = cells * np.uint64(0x9E3779B97F4A7C15) + steps[:, k :: self.levels]
        return (cells ^ (cells >> np.uint64(29))).view(np.int64)


# A cell's step in distances of a pair at the threshold, and the chances that such a pair,
# or a pair of unrelated unit vectors, shares it on one projection.
STEP = 4.0

# Blocks of a cell at most, and blocks whose vectors visit another one together.
MARKS = 1024
CHUNK_BLOCKS = 8


def same_step(width: float) -> float:
    """Chance that two points share a random step, ``width`` in deviations of their difference."""
    return 1 - 2 * normal_cdf(-width) - 2 / (math.sqrt(2 * math.pi) * width) * (1 - math.exp(-(width**2) / 2))


def grid_for(rows: int, cell_rows: int, distance: float, recall: float) -> Grid:
    """As many levels as bring unrelated vectors to ``cell_rows`` a cell, and as many tables as keep the recall."""
    if rows <= cell_rows:
        return Grid(0, 1)
    apart = same_step(STEP * distance / math.sqrt(2))
    levels = math.ceil(math.log(rows / cell_rows) / -math.log(apart))
    together = same_step(STEP) ** levels
    return Grid(levels, math.ceil(math.log(1 - recall) / math.log(1 - together)))


def directions(seed: int, dims: int, count: int) -> np.ndarray:
    return np.random.default_rng([seed, dims]).standard_normal((dims, count))


def projected(unit: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """``unit @ turn``, summed in the same order for each vector, so that it is the same number whatever others come with it."""
    out = np.zeros((len(unit), turn.shape[1]))
    for k in range(unit.shape[1]):
        out += unit[:, k, None] * turn[k]
    return out


def unit_rows(vectors: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    rows = np.asarray(flat.flatten(), float).reshape(-1, dims)
    return rows / np.sqrt((rows * rows).sum(1))[:, None]


def valid(vector: Column) -> Column:
    """Neither null nor empty nor zero, and finite in every component."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


class SortedLines:
    """The stored points on every projection in order, and the rank of each point there."""

    def __init__(self, stored: np.ndarray):
        points, projections = stored.shape
        order = np.argsort(stored, axis=0, kind="stable")
        self.line = np.ascontiguousarray(np.take_along_axis(stored, order, axis=0).T)
        self.rank = np.empty((projections, points), np.uint16 if points < 1 << 16 else np.uint32)
        for k in range(projections):
            self.rank[k, order[:, k]] = np.arange(points)

    def collisions(self, queries: np.ndarray, window: float) -> np.ndarray:
        """On how many projections each stored point lies in the window centred on each query.

        A window is one run of the sorted points, so a point is in it if its rank
        is less than the run's length beyond the run's first: one unsigned
        comparison, in which smaller ranks wrap around.
        """
        shape = len(queries), self.rank.shape[1]
        count = np.zeros(shape, np.uint8)
        beyond, inside = np.empty(shape, self.rank.dtype), np.empty(shape, bool)
        for k, (line, rank) in enumerate(zip(self.line, self.rank)):
            first = np.searchsorted(line, queries[:, k] - window, "left").astype(rank.dtype)
            end = np.searchsorted(line, queries[:, k] + window, "right").astype(rank.dtype)
            np.subtract(rank[None, :], first[:, None], out=beyond)
            np.less(beyond, (end - first)[:, None], out=inside)
            np.add(count, inside.view(np.uint8), out=count)
        return count


def collision_counts(queries: np.ndarray, stored: np.ndarray, window: float) -> np.ndarray:
    return SortedLines(stored).collisions(queries, window)


def shard_links(group: pa.Table, rule: Collisions, grid: Grid, seed: int, part: int = 32) -> pa.Table:
    """(class_id, links, root) of the classes of one shard that have a link.

    Home vectors are stored and ask, visitors only ask. A pair is verified in
    double precision if its count suffices, and counts in the first table only
    in which both share a cell. A dense group yields one row per vector, not
    its pairs.
    """
    order = np.argsort(~group.column("home").to_numpy(), kind="stable")
    group = group.take(pa.array(order))
    dims = len(group.column("vector")[0])
    unit = unit_rows(group.column("vector"), dims)
    ids = group.column("class_id").to_numpy()
    weight = group.column("n").to_numpy()
    table = group.column("table")[0].as_py()
    # The tables before this one: a pair that shares a cell in one of them was counted there.
    cells = grid.cells(unit, seed, table, rule.distance)
    homes = int(group.column("home").to_numpy().sum())
    line = (unit @ directions(seed, dims, rule.projections)).astype(np.float32)
    stored = SortedLines(line[:homes])
    links = np.zeros(len(ids), np.int64)
    label = np.arange(len(ids))
    # Home vectors ask each other in the first chunk only.
    for a in range(homes if group.column("chunk")[0].as_py() else 0, len(ids), part):
        asking = np.arange(a, min(a + part, len(ids)))
        enough = stored.collisions(line[asking], rule.window) >= rule.least
        # Of two home vectors the earlier one asks.
        enough &= np.arange(homes)[None, :] > np.where(asking < homes, asking, -1)[:, None]
        i, j = np.nonzero(enough)
        for b in range(0, len(i), 1 << 17):
            x, y = asking[i[b : b + (1 << 17)]], j[b : b + (1 << 17)]
            near = np.einsum("ij,ij->i", unit[x], unit[y]) >= rule.threshold
            if table:
                near &= ~(cells[x] == cells[y]).any(1)
            x, y = x[near], y[near]
            np.add.at(links, x, weight[y])
            np.add.at(links, y, weight[x])
            merge_labels(label, x, y)
    # The first of a component by place stands for it; any one would do.
    linked = np.flatnonzero(links)
    return pa.table({"class_id": ids[linked], "links": links[linked], "root": ids[label[linked]]})


def near_vectors(
    vectors: DataFrame,
    *,
    threshold: float = 0.93,
    projections: int = 24,
    recall: float = 0.9995,
    cell_rows: int = 8192,
    block_rows: int = 2048,
    seed: int = 11,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding, label).

    Two vectors link if their labels are equal, their lengths too, and their
    cosine in double precision is ``threshold`` or more. ``n_links`` counts the
    other vectors linked directly, ``component_id`` is the smallest vec_id
    reachable, and ``kept`` says whether that is the row's own.

    Equal vectors of a label are one class, however many, and are only counted.
    A label with up to ``cell_rows`` classes is compared as a whole; a larger
    one is dealt to cells of several tables so that the work stays near
    ``cell_rows`` for each vector. Within a cell, blocks are ranges of one
    sorted projection, and a vector visits the later blocks that its window
    reaches. Pairs that collide on enough projections are verified; what is
    not found is lost with a chance below 1 - ``recall`` per pair and step at
    the threshold, and far less for closer pairs.

    Vectors that are null, empty, zero, or hold a null or non-finite component,
    rows with a null label, and rows with a null vec_id link with nothing; the
    last have a null component and are kept. Rows that repeat a vec_id are
    vectors of their own. An empty table gives no rows. Other columns are
    ignored.
    """
    rule = calibrated(threshold, projections, recall)
    usable = valid(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    # Two 64-bit hashes name a class.
    keyed = vectors.select(
        "vec_id",
        F.when(usable, F.xxhash64("label", "embedding")).alias("k1"),
        F.when(usable, F.xxhash64(F.lit("second"), "embedding", "label")).alias("k2"),
        "label",
        "embedding",
    )
    rows = store(keyed.select("vec_id", "k1", "k2"), "vector-rows")
    classes = store(
        keyed.where(F.col("k1").isNotNull())
        .groupBy("k1", "k2")
        .agg(F.min("vec_id").alias("smallest"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("embedding").alias("vector"))
        .withColumn("dims", F.size("vector"))
        # A number of its own for each class, also where vec_ids repeat; read back, it is fixed.
        .withColumn("class_id", F.xxhash64("k1", "k2", "smallest")),
        "vector-classes",
    )
    links = store(class_links(classes, rule, cell_rows, block_rows, seed), "vector-links")
    degree = links.groupBy("class_id").agg(F.sum("links").alias("links"))
    root = components(links.select("class_id", "root")).withColumnsRenamed({"node": "class_id", "root": "group"})
    known = classes.select("k1", "k2", "class_id", "smallest", "n").join(degree, "class_id", "left").join(root, "class_id", "left")
    known = known.withColumn("group", F.coalesce("group", "class_id"))
    low = known.groupBy("group").agg(F.min("smallest").alias("component"))
    known = known.join(low, "group").select("k1", "k2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"), "component")
    joined = rows.join(known, ["k1", "k2"], "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def class_links(classes: DataFrame, rule: Collisions, cell_rows: int, block_rows: int, seed: int) -> DataFrame:
    """(class_id, links, root): the links of the classes, found shard by shard."""
    sizes = store(classes.groupBy("label", "dims").agg(F.count(F.lit(1)).alias("size")), "vector-sizes")
    named = sizes.select(F.col("label").alias("l"), F.col("dims").alias("d"), "size")
    sized = classes.join(named, (F.col("label") == F.col("l")) & (F.col("dims") == F.col("d"))).select(
        "class_id", "n", "label", "dims", "size", "vector"
    )
    label = classes.schema["label"].dataType.simpleString()
    vector = classes.schema["vector"].dataType.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The cells of each class in all tables, and its place on the sorted projection."""
        for batch in batches:
            size, dims = batch.column("size").to_numpy(), batch.column("dims").to_numpy()
            at_cells: list = [None] * len(size)
            at_line = np.zeros(len(size))
            for rows, width in sorted(set(zip(size.tolist(), dims.tolist()))):
                at = np.flatnonzero((size == rows) & (dims == width))
                grid = grid_for(rows, cell_rows, rule.distance, rule.recall)
                unit = unit_rows(batch.column("vector").take(pa.array(at)), width)
                for place, row in zip(at.tolist(), grid.cells(unit, seed, grid.tables, rule.distance).tolist()):
                    at_cells[place] = row
                at_line[at] = projected(unit, directions(seed + 3, width, 1))[:, 0]
            columns = [batch.column(c) for c in own]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(at_cells, pa.list_(pa.int64())), pa.array(at_line)], names=[*own, "cells", "line"]
            )

    own = ["class_id", "n", "label", "dims", "size", "vector"]
    schema = f"class_id long, n long, label {label}, dims int, size long, vector {vector}, cells array<long>, line double"
    # A vector goes to the files once; its copies for the tables are made on the way to the shards.
    placed_once = store(sized.select(*own).mapInArrow(deal, schema), "vector-cells")
    dealt = placed_once.select(*own, "line", F.posexplode("cells").alias("table", "cell"))
    key = ["label", "dims", "table", "cell"]
    # Block borders of cells with more than one block: quantiles of the sorted projection, so many that a block has about block_rows.
    counts = dealt.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > block_rows)
    several = store(counts.select(*[F.col(c).alias(f"_{c}") for c in key], F.least(F.lit(MARKS), F.ceil(F.col("rows") / block_rows)).alias("blocks")), "vector-blocks")
    same = F.lit(True)
    for c in key:
        same = same & (F.col(c) == F.col(f"_{c}"))
    quantiles = dealt.select(*key, "line").join(several, same).groupBy(*[f"_{c}" for c in key]).agg(
        F.max("blocks").alias("blocks"), F.percentile_approx("line", [k / MARKS for k in range(1, MARKS)], 10 * MARKS).alias("marks")
    )
    borders = store(
        quantiles.select(
            *[f"_{c}" for c in key],
            F.transform(F.sequence(F.lit(1), (F.col("blocks") - 1).cast("int")), lambda b: F.get("marks", (b * MARKS / F.col("blocks")).cast("int") - 1)).alias("marks"),
        ),
        "vector-borders",
    )
    placed = dealt.join(borders, same, "left").drop(*[f"_{c}" for c in key]).withColumn("marks", F.coalesce("marks", F.array().cast("array<double>")))
    # A pair differs on the projection by more than this many distances with a chance below 1 - recall.
    reach = 3.9 * rule.distance
    first = F.size(F.filter("marks", lambda m: m < F.col("line")))
    last = F.size(F.filter("marks", lambda m: m < F.col("line") + reach))
    shards = placed.withColumn("first", first).withColumn("block", F.explode(F.sequence(first, last)))
    shards = shards.withColumn("home", F.col("block") == F.col("first"))
    # The visitors of a block come in chunks of a few blocks each, and its home vectors are there for every chunk:
    # a dense cell, however large, makes more shards and not larger ones.
    chunk = F.floor((F.col("block") - F.col("first")) / CHUNK_BLOCKS).cast("int")
    chunks = F.when(F.col("home"), F.sequence(F.lit(0), F.floor(F.col("block") / CHUNK_BLOCKS).cast("int"))).otherwise(F.array(chunk))
    shards = shards.withColumn("chunk", F.explode(chunks))
    shards = shards.select("class_id", "n", "vector", "size", "home", *key, "block", "chunk")

    def link(group: pa.Table) -> pa.Table:
        grid = grid_for(group.column("size")[0].as_py(), cell_rows, rule.distance, rule.recall)
        return shard_links(group, rule, grid, seed)

    return shards.groupBy(*key, "block", "chunk").applyInArrow(link, "class_id long, links long, root long")
