"""Best-fit packing of documents into context windows, under conflicts."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import WORD_PATTERN, store, word_count


@dataclass
class Bins:
    """Open bins in order of their residual, each with a bitmap of its sources and one of its duplicate clusters."""

    capacity: int
    residual: list[int] = field(default_factory=list)
    sources: list[int] = field(default_factory=list)
    clusters: list[int] = field(default_factory=list)
    at: dict[int, list[int]] = field(default_factory=dict)
    # Bit r is set if a bin has residual r; the next residual is the lowest bit from there on.
    present: int = 0

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and offset for a piece: the tightest bin that has room and neither of its bits, else a new one."""
        residual = size
        while rest := self.present >> residual:
            residual += (rest & -rest).bit_length() - 1
            for nth, k in enumerate(self.at[residual]):
                if not (self.sources[k] & source or self.clusters[k] & cluster):
                    self.at[residual].pop(nth)
                    if not self.at[residual]:
                        self.present ^= 1 << residual
                    return k, self.fill(k, size, source, cluster)
            residual += 1
        self.residual.append(self.capacity)
        self.sources.append(0)
        self.clusters.append(0)
        return len(self.residual) - 1, self.fill(len(self.residual) - 1, size, source, cluster)

    def fill(self, k: int, size: int, source: int, cluster: int) -> int:
        offset = self.capacity - self.residual[k]
        self.residual[k] -= size
        self.sources[k] |= source
        self.clusters[k] |= cluster
        # A full bin takes nothing more.
        if self.residual[k]:
            self.at.setdefault(self.residual[k], []).append(k)
            self.present |= 1 << self.residual[k]
        return offset


def lanes(sources: Sequence, order: Sequence[int], bins: int) -> list[tuple]:
    """The source of each piece, with a lane: a source with more pieces than half the ``bins`` takes turns in several."""
    count = Counter(sources)
    seen: Counter = Counter()
    lane: list[tuple] = [()] * len(sources)
    for i in order:
        source = sources[i]
        lane[i] = (source, seen[source] % -(-2 * count[source] // bins))
        seen[source] += 1
    return lane


def bits_of(values: Sequence) -> list[int]:
    """A bit for each value that occurs twice or more; others can conflict with nothing and have none."""
    count = Counter(values)
    known: dict = {}
    return [0 if count[v] < 2 else 1 << known.setdefault(v, len(known)) for v in values]


def best_fit(
    sizes: Sequence[int], sources: Sequence, clusters: Sequence, capacity: int, order: Sequence[int], same: Sequence | None = None
) -> list[tuple[int, int]]:
    """Bin and offset of each piece, placed in ``order``; pieces equal in ``same`` conflict as those of a cluster do."""
    bins = Bins(capacity)
    needed = max(1, -(-sum(sizes) // capacity))
    source, cluster = bits_of(lanes(sources, order, needed)), bits_of(clusters)
    if same is not None:
        shift = max((b.bit_length() for b in cluster), default=0)
        also = bits_of([(i,) if v is None else v for i, v in enumerate(same)])
        cluster = [c | a << shift for c, a in zip(cluster, also)]
    placed: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    for i in order:
        placed[i] = bins.place(sizes[i], source[i], cluster[i])
    return placed


def copies_of(text: Column) -> Column:
    """The duplicate cluster of a text: equal for texts that differ in letter case or spacing only."""
    words = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+", " "))
    return F.unhex(F.md5(words))


def piece_texts(text: Column, last: Column, capacity: int) -> Column:
    """The words of the pieces 0 to ``last`` of a text, each joined by one space."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD_PATTERN})"), F.lit(1))

    def cut(found: Column) -> Column:
        begin = F.sequence(F.lit(0).cast("long"), last)
        return F.transform(begin, lambda i: F.array_join(F.slice(found, (i * capacity + 1).cast("int"), F.lit(capacity)), " "))

    # The words are found once, as the element of an array, however many pieces there are.
    return F.transform(F.array(words), cut)[0]


def pack(documents: DataFrame, *, capacity: int = 2048, cluster: Column | None = None, same: Column | None = None, shard_rows: int = 2048, with_words: bool = False) -> DataFrame:
    """doc_id, row_id, piece, start, n_words, shard, bin, bin_id, position: where each piece of each document goes.

    Documents longer than ``capacity`` words are cut into pieces of that many,
    and a rest. A bin holds at most ``capacity`` words, at most one piece of a
    duplicate cluster (``cluster``; by default texts equal but for case and
    spacing), at most one of rows equal in ``same`` (if given; null is equal to
    none) and at most one of a source. A source with more pieces in a shard
    than half the bins that the shard's words need would leave bins half empty:
    it has several bits, one for as many pieces as that, its pieces in turn,
    and a bin takes one of each. Pieces go largest first to the bin
    with the smallest residual that fits and has no conflict; the search goes
    on from residual to residual until one is found, and a new bin is opened
    if there is none. ``start`` is the first word in the document, and
    ``position`` the first in the bin. ``row_id`` tells the rows apart, also
    those of one doc_id. ``with_words`` adds ``words``, the words of the piece
    joined by one space: the pieces of a bin by position are its text, the
    pieces of a row by start that document's.

    Pieces are dealt to shards of about ``shard_rows``, by a hash of their
    place, and each shard is packed by one task: a source or a cluster that
    holds a third of all rows is spread over all shards like the rest, and no
    task's work depends on the size of the input.

    Null, empty and blank texts have one row, of 0 words, in no bin (null).
    A null source is a source. Rows that repeat an id are packed as documents
    of their own, which conflict as copies. An empty table gives no rows. Other
    columns are ignored.
    """
    size = word_count(F.col("text"))
    group = copies_of(F.col("text")) if cluster is None else cluster
    whole = documents.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"), group.alias("cluster"), (F.lit(None).cast("string") if same is None else same).alias("same"), *([F.col("text")] if with_words else []))
    # Read back from files, a row's place is fixed: a retry deals it to the same shard.
    whole = store(whole, "pack-rows").withColumn("place", F.monotonically_increasing_id())
    last = F.greatest(F.lit(0), F.floor((F.col("size") - 1) / capacity)).cast("long")
    slim = ["doc_id", "source", "size", "cluster", "same", "place"]
    if with_words:
        pieces = whole.select(*slim, F.posexplode(piece_texts(F.col("text"), last, capacity)).alias("nth", "words"))
        pieces = pieces.withColumn("piece", F.col("nth").cast("long"))
    else:
        pieces = whole.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    pieces = pieces.withColumn("start", F.col("piece") * capacity).withColumn("n_words", F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("start")))
    total = whole.agg(F.sum(last + 1)).first()[0] or 0
    shards = max(1, math.ceil(total / shard_rows))
    dealt = pieces.where(F.col("n_words") > 0).withColumn("shard", F.pmod(F.xxhash64("place", "piece"), F.lit(shards)).cast("int"))

    same_given = same is not None
    kept = ["doc_id", "row_id", "piece", "start", "n_words", "shard", *(["words"] if with_words else [])]

    def packed(rows: pa.Table) -> pa.Table:
        sizes, place, piece = (rows.column(c).to_pylist() for c in ("n_words", "place", "piece"))
        order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], place[i], piece[i]))
        where = best_fit(sizes, rows.column("source").to_pylist(), rows.column("cluster").to_pylist(), capacity, order, rows.column("same").to_pylist() if same_given else None)
        return pa.table(
            {
                **{c: rows.column(c) for c in kept},
                "bin": pa.array([b for b, _ in where], pa.int32()),
                "position": pa.array([p for _, p in where], pa.int64()),
            }
        )

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, row_id long, piece long, start long, n_words long, shard int, {'words string, ' if with_words else ''}bin int, position long"
    full = dealt.withColumn("row_id", F.col("place")).select(*kept, "source", "cluster", "same", "place").groupBy("shard").applyInArrow(packed, schema)
    none = whole.where(F.col("size") == 0).select(
        "doc_id",
        F.col("place").alias("row_id"),
        *[F.lit(0).cast("long").alias(c) for c in ("piece", "start", "n_words")],
        F.lit(None).cast("int").alias("shard"),
        *([F.lit("").alias("words")] if with_words else []),
        F.lit(None).cast("int").alias("bin"),
        F.lit(None).cast("long").alias("position"),
    )
    bin_id = F.concat_ws("-", F.col("shard").cast("string"), F.col("bin").cast("string"))
    return full.unionAll(none).withColumn("bin_id", F.when(F.col("bin").isNotNull(), bin_id))
