"""Exact removal of repeated word windows, behind a count-min prefilter.

The distinct texts are dealt once into chunks and stored in a table bucketed by
chunk, several chunks to a bucket, so that the later passes read a chunk where
it lies and no text is shuffled again. Three passes follow:

1. every chunk sketches its windows (cells and counts of a count-min sketch,
   one list per row of the sketch); the chunks' sketches are merged cell range
   by cell range, and each chunk gets back one bit per cell: counted twice or
   more, or not;
2. a window repeated by its estimate is sent, once per chunk with the smallest
   document that has it, to be grouped exactly by a 128-bit hash of its words;
   the chunk gets back one bit per window: does a smaller document have it;
3. the chunk removes what the windows with that bit cover.

A sketch never underestimates, so no repeated window is lost. Sketch, hashes
and bits are packed; what is shuffled is a few bytes per window and grows with
the input. A window in very many documents is one entry per chunk.

Every chunk has a piece for every range, and both grow in number with the
input. Where pieces would get small, they go in two steps: a chunk's pieces are
for coarse ranges, the chunks of a group are merged coarse range by coarse
range, and the groups' pieces for the ranges within follow; the answers come
back the same way. So a piece holds about as many windows as a chunk has,
divided by the root of the number of ranges.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import store, unique_name, words_of
from rowtide.session import work_dir

LAST = (1 << 63) - 1
# A merged range of the sketch has so many cells at most, 2 ** RANGE_BITS.
RANGE_BITS = 25
# Chunks to a bucket while Spark's limit of buckets allows it.
BUCKET_CHUNKS = 4
FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
BYTES_PER_WORD = 6
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def pack(values: np.ndarray) -> bytes:
    """Sorted non-negative integers as compressed differences, byte plane by byte plane."""
    steps = np.diff(values.astype(np.int64), prepend=0).astype(np.uint32)
    return pa.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def unpack(data: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * count, "zstd", asbytes=True), np.uint8).reshape(4, count)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.int64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finishing steps that spread all bits of a 64-bit hash."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@dataclass
class Windows:
    """The windows of some texts, in order: two hashes, the text and the place of the first word."""

    words: list[list[bytes]]
    start: np.ndarray
    first: np.ndarray
    hashes: tuple[np.ndarray, np.ndarray]

    @property
    def text(self) -> np.ndarray:
        return np.searchsorted(self.start, self.first, side="right") - 1


def windows_of(texts: list[str | None], size: int) -> Windows:
    words = [words_of(t) for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    start = np.concatenate([[0], np.cumsum(counts)])[:-1] if len(words) else np.zeros(0, np.int64)
    # Two independent halves of a 128-bit hash, of every distinct word once.
    coded = pa.array([w for ws in words for w in ws], pa.large_binary()).dictionary_encode()
    halves = np.frombuffer(b"".join(map(xxhash.xxh128_digest, coded.dictionary.to_pylist())), np.uint64).reshape(-1, 2)
    place = coded.indices.to_numpy()
    one, other = halves[place, 0], halves[place, 1]
    n = max(0, len(one) - size + 1)
    hashes = []
    for values, factor in zip((one, other), FACTORS):
        h = np.zeros(n, np.uint64)
        for k in range(size):
            h *= factor
            h += values[k : k + n]
        hashes.append(h)
    spare = np.repeat(counts, counts) - (np.arange(len(one)) - np.repeat(start, counts))
    first = np.flatnonzero(spare[:n] >= size)
    return Windows(words, start, first, (mixed(hashes[0][first]), mixed(hashes[1][first])))


@dataclass(frozen=True)
class Plan:
    """Sizes that follow from the input.

    A sketch row is 2 ** bits wide, in 2 ** range_bits ranges; hashes have as
    many. A chunk's pieces are for 2 ** coarse_bits ranges, and where these are
    fewer, ``group`` chunks are merged before the ranges within a coarse one are
    told apart.
    """

    size: int
    depth: int
    bits: int
    range_bits: int
    coarse_bits: int

    @classmethod
    def of(cls, size: int, depth: int, cells: float, windows_per_chunk: float, least_piece: int) -> Plan:
        bits = math.ceil(math.log2(max(1024, cells)))
        range_bits = min(bits - 8, max(6, bits - RANGE_BITS))
        small = windows_per_chunk < least_piece * 2**range_bits
        return cls(size, depth, bits, range_bits, range_bits // 2 if small else range_bits)

    @property
    def two_steps(self) -> bool:
        return self.coarse_bits < self.range_bits

    @property
    def group(self) -> int:
        return 1 << (self.range_bits - self.coarse_bits)

    @property
    def shift(self) -> np.uint64:
        return np.uint64(64 - self.bits)

    def cells(self, w: Windows, row: int) -> np.ndarray:
        # The rows of the sketch take different bits of the 128.
        h = w.hashes[row % 2]
        if row > 1:
            h = mixed(h + FACTORS[row % 2] * np.uint64(row))
        return (h >> self.shift).astype(np.int64)

    def high(self, one: np.ndarray) -> np.ndarray:
        return (one >> self.shift).astype(np.int64)

    def ranges(self, cells: np.ndarray, range_bits: int) -> Iterator[tuple[int, slice]]:
        """Each of 2 ** range_bits ranges with a sorted cell in it, and where its cells lie."""
        part = cells >> (self.bits - range_bits)
        at = np.flatnonzero(np.diff(part, prepend=-1))
        for a, b in zip(at, [*at[1:], len(cells)]):
            yield int(part[a]), slice(int(a), int(b))

    def base(self, part: int, range_bits: int) -> int:
        return part << (self.bits - range_bits)


def sketch(chunk: int, texts: list[str], plan: Plan) -> Iterator[tuple]:
    """(row, range, chunk, cells, counts, n): the chunk's part of the count-min sketch."""
    w = windows_of(texts, plan.size)
    text = w.text
    for row in range(plan.depth):
        cells = plan.cells(w, row)
        # Once per text: a window that one text repeats is not repeated across documents.
        order = np.lexsort((text, cells))
        c, t = cells[order], text[order]
        once = np.ones(len(c), bool)
        once[1:] = (c[1:] != c[:-1]) | (t[1:] != t[:-1])
        cell, count = np.unique(c[once], return_counts=True)
        count = np.minimum(count, 255).astype(np.uint8)
        yield from sketch_rows(row, chunk, cell, count, plan, plan.coarse_bits)


def sketch_rows(row: int, owner: int, cell: np.ndarray, count: np.ndarray, plan: Plan, range_bits: int) -> Iterator[tuple]:
    for part, at in plan.ranges(cell, range_bits):
        yield row, part, owner, pack(cell[at] - plan.base(part, range_bits)), count[at].tobytes(), at.stop - at.start


def merged_cells(group: pa.Table) -> tuple[np.ndarray, np.ndarray, list[tuple[dict, np.ndarray]]]:
    """The cells of a group of chunks in one coarse range with their counts, and each chunk's own."""
    own = [(r, unpack(r["cells"], r["n"])) for r in group.to_pylist()]
    cells, place = np.unique(np.concatenate([c for _, c in own]), return_inverse=True)
    total = np.bincount(place, np.concatenate([np.frombuffer(r["counts"], np.uint8) for r, _ in own]))
    return cells, np.minimum(total, 255).astype(np.uint8), own


def group_sketch(group: pa.Table, plan: Plan) -> Iterator[tuple]:
    """The merged sketch of a group of chunks, a piece for every range within the coarse one."""
    row, part, owner = (group.column(c)[0].as_py() for c in ("row", "part", "crowd"))
    cells, counts, _ = merged_cells(group)
    yield from sketch_rows(row, owner, cells + plan.base(part, plan.coarse_bits), counts, plan, plan.range_bits)


def hand_down_cells(group: pa.Table, bits: pa.Table) -> Iterator[tuple]:
    """(chunk, row, coarse range, bits): what the group was told of its cells, for each of its chunks."""
    cells, _, own = merged_cells(group)
    told = joined_bits(bits.to_pylist(), group.column("row")[0].as_py())
    for r, mine in own:
        yield r["chunk"], r["row"], r["part"], np.packbits(told[np.searchsorted(cells, mine)]).tobytes(), r["n"]


def repeated_cells(group: pa.Table, width: int) -> Iterator[tuple]:
    """(chunk, row, range, bits): merge one range of one sketch row, and tell each chunk which of its cells count two."""
    # Whether a cell counts two is all that is asked.
    total = np.zeros(width, np.uint8)
    parts = []
    for r in group.to_pylist():
        cell = unpack(r["cells"], r["n"]).astype(np.int32)
        total[cell] = np.minimum(total[cell] + np.minimum(np.frombuffer(r["counts"], np.uint8), 2), 2)
        parts.append((r, cell))
    for r, cell in parts:
        yield r["chunk"], r["row"], r["part"], np.packbits(total[cell] >= 2).tobytes(), r["n"]


def joined_bits(rows: list[dict], row: int) -> np.ndarray:
    mine = sorted((r["part"], r["bits"], r["n"]) for r in rows if r["row"] == row)
    return np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for _, b, n in mine] or [np.zeros(0, np.uint8)]).astype(bool)


@dataclass
class Candidates:
    """The windows repeated by their estimate: places among all windows, and the distinct ones in hash order."""

    place: np.ndarray
    group: np.ndarray
    one: np.ndarray
    other: np.ndarray
    smallest: np.ndarray


def candidates(w: Windows, rank: np.ndarray, bits: list[dict], plan: Plan) -> Candidates:
    flagged = np.ones(len(w.first), bool)
    for row in range(plan.depth):
        cells = plan.cells(w, row)
        flagged &= joined_bits(bits, row)[np.unique(cells, return_inverse=True)[1]] if len(cells) else flagged
    place = np.flatnonzero(flagged)
    one, other = w.hashes[0][place], w.hashes[1][place]
    order = np.lexsort((other, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (other[order][1:] != other[order][:-1])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    smallest = np.full(int(new.sum()), LAST, np.int64)
    np.minimum.at(smallest, group, rank[w.text[place]])
    return Candidates(place, group, one[order][new], other[order][new], smallest)


def exact_entries(chunk: int, found: Candidates, plan: Plan) -> Iterator[tuple]:
    """(part, chunk, one, other, smallest, n): the chunk's distinct candidate windows by range of hash."""
    yield from entry_rows(chunk, found.one, found.other, found.smallest, plan, plan.coarse_bits)


def entry_rows(owner: int, one: np.ndarray, other: np.ndarray, smallest: np.ndarray, plan: Plan, range_bits: int) -> Iterator[tuple]:
    for part, at in plan.ranges(plan.high(one), range_bits):
        yield part, owner, one[at].tobytes(), other[at].tobytes(), smallest[at].tobytes(), at.stop - at.start


@dataclass
class Entries:
    """The entries of several owners as one list, in hash order without repeats, and where each owner's are in it."""

    rows: list[dict]
    one: np.ndarray
    other: np.ndarray
    smallest: np.ndarray
    low: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, group: pa.Table) -> Entries:
        rows = group.to_pylist()
        kinds = {"one": np.uint64, "other": np.uint64, "smallest": np.int64}
        one, other, smallest = (np.concatenate([np.frombuffer(r[k], kind) for r in rows]) for k, kind in kinds.items())
        order = np.lexsort((other, one))
        new = np.ones(len(order), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (other[order][1:] != other[order][:-1])
        at = np.flatnonzero(new)
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        return cls(rows, one[order][at], other[order][at], smallest, np.minimum.reduceat(smallest[order], at), place)

    def answers(self, smaller: np.ndarray) -> Iterator[tuple]:
        """(owner, row, range, bits) from one bit for each entry of each owner, one owner after the other."""
        start = 0
        for r in self.rows:
            yield r["chunk"], -1, r["part"], np.packbits(smaller[start : start + r["n"]]).tobytes(), r["n"]
            start += r["n"]


def group_entries(group: pa.Table, plan: Plan) -> Iterator[tuple]:
    """The entries of a group of chunks with their smallest documents, a piece for every range within the coarse one."""
    found = Entries.of(group)
    yield from entry_rows(group.column("crowd")[0].as_py(), found.one, found.other, found.low, plan, plan.range_bits)


def smaller_exists(group: pa.Table) -> Iterator[tuple]:
    """(chunk, row, range, bits): group equal windows of one range; tell each chunk where a smaller document has one."""
    found = Entries.of(group)
    yield from found.answers(found.low[found.place] < found.smallest)


def hand_down_entries(group: pa.Table, bits: pa.Table) -> Iterator[tuple]:
    """(chunk, row, coarse range, bits): a smaller document has it in another group, or in another chunk of this one."""
    found = Entries.of(group)
    elsewhere = joined_bits(bits.to_pylist(), -1)
    yield from found.answers(elsewhere[found.place] | (found.low[found.place] < found.smallest))


def cleaned(texts: list[str], rank: np.ndarray, bits: list[dict], plan: Plan) -> Iterator[tuple[int, int, list[bytes] | None]]:
    """Per text: words, words removed, and the words kept (None: all)."""
    w = windows_of(texts, plan.size)
    found = candidates(w, rank, bits, plan)
    elsewhere = joined_bits(bits, -1)
    of = w.text[found.place]
    gone = elsewhere[found.group] | (rank[of] > found.smallest[found.group])
    cover = np.zeros(sum(map(len, w.words)) + 1, np.int64)
    at = w.first[found.place[gone]]
    np.add.at(cover, at, 1)
    np.add.at(cover, at + plan.size, -1)
    covered = np.cumsum(cover)[:-1] > 0
    for words, start in zip(w.words, w.start.tolist()):
        mine = covered[start : start + len(words)]
        lost = int(mine.sum())
        yield len(words), lost, None if not lost else [x for x, c in zip(words, mine.tolist()) if not c]


def first_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A text once per task; a later copy only passes its rank on, and that only if it is smaller."""
    seen: dict[bytes, int] = {}
    for batch in batches:
        digest, rank, text = batch.column("digest").to_pylist(), batch.column("rank").to_pylist(), batch.column("text")
        keep, known = [], []
        for i, (d, r) in enumerate(zip(digest, rank)):
            if d not in seen or r < seen[d]:
                keep.append(i)
                known.append(d in seen)
                seen[d] = r
        rows = batch.take(pa.array(keep, pa.int64()))
        bare = pa.compute.if_else(pa.array(known, pa.bool_()), pa.scalar(None, text.type), rows.column("text"))
        yield pa.RecordBatch.from_arrays([rows.column("chunk"), rows.column("digest"), rows.column("rank"), bare], names=["chunk", "digest", "rank", "text"])


def table_of(rows: Iterator[tuple], like: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(like)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, like)], schema=like)


SKETCH = "row int, part long, chunk int, cells binary, counts binary, n int"
ENTRIES = "part long, chunk int, one binary, other binary, smallest binary, n int"
BITS = "chunk int, row int, part long, bits binary, n int"
SKETCH_ARROW = pa.schema([("row", pa.int32()), ("part", pa.int64()), ("chunk", pa.int32()), ("cells", pa.binary()), ("counts", pa.binary()), ("n", pa.int32())])
ENTRIES_ARROW = pa.schema([("part", pa.int64()), ("chunk", pa.int32()), ("one", pa.binary()), ("other", pa.binary()), ("smallest", pa.binary()), ("n", pa.int32())])
BITS_ARROW = pa.schema([("chunk", pa.int32()), ("row", pa.int32()), ("part", pa.int64()), ("bits", pa.binary()), ("n", pa.int32())])


def asked(pieces: DataFrame, key: list[str], judge: Callable, merge: Callable, hand_down: Callable, schema: str, like: pa.Schema, plan: Plan) -> DataFrame:
    """The answers (``BITS``) to the chunks' pieces, whose ranges ``judge`` decides; in two steps where the plan says so."""

    def judged(group: pa.Table) -> pa.Table:
        return table_of(judge(group), BITS_ARROW)

    if not plan.two_steps:
        return pieces.groupBy(*key).applyInArrow(judged, BITS)

    def merged(group: pa.Table) -> pa.Table:
        return table_of(merge(group, plan), like)

    def handed(group: pa.Table, told: pa.Table) -> pa.Table:
        return table_of(hand_down(group, told) if group.num_rows else (), BITS_ARROW)

    crowd = F.floor(F.col("chunk") / plan.group).cast("int")
    pieces = store(pieces.withColumn("crowd", crowd), "pieces")
    answers = pieces.groupBy(*key, "crowd").applyInArrow(merged, schema).groupBy(*key).applyInArrow(judged, BITS)
    # The owner of a merged piece is the group, and its range lies within a coarse one.
    coarse = F.shiftright("part", plan.range_bits - plan.coarse_bits)
    by_crowd = answers.withColumns({"crowd": F.col("chunk"), "_coarse": coarse})
    left = pieces.withColumn("_coarse", F.col("part"))
    on = ["_coarse", "crowd", *(k for k in key if k != "part")]
    return left.groupBy(*on).cogroup(by_crowd.groupBy(*on)).applyInArrow(handed, BITS)


def digest_of(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def remove_repeats(
    documents: DataFrame,
    *,
    size: int = 13,
    depth: int = 2,
    chunk_bytes: int = 4 << 20,
    cells_per_window: int = 4,
    least_piece: int = 512,
    as_text: bool = False,
) -> DataFrame:
    """doc_id, digest, n_words, n_removed and what is kept, for every row of ``documents``.

    A word goes if a window of ``size`` words that covers it also starts in a
    document with a smaller doc_id; windows are judged on the input. ``kept``
    is the SHA-256 of the kept words joined by one space or, with ``as_text``,
    that text itself (the text as it was if nothing went). Pieces that would
    hold fewer than ``least_piece`` windows on average go in two steps.

    Needs the right to create a table: the distinct texts are a bucketed one,
    whose name leaves the catalog at once; its files stay in the work folder.

    Null, empty and blank texts have no words and keep the empty text; texts
    shorter than a window lose nothing; a window that only its own document
    repeats stays. Exact copies are one text: the smallest doc_id stands for
    it, all others lose every word if the text has a window. Rows with the same
    doc_id have the same rank and never remove each other; a null doc_id ranks
    last, and rows without one never remove each other. Repeated rows give
    repeated rows. An empty table gives no rows. Other columns are ignored.
    """
    spark = documents.sparkSession
    rank = F.coalesce(F.col("doc_id"), F.lit(LAST)).cast("long")
    rows = store(
        documents.select(
            F.col("doc_id"), rank.alias("rank"), digest_of(F.col("text")).alias("digest"), F.octet_length("text").alias("n_bytes")
        ),
        "substring-rows",
    )
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    chunks = max(1, math.ceil(total / chunk_bytes))
    windows = total / BYTES_PER_WORD
    plan = Plan.of(size, depth, cells_per_window * windows, windows / chunks, least_piece)
    width = 1 << (plan.bits - plan.range_bits)
    # A bucket holds several chunks, and more where Spark does not allow so many buckets.
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    # Few chunks have a bucket each, so that all cores have work.
    buckets = min(most, chunks, max(math.ceil(chunks / BUCKET_CHUNKS), 4 * spark.sparkContext.defaultParallelism))

    chunk = F.pmod(F.xxhash64("digest"), F.lit(chunks)).cast("int")
    dealt = (
        documents.select(rank.alias("rank"), digest_of(F.col("text")).alias("digest"), F.coalesce("text", F.lit("")).alias("text"))
        .select(chunk.alias("chunk"), "digest", "rank", "text")
        .mapInArrow(first_of_task, "chunk int, digest binary, rank long, text string")
        .repartition(buckets, "chunk")
        .groupBy("chunk", "digest")
        .agg(F.min("rank").alias("rank"), F.first("text", ignorenulls=True).alias("text"))
    )
    name = unique_name("distinct_texts")
    path = f"{work_dir(spark, 'texts')}/rows"
    dealt.write.bucketBy(buckets, "chunk").option("path", path).option("compression", "zstd").saveAsTable(name)
    texts = spark.table(name)
    # Resolved by now: the files and their buckets are known, the name is not needed any more.
    spark.sql(f"DROP TABLE {name}")

    def sketched(group: pa.Table) -> pa.Table:
        return table_of(sketch(group.column("chunk")[0].as_py(), group.column("text").to_pylist(), plan), SKETCH_ARROW)

    def entered(group: pa.Table, known: pa.Table) -> pa.Table:
        if not group.num_rows:
            return ENTRIES_ARROW.empty_table()
        w = windows_of(group.column("text").to_pylist(), plan.size)
        found = candidates(w, group.column("rank").to_numpy(), known.to_pylist(), plan)
        return table_of(exact_entries(group.column("chunk")[0].as_py(), found, plan), ENTRIES_ARROW)

    def finished(group: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        source = group.column("text").to_pylist()
        for old, (n, lost, kept) in zip(source, cleaned(source, group.column("rank").to_numpy(), known.to_pylist(), plan)):
            words = b" ".join(words_of(old) if kept is None else kept)
            if not as_text:
                out.append((n, lost, hashlib.sha256(words).hexdigest()))
            else:
                out.append((n, lost, old if kept is None else words.decode("utf-8", "surrogatepass")))
        n, lost, kept = zip(*out) if out else ((), (), ())
        return pa.table(
            {
                "digest": group.column("digest"),
                "rank": group.column("rank"),
                "n_words": pa.array(n, pa.int64()),
                "n_removed": pa.array(lost, pa.int64()),
                "kept": pa.array(kept, pa.string()),
            }
        )

    def repeated(group: pa.Table) -> Iterator[tuple]:
        return repeated_cells(group, width)

    by_chunk = texts.groupBy("chunk")
    pieces = by_chunk.applyInArrow(sketched, SKETCH)
    doubtful = store(asked(pieces, ["row", "part"], repeated, group_sketch, hand_down_cells, SKETCH, SKETCH_ARROW, plan), "cells")
    entries = by_chunk.cogroup(doubtful.groupBy("chunk")).applyInArrow(entered, ENTRIES)
    smaller = asked(entries, ["part"], smaller_exists, group_entries, hand_down_entries, ENTRIES, ENTRIES_ARROW, plan)
    known = doubtful.unionAll(smaller)
    result = by_chunk.cogroup(known.groupBy("chunk")).applyInArrow(
        finished, "digest binary, rank long, n_words long, n_removed long, kept string"
    )
    copy = rows["rank"] > result["rank"]
    gone = copy & (result["n_words"] >= size)
    nothing = "" if as_text else EMPTY_SHA
    return rows.join(result, "digest").select(
        rows["doc_id"],
        "digest",
        "n_words",
        F.when(gone, result["n_words"]).otherwise(result["n_removed"]).alias("n_removed"),
        F.when(gone, F.lit(nothing)).otherwise(result["kept"]).alias("kept"),
    )


def cleaned_documents(documents: DataFrame, **settings) -> DataFrame:
    """``documents`` with the repeated passages gone from ``text``, and ``n_chars`` to match where there is one.

    A null text stays null. All other columns and the number of rows stay as
    they are. Rows are matched by doc_id and content, so each gets what belongs
    to its own text even if ids repeat.
    """
    found = (
        remove_repeats(documents, as_text=True, **settings)
        .select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.col("kept").alias("_kept"))
        .dropDuplicates(["_id", "_digest"])
    )
    # The old text stays behind, only its digest takes part in the join; the rest travels as
    # one struct, so that no column of it can clash.
    rest = [c for c in documents.columns if c != "text"]
    slim = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row"),
        digest_of(F.col("text")).alias("_own"),
        F.col("text").isNull().alias("_none"),
    )
    both = slim.join(found, (F.col("_own") == F.col("_digest")) & F.col("_row.doc_id").eqNullSafe(F.col("_id")))
    new = {"text": F.when(~F.col("_none"), F.col("_kept"))}
    if "n_chars" in rest:
        new["n_chars"] = F.when(F.col("_none"), F.col("_row.n_chars")).otherwise(F.length("_kept")).cast(documents.schema["n_chars"].dataType)
    return both.select(*[(new[c] if c in new else F.col(f"_row.`{c}`")).alias(c) for c in documents.columns])
