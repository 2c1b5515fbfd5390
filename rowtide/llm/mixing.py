"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import store, word_count

# Documents of a source whose order is looked at together; more make more buckets.
BUCKET_ROWS = 8192
KEY_BITS = 63


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source, source_size, target of each source, from (source, source_size).

    The sources, by code point with null last, have ``weights`` in turn and
    share ``share`` times all sizes. A source above ``most`` times its own size
    stops there, and what is over goes to the others by weight, until none is
    above. With the sources ordered by most * size / weight, those that stop
    come first: the level of the rest is what is left after them, over the
    weights left. One row per source is all that is ordered here.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    nth = F.row_number().over(by_name)
    ranked = sizes.withColumn("nth", nth).withColumn("w", F.element_at(turn, (F.pmod(F.col("nth") - 1, F.lit(len(weights))) + 1).cast("int")))
    full = most * F.col("source_size")
    filling = Window.orderBy(full / F.col("w"), "nth")
    everything = Window.partitionBy()
    before = F.coalesce(F.sum(full).over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("w").over(filling.rowsBetween(0, Window.unboundedFollowing))
    budget = share * F.sum("source_size").over(everything)
    levels = ranked.withColumn("place", F.row_number().over(filling)).withColumn("level", F.greatest(F.lit(0.0), budget - before) / left)
    first_open = F.min(F.when(full / F.col("w") > F.col("level"), F.struct("place", "level"))).over(everything)
    final = levels.withColumn("final", first_open)
    target = F.when(F.col("final").isNull(), full).otherwise(F.least(full, F.col("w") * F.col("final.level")))
    return final.select("source", "source_size", target.cast("double").alias("target"))


def tilt(size: Column, slope: Column, mean: Column, most: float) -> Column:
    """The rate of a document: exponentially tilted by its size, at most ``most``."""
    return F.least(F.lit(most), F.exp(F.least(F.lit(60.0), F.greatest(F.lit(-700.0), slope * size / mean))))


def balance(grouped: DataFrame, wanted: DataFrame, most: float, *, rounds: int = 80, tolerance: float = 1e-9) -> DataFrame:
    """source, source_size, target, slope, mean: the tilt whose rates times sizes sum to the target.

    ``grouped`` has (source, size, n): documents of one source and size have one
    rate. The dual of the entropy problem is convex and has one number per
    source; a round is one aggregation for the sum and its derivative, then a
    Newton step, or a bisection where that would leave the bracket. A target at
    the limit needs no tilt: its rates are ``most`` and its slope is null.
    """
    base = grouped.where(F.col("size") > 0)
    mean = base.groupBy(F.col("source").alias("s")).agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    full = F.col("target") >= most * F.col("source_size") * (1 - 1e-12)
    state = wanted.join(mean, F.col("source").eqNullSafe(F.col("s"))).select(
        "source",
        "source_size",
        "target",
        "mean",
        F.when(~full, F.lit(0.0)).alias("slope"),
        F.lit(-1e9).alias("low"),
        F.lit(1e9).alias("high"),
        full.alias("done"),
    )
    state = store(state, "mix-state")
    for _ in range(rounds):
        if not state.where(~F.col("done")).limit(1).count():
            break
        open_ = state.where(~F.col("done")).select(F.col("source").alias("s"), "mean", "slope")
        at = base.join(open_, F.col("source").eqNullSafe(F.col("s")))
        rate = tilt(F.col("size"), F.col("slope"), F.col("mean"), most)
        words = rate * F.col("size") * F.col("n")
        sums = at.groupBy("s").agg(
            F.sum(words).alias("value"),
            F.sum(F.when(rate < most, words * F.col("size") / F.col("mean")).otherwise(0.0)).alias("steep"),
        )
        gap = F.col("value") - F.col("target")
        near = F.col("done") | (F.abs(gap) <= F.greatest(F.lit(1e-6), tolerance * F.col("target")))
        low = F.when(gap < 0, F.col("slope")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("slope")).otherwise(F.col("high"))
        newton = F.col("slope") - F.try_divide(gap, F.col("steep"))
        # Halves the bracket on a scale that is logarithmic far from zero.
        middle = F.sinh((F.asinh(low) + F.asinh(high)) / 2)
        step = F.when(near, F.col("slope")).when((F.col("steep") > 0) & (newton > low) & (newton < high), newton).otherwise(middle)
        moved = state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", "target", "mean", step.alias("slope"), low.alias("low"), high.alias("high"), near.alias("done")
        )
        state = store(moved, "mix-state")
    return state.select("source", "source_size", "target", "slope", "mean")


def with_key(documents: DataFrame) -> DataFrame:
    """Adds _size (words), _source and _key (a hash that orders the documents of a source)."""
    size = word_count(documents["text"])
    source = documents["source"].cast("string")
    key = F.shiftrightunsigned(F.xxhash64(documents["doc_id"], size, source), 64 - KEY_BITS)
    return documents.withColumns({"_size": size, "_source": source, "_key": key})


def rounded(most: int) -> Column:
    """Copies of a document: its rate rounded by its hash, up with the chance of the fraction."""
    rate = F.when(F.col("slope").isNull(), F.lit(float(most))).otherwise(tilt(F.col("_size"), F.col("slope"), F.col("mean"), float(most)))
    # 53 bits of another hash as a number in [0, 1).
    chance = F.shiftrightunsigned(F.xxhash64("_key", F.lit("copies")), 11) / F.lit(float(1 << 53))
    return F.when(F.col("_size") > 0, F.least(F.lit(most), F.floor(rate + chance))).otherwise(0).cast("long")


def room(most: int) -> Column:
    """Words by which one copy more (where words are missing) or one less changes the mix."""
    can = ((F.col("gap") > 0) & (F.col("copies") < most)) | ((F.col("gap") < 0) & (F.col("copies") > 0))
    return F.when(can, F.col("_size")).otherwise(F.lit(0).cast("long"))


def mixing_plan(rows: DataFrame, weights: Sequence[float], share: float, most: int) -> DataFrame:
    """One row per source: its tilt, and up to which key its documents get a copy more or less.

    ``rows`` has _size, _source and _key. Rounding leaves a gap to the target;
    in the order of the keys documents gain (or lose) a copy until it is
    closed, the one at ``edge`` in part. The edge is found in two steps, the
    bucket of keys first and the key in it then, so that no source is ordered
    as a whole.
    """
    grouped = store(rows.groupBy(F.col("_source").alias("source"), F.col("_size").alias("size")).agg(F.count(F.lit(1)).alias("n")), "mix-groups")
    total = grouped.agg(F.sum("n")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, total / BUCKET_ROWS))))
    sums = grouped.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    wanted = store(targets(sums, weights, share, float(most)), "mix-targets")
    tilted = balance(grouped, wanted, float(most))
    # A source without a word has no tilt, and nothing to copy.
    tilts = store(
        wanted.join(tilted.select(F.col("source").alias("s"), "slope", "mean"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s"),
        "mix-tilts",
    )
    copied = rows.join(tilts, F.col("_source").eqNullSafe(F.col("source"))).withColumn("copies", rounded(most))
    taken = copied.groupBy("source").agg(F.sum(F.col("copies") * F.col("_size")).alias("rounded"))
    gaps = store(
        tilts.join(taken.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
        .drop("s")
        .withColumn("gap", (F.round("target").cast("long") - F.coalesce("rounded", F.lit(0))).cast("long")),
        "mix-gaps",
    )
    open_ = rows.join(gaps, F.col("_source").eqNullSafe(F.col("source"))).withColumn("copies", rounded(most))
    open_ = open_.withColumn("room", room(most)).where(F.col("room") > 0).withColumn("bucket", F.shiftright("_key", KEY_BITS - bits))
    need = F.abs("gap")

    def edge(parts: DataFrame, by: str) -> DataFrame:
        """The part of each source in which its running sum of room passes the gap."""
        so_far = Window.partitionBy("source").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        placed = parts.withColumn("start", F.col("offset") + F.coalesce(F.sum("all_room").over(so_far), F.lit(0)))
        return placed.where((F.col("start") <= F.col("need")) & (F.col("need") < F.col("start") + F.col("all_room")))

    buckets = open_.groupBy("source", "bucket").agg(F.sum("room").alias("all_room"), F.max(need).alias("need"))
    at_bucket = store(
        edge(buckets.withColumn("offset", F.lit(0).cast("long")), "bucket").select(F.col("source").alias("s"), F.col("bucket").alias("b"), "start"), "mix-buckets"
    )
    inside = open_.join(at_bucket, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    keys = inside.groupBy("source", "_key").agg(
        F.sum("room").alias("all_room"), F.max(need).alias("need"), F.max("start").alias("offset"), F.count(F.lit(1)).alias("rows")
    )
    at_key = edge(keys, "_key").select(
        F.col("source").alias("s"), F.col("_key").alias("edge"), F.floor((F.col("need") - F.col("start")) / F.col("rows")).cast("long").alias("part")
    )
    # Where all the room does not close the gap there is no edge, and all of it is used.
    plan = gaps.join(at_key, F.col("source").eqNullSafe(F.col("s")), "left").withColumn(
        "edge", F.coalesce("edge", F.when(F.col("gap") == 0, F.lit(-1)).otherwise(F.lit((1 << 63) - 1)).cast("long"))
    )
    return store(plan.select("source", "source_size", "target", "slope", "mean", "gap", "edge", F.coalesce("part", F.lit(0)).alias("part")), "mix-plan")


def apply_plan(rows: DataFrame, plan: DataFrame, most: int) -> DataFrame:
    """``rows`` with source_size, target, copies and taken. Row by row: the plan has one row per source."""
    names = {c: f"_plan_{c}" for c in ("source", "source_size", "target")}
    renamed = plan.withColumnsRenamed(names)
    joined = rows.join(renamed, F.col("_source").eqNullSafe(F.col("_plan_source"))).withColumn("copies", rounded(most))
    change = F.when(F.col("_key") < F.col("edge"), F.col("_room")).when(F.col("_key") == F.col("edge"), F.least("_room", "part")).otherwise(F.lit(0))
    taken = F.col("copies") * F.col("_size") + F.when(F.col("gap") < 0, -change).otherwise(change)
    done = joined.withColumn("_room", room(most)).withColumn("_taken", taken.cast("long"))
    return done.withColumn("_copies", F.when(F.col("_size") > 0, F.ceil(F.col("_taken") / F.col("_size"))).otherwise(0).cast("long"))


def mix(documents: DataFrame, *, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every row of ``documents``.

    ``size`` counts words. The rates of a source are exponentially tilted by
    size so that they meet its target, and are rounded to ``copies`` by a hash
    of id, size and source. What rounding leaves over or short is settled with
    further whole copies in the order of the hash, the last of them cut to the
    words still missing. So ``taken`` is ``copies`` times ``size`` but for one
    document of a source, its sum is the target to the word, and it is never
    above ``most`` times ``size``.

    Reruns give the same result. Null, empty and blank texts have size 0 and
    take nothing. A null source is a source of its own, the last; a source
    without a word has target 0. Repeated rows have one hash and are treated
    alike; if one of them is cut all are, and the sum may be off by less than a
    word for each. A null doc_id is an id like any other. An empty table gives
    no rows. Other columns are ignored. Documents are only summed by source, by
    size and by bucket of the hash; nothing else is shuffled, and no source is
    ordered as a whole.
    """
    slim = documents.select("doc_id", "source", "text")
    rows = store(with_key(slim).drop("source", "text"), "mix-rows")
    plan = mixing_plan(rows, weights, share, most)
    return apply_plan(rows, plan, most).select(
        "doc_id",
        F.col("_source").alias("source"),
        F.col("_size").alias("size"),
        F.col("_plan_source_size").alias("source_size"),
        F.col("_plan_target").alias("target"),
        F.col("_copies").alias("copies"),
        F.col("_taken").alias("taken"),
    )


def repeated_documents(documents: DataFrame, *, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """The rows of ``documents`` as often as the mix takes them, with all their columns.

    A document that is cut keeps its first words in its last copy, joined by
    one space, with ``n_chars`` to match where there is one. The texts are not
    shuffled.
    """
    plan = mixing_plan(with_key(documents.select("doc_id", "source", "text")).select("_size", "_source", "_key"), weights, share, most)
    # The row travels as one struct, so that no column of it can clash with the plan's.
    boxed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"), "doc_id", "source", "text")
    kept = apply_plan(with_key(boxed), plan, most).where(F.col("_taken") > 0)
    out = kept.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    left = F.col("_taken") - (F.col("_copy") - 1) * F.col("_size")
    cut = left < F.col("_size")
    words = F.regexp_extract_all(F.col("text"), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    shown = F.when(cut, F.array_join(F.slice(words, 1, left.cast("int")), " ")).otherwise(F.col("text"))
    out = out.withColumn("_text", shown).withColumn("_cut", cut)
    new = {"text": F.col("_text")}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.when(F.col("_cut"), F.length("_text")).otherwise(F.col("_row.n_chars")).cast(documents.schema["n_chars"].dataType)
    return out.select(*[(new[c] if c in new else F.col(f"_row.`{c}`")).alias(c) for c in documents.columns])
