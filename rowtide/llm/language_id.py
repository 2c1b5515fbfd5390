"""Language identification by Kneser-Ney character models."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import fold, store, text_udf

SPACE = 32
OTHER_LETTER = 0xFFFD
ORDER = 4
MIX = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = "und"


def letters() -> np.ndarray:
    """Which of the first 65536 code points are letters."""
    return np.array([chr(i).isalpha() for i in range(1 << 16)])


def symbols(texts: list[str | None], is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of the texts as 16-bit symbols, all else as single spaces, and the text of each.

    A text starts with a space and ends with one. Letters beyond 16 bits are
    one symbol.
    """
    parts = [(" " + (t or "").lower() + " ").encode("utf-32-le", "surrogatepass") for t in texts]
    size = np.fromiter((len(p) // 4 for p in parts), np.int64, len(parts))
    code = np.frombuffer(b"".join(parts), np.uint32)
    low = np.minimum(code, OTHER_LETTER).astype(np.int64)
    letter = is_letter[low]
    wide = np.flatnonzero(code > 0xFFFF)
    letter[wide] = [chr(c).isalpha() for c in code[wide].tolist()]
    text = np.repeat(np.arange(len(parts)), size)
    kept = letter.copy()
    # Of a run of other characters the first one stays, if it starts the text or follows a letter.
    kept[1:] |= letter[:-1]
    kept[np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else []] = True
    return np.where(letter, low, SPACE)[kept].astype(np.uint64), text[kept]


def grams(texts: list[str | None], is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 4-grams of the texts, each packed exactly into 64 bits, and the text of each.

    There is one for every symbol but a text's first space; before the text
    there are spaces. A text without a letter has none.
    """
    one, text = symbols(texts, is_letter)
    key = one.copy()
    for back in range(1, ORDER):
        earlier = np.full(len(one), SPACE, np.uint64)
        earlier[back:] = np.where(text[back:] == text[:-back], one[:-back], np.uint64(SPACE))
        key |= earlier << np.uint64(16 * back)
    starts = np.ones(len(one), bool)
    starts[1:] = text[1:] != text[:-1]
    return key[~starts], text[~starts]


def hashed(keys: np.ndarray) -> np.ndarray:
    """A bijective hash of packed grams: equal hashes are equal grams."""
    h = keys * MIX
    return h ^ (h >> np.uint64(32))


def find(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each hash in a sorted array of them, or -1."""
    if not len(table):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return np.where(table[at] == wanted, at, -1)


@dataclass(frozen=True)
class Level:
    """Grams of one order: sorted hashes with log-probabilities per language, and contexts with back-off logs.

    ``all_grams`` and ``all_contexts`` say that the order has no others.
    """

    hashes: np.ndarray
    log_p: np.ndarray
    contexts: np.ndarray
    log_backoff: np.ndarray
    all_grams: bool
    all_contexts: bool


@dataclass(frozen=True)
class Sums:
    """Per text the log-probabilities summed by language and the number of symbols, and the grams left open, counted."""

    total: np.ndarray
    symbols: np.ndarray
    open_text: np.ndarray
    open_gram: np.ndarray
    open_times: np.ndarray


@dataclass(frozen=True)
class SentModel:
    """The frequent grams of the models, which go to the tasks. What it cannot answer for certain it leaves open."""

    langs: tuple[str, ...]
    levels: tuple[Level, ...]
    floor: float
    is_letter: np.ndarray

    def log_probability(self, keys: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
        """Interpolated log-probability of the last symbol of each gram, one column per language, and which are open.

        A stored gram has it ready. For others the context's back-off weight and
        the shorter gram are looked up, if it is certain that the order has no
        such gram or context.
        """
        if not order:
            return np.full((len(keys), len(self.langs)), self.floor, np.float32), np.zeros(len(keys), bool)
        level = self.levels[order - 1]
        at = find(level.hashes, hashed(keys))
        out = level.log_p[np.maximum(at, 0)] if len(level.hashes) else np.zeros((len(keys), len(self.langs)), np.float32)
        unsure = at < 0
        missing = np.flatnonzero(unsure)
        if len(missing) and level.all_grams:
            rest, inverse = np.unique(keys[missing], return_inverse=True)
            value, deeper = self.log_probability(rest & mask(order - 1), order - 1)
            context = find(level.contexts, hashed(rest >> np.uint64(16)))
            known = context >= 0
            value[known] += level.log_backoff[context[known]]
            if not level.all_contexts:
                deeper |= ~known
            out[missing], unsure[missing] = value[inverse], deeper[inverse]
        return out, unsure

    def sums(self, texts: list[str | None]) -> Sums:
        keys, text = grams(texts, self.is_letter)
        total = np.zeros((len(texts), len(self.langs)))
        open_text, open_gram = [], []
        for a in range(0, len(keys), 1 << 18):
            block = slice(a, a + (1 << 18))
            log_p, unsure = self.log_probability(keys[block])
            log_p[unsure] = 0
            for k in range(len(self.langs)):
                total[:, k] += np.bincount(text[block], log_p[:, k], len(texts))
            open_text.append(text[block][unsure])
            open_gram.append(keys[block][unsure])
        symbols = np.bincount(text, minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)
        of = np.concatenate(open_text) if open_text else np.zeros(0, np.int64)
        gram = np.concatenate(open_gram) if open_gram else np.zeros(0, np.uint64)
        order = np.lexsort((gram, of))
        of, gram = of[order], gram[order]
        first = np.ones(len(of), bool)
        first[1:] = (of[1:] != of[:-1]) | (gram[1:] != gram[:-1])
        start = np.flatnonzero(first)
        return Sums(total, symbols, of[start], gram[start], np.diff(np.append(start, len(of))))

    def columns(self, text: Column) -> Column:
        """A struct of the sums of a text, its number of symbols, and the open grams with how often they occur."""

        def run(texts: list[str | None]) -> dict:
            s = self.sums(texts)
            cut = np.searchsorted(s.open_text, np.arange(1, len(texts)))
            return {
                "total": s.total.tolist(),
                "symbols": s.symbols.tolist(),
                "grams": [g.tolist() for g in np.split(s.open_gram.view(np.int64), cut)][: len(texts)],
                "times": [n.tolist() for n in np.split(s.open_times, cut)][: len(texts)],
            }

        return text_udf(run, "total array<double>, symbols long, grams array<long>, times array<long>")(text)


@dataclass(frozen=True)
class LanguageModels:
    """Kneser-Ney models of all languages: whole in stored tables by order, their frequent part in ``sent``.

    ``grams`` holds (gram, n, log_p) and ``contexts`` (context, n, log_backoff),
    with one value per language in the arrays, lowest order first.
    """

    sent: SentModel
    grams: tuple[DataFrame, ...]
    contexts: tuple[DataFrame, ...]

    @property
    def sent_whole(self) -> bool:
        return all(level.all_grams and level.all_contexts for level in self.sent.levels)

    def look_up(self, wanted: DataFrame) -> DataFrame:
        """(gram, log_p) of each distinct ``gram``, by joins with the whole tables."""
        none = F.array(*[F.lit(0.0) for _ in self.sent.langs])
        found = wanted.select("gram")
        value = F.array(*[F.lit(self.sent.floor) for _ in self.sent.langs])
        for order in range(1, ORDER + 1):
            key = F.col("gram").bitwiseAND(F.lit(signed_mask(order)))
            p = self.grams[order - 1].select(F.col("gram").alias(f"g{order}"), F.col("log_p").alias(f"p{order}"))
            backoff = self.contexts[order - 1].select(F.col("context").alias(f"c{order}"), F.col("log_backoff").alias(f"b{order}"))
            found = found.join(p, key == F.col(f"g{order}"), "left")
            found = found.join(backoff, F.shiftrightunsigned(key, 16) == F.col(f"c{order}"), "left")
            value = F.coalesce(F.col(f"p{order}"), added(F.coalesce(F.col(f"b{order}"), none), value))
        return found.select("gram", value.alias("log_p"))

    def entropies(self, texts: DataFrame) -> DataFrame:
        """``texts`` with ``entropies``: by language, in nats per symbol; null without a letter or a language.

        ``texts`` has a column ``row`` of its own for each row, and ``text``.
        Grams that the tasks leave open are joined with the whole tables, each
        distinct one once.
        """
        langs = self.sent.langs
        scored = store(texts.withColumn("s", self.sent.columns(F.col("text"))).drop("text"), "language-sums")
        total = F.col("s.total")
        if not self.sent_whole:
            left_open = scored.select("row", F.explode(F.arrays_zip("s.grams", "s.times")).alias("o")).select("row", F.col("o.grams").alias("gram"), "o.times")
            known = store(self.look_up(left_open.select("gram").distinct()), "language-rare")
            rare = left_open.join(known, "gram").groupBy("row").agg(
                F.array(*[F.sum(F.col("log_p")[k] * F.col("times")) for k in range(len(langs))]).alias("rare")
            )
            scored = scored.join(rare, "row", "left")
            total = F.when(F.col("rare").isNull(), total).otherwise(added(total, F.col("rare")))
        per_symbol = F.transform(total, lambda x: -x / F.col("s.symbols"))
        known_text = (F.col("s.symbols") > 0) & F.lit(bool(langs))
        return scored.withColumn("entropies", F.when(known_text, per_symbol)).drop("s", "rare")


def added(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def mask(order: int) -> np.uint64:
    return np.uint64((1 << (16 * order)) - 1)


def signed_mask(order: int) -> int:
    return (1 << (16 * order)) - 1 if order < ORDER else -1


def gram_counts(training: DataFrame) -> DataFrame:
    """(lang, gram, c): how often each 4-gram occurs in the texts of each language, over all rows."""
    is_letter = letters()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, text = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for name in sorted(set(lang)):
                mine = [t for t, of in zip(text, lang) if of == name]
                sizes = np.cumsum([len(t or "") for t in mine])
                # Parts of about a million characters bound the memory, whatever the batch.
                for part in np.split(np.arange(len(mine)), np.searchsorted(sizes, np.arange(1 << 20, sizes[-1], 1 << 20))):
                    keys, _ = grams([mine[i] for i in part], is_letter)
                    gram, count = np.unique(keys, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(count.astype(np.int64))],
                        names=["lang", "gram", "c"],
                    )

    parts = training.mapInArrow(run, "lang string, gram long, c long")
    return parts.groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def by_language(rows: DataFrame, key: str, langs: tuple[str, ...]) -> DataFrame:
    """(key, n, value): ``n`` summed over the languages, and their values as an array, 0 where there is none."""
    one = rows.groupBy(key).agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("lang", "value"))).alias("of"))
    each = F.transform(F.array(*[F.lit(name) for name in langs]), lambda name: F.coalesce(F.try_element_at("of", name), F.lit(0.0)))
    return one.select(key, "n", each.alias("value"))


def level_tables(counts: DataFrame, order: int, langs: tuple[str, ...], lower: DataFrame | None, floor: float) -> tuple[DataFrame, DataFrame]:
    """(gram, n, log_p) and (context, n, log_backoff) of one order, over all its grams.

    Per language the discount is n1 / (n1 + 2 n2), with n1 and n2 the grams
    counted once and twice. A language without the gram or the context takes
    the probability of the shorter gram. ``lower`` has those; every shorter
    gram is in it, since it was counted from these.
    """
    once, twice = F.sum((F.col("c") == 1).cast("double")), F.sum((F.col("c") == 2).cast("double"))
    # Never all of a count, nor nothing: both kinds of grams keep some probability.
    discount = F.least(F.lit(0.95), F.greatest(F.lit(0.05), F.coalesce(F.try_divide(once, once + 2 * twice), F.lit(0.5))))
    per_lang = counts.groupBy("lang").agg(discount.alias("discount"))
    rows = counts.withColumn("context", F.shiftrightunsigned("gram", 16))
    sums = rows.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds")).join(per_lang, "lang")
    weight = F.log(F.col("discount") * F.col("kinds") / F.col("total"))
    contexts = store(
        by_language(sums.select("lang", "context", F.col("total").alias("n"), weight.alias("value")), "context", langs).withColumnRenamed("value", "log_backoff"),
        "language-contexts",
    )
    alpha = F.greatest(F.col("c") - F.col("discount"), F.lit(0.0)) / F.col("total")
    own = by_language(rows.join(sums, ["lang", "context"]).select("lang", "gram", F.col("c").alias("n"), alpha.alias("value")), "gram", langs)
    joined = own.join(contexts.select("context", "log_backoff"), F.shiftrightunsigned("gram", 16) == F.col("context"))
    if lower is None:
        shorter = F.array(*[F.lit(floor) for _ in langs])
    else:
        shorter = F.col("lower")
        joined = joined.join(lower.select(F.col("gram").alias("rest"), F.col("log_p").alias("lower")), F.col("gram").bitwiseAND(F.lit(signed_mask(order - 1))) == F.col("rest"))
    # P = alpha + backoff * P of the shorter gram.
    log_p = F.zip_with("value", added(F.col("log_backoff"), shorter), lambda a, rest: F.log(a + F.exp(rest)))
    return store(joined.select("gram", "n", log_p.alias("log_p")), "language-grams"), contexts


def frequent(table: DataFrame, key: str, value: str, most: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Hashes, sorted, and values of the most frequent rows, at most ``most``, and whether these are all.

    Rows come down to a frequency: the lowest one that ``most`` rows at most
    reach. It is found among the distinct frequencies, one row each.
    """
    reached = F.sum("count").over(Window.orderBy(F.col("n").desc()))
    lowest = table.groupBy("n").count().withColumn("rows", reached).where(F.col("rows") <= most).agg(F.min("n")).first()[0]
    top = table.where(F.lit(False) if lowest is None else F.col("n") >= lowest).select(key, value).toArrow().combine_chunks()
    hashes = hashed(top[key].to_numpy().astype(np.int64).view(np.uint64))
    values = np.array(top[value].to_pylist(), np.float32)
    order = np.argsort(hashes)
    return hashes[order], values[order], len(hashes) == table.count()


def fit_languages(training: DataFrame, *, max_entries: int = 1_000_000) -> LanguageModels:
    """Interpolated Kneser-Ney models of all languages in ``training`` (text, lang).

    Counts, continuation counts (in how many contexts a shorter gram continues
    a longer one), discounts, context sums and probabilities are aggregations
    and joins over every row, and no gram is left out: the tables grow with the
    input. Of each order the most frequent grams and contexts, of at most
    ``max_entries`` numbers (grams times languages), are also sent to the tasks.
    """
    floor = -float(np.log(1 << 16))  # Every symbol is possible in every language.
    counts = store(gram_counts(training.where(F.col("lang").isNotNull()).select("lang", "text")), "grams")
    langs = tuple(r[0] for r in counts.select("lang").distinct().orderBy("lang").collect())
    if not langs:
        none = Level(np.zeros(0, np.uint64), np.zeros((0, 0), np.float32), np.zeros(0, np.uint64), np.zeros((0, 0), np.float32), True, True)
        return LanguageModels(SentModel(langs, (none,) * ORDER, floor, letters()), (), ())
    by_order = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit(signed_mask(order)))
        by_order[order] = store(by_order[order + 1].groupBy("lang", shorter.alias("gram")).agg(F.count(F.lit(1)).alias("c")), "grams")
    most = max(1, max_entries // len(langs))
    all_grams, all_contexts, levels = [], [], []
    for order in range(1, ORDER + 1):
        table, contexts = level_tables(by_order[order], order, langs, all_grams[-1] if all_grams else None, floor)
        all_grams.append(table)
        all_contexts.append(contexts)
        gram, log_p, whole = frequent(table, "gram", "log_p", most)
        context, log_backoff, whole_contexts = frequent(contexts, "context", "log_backoff", most)
        levels.append(Level(gram, log_p, context, log_backoff, whole, whole_contexts))
    return LanguageModels(SentModel(langs, tuple(levels), floor, letters()), tuple(all_grams), tuple(all_contexts))


def identify(documents: DataFrame, *, buckets: int = 4, remainder: int = 2, quantile: float = 0.999, max_entries: int = 1_000_000) -> DataFrame:
    """doc_id, held_out, lang_pred, score, entropy, rejected of every row of ``documents``.

    Learns from the rows with a language whose crc32(doc_id) modulo ``buckets``
    is not ``remainder``. ``lang_pred`` is the language with the lowest
    cross-entropy per symbol (the first by name of equals), ``und`` for a text
    that is null or has no letter. ``score`` is 1 where no other language comes
    near, 1 / languages where all are equal, 0 for ``und``. ``rejected`` says
    that the entropy is above the ``quantile`` of the learning texts of that
    language: the text is unlike what was learned, whichever language is
    nearest; ``und`` is rejected.

    Whole texts are scored by the whole models. A row without a doc_id is held out. Repeated rows
    give repeated rows. With nothing to learn from every text is ``und``. An
    empty table gives no rows. Other columns are ignored.
    """
    out = F.coalesce(fold(F.col("doc_id"), buckets) == remainder, F.lit(True))
    rows = documents.select("doc_id", "text", F.col("lang").cast("string").alias("lang"), out.alias("held_out"))
    models = fit_languages(rows.where(~F.col("held_out")), max_entries=max_entries)
    # The sums are stored with the number of their row.
    found = models.entropies(rows.withColumn("row", F.monotonically_increasing_id()))
    least = F.array_min("entropies")
    name = F.get(F.array(*[F.lit(x) for x in models.sent.langs]).cast("array<string>"), (F.array_position("entropies", least) - 1).cast("int"))
    # Entropies per symbol, taken as evidence of about ten of them.
    chances = F.aggregate("entropies", F.lit(0.0), lambda total, e: total + F.exp(-10 * (e - least)))
    own = store(
        found.select(
            "doc_id",
            "held_out",
            "lang",
            F.coalesce(name, F.lit(UNKNOWN)).alias("lang_pred"),
            least.alias("entropy"),
            F.coalesce(1 / chances, F.lit(0.0)).alias("score"),
        ),
        "languages",
    )
    learned = own.where(~F.col("held_out") & (F.col("lang") == F.col("lang_pred")))
    # One row per language.
    limit = store(learned.groupBy(F.col("lang").alias("of")).agg(F.percentile_approx("entropy", quantile, 10000).alias("most")), "limits")
    return own.join(limit, F.col("lang_pred") == F.col("of"), "left").select(
        "doc_id", "held_out", "lang_pred", "score", "entropy", F.coalesce(F.col("entropy") > F.col("most"), F.lit(True)).alias("rejected")
    )
