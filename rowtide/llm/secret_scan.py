"""Secrets in texts: fixed patterns, and values in a credential's place that are costly to guess.

Three patterns give the base spans. Beside them, whatever stands where a
credential would stand (behind ``password is``, ``auth:``, ``Bearer``, in the
user part of an address, ...) is a candidate, and how many guesses an attacker
needs for it decides: a value is cut into words, dates, repeats, keyboard walks
and brute-force spans so that the sum of their costs is the smallest
(dynamic programming over its characters). A placeholder, a plain word or
``qwerty2019`` is cheap; a random key is not.

Words cost by how frequent they are in the whole corpus, candidates left out.
The dictionary is a table as large as the corpus makes it; it is never sent to
the tasks. The distinct candidates' letter sequences are joined with it, and
each distinct candidate is judged once, however many documents hold it. Joins
spread a key that many rows share over several tasks.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import spread_join, store

# The base patterns, by kind in their order, and how many characters a match must have.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "guess")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# Where credentials stand: a name, a sign that gives it a value, and the value up to a quote or white space.
CONTEXT = re.compile(
    r"""(?:
        (?:(?:pass(?:word|wd|phrase|code)|secret|token|credentials?|(?:api|access|private|secret|auth|client)[\x20_-]?key)
           |(?<![a-z])(?:pass|pwd|auth|login))
        ["']?[\x20\t]*(?:=>|:=|[:=]|(?<![a-z])is(?![a-z]))[\x20\t]*
        |(?<![a-z])bearer[\x20\t]+
        |://[^/\s:@]*:(?=[^/\s@]+@)
    )(?:"([^"\s]+)"|'([^'\s]+)'|([^\s"'][^\s]*))""",
    re.ASCII | re.IGNORECASE | re.VERBOSE,
)
CONTEXT_WORDS = (b"pass", b"pwd", b"secret", b"token", b"credential", b"key", b"auth", b"login", b"bearer", b"://")
TRAILING = ".,;:!?)]}>\"'"
AT_HOST = re.compile(r"[^/\s@]+(?=@)")

# Words a guesser tries first, whatever the corpus: names of credentials and of things that stand in for one.
PLACEHOLDERS = (
    "password passwd secret token apikey key api access private public auth login user username admin root guest test "
    "testing example sample dummy placeholder default change changeme your my the here insert replace enter redacted "
    "hidden none null true false empty value string letmein welcome hello master demo foo bar todo config env getenv "
    "environ process required optional undefined unknown"
).split()
PLACEHOLDER_BITS = math.log2(len(PLACEHOLDERS))
LEAST_WORD, MOST_WORD = 3, 20
WORD = re.compile(r"[^\W\d_]+")
# Digits and signs that are written for letters.
LEET = str.maketrans("4@310!5$7", "aaeioisst")

KEYS = {}
for _row, (_plain, _shifted) in enumerate(
    (("`1234567890-=", "~!@#$%^&*()_+"), ("qwertyuiop[]\\", "QWERTYUIOP{}|"), ("asdfghjkl;'", 'ASDFGHJKL:"'), ("zxcvbnm,./", "ZXCVBNM<>?"))
):
    for _place, _pair in enumerate(zip(_plain, _shifted)):
        for _sign in _pair:
            # A row is half a key to the right of the one above it; the first has a key more on the left.
            KEYS[_sign] = (_row, 2 * _place + (_row or -2))

NEAREST = {(0, 2), (0, -2), (1, 1), (1, -1), (-1, 1), (-1, -1)}

SEGMENT = math.log2(5)
# A word may bring one of these with it, to the next word.
JOINTS, JOINT = "_-./", 2.0
WALK_START, TURN, STRAIGHT = math.log2(47), math.log2(6), 0.5
LONGEST_UNIT, REPEATED = 8, 0.25
DAYS, YEARS, SEPARATORS = 365, 120, 5
DATES = (
    (re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"), math.log2(DAYS * YEARS * SEPARATORS)),
    (re.compile(r"(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\1(?:(?:19|20)\d\d|\d\d)"), math.log2(DAYS * YEARS * SEPARATORS) + 1),
    (re.compile(r"(?:19|20)\d\d"), math.log2(YEARS)),
)

Span = tuple[int, int, int]


def base_spans(text: str, low: bytes) -> list[Span]:
    """(start, number of the kind, end) of the fixed patterns; ``low`` is the text as bytes with A-Z lowered."""
    found = []
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_ASSIGN]
    if b"akia" in low:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, low: bytes) -> Iterator[tuple[int, int, int]]:
    """(start of the context, start of the value, its end) wherever a credential would stand."""
    if not any(w in low for w in CONTEXT_WORDS):
        return
    for m in CONTEXT.finditer(text):
        start, end = m.span(m.lastindex)
        if text.startswith("://", m.start()):
            host = AT_HOST.match(text, start)
            if host:
                yield m.start(), start, host.end()
            continue
        if m.lastindex == 3:
            end = start + len(text[start:end].rstrip(TRAILING))
        if end > start:
            yield m.start(), start, end


def scanned(text: str | None) -> tuple[list[Span], list[tuple[int, int, str]]]:
    """The base spans, and the candidates (start, end, value) that no base span covers already."""
    if not text:
        return [], []
    low = text.encode("utf-8", "surrogatepass").lower()
    base = base_spans(text, low)
    open_ = []
    # Both come by start. A candidate lies in a base span only if it does in the one that reaches furthest.
    k, reach = 0, -1
    for start, begin, end in candidates(text, low):
        while k < len(base) and base[k][0] <= start:
            reach = max(reach, base[k][2])
            k += 1
        if end > reach:
            open_.append((start, end, text[begin:end]))
    return base, open_


def letters(text: str) -> str:
    """Lower case, one character for one."""
    return "".join(x if len(x) == 1 else c for c, x in zip(text, map(str.lower, text)))


def pieces(value: str) -> Iterator[tuple[int, str, int]]:
    """(start, letters, changed) of every sequence of letters that may be a word, also of one written with digits and signs."""
    plain = letters(value)
    seen = set()
    for form in (plain, plain.translate(LEET)):
        for run in WORD.finditer(form):
            a, b = run.span()
            for start in range(a, b - LEAST_WORD + 1):
                for end in range(start + LEAST_WORD, min(b, start + MOST_WORD) + 1):
                    changed = sum(x != y for x, y in zip(plain[start:end], form[start:end])) if form is not plain else 0
                    if form is plain or changed:
                        item = (start, form[start:end], changed)
                        if item not in seen:
                            seen.add(item)
                            yield item


def case_bits(word: str) -> float:
    """How many ways there are to write so many capitals."""
    upper = sum(map(str.isupper, word))
    lower = len(word) - upper
    if not upper:
        return 0.0
    if not lower or (upper == 1 and word[0].isupper()):
        return 1.0
    return math.log2(sum(math.comb(len(word), i) for i in range(1, min(upper, lower) + 1)))


def character_bits(c: str) -> float:
    if c.isdigit():
        return math.log2(10)
    return math.log2(26) if c.isalpha() else math.log2(33)


def guess_bits(value: str, words: list[tuple[int, int, float]] = ()) -> float:
    """log2 of the guesses of the cheapest way to cut the value into segments.

    ``words`` are (start, length, bits) of the dictionary words in it. Every
    segment first costs the choice of its kind. Brute-force spans cost by
    character, keyboard walks by turn, repeats of up to 8 characters little for
    each one repeated; so all three go on from character to character, and the
    work is linear in the length but for the words.
    """
    n = len(value)
    ending: dict[int, list[tuple[int, float]]] = {}
    for start, length, bits in words:
        end, cost = start + length, bits + case_bits(value[start : start + length])
        ending.setdefault(end, []).append((start, cost))
        if end < n and value[end] in JOINTS:
            ending.setdefault(end + 1, []).append((start, cost + JOINT))
    for pattern, bits in DATES:
        for i in range(n):
            m = pattern.match(value, i) if value[i].isdigit() else None
            if m:
                ending.setdefault(m.end(), []).append((i, bits))
    best = [0.0] + [math.inf] * n
    brute = begun = walk = math.inf
    heading = None
    repeat = [math.inf] * (LONGEST_UNIT + 1)
    unit_choice = math.log2(LONGEST_UNIT)
    for i, c in enumerate(value):
        opened = best[i] + SEGMENT
        brute = min(opened, brute) + character_bits(c)
        here, last = KEYS.get(c), KEYS.get(value[i - 1]) if i else None
        step = (here[0] - last[0], here[1] - last[1]) if here and last else None
        # The next key in the row, or one of the two nearest in the row above or below. A walk begun
        # at the key before has no direction yet, one that came there has.
        if step in NEAREST:
            walk = min(begun + TURN, walk + (STRAIGHT if step == heading else TURN))
        else:
            walk = math.inf
        heading = step
        begun = opened + WALK_START if here else math.inf
        for p in range(1, LONGEST_UNIT + 1):
            if i >= p and value[i - p] == c:
                repeat[p] = min(opened + unit_choice, repeat[p]) + REPEATED
            else:
                repeat[p] = math.inf
        best[i + 1] = min(brute, begun, walk, *repeat, *(best[s] + SEGMENT + bits for s, bits in ending.get(i + 1, ())))
    return best[n]


SCANNED = "doc_id {id}, base array<struct<start:int,rank:int,end:int>>, hits array<struct<start:int,end:int,value:string>>"


def scan_rows(documents: DataFrame) -> DataFrame:
    """doc_id, base spans and open candidates of every row, with a number of its own, stored."""
    span = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())])
    hit = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, hits = [], []
            for text in batch.column("text"):
                spans, open_ = scanned(text.as_py())
                base.append([dict(zip(("start", "rank", "end"), s)) for s in spans])
                hits.append([dict(zip(("start", "end", "value"), h)) for h in open_])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, pa.list_(span)), pa.array(hits, pa.list_(hit))], names=["doc_id", "base", "hits"]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select(F.col("doc_id"), F.col("text")).mapInArrow(scan, SCANNED.format(id=kind))
    return store(rows.withColumn("row", F.monotonically_increasing_id()), "secret-rows")


def word_counts(documents: DataFrame, *, most_words: int = 100_000) -> DataFrame:
    """(word, n): how often the corpus has each sequence of letters, lower-cased, candidates left out.

    A task passes its counts on whenever it holds ``most_words``; they are summed up behind the shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def passed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column("text"):
                text = text.as_py()
                if not text:
                    continue
                at, kept = 0, []
                for _, begin, end in candidates(text, text.encode("utf-8", "surrogatepass").lower()):
                    kept.append(text[at:begin])
                    at = end
                kept.append(text[at:])
                counts.update(WORD.findall(" ".join(kept).lower()))
                if len(counts) >= most_words:
                    yield passed()
        yield passed()

    counted = documents.select("text").mapInArrow(count, "word string, n long")
    counted = counted.where(F.length("word").between(LEAST_WORD, MOST_WORD))
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def costly_values(values: DataFrame, documents: DataFrame, least_bits: float) -> DataFrame:
    """The keys of the values that take 2 ** least_bits guesses or more."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = [], []
            for key, value in zip(batch.column("key").to_pylist(), batch.column("value").to_pylist()):
                for item in pieces(value):
                    keys.append(key)
                    found.append(item)
                if len(found) > 50_000:
                    yield cut_rows(keys, found)
                    keys, found = [], []
            yield cut_rows(keys, found)

    def cut_rows(keys: list, found: list[tuple[int, str, int]]) -> pa.RecordBatch:
        start, word, changed = zip(*found) if found else ((), (), ())
        columns = [pa.array(keys, pa.string()), pa.array(start, pa.int32()), pa.array(word, pa.string()), pa.array(changed, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names=["key", "start", "word", "changed"])

    spark = values.sparkSession
    found = store(values.mapInArrow(cut, "key string, start int, word string, changed int"), "secret-pieces")
    counts = store(word_counts(documents), "secret-words")
    total = F.log2(F.lit(float(counts.agg(F.sum("n")).first()[0] or 1)))
    known = counts.join(found.select("word").distinct(), "word", "left_semi").select("word", (total - F.log2(F.col("n"))).alias("bits"))
    fixed = spark.createDataFrame([(w, PLACEHOLDER_BITS) for w in PLACEHOLDERS], "word string, bits double")
    known = known.unionAll(fixed).groupBy("word").agg(F.min("bits").alias("bits"))
    words = spread_join(found, known, "word").select(
        "key", F.struct("start", F.length("word").alias("length"), (F.col("bits") + F.col("changed")).alias("bits")).alias("word")
    )
    listed = words.groupBy("key").agg(F.collect_list("word").alias("words"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("key").to_pylist(), batch.column("value").to_pylist(), batch.column("words"))
            costly = [k for k, v, w in rows if guess_bits(v, [(x["start"], x["length"], x["bits"]) for x in w.as_py() or ()]) >= least_bits]
            yield pa.RecordBatch.from_arrays([pa.array(costly, pa.string())], names=["key"])

    return values.join(listed, "key", "left").select("key", "value", "words").mapInArrow(judge, "key string")


def find_secrets(documents: DataFrame, *, least_bits: float = 40.0) -> DataFrame:
    """doc_id and ``secrets``, an array of (kind, start, end) by start and then kind, for every row of ``documents``.

    ``start`` and ``end`` count code points, the end is exclusive. Kinds are
    ``assign``, ``access`` and ``hex``, the matches of the base patterns, and
    ``guess``: a value in a credential's place that takes 2 ** ``least_bits``
    guesses or more, from the credential's name to the value's end, unless a
    base match covers it. A value ends at white space or its quote.

    Null, empty and blank texts have no secrets: an empty array. Repeated rows
    and doc_ids are rows of their own, a null doc_id is kept. Texts are never
    cut. An empty table gives no rows. Other columns are ignored.
    """
    rows = scan_rows(documents)
    span = "array<struct<start:int,rank:int,end:int>>"
    with_hits = rows.where(F.size("hits") > 0).select("row", F.explode("hits").alias("hit"))
    hits = with_hits.select("row", "hit.start", "hit.end", F.md5(F.col("hit.value").cast("binary")).alias("key"))
    values = with_hits.select(F.md5(F.col("hit.value").cast("binary")).alias("key"), F.col("hit.value").alias("value"))
    values = store(values.groupBy("key").agg(F.first("value").alias("value")), "secret-values")
    # Without a candidate there is nothing to weigh words for.
    costly = values.select("key") if values.isEmpty() else store(costly_values(values, documents, least_bits), "secret-costly")
    guessed = spread_join(hits, costly, "key").select("row", F.struct("start", F.lit(3).alias("rank"), "end").alias("span"))
    added = guessed.groupBy("row").agg(F.collect_list("span").cast(span).alias("added"))
    # Rows without a candidate are complete as they are.
    judged = rows.where(F.size("hits") > 0).select("row", "doc_id", "base").join(added, "row", "left").select("doc_id", "base", "added")
    plain = rows.where(F.size("hits") == 0).select("doc_id", "base", F.lit(None).cast(span).alias("added"))
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(span))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return plain.unionAll(judged).select(
        "doc_id",
        F.transform(spans, lambda s: F.struct(F.get(names, s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("secrets"),
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digests(documents: DataFrame, **settings) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess of every row."""
    found = find_secrets(documents, **settings)

    def number(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"] != KINDS[3])
    return found.select(
        "doc_id",
        *(number(k) for k in KINDS[:3]),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
        number(KINDS[3]),
    )
