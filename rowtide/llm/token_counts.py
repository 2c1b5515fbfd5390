"""Token counts through a cache of content digests."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.llm.common import store
from rowtide.session import work_dir

# Words whose counts a task remembers.
KNOWN_WORDS = 500_000
# A content with more than one in so many rows is a hot one.
HOT = 1000

CACHE = T.StructType(
    [
        T.StructField("content", T.BinaryType()),
        T.StructField("tokenizer", T.StringType()),
        T.StructField("n_tokens", T.LongType()),
    ]
)


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and of the library that reads it: counts of another version are never used."""
    import sentencepiece
    import tokenizers

    library = sentencepiece.__version__ if path.endswith(".model") else tokenizers.__version__
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + library.encode()).hexdigest()


def ignores_space_runs(path: str) -> bool:
    """Whether the file itself says that runs of white space count as one space, whatever else it does."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    steps = described.get("normalizer") or {}
    runs = [s for s in steps.get("normalizers", [steps]) if s.get("type") == "Replace" and s.get("pattern") == {"Regex": "\\s+"} and s.get("content") == " "]
    tight = all(not (t["lstrip"] or t["rstrip"]) and not any(c.isspace() for c in t["content"]) for t in described["added_tokens"])
    return bool(runs) and tight


def normalised(text: Column, space_runs: bool) -> Column:
    """The content whose tokens are counted. Only changes that the tokenizer makes too are made here."""
    text = F.coalesce(text, F.lit(""))
    return F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " ") if space_runs else text


def words_apart(path: str) -> bool:
    """Whether the file says that no token reaches over a space, so that words can be counted one by one."""
    if not ignores_space_runs(path):
        return False
    with open(path, encoding="utf-8") as file:
        splitter = json.load(file).get("pre_tokenizer") or {}
    first = splitter.get("pretokenizers", [splitter])[0]
    if first.get("type") != "Split" or first.get("behavior") != "Removed" or not first.get("invert"):
        return False
    # Only what the pattern matches is kept; outside its negated classes nothing in it matches a space.
    rest = re.sub(r"\[\^[^\]]*\]", "", first["pattern"].get("Regex", " "))
    return not re.search(r"[ .]|\\[sSWDPX]", rest)


def counter(path: str):
    """A function from texts to token counts; no added begin or end, no truncation, no padding."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    # Tasks share a machine's cores: one thread each.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()

    def whole(texts: list[str]) -> list[int]:
        return [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]

    known: dict[str, int] = {}

    def by_word(texts: list[str]) -> list[int]:
        """Sums over the words of a text, each distinct word encoded once."""
        if len(known) > KNOWN_WORDS:
            known.clear()
        lists = [t.split(" ") for t in texts]
        new = sorted(set().union(*lists) - known.keys())
        known.update(zip(new, whole(new)))
        return [sum(map(known.__getitem__, words)) for words in lists]

    return by_word if words_apart(path) else whole


def open_cache(spark: SparkSession, path: str | None) -> DataFrame:
    """The stored counts; none when nothing is stored yet."""
    if path is None:
        return spark.createDataFrame([], CACHE)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], CACHE)
    return spark.read.schema(CACHE).parquet(path)


def encode_misses(content: DataFrame, path: str, version: str) -> DataFrame:
    """Counts of distinct contents (columns content, text) in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in batches:
            count = count or counter(path)
            texts = batch.column("text").to_pylist()
            got = []
            for a in range(0, len(texts), 256):
                got += count(texts[a : a + 256])
            yield pa.RecordBatch.from_arrays(
                [batch.column("content"), pa.array([version] * len(got)), pa.array(got, pa.int64())], names=CACHE.names
            )

    return content.mapInArrow(run, CACHE)


def count_tokens(documents: DataFrame, tokenizer: str, *, cache: str | None = None, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``documents``.

    ``tokenizer`` is the path of a vocabulary file, the same on all machines:
    ``.json`` for tokenizers, ``.model`` for sentencepiece. ``cache`` is a
    folder all machines share; without one, a new folder in the shared work
    folder is used. Contents whose digest is stored for this tokenizer version
    are not encoded again; of the others each distinct one is encoded once and
    its count appended. Copies are reduced in each task before the texts are
    shuffled, so a text with very many copies is no hot key. The last join
    carries digests only. Contents with more than one row in ``HOT`` (so fewer
    than that many of them) are not dealt by content there: their counts are
    broadcast.

    Null counts as empty: 0 bytes, 0 tokens. Very long texts are encoded whole.
    Repeated rows give repeated rows, and a null doc_id stays null. Two runs
    that fill one cache at once may both append a count; they are equal, and
    one is read. An empty table gives no rows. Other columns are ignored.
    """
    spark = documents.sparkSession
    version, space_runs = tokenizer_version(tokenizer), ignores_space_runs(tokenizer)
    folder = cache or f"{work_dir(spark, 'token-cache')}/counts"
    content = normalised(F.col("text"), space_runs)
    # SHA-256: a collision would silently give a wrong count.
    digest = F.unhex(F.sha2(content, 256))
    rows = store(
        documents.select("doc_id", digest.alias("content"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")),
        "token-rows",
    )
    stored = open_cache(spark, cache).where(F.col("tokenizer") == version).select("content").distinct()
    # Grouped before they are compared with the cache: the comparison would deal all copies of a text to one task.
    distinct = documents.select(digest.alias("content"), content.alias("text")).groupBy("content").agg(F.first("text").alias("text"))
    misses = distinct.join(stored, "content", "left_anti")
    encode_misses(misses, tokenizer, version).write.mode("append").parquet(folder)
    counts = (
        spark.read.schema(CACHE).parquet(folder).where(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    )
    counts = store(counts, "token-counts")
    copies = rows.groupBy("content").agg(F.count(F.lit(1)).alias("copies"))
    frequent = copies.where(F.col("copies") * HOT > F.lit(rows.count())).select("content")
    hot = F.broadcast(store(counts.join(frequent, "content", "left_semi"), "token-hot"))
    joined = rows.join(hot, "content").unionByName(rows.join(hot, "content", "left_anti").join(counts, "content"))
    return joined.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
