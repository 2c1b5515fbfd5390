"""The operators over the given tables, and the SQL that gives the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rowtide.llm.embedding_dedup import near_vectors
from rowtide.llm.language_id import identify
from rowtide.llm.mixing import mix
from rowtide.llm.packing import pack
from rowtide.llm.periodic_runs import periodic_runs
from rowtide.llm.quality_ranker import quality_scores
from rowtide.llm.quality_rules import quality_rules
from rowtide.llm.secret_scan import secret_digests
from rowtide.llm.simhash_dedup import near_groups
from rowtide.llm.substring_dedup import remove_repeats
from rowtide.llm.token_counts import count_tokens
from rowtide.llm.toxicity import toxicity_scores
from rowtide.llm.whitening import whitened

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document; the cache starts empty, so every distinct text is encoded."""
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", found["kept"].alias("kept_sha256"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def op12_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document; one in ten has its tail repeated first, by its id."""
    return periodic_runs(table(spark, sf_dir, "documents"), plant=True)


QUERIES: dict[str, Query] = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_language_id": op2_language_id,
    "op3_token_counts": op3_token_counts,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_toxicity": op5_toxicity,
    "op6_quality_rules": op6_quality_rules,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_source_mixing": op8_source_mixing,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_secret_scans": op12_secret_scans,
    "op13_periodic_runs": op13_periodic_runs,
}

WORDS_SQL = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

SQL = {
    "op1_embedding_near_dedup": """
        with recursive
        usable as (
          select vec_id, label, cast(embedding as double[]) as e from embeddings
          where vec_id is not null and label is not null and len(embedding) > 0
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
            and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links as (
          select a.vec_id as x, b.vec_id as y
          from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
          where list_cosine_similarity(a.e, b.e) >= 0.93),
        reach(x, y) as (
          select vec_id, vec_id from embeddings
          union
          select reach.x, links.y from reach join links on reach.y = links.x),
        low as (select x, min(y) as component_id from reach group by x),
        degree as (select x, count(*) as n from links group by x)
        select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
        from embeddings join low on low.x = vec_id left join degree on degree.x = vec_id""",
    "op7_substring_dedup": rf"""
        with words as (select doc_id, {WORDS_SQL} as w from documents),
        windows as (
          select doc_id, i, w[i:i + 12] as win
          from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from words where len(w) >= 13)),
        lows as (select win, min(doc_id) as low from windows group by win),
        covered as (
          select doc_id, list_distinct(flatten(list(range(i, i + 13)))) as gone
          from windows join lows using (win) where doc_id > low group by doc_id),
        kept as (
          select doc_id, len(w) as n_words, coalesce(len(gone), 0) as n_removed,
                 case when gone is null then w else list_filter(w, lambda x, i: not list_contains(gone, i)) end as k
          from words left join covered using (doc_id))
        select doc_id, cast(n_words as bigint) as n_words, cast(n_removed as bigint) as n_removed,
               sha256(array_to_string(k, ' ')) as kept_sha256
        from kept""",
}


def llm_queries() -> dict[str, Query]:
    return dict(QUERIES)


def llm_sql() -> dict[str, str]:
    return dict(SQL)
