"""One query for each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (
    byte_bpe,
    decontaminate,
    exact_dedup,
    jaccard_join,
    lexical_search,
    lm_scoring,
    quality,
    secret_scan,
    spelling_variants,
    suffix_dedup,
    token_counts,
    token_files,
    url_filter,
)
from barloom.llm.common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target are the documents labelled as good, without those that are held out; all others are the background."""
    labels = table(spark, sf_dir, "labels")
    good = labels.where((F.col("quality") == 1) & ~quality.held_out(F.col("doc_id"))).select("doc_id")
    return lm_scoring.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The owner of a document is its source, the repository its source and language."""
    owner = F.col("source")
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"), owner, F.concat_ws("/", owner, "lang"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_strings(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes are the quality labels of the pages that have one under their id."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    found = url_filter.filter_urls(table(spark, sf_dir, "pages"), outcomes)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands in the files after they are written, read back from them."""
    docs = table(spark, sf_dir, "documents")
    found = token_files.read_token_files(token_files.write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json")))
    n_tokens = F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return found.select("doc_id", "start", n_tokens, F.crc32("ids").alias("ids_crc32"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted misspellings: a letter less in every 199th word of a document, by hash."""
    return spelling_variants.spelling_groups(table(spark, sf_dir, "documents"), noise=199)


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_secrets": op4_secrets,
    "op5_decontaminate": op5_decontaminate,
    "op6_quality": op6_quality,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_lexical_search": op11_lexical_search,
    "op12_token_files": op12_token_files,
    "op13_spelling_variants": op13_spelling_variants,
}
