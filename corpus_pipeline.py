"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns what it keeps; all but the last return the
columns of ``docs``. Null and empty texts, repeated rows and extra columns are handled as the operators say; rows with
the same id share a decision. An empty table passes through as an empty table.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import byte_bpe, decontaminate, exact_dedup, jaccard_join, quality
from barloom.llm.common import ship, table, without
from barloom.session import checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking rejects go."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return without(docs, exact_dedup.exact_duplicates(docs).where("NOT kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the least id stays."""
    return without(docs, jaccard_join.near_duplicates(docs).where("doc_id <> component_id"))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain too much of the benchmark go."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found.where(F.col("contaminated")))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the bytes that they decode to."""
    return byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), with_ids=True)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("byte-level BPE", encode_stage),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what passes between them is written to the shared folder."""
    ship(spark)
    folder = f"{checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
