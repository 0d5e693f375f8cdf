"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread as the next one's input.

Every stage keeps the columns of documents and works on all rows its predecessor kept: documents that the
quality model rejects go; one document of each group of near duplicates stays (five-word shingles, similarity
0.8); documents that hold a benchmark item go; personal data is masked in the texts; the texts are encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspan.llm import bpe, decontaminate, jaccard_join, pii, quality
from tallyspan.llm.registry import reachable
from tallyspan.session import scratch_path
from tallyspan.tables import SCHEMAS, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the language model of trusted text does not reject; an empty text is kept."""
    reachable(spark)
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: the least doc_id's. Empty texts and rows without doc_id are in no group and stay."""
    reachable(spark)
    return jaccard_join.keep_one(docs, n=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark item."""
    reachable(spark)
    return decontaminate.without_leaks(docs, decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with personal data in the texts replaced by its kind; n_chars follows the new text."""
    reachable(spark)
    return pii.mask(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(docs.columns)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    reachable(spark)
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.digests(bpe.encode_and_decode(docs, vocabulary))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("personal data", personal_data),
    ("byte-level BPE", byte_level_bpe),
]

#: No SQL: the stages train a model, align texts and merge byte pairs; the tests compare each with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = reachable(spark).read.schema(SCHEMAS["documents"]).parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
