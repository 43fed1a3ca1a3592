"""From raw documents to token digests: five stages over whole tables, each by an operator of the llm package.

Every stage gets what the one before it kept, decides, and passes on whole rows with the columns of
documents; the last one adds the token columns. Between two stages the documents are written to the
cluster's shared folder and read again. Rows that repeat are separate documents until near
duplicates are removed; null texts are kept or dropped by their score like empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from issuerlake.llm import bpe, contamination, neardup, quality, secrets
from issuerlake.llm.common import bucket
from issuerlake.session import shared_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the model learns from labels of four keys in five."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(bucket("doc_id", 5) != 0)
    return quality.keep_good(docs, quality.train(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8, smallest key."""
    return neardup.keep_first(docs, width=5, similarity=(80, 100))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return contamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secrets.redact(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token count and digests of ids and decoded text of every document."""
    import public_tokenizers

    return bpe.digest(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("near-duplicate removal", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("BPE encoding and decoding", bpe_tokens),
]

# The trained classifier has no SQL form; tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = shared_dir(spark, f"pipeline-{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
