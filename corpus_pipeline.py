"""Training-data pipeline: stages over ``documents``, each a Spark job of its own.

A stage takes the documents that its predecessor kept and returns their columns; the last
one returns a row of counts and digests per document. Columns of any name and type pass
through. An empty table stays empty, null ids and repeated rows are allowed everywhere;
what a null or empty text, a tie or a repeated row means is said at each stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.llm import bpe, leaks, line_dedup, quality, shared, simhash
from ledgerspark.llm.queries import vocabulary_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counts and the log-likelihood ratio, which is learned from
    these documents and those of them that ``labels`` trusts. Null and empty texts go; repeated
    rows are judged each; a score at the threshold stays."""
    trusted = quality.trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.filtered(docs, quality.weights(docs, trusted))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that are kept elsewhere; those left without a sign go, and so do
    null and empty texts. Of equal lines one stays; rows that repeat id and text are one document."""
    return line_dedup.deduplicated(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints (three words, two bits) link. Texts without
    words share a fingerprint, so one of them stays; of repeated rows and ties one stays."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``. Null and empty texts stay, repeated rows are
    judged each; null and empty items say nothing."""
    return leaks.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens, and digests of the ids and of the decoded text, per document; a null text
    counts as empty, repeated rows stay."""
    return bpe.encoded(docs, vocabulary_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

# MinHash, SimHash and BPE are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another; the rows of each but the last go through Parquet."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
