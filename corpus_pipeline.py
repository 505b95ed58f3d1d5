"""From raw documents to tokens: five stages, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and works on all that the one before kept.
"""

from pyspark.sql import DataFrame, SparkSession

from surveil.llm import bpe, minhash, mixing, quality, suffix
from surveil.session import release_heaps, stage


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: rejected documents go, kept ones lose the lines that failed."""
    return quality.clean(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash: one document of each group of near duplicates stays."""
    return minhash.drop_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix array: strings of 100 bytes that stand earlier are cut out."""
    release_heaps(spark)
    return suffix.cut_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Source weights: each document as often as it is taken."""
    release_heaps(spark)
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: one row per mixed document, with its token ids."""
    release_heaps(spark)
    return bpe.encode(docs.select("doc_id", "source", "text"), bpe.vocabulary_path())


STAGES = [("quality rules", clean), ("minhash near-dedup", deduplicate), ("suffix-array dedup", cut_repeats),
          ("mixing to target weights", mix), ("bpe encoding", tokenize)]

# A suffix sort and a tokenizer with 49,408 entries have no SQL; tests/llm runs all stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"), "zstd")
    return docs
