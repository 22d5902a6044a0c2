"""Documents to training sequences: quality rules, near-dedup, substring dedup, decontamination, packing.

Each stage works on all documents that the one before it kept and is written before the next one reads it. Null texts
count as empty and fail the quality rules; rows without a doc_id stay as long as their text does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schemaward.llm import decontaminate, near_copies, packing, quality, substrings
from schemaward.llm.batches import store


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the certified rules keep."""
    return quality.kept_documents(docs, _table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies: that of the smallest doc_id, null ones last. SimHash classes (op9's) and then
    MinHash bands propose them, a Jaccard similarity of 0.8 or more of five-word shingles decides. It is decided by rows,
    whatever doc_ids repeat; of rows equal in all columns one stays."""
    return near_copies.first_of_classes(docs, size=5, similarity=0.8)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows that repeat; a text that loses nothing stays as it is, one that loses all goes."""
    cut = substrings.remove_repeated_windows(docs, width=35).where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return cut.withColumn("text", text).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, _table(spark, sf_dir, "benchmark")).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of at most 2048 tokens."""
    return packing.pack(docs.select("doc_id", "text")).select("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules), ("near-dedup", near_dedup), ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination), ("best-fit packing", best_fit_packing),
]
ORACLE_SQL = None  # fingerprints, latent search and packing are beyond SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = store(docs, "stage")
    return docs
