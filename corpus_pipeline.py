"""From raw documents to packed training sequences, in five stages, with small Arrow batches throughout the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import classifier, common, decontamination, jaccard, packing, queries, substrings


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    common.limit_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = classifier.quality_scores(docs, labels)
    return scored.where(F.col("score") >= queries.GOOD_SCORE).select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    common.limit_batches(spark)
    return jaccard.distinct_documents(docs).select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; texts that lose nothing stay as they are."""
    common.limit_batches(spark)
    cleaned = substrings.substring_dedup(docs)
    cut = F.col("n_removed") > 0
    text = F.when(cut, F.col("kept")).otherwise(F.col("text"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(cut, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumns(changed).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages."""
    common.limit_batches(spark)
    judged = decontamination.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return judged.where(~F.col("contaminated")).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all token pieces in sequences."""
    common.limit_batches(spark)
    return packing.pack_documents(docs, queries.vocabulary(), queries.SEQUENCE)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard", ngram_jaccard),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot state the classifier, so none is given; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each to what the one before has written."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
