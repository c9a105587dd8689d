"""Classifiers of the labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scores import NEGATIVE, POSITIVE
from millrace.operators import learning
from millrace.plans.text import documents
from millrace.sources.features import is_positive, text_instances
from millrace.sources.tables import read_table


def labelled_documents(spark: SparkSession, directory: str, how: str = "inner") -> DataFrame:
    """``(doc_id, model_id, label, features)``: documents of low quality are positive, one model per language.

    ``how="left"`` keeps documents without a label, which is then null.
    """
    labels = read_table(spark, directory, "labels").select(
        "doc_id", F.when(F.col("quality") == 0, POSITIVE).otherwise(NEGATIVE).alias("label")
    )
    texts = documents(spark, directory).withColumnRenamed("lang", "model_id")
    return text_instances(texts.join(labels, "doc_id", how), "model_id", "label")


def training_set(spark: SparkSession, directory: str, per_language: bool = False) -> DataFrame:
    """Labelled documents as numbers; one model of all of them, or one per language."""
    instances = labelled_documents(spark, directory).withColumn("label", is_positive(F.col("label")))
    return instances if per_language else instances.withColumn("model_id", F.lit("all"))


def train_classifier(spark: SparkSession, directory: str, per_language: bool = False, **options) -> DataFrame:
    return learning.train_batch(training_set(spark, directory, per_language), **options)


def document_features(spark: SparkSession, directory: str) -> DataFrame:
    """``(doc_id, features)`` of all documents, whose texts are not moved to look up labels."""
    return text_instances(documents(spark, directory))


def apply_classifier(spark: SparkSession, directory: str, model: DataFrame) -> DataFrame:
    """The score of every document, labelled or not."""
    instances = labelled_documents(spark, directory, "left")
    return learning.apply_model(instances, model, texts=document_features(spark, directory))


def apply_ensemble(spark: SparkSession, directory: str, models: DataFrame, method: str = "average") -> DataFrame:
    instances = labelled_documents(spark, directory, "left")
    return learning.apply_ensemble(instances, models, method, texts=document_features(spark, directory))
