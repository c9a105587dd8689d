"""Labelled feature lines, labelled documents, and model files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scores import POSITIVE
from millrace.functions.tokens import tokenize

MODEL_SCHEMA = "model_id string, feature string, weight double"


def is_positive(label: Column) -> Column:
    """1.0 for the positive label and 0.0 for any other."""
    return F.when(label == POSITIVE, 1.0).otherwise(0.0)


def parse_instances(lines: DataFrame, line: str = "line") -> DataFrame:
    """``(doc_id, label, features)`` of lines ``docid label f1 f2 ...`` with integer features."""
    field = F.split(F.col(line), " ")
    return lines.select(field.alias("_f")).select(
        F.get("_f", F.lit(0)).alias("doc_id"),
        F.get("_f", F.lit(1)).alias("label"),
        F.slice("_f", 3, F.size("_f")).cast("array<int>").alias("features"),
    )


def text_instances(documents: DataFrame, *keep: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, ..., features)`` with the words of each document as features."""
    return documents.select(F.col(doc_id).alias("doc_id"), *keep, tokenize(F.col(text)).alias("features"))


def read_model(spark: SparkSession, path: str) -> DataFrame:
    """``(model_id, feature, weight)`` of a model table."""
    return spark.read.parquet(path)


def parse_model(lines: DataFrame, line: str = "line", *keep: str) -> DataFrame:
    """``(feature, weight)`` of lines ``(feature,weight)``."""
    # Fixed value: the text form of one weight.
    pattern = r"^\((.*),([^,]*)\)$"
    return lines.select(
        *keep,
        F.regexp_extract(line, pattern, 1).alias("feature"),
        F.regexp_extract(line, pattern, 2).cast("double").alias("weight"),
    )


def read_text_models(spark: SparkSession, path: str) -> DataFrame:
    """``(model_id, feature, weight)`` of the part files of a directory, each file being one model."""
    files = spark.read.option("pathGlobFilter", "part-*").text(path)
    lines = files.select(F.regexp_extract("_metadata.file_name", r"^(part-\d+)", 1).alias("model_id"), F.col("value").alias("line"))
    return parse_model(lines, "line", "model_id")
