"""Text statistics over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.sql import TOKENIZE, register_functions
from millrace.functions.tokens import tokenize
from millrace.operators import counts, pmi
from millrace.sources.tables import dealt_out, read_table
from millrace.sources.text import explode_lines


def documents(spark: SparkSession, directory: str) -> DataFrame:
    """The documents, dealt out to as many tasks as the session asks for."""
    return dealt_out(read_table(spark, directory, "documents").select("doc_id", "text", "lang"))


def document_lines(spark: SparkSession, directory: str) -> DataFrame:
    """``(doc_id, line_no, line)``."""
    return explode_lines(documents(spark, directory), "text", "doc_id")


def line_tokens(spark: SparkSession, directory: str) -> DataFrame:
    """``(doc_id, line_no, n_tokens)``."""
    return document_lines(spark, directory).select("doc_id", "line_no", F.size(tokenize(F.col("line"))).alias("n_tokens"))


def word_count(spark: SparkSession, directory: str) -> DataFrame:
    return counts.word_count(documents(spark, directory))


def word_count_in_sql(spark: SparkSession, directory: str) -> DataFrame:
    """``(word, n)`` by SQL text that calls the word function."""
    register_functions(spark)
    return spark.sql(
        f"SELECT word, count(*) AS n FROM (SELECT {TOKENIZE}(text) AS words FROM {{texts}}) "
        "LATERAL VIEW explode(words) AS word GROUP BY word",
        texts=documents(spark, directory),
    )


def line_frequency(spark: SparkSession, directory: str, limit: int | None = None) -> DataFrame:
    return counts.line_frequency(document_lines(spark, directory), limit)


def successor_count(spark: SparkSession, directory: str, word: str, min_count: int = 2) -> DataFrame:
    return counts.successor_count(document_lines(spark, directory), word, min_count)


def bigram_counts(spark: SparkSession, directory: str) -> DataFrame:
    return counts.bigram_counts(document_lines(spark, directory))


def bigram_marginals(spark: SparkSession, directory: str) -> DataFrame:
    return counts.left_marginals(bigram_counts(spark, directory))


def bigram_relfreq_pairs(spark: SparkSession, directory: str) -> DataFrame:
    return counts.relative_frequency_pairs(document_lines(spark, directory))


def bigram_relfreq_stripes(spark: SparkSession, directory: str, segments: int = counts.SEGMENTS) -> DataFrame:
    return counts.relative_frequency_stripes(document_lines(spark, directory), segments)


def pmi_pairs(spark: SparkSession, directory: str, threshold: int = 1, **options) -> DataFrame:
    return pmi.pmi_pairs(document_lines(spark, directory), threshold, **options)


def pmi_stripes(spark: SparkSession, directory: str, threshold: int = 1, **options) -> DataFrame:
    return pmi.pmi_stripes(document_lines(spark, directory), threshold, **options)
