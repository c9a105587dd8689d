"""Inverted index of the documents and boolean queries over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import boolean, index
from millrace.operators.counts import words
from millrace.plans.text import documents
from millrace.session import fresh_path, shuffle_partitions
from millrace.sinks.files import read_terms, write_index


def term_frequency(spark: SparkSession, directory: str) -> DataFrame:
    return index.term_frequency(documents(spark, directory))


def document_frequency(spark: SparkSession, directory: str) -> DataFrame:
    return index.document_frequency(term_frequency(spark, directory))


def inverted_index(
    spark: SparkSession, directory: str, max_postings: int = index.MAX_POSTINGS, gaps: bool = False
) -> DataFrame:
    """Posting lists of the documents, with ids or with gaps between them."""
    lists = index.posting_lists(term_frequency(spark, directory), max_postings)
    return index.gap_encode(lists) if gaps else lists


def query_table(spark: SparkSession, queries: Sequence[str]) -> DataFrame:
    """``(qid, query)`` of postfix queries, numbered in order.

    As literals they have a known size, so the planner can broadcast them; rows made in Python would
    count as a table of unknown size, and it would rather broadcast or move the postings.
    """
    literals = [F.struct(F.lit(qid).alias("qid"), F.lit(query).alias("query")) for qid, query in enumerate(queries)]
    return spark.range(1).select(F.inline(F.array(*literals)))


def boolean_retrieval(
    spark: SparkSession, directory: str, queries: Sequence[str] | DataFrame, postings: DataFrame | None = None
) -> DataFrame:
    """``(qid, doc_id, line)`` of the documents that match each query, with the beginning of their text.

    ``postings`` is an index built before. Without it the words of the documents are looked up as they
    are read: only the occurrences of the queries' terms are kept, and nothing else is grouped.
    """
    table = queries if isinstance(queries, DataFrame) else query_table(spark, queries)
    if postings is None:
        postings = words(documents(spark, directory), "text", "doc_id").withColumnRenamed("word", "term")
    found = boolean.retrieve(table, postings)
    return boolean.with_snippets(found, documents(spark, directory))


def indexed_retrieval(spark: SparkSession, directory: str, queries: Sequence[str]) -> DataFrame:
    """Write the index of the documents, and answer the queries from the posting lists of their terms."""
    path = fresh_path(spark, "index")
    write_index(inverted_index(spark, directory), path, shuffle_partitions(spark))
    terms = sorted({term for query in queries for term in query.split()} - {boolean.AND, boolean.OR})
    postings = index.flatten(read_terms(spark.read.parquet(path), terms))
    return boolean_retrieval(spark, directory, queries, postings)


def _terms_of(spark: SparkSession, directory: str, *terms: str) -> DataFrame:
    """``(doc_id, terms)``: which of the terms a document has, for documents with any; the texts are read once."""
    occurrences = words(documents(spark, directory), "text", "doc_id").where(F.col("word").isin(*terms))
    return occurrences.groupBy("doc_id").agg(F.collect_set("word").alias("terms"))


def matching_all(spark: SparkSession, directory: str, left: str, right: str) -> DataFrame:
    """``(doc_id)`` of the documents with both terms, as the intersection of their postings."""
    found = _terms_of(spark, directory, left, right)
    return found.where(F.array_contains("terms", left) & F.array_contains("terms", right)).select("doc_id")


def matching_any(spark: SparkSession, directory: str, left: str, right: str) -> DataFrame:
    """``(doc_id)`` of the documents with at least one of the terms, as the union of their postings."""
    return _terms_of(spark, directory, left, right).select("doc_id")
