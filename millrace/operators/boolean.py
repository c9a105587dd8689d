"""Batches of boolean queries over the postings of an index.

A query is blank-separated postfix: terms as typed, ``AND`` and ``OR``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AND, OR = "AND", "OR"
SNIPPET_CHARS = 80


def _is_operator(token: Column) -> Column:
    return token.isin(AND, OR)


def _checked(postfix: Column) -> Column:
    """Tokens of a query; a query that does not leave exactly one result fails."""
    tokens = F.split(F.trim(postfix), r"\s+")
    # An operator needs two operands, and everything has to end as one. A depth of -1 marks a failure.
    depth = F.aggregate(
        tokens,
        F.lit(0),
        lambda d, t: F.when(d < 0, d).when(~_is_operator(t), d + 1).when(d < 2, F.lit(-1)).otherwise(d - 1),
    )
    complaint = F.concat(F.lit("malformed postfix query: "), postfix)
    return F.when((depth == 1) & (F.trim(postfix) != ""), tokens).otherwise(F.raise_error(complaint))


def matches(tokens: Column, found: Column) -> Column:
    """Value of a postfix query for a document that holds the ``found`` terms."""
    empty = F.array().cast("array<boolean>")

    def step(stack: Column, token: Column) -> Column:
        rest, top, below = F.slice(stack, 3, F.size(stack)), F.get(stack, F.lit(0)), F.get(stack, F.lit(1))
        return (
            F.when(token == AND, F.concat(F.array(top & below), rest))
            .when(token == OR, F.concat(F.array(top | below), rest))
            .otherwise(F.concat(F.array(F.array_contains(found, token)), stack))
        )

    return F.get(F.aggregate(tokens, empty, step), F.lit(0))


def retrieve(queries: DataFrame, postings: DataFrame) -> DataFrame:
    """``(qid, doc_id)`` of the documents each query matches.

    ``queries`` has ``(qid, query)`` and ``postings`` at least ``(term, doc_id)``, where a pair may occur
    several times. Both operators are monotone, so a document with none of the terms cannot match and
    the join on terms loses nothing.
    """
    parsed = queries.select("qid", _checked(F.col("query")).alias("tokens"))
    wanted = parsed.select("qid", "tokens", F.explode(F.array_distinct("tokens")).alias("term")).where(
        ~_is_operator(F.col("term"))
    )
    hits = postings.select("term", "doc_id").join(wanted, "term")
    # A query's own tokens travel with it; the set per document is no longer than the query.
    per_document = hits.groupBy("qid", "doc_id", "tokens").agg(F.collect_set("term").alias("found"))
    return per_document.where(matches(F.col("tokens"), F.col("found"))).select("qid", "doc_id")


def snippet(text: Column, chars: int = SNIPPET_CHARS) -> Column:
    """The text itself, or its beginning with an ellipsis if it is longer."""
    return F.when(F.length(text) > chars, F.concat(F.substring(text, 1, chars), F.lit("..."))).otherwise(text)


def with_snippets(hits: DataFrame, documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Attach the beginning of each document; it is cut before the join, so whole texts are not moved."""
    beginnings = documents.select(F.col(doc_id).alias("doc_id"), snippet(F.col(text)).alias("line"))
    return hits.join(beginnings, "doc_id").select("qid", "doc_id", "line")
