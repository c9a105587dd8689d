"""The column functions as functions of SQL text, in the SQL language itself: no Python worker runs them."""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.functions.tokens import WORD_PATTERN

TOKENIZE = "tokenize_words"
TOKEN_COUNT = "count_words"


def register_functions(spark: SparkSession) -> None:
    """Make ``tokenize_words(text)`` and ``count_words(text)`` known to the session.

    The body is an expression that Catalyst puts in place of the call, so calls are optimized like any expression.
    """
    pattern = WORD_PATTERN.replace("\\", "\\\\").replace("'", "\\'")
    words = f"regexp_extract_all(lower(text), '{pattern}', 0)"
    for name, kind, body in ((TOKENIZE, "ARRAY<STRING>", words), (TOKEN_COUNT, "INT", f"size({words})")):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS {kind} RETURN {body}")
