"""Word tokens as JVM-side array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words are cut at blank, tab, line feed, carriage return and form feed, and start
# and end with a letter a-z after lower-casing.
WORD_PATTERN = r"[a-z](?:[^ \t\n\r\f]*[a-z])?"


def tokenize(text: Column) -> Column:
    """Lower-cased words without leading or trailing non-letters; inner marks and digits stay.

    One regular-expression pass over the whole text: from a first letter the match runs greedily to
    the last letter before the next separator, so nothing has to be trimmed or filtered per word.
    """
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def leading_distinct(tokens: Column, limit: int | None = None) -> Column:
    """Distinct words, or those among the first ``limit`` ones, in order of first occurrence."""
    return F.array_distinct(tokens if limit is None else F.slice(tokens, 1, limit))


def bigram_array(tokens: Column) -> Column:
    """Neighbouring words as an array of ``(left, right)`` structs; empty for fewer than two words.

    ``tokens`` is used several times, so it should be a column and not the expression that makes it.
    """
    steps = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.arrays_zip(F.slice(tokens, 1, steps).alias("left"), F.slice(tokens, 2, steps).alias("right"))
