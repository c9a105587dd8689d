"""Scores and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POSITIVE, NEGATIVE = "spam", "ham"


def significant(value: Column, digits: int) -> Column:
    """A double rounded to so many significant digits; zero, null and infinities stay."""
    size = F.floor(F.log10(F.abs(value)))
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - size)
    finite = F.abs(value) < float("inf")
    return F.when((value != 0) & finite, F.round(value * scale) / scale).otherwise(value)


def sigmoid(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def label_of(score: Column) -> Column:
    """Positive only above zero."""
    return F.when(score > 0, POSITIVE).otherwise(NEGATIVE)


def pmi(pair: Column, left: Column, right: Column, total: Column) -> Column:
    """log10 of p(x,y) / (p(x) p(y)) from counts."""
    return F.log10(pair.cast("double") * total / (left.cast("double") * right))
