"""Splitting hot keys.

A key that holds a large share of all rows would put that share into one task of a shuffle. The
jobs here know or can bound how many rows each key has, so they number the splits of the few hot
keys, spread the rows of those keys over the splits, and copy the matching side once per split.
Keys that are not hot keep a single split, and no row is dropped.

The list of hot keys is the only thing broadcast. It holds a hash and a number per key, so the
length of a key does not matter. A key is listed if it has more rows than one split and more than
1 / ``MAX_HOT_KEYS`` of all rows: fewer than ``MAX_HOT_KEYS`` keys can, which bounds the list whatever
the data, and any other key is a small part of all rows. Keys whose hashes meet are split alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_HOT_KEYS = 50_000
ROWS_PER_SPLIT = 2_000_000

Keys = str | tuple[str, ...]


def split_count(rows: Column, rows_per_split: int) -> Column:
    """How many splits a key with ``rows`` rows gets."""
    return F.greatest(F.ceil(rows / F.lit(rows_per_split)), F.lit(1)).cast("int")


def _names(key: Keys) -> tuple[str, ...]:
    return (key,) if isinstance(key, str) else tuple(key)


def hot_keys(weights: DataFrame, key: Keys, rows: str, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """``(hot, rows)``: the hash and the rows of every key that is listed."""
    least = weights.agg((F.sum(rows) / MAX_HOT_KEYS).alias("least")).scalar()
    # The filter is on the rows alone: one on the key would be pushed below the aggregation that made the
    # weights, which then could not share its shuffle with the other uses of them.
    hot = weights.where((F.col(rows) > rows_per_split) & (F.col(rows) > least))
    return hot.groupBy(F.xxhash64(*_names(key)).alias("hot")).agg(F.max(rows).alias("rows"))


def with_splits(df: DataFrame, key: Keys, hot: DataFrame, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Add ``_splits``, 1 for every key that is not in ``hot``."""
    named = hot.select(F.col("hot").alias("_hot"), split_count(F.col("rows"), rows_per_split).alias("_n"))
    joined = df.join(F.broadcast(named), F.xxhash64(*[df[k] for k in _names(key)]) == F.col("_hot"), "left")
    return joined.withColumn("_splits", F.coalesce("_n", F.lit(1))).drop("_hot", "_n")


def join_spread(
    facts: DataFrame,
    lookup: DataFrame,
    key: Keys,
    spread_by: str,
    hot: DataFrame,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Inner join of ``facts`` with a ``lookup`` of one row per key, hot keys spread over several tasks.

    ``spread_by`` is a column of ``facts`` that varies within a hot key.
    """
    salt = F.when(F.col("_splits") > 1, F.pmod(F.xxhash64(spread_by), F.col("_splits"))).otherwise(0).cast("int")
    left = with_splits(facts, key, hot, rows_per_split).withColumn("_salt", salt).drop("_splits")
    right = with_splits(lookup, key, hot, rows_per_split).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("_splits") - 1)).alias("_salt")
    )
    return left.join(right.drop("_splits"), [*_names(key), "_salt"]).drop("_salt")
