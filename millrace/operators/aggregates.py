"""Aggregates that are not built in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEP = 512.0


def log_or_zero(value: Column) -> Column:
    """Logarithm with minus infinity for zero, where ``log`` gives null."""
    return F.when(value > 0, F.log(value)).otherwise(F.lit(float("-inf")))


def log_sum_exp(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """log(sum(exp(value))) per key without overflow or underflow; minus infinity stands for zero.

    Values are summed within bands of 512 units, each relative to its band, by an ordinary
    aggregation with partial sums. Each key then has one row per band, and the bands are added
    relative to the highest one. No join back to a maximum is needed, so frequent keys do no harm.
    """
    finite = F.col(value) > F.lit(float("-inf"))
    band = F.when(finite, F.floor(F.col(value) / _STEP).cast("double"))
    bands = (
        df.select(*keys, F.col(value).alias("_x"), band.alias("_band"))
        .groupBy(*keys, "_band")
        .agg(F.sum(F.exp(F.col("_x") - F.col("_band") * _STEP)).alias("_sum"))
    )
    entries = F.collect_list(F.when(F.col("_band").isNotNull(), F.struct("_band", "_sum")))
    per_key = bands.groupBy(*keys).agg(F.max("_band").alias("_top"), entries.alias("_bands"))
    total = F.aggregate(
        "_bands", F.lit(0.0), lambda acc, b: acc + b["_sum"] * F.exp((b["_band"] - F.col("_top")) * _STEP)
    )
    value_of = F.when(F.col("_top").isNull(), F.lit(float("-inf"))).otherwise(F.log(total) + F.col("_top") * _STEP)
    return per_key.select(*keys, value_of.alias(name))
