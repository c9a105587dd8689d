"""Column expressions over arrays of words, for operators that stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SMALLEST_MAP, LARGEST_MAP = 1 << 16, 1 << 24  # bits; the largest takes 2 MB
MAX_BROADCAST_BYTES = 64 << 20


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def alnum_words(text: Column) -> Column:
    """Words of letters, digits and characters beyond ASCII, A-Z lower-cased; none for null."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN_WORDS), lambda w: w != "")


def gram_hashes(words: Column, n: int) -> Column:
    """Hashes of all runs of ``n`` words, equal to ``xxhash64`` of ``n`` and the run as an array; none if there are fewer."""
    at = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.lit(n), *[F.get(words, i + k if k else i) for k in range(n)]))


def window_minima(hashes: Column, width: int) -> Column:
    """Minimum of every run of ``width`` hashes; none if there are fewer."""
    if width == 1:
        return hashes
    at = F.when(F.size(hashes) >= width, F.sequence(F.lit(1), F.size(hashes) - (width - 1)))
    return F.transform(
        F.coalesce(at, F.array().cast("array<int>")), lambda i: F.array_min(F.slice(hashes, i, width))
    )


def bitmap(keys: DataFrame, key: str) -> tuple[Column, int]:
    """A bitmap of the hashes in ``keys`` as a scalar column, and its number of bits.

    It grows with the number of keys up to ``LARGEST_MAP`` and only says which hashes can be skipped, so that more
    keys than it can tell apart cost time but change nothing.
    """
    wanted = 64 * max(1, keys.count())
    bits = min(LARGEST_MAP, max(SMALLEST_MAP, 1 << (wanted - 1).bit_length()))
    place = F.pmod(F.col(key), F.lit(bits))
    marks = keys.select(
        F.shiftright(place, 6).alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int")).alias("mark"),
    )
    blank = keys.sparkSession.range(bits >> 6).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mark"))
    words = marks.unionByName(blank).groupBy("word").agg(F.bit_or("mark").alias("mark"))
    # Put in order by word in one row: its size is bounded by LARGEST_MAP.
    row = words.agg(F.sort_array(F.collect_list(F.struct("word", "mark"))).alias("map"))
    return row.select(F.transform("map", lambda s: s["mark"]).alias("map")).scalar(), bits


def marked(map_: Column, bits: int, value: Column) -> Column:
    """Whether the bitmap may hold the value."""
    place = F.pmod(value, F.lit(bits))
    word = F.element_at(map_, (F.shiftright(place, 6) + 1).cast("int"))
    return F.call_function("getbit", word, F.pmod(place, F.lit(64)).cast("int")) == 1


def broadcast_if_small(df: DataFrame, size: int) -> DataFrame:
    """Hint a broadcast if ``size``, a bound of the bytes that was measured, allows it."""
    return F.broadcast(df) if size <= MAX_BROADCAST_BYTES else df
