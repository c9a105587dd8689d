"""Counting words, successors, and neighbouring words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.tokens import bigram_array, leading_distinct, tokenize
from millrace.operators import skew

MARGINAL = "*"
SEGMENTS = 16


def words(texts: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per word occurrence with the ``keep`` columns.

    The words are exploded from the expression itself. Exploding a column of them would make the
    optimizer add a filter for empty arrays below it, which cuts every text into words once more.
    """
    return texts.select(*keep, F.explode(tokenize(F.col(text))).alias("word")).where(F.col("word").isNotNull())


def word_count(texts: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n)``; occurrences are summed before the shuffle, so frequent words cost one row per task."""
    return words(texts, text).groupBy("word").agg(F.count("*").alias("n"))


def line_frequency(lines: DataFrame, limit: int | None = None) -> DataFrame:
    """``(word, n)`` with the number of lines that hold the word, or hold it among their first ``limit`` words."""
    return (
        lines.select(F.explode(leading_distinct(tokenize(F.col("line")), limit)).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


def bigrams(lines: DataFrame) -> DataFrame:
    """One row ``(left, right)`` per pair of neighbouring words of a line.

    Words are never null. Saying so here keeps the joins below from filtering one use of the counts
    and not another, so that all uses read the same shuffle.
    """
    pairs = lines.select(tokenize(F.col("line")).alias("_words")).select(F.inline(bigram_array(F.col("_words"))))
    return pairs.where(F.col("left").isNotNull() & F.col("right").isNotNull())


def successor_count(lines: DataFrame, word: str, min_count: int = 2) -> DataFrame:
    """``(successor, n)`` of the words that follow ``word`` at least ``min_count`` times."""
    return (
        bigrams(lines)
        .where(F.col("left") == word)
        .groupBy(F.col("right").alias("successor"))
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_count)
    )


def bigram_counts(lines: DataFrame) -> DataFrame:
    """``(left, right, n)``."""
    return bigrams(lines).groupBy("left", "right").agg(F.count("*").alias("n"))


def left_marginals(counts: DataFrame) -> DataFrame:
    """``(left, total, partners)``: occurrences as left word and number of different right words.

    The partners are counted by their ``n``, which is never 0, because a plain count would leave that
    column out of the shuffle below and so not share it with the other uses of the counts.
    """
    return counts.groupBy("left").agg(F.sum("n").alias("total"), F.count_if(F.col("n") > 0).alias("partners"))


def _with_totals(counts: DataFrame, marginals: DataFrame, rows_per_split: int) -> DataFrame:
    """Attach ``total`` and ``partners`` of the left word to every pair; frequent left words are spread."""
    hot = skew.hot_keys(marginals, "left", "partners", rows_per_split)
    return skew.join_spread(counts, marginals, "left", "right", hot, rows_per_split)


def relative_frequency_pairs(lines: DataFrame, rows_per_split: int = skew.ROWS_PER_SPLIT) -> DataFrame:
    """``(left, right, value)``: share of the right word after the left one, and the marginal rows.

    A marginal row has ``*`` as right word and the number of pairs the left word starts as value.
    """
    counts = bigram_counts(lines)
    marginals = left_marginals(counts)
    shares = _with_totals(counts, marginals, rows_per_split).select("left", "right", (F.col("n") / F.col("total")).alias("value"))
    return shares.unionByName(
        marginals.select("left", F.lit(MARGINAL).alias("right"), F.col("total").cast("double").alias("value"))
    )


def segment_of(entry: Column, segments: int) -> Column:
    """In which segment of a stripe an entry is: by the first 32 bits of its MD5, whatever the size of the stripe."""
    return (F.conv(F.substring(F.md5(entry.cast("binary")), 1, 8), 16, 10).cast("long") % segments).cast("int")


def stripes(pairs: DataFrame, key: str, entry: str, value: Column, segments: int, name: str = "stripe") -> DataFrame:
    """Collect ``entry -> value`` maps per key: ``(key, segment, stripe)``.

    The entries of every key are dealt to ``segments`` maps by one rule, so that a key with very many
    entries has several smaller rows. Data with larger stripes need more segments.
    """
    segment = segment_of(F.col(entry), segments)
    return (
        pairs.select(key, segment.alias("segment"), F.struct(F.col(entry), value.alias("value")).alias("_entry"))
        .groupBy(key, "segment")
        .agg(F.map_from_entries(F.sort_array(F.collect_list("_entry"))).alias(name))
    )


def relative_frequency_stripes(lines: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """``(left, segment, stripe)``: maps from right word to its share, dealt to ``segments`` per left word.

    The total of a left word is summed over its stripes, of which there are ``segments`` at most, so the pairs are counted
    and moved to their stripes once, without their totals, and no left word needs to be split.
    """
    counted = stripes(bigram_counts(lines), "left", "right", F.col("n"), segments)
    inside = F.aggregate(F.map_values("stripe"), F.lit(0).cast("long"), lambda total, n: total + n)
    totals = counted.withColumn("_total", F.sum(inside).over(Window.partitionBy("left")))
    return totals.select("left", "segment", F.transform_values("stripe", lambda _, n: n / F.col("_total")).alias("stripe"))
