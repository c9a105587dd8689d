"""Inverted index: postings, document frequencies, and gap coding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.counts import words
from millrace.operators.gaps import running_sums
from millrace.session import fresh_path, in_buckets, write_and_read, write_bucketed

# Documents are numbered without gaps, and a posting list is cut into blocks of this many numbers.
MAX_POSTINGS = 65_536
# Long terms and numbers of documents up to these counts are broadcast to the postings (some 100 and 250 MB at most).
BROADCAST_TERMS, BROADCAST_DOCUMENTS = 1_000_000, 4_000_000
# A term of up to this many documents is in one task with all its segments, a longer one with this many segments at a time.
WHOLE_TERM, SPAN_SEGMENTS = 1_000_000, 64


def term_frequency(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(term, doc_id, tf)``, the working form of the index: one row per posting.

    The texts of a document are brought together before they are cut into words, as they are smaller than their postings.
    """
    texts = in_buckets(documents.select(F.col(doc_id).alias("doc_id"), text), "doc_id")
    tokens = words(texts, text, "doc_id").withColumnRenamed("word", "term")
    return tokens.groupBy("term", "doc_id").agg(F.count("*").cast("int").alias("tf"))


def document_frequency(postings: DataFrame) -> DataFrame:
    """``(term, df)``."""
    return postings.groupBy("term").agg(F.count("*").alias("df"))


def numbered(postings: DataFrame) -> DataFrame:
    """``(doc_id, number)``: the documents of the postings in order of id, numbered from 0 without gaps.

    Ranges of ids are numbered apart and shifted by the sizes of the ranges before, of which there is one per
    partition. The ranges are written, so that they do not change between their uses.
    """
    spark = postings.sparkSession
    ids = postings.select("doc_id").distinct().repartitionByRange("doc_id")
    ranges = write_and_read(ids.select("doc_id", F.spark_partition_id().alias("range")), fresh_path(spark, "index-ids"))
    earlier = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy(F.col("range").alias("_of")).agg(F.count("*").alias("_n"))
    shifts = sizes.select("_of", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    place = F.row_number().over(Window.partitionBy("range").orderBy("doc_id")) - 1
    placed = ranges.withColumn("_place", place).join(shifts, F.col("range") == F.col("_of"))
    return placed.select("doc_id", (F.col("_place") + F.col("_shift")).cast("long").alias("number"))


def _span() -> Column:
    """Which part of a term's segments a segment is in. Segments with the same term and span are in one task."""
    return F.when(F.col("df") > WHOLE_TERM, F.floor(F.col("segment") / SPAN_SEGMENTS)).otherwise(0).cast("long").alias("_span")


def _in_spans(lists: DataFrame, label: str, placed: bool) -> DataFrame:
    """The segments with their ``_span``, written by term and span."""
    written = write_bucketed(lists.select("*", _span()), label, "term", "_span", placed=placed)
    written.release()
    return written.table


def _with_starts(segments: DataFrame, spans: DataFrame) -> DataFrame:
    """Segments with the ``_start`` of their span; only spans of terms with several have a row."""
    starts = write_and_read(spans, fresh_path(segments.sparkSession, "index-starts"))
    return segments.join(F.broadcast(starts) if starts.count() <= BROADCAST_TERMS else starts, ["term", "_span"], "left")


def posting_lists(postings: DataFrame, max_postings: int = MAX_POSTINGS) -> DataFrame:
    """``(term, segment, df, postings)`` with postings ``(doc_id, tf)`` ascending by document.

    A term of at most ``max_postings`` documents is one row with segment 0. A longer list is cut by the numbers of
    its documents, segment s holding numbers from s * max_postings on, so that a segment holds ``max_postings``
    entries at most and the segments in order give the whole list. Lists are never gathered whole before it is known
    that they are short, and nothing depends on how far ids lie apart or on how long a term is. Only postings of long
    lists need numbers, and every posting is gathered once: it goes as a short row to the task of its term and span, where
    the coding finds the segments again. Postings are written by term and document, so that neighbours are alike and pack well.
    """
    spark = postings.sparkSession
    written = write_and_read(postings.sortWithinPartitions("term", "doc_id"), fresh_path(spark, "index-postings"))
    long = document_frequency(written).where(F.col("df") > max_postings)
    long = write_and_read(long, fresh_path(spark, "index-long"))
    few = long.count() <= BROADCAST_TERMS
    marked = written.join(F.broadcast(long) if few else long, "term", "left")
    numbers = write_and_read(numbered(written), fresh_path(spark, "index-numbers"))
    if numbers.count() <= BROADCAST_DOCUMENTS:
        numbers = F.broadcast(numbers)
    block = F.floor(F.col("number") / max_postings).cast("long")
    cut = marked.where(F.col("df").isNotNull()).join(numbers, "doc_id").select("term", block.alias("segment"), "df", "doc_id", "tf")
    short = marked.where(F.col("df").isNull()).select("term", F.lit(0).cast("long").alias("segment"), "df", "doc_id", "tf")
    gathered = (
        in_buckets(short.unionByName(cut).select("term", _span(), "df", "tf", "segment", "doc_id"), "term", "_span")
        .groupBy("term", "_span", "segment")
        .agg(F.max("df").alias("_df"), F.collect_list(F.struct("doc_id", "tf")).alias("_postings"))
    )
    df = F.coalesce("_df", F.size("_postings").cast("long"))
    return gathered.select("term", "segment", df.alias("df"), F.sort_array("_postings").alias("postings"))


def gap_encode(lists: DataFrame, placed: bool = True) -> DataFrame:
    """``(term, segment, df, gaps)``: each document id as its distance from the term's previous one.

    The first gap of a list is the id itself. Within a segment the distances come from the array alone; the id before a
    segment is the last one of the segment before, or of the span before, of which there is one short row each. Lists
    that are ``placed``, as ``posting_lists`` leaves them, are not moved; others are written in many files if called so.
    """
    lists = _in_spans(lists, "index-lists", placed)
    last = F.element_at("postings", -1)["doc_id"]
    ends = lists.where(F.col("df") > WHOLE_TERM).groupBy("term", "_span").agg(F.max(last).alias("_end"))
    spans = ends.select("term", "_span", F.lag("_end").over(Window.partitionBy("term").orderBy("_span")).alias("_start"))
    before = F.lag(last).over(Window.partitionBy("term", "_span").orderBy("segment"))
    return (
        _with_starts(lists.withColumn("_before", before), spans)
        .withColumn("_base", F.coalesce("_before", "_start", F.lit(0)))
        .select(
            "term",
            "segment",
            "df",
            F.transform(
                "postings",
                lambda p, i: F.struct(
                    (p["doc_id"] - F.when(i == 0, F.col("_base")).otherwise(F.get("postings", i - 1)["doc_id"])).alias("gap"),
                    p["tf"].alias("tf"),
                ),
            ).alias("gaps"),
        )
    )


def gap_decode(encoded: DataFrame, placed: bool = True) -> DataFrame:
    """``(term, doc_id, tf)`` from ``gap_encode``: ids are the running sums of the gaps.

    The sums run within a segment, whose size is bounded, from the sum of the segments before it in its span and of the
    spans before. They are made where the segment is, so that no posting is moved; ``placed`` as for ``gap_encode``.
    """
    encoded = _in_spans(encoded, "index-gaps", placed)
    width = F.aggregate("gaps", F.lit(0).cast("long"), lambda acc, g: acc + g["gap"])
    earlier = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    widths = encoded.where(F.col("df") > WHOLE_TERM).groupBy("term", "_span").agg(F.sum(width).alias("_width"))
    spans = widths.select("term", "_span", F.sum("_width").over(earlier.partitionBy("term").orderBy("_span")).alias("_start"))
    before = F.sum(width).over(earlier.partitionBy("term", "_span"))
    summed = _with_starts(encoded.withColumn("_before", before), spans)
    base = F.coalesce("_before", F.lit(0)) + F.coalesce("_start", F.lit(0))
    return summed.select("term", base.alias("_base"), "gaps").mapInArrow(running_sums(), "term string, doc_id long, tf int")


def flatten(lists: DataFrame) -> DataFrame:
    """``(term, doc_id, tf)`` of posting lists."""
    return lists.select("term", F.inline("postings"))
