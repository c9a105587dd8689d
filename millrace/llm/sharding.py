"""Sharding by longest processing time: groups of equal texts, largest first, go to the least-loaded shard.

The heap runs over size classes, not over groups: sizes are kept to twelve significant bits, so there are fewer
than 80,000 classes whatever the input, and all groups below 4096 bytes are exact. Where a class has many groups
of one size, what the heap would do with them one after another is computed at once. Groups are numbered within
their class in Spark, and the plan says which numbers go to which shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored, with_rank

BITS = 12


def size_class(size: Column) -> Column:
    """The size, with all but its first twelve bits cleared."""
    drop = F.greatest(F.length(F.bin(size)) - BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", size, drop), drop).cast("long")


def _deal(loads: list[float], size: float, count: int) -> list[int]:
    """How many of ``count`` equal items each shard gets if they go to the least-loaded shard one by one."""
    low, high = min(loads), max(loads) + size * (count + 1)
    given = [0] * len(loads)

    def upto(level: float) -> list[int]:
        return [max(0, int((level - load) // size)) for load in loads]

    for _ in range(100):
        middle = (low + high) / 2
        if sum(upto(middle)) <= count:
            low, given = middle, upto(middle)
        else:
            high = middle
    heap = [(load + n * size, i) for i, (load, n) in enumerate(zip(loads, given, strict=True))]
    heapq.heapify(heap)
    for _ in range(count - sum(given)):
        load, i = heap[0]
        given[i] += 1
        heapq.heapreplace(heap, (load + size, i))
    return given


def plan_shards(classes: Iterable[tuple[int, int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """``(class, first, past the last, shard)`` for ``(class, groups, bytes)`` of every class."""
    loads = [0.0] * shards
    plan = []
    for name, count, total in sorted(classes, reverse=True):
        size, at = total / count, 0
        for shard, n in enumerate(_deal(loads, size, count)):
            if n:
                plan.append((name, at, at + n, shard))
                loads[shard] += n * size
                at += n
    return plan


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` for every row of ``docs(doc_id, text)``.

    ``size`` is the number of UTF-8 bytes plus one; a null text counts as empty, and equal texts (null and
    empty ones too) share a shard. Slots number the rows of a shard from 0. Repeated rows and null ids are rows
    like any other, other columns are not read, and an empty table gives no rows. A group that is larger than a
    fair share stays whole, so its shard is as uneven as that group makes it.
    """
    spark = docs.sparkSession
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = stored(
        docs.select(
            docs["doc_id"].alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(text.cast("binary"))).alias("key"),
        ),
        "shard-rows",
    )
    groups = stored(
        rows.groupBy("key", "size", "text_crc32")
        .agg(F.count("*").alias("n"))
        .withColumn("bytes", F.col("size") * F.col("n"))
        .withColumn("class", size_class(F.col("bytes"))),
        "shard-groups",
    )
    classes = groups.groupBy("class").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).collect()
    plan = spark.createDataFrame(
        plan_shards([tuple(r) for r in classes], shards), "of long, first long, past long, shard int"
    )
    spans = plan.groupBy("of").agg(F.collect_list(F.struct("past", "shard")).alias("spans"))
    span = F.filter("spans", lambda s: s["past"] > F.col("rank"))
    placed = (
        with_rank(groups, "class", ["key", "size", "text_crc32"], "rank")
        .join(F.broadcast(spans), F.col("class") == F.col("of"))
        .select(
            F.col("key").alias("_key"),
            F.col("size").alias("_size"),
            F.col("text_crc32").alias("_crc"),
            F.array_min(F.transform(span, lambda s: F.struct(s["past"].alias("past"), s["shard"].alias("shard"))))["shard"].alias("shard"),
        )
    )
    same = (F.col("key") == F.col("_key")) & (F.col("size") == F.col("_size")) & (F.col("text_crc32") == F.col("_crc"))
    # The rows of a large group meet its one row in a plain inner join, which AQE splits.
    sharded = stored(rows.join(placed, same).select("doc_id", "size", "text_crc32", "shard"), "shard-of")
    return with_rank(sharded, "shard", ["doc_id", "size", "text_crc32"], "slot").select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )
