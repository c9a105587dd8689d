"""Connected components by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Scratch

MAX_ROUNDS = 60
EDGES_A_TASK = 50_000


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    wide = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(wide)).first())


def _tasks(edges: DataFrame, count: int) -> int:
    """Tasks for so many edges, and no fewer than run at once.

    Shuffles have as many partitions as the session says, which for the few edges of most calls may be many more;
    each would be a task of its own in every step of every round, and the driver keeps and reports them all.
    """
    return max(edges.sparkSession.sparkContext.defaultParallelism, -(-count // EDGES_A_TASK))


ADAPTIVE_KEY = "spark.sql.adaptive.enabled"


@contextmanager
def _planned_once(spark: SparkSession, few: bool) -> Iterator[None]:
    """Plan what is run here once, if it has ``few`` edges, and not again after each shuffle.

    A round has some ten shuffles. With few edges there is nothing to learn from them, while every new plan costs the driver
    memory and threads. With many, planning again is what splits the rows of a node with very many neighbours.
    """
    before = spark.conf.get(ADAPTIVE_KEY)
    if few:
        spark.conf.set(ADAPTIVE_KEY, "false")
    try:
        yield
    finally:
        spark.conf.set(ADAPTIVE_KEY, before)


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("least")).coalesce(tasks)
    least = least.select(F.col("a").alias("u"), F.least("a", "least").alias("least"))
    linked = both.join(least, F.col("a") == F.col("u")).where("b > a").coalesce(tasks)
    return linked.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct().coalesce(tasks)


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Edges lead from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("least")).coalesce(tasks)
    others = edges.join(least.withColumnRenamed("a", "u"), F.col("a") == F.col("u")).where("b <> least").coalesce(tasks)
    return others.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.toDF("a", "b")).distinct().coalesce(tasks)


def components(edges: DataFrame) -> DataFrame:
    """``(id, root)`` for every node of ``edges(a, b)``; the root is the smallest node of its component.

    Every round is written to the shared folder, and the one before deleted. Loops and repeated edges change
    nothing; nodes without an edge to another node are not listed.
    """
    scratch = Scratch(edges.sparkSession)
    # Repeated edges are left to the first round, which sees each once more than it has to and returns it once.
    now = scratch.stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    mark = _mark(now)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        older, scratch = scratch, Scratch(edges.sparkSession)
        tasks = _tasks(now, mark[0])
        with _planned_once(edges.sparkSession, mark[0] <= EDGES_A_TASK):
            now = scratch.stored(_small_star(_large_star(now, tasks), tasks), "edges")
            before, mark = mark, _mark(now)
        older.delete()
        if before == mark:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("id"), F.col("b").alias("root")).union(now.select("b", "b").distinct())


def with_links(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components of the links and of ``roots``, which are such components already; ``roots`` as they are if there are no links."""
    if links.isEmpty():
        return roots
    return components(roots.where("id <> root").toDF("a", "b").union(links))
