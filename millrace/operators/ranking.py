"""Personalized ranking of the nodes of a graph, with several source nodes.

A graph is a table of node ids ``(id)`` and one of edges ``(src, dst)``; parallel edges count each.
Rank flows along the edges in equal parts, a node without out-edges sends its rank to the sources in
equal parts, and every step restarts at the sources with probability alpha. All sources share one
rank vector. Rank sent to an id that is no node is lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import pairwise
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scores import significant
from millrace.operators.aggregates import log_or_zero, log_sum_exp
from millrace.operators.skew import hot_keys, with_splits
from millrace.session import Bucketed, fresh_path, write_and_read, write_bucketed

ALPHA = 0.15

# A node with links to more targets than this has them dealt to several tasks.
EDGES_PER_SPLIT = 1_000_000


class Prepared(NamedTuple):
    """What stays the same in all steps, written once and bucketed by what the steps join on.

    ``nodes`` has ``(id, degree, splits)``. ``links`` has ``(src, split, dst, n)`` with the number of
    edges from src to dst, the links of a node of many edges being dealt to ``splits`` groups.
    """

    node_table: Bucketed
    link_table: Bucketed

    @property
    def nodes(self) -> DataFrame:
        return self.node_table.table

    @property
    def links(self) -> DataFrame:
        return self.link_table.table

    def release(self) -> None:
        self.node_table.release()
        self.link_table.release()


def degrees(edges: DataFrame) -> DataFrame:
    """``(id, degree)`` of the nodes with out-edges."""
    return edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree"))


def graph_statistics(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: ``nodes``, ``edges``, and ``active_nodes``, those with out-edges."""
    per_node = nodes.join(degrees(edges), "id", "left")
    return per_node.agg(
        F.count("*").alias("nodes"),
        F.coalesce(F.sum("degree"), F.lit(0)).alias("edges"),
        F.count("degree").alias("active_nodes"),
    )


def missing_targets(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(dst, messages)`` of the ids that edges point to but that are no nodes."""
    targets = edges.groupBy("dst").agg(F.count("*").alias("messages"))
    return targets.join(nodes, targets["dst"] == nodes["id"], "left_anti")


def message_statistics(nodes: DataFrame, edges: DataFrame, sources: Sequence[int]) -> DataFrame:
    """One row of what a step sends.

    ``messages`` counts one per edge and one per source for every node without out-edges, ``missing`` the
    targets of edges that are no nodes.
    """
    wanted = sorted(set(sources))
    per_node = nodes.join(degrees(edges), "id", "left")
    sent = per_node.agg(
        F.count("*").alias("nodes"),
        F.coalesce(F.sum("degree"), F.lit(0)).alias("edges"),
        F.count(F.when(F.col("degree").isNull(), 1)).alias("dangling"),
    )
    missing = missing_targets(nodes, edges).agg(F.count("*").alias("missing")).scalar()
    return (
        sent.withColumn("messages", F.col("edges") + F.col("dangling") * len(wanted))
        .withColumn("missing", missing)
        .select("nodes", "edges", "messages", "missing")
    )


def duplicate_nodes(nodes: DataFrame) -> DataFrame:
    """``(id, definitions)`` of the ids that occur more than once."""
    return nodes.groupBy("id").agg(F.count("*").alias("definitions")).where(F.col("definitions") > 1)


def check_unique(nodes: DataFrame) -> None:
    """Raise if an id occurs more than once; ``duplicate_nodes`` reports all that do."""
    twice = duplicate_nodes(nodes).take(1)
    if twice:
        raise ValueError(f"node {twice[0]['id']} is defined {twice[0]['definitions']} times")


def is_source(node: Column, sources: Sequence[int]) -> Column:
    return node.isin(sorted(set(sources)))


def prepare(nodes: DataFrame, edges: DataFrame, edges_per_split: int = EDGES_PER_SPLIT) -> Prepared:
    """Compute the fixed tables once and cut their lineage, so that no step recomputes the graph.

    Parallel edges become one link. The links are built and written once, and the degrees are sums over them.
    A step moves ranks but never links.
    """
    spark = nodes.sparkSession
    base = fresh_path(spark, "graph")
    linked = write_and_read(edges.groupBy("src", "dst").agg(F.count("*").alias("n")), f"{base}/linked")
    degree = linked.groupBy(F.col("src").alias("id")).agg(F.sum("n").alias("degree"), F.count("*").alias("targets"))
    table = write_and_read(
        nodes.join(degree, "id", "left").select("id", F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("targets", F.lit(0)).alias("targets")),
        f"{base}/nodes",
    )
    check_unique(table)
    hot = hot_keys(table, "id", "targets", edges_per_split)
    splits = with_splits(table, "id", hot, edges_per_split).withColumnRenamed("_splits", "splits")
    dealt = with_splits(linked, "src", hot, edges_per_split).select(
        "src",
        F.when(F.col("_splits") > 1, F.pmod(F.xxhash64("dst"), F.col("_splits"))).otherwise(0).cast("int").alias("split"),
        "dst",
        "n",
    )
    node_table = write_bucketed(splits.select("id", "degree", "splits"), "nodes", "id")
    try:
        return Prepared(node_table, write_bucketed(dealt, "links", "src", "split"))
    except Exception:
        node_table.release()
        raise


def _per_split(nodes: DataFrame) -> DataFrame:
    """A row per node and split."""
    return nodes.select("*", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("split"))


def initial_ranks(graph: Prepared, sources: Sequence[int]) -> DataFrame:
    """The node table with ``rank``: one over the number of sources at a source, else 0.

    A source named twice counts once.
    """
    start = 1.0 / len(set(sources))
    rank = F.when(is_source(F.col("id"), sources), F.lit(start)).otherwise(F.lit(0.0))
    return graph.nodes.withColumn("rank", rank)


def step(graph: Prepared, ranks: DataFrame, sources: Sequence[int], alpha: float = ALPHA) -> DataFrame:
    """The node table with the ranks after one more step."""
    count = len(set(sources))
    dangling = ranks.where("degree = 0").agg(F.coalesce(F.sum("rank"), F.lit(0.0)).alias("r")).scalar()
    senders = _per_split(ranks.where("degree > 0 AND rank > 0"))
    part = F.col("rank") / F.col("degree")
    mass = (
        graph.links.join(senders.select(F.col("id").alias("src"), "split", part.alias("part")), ["src", "split"])
        .groupBy(F.col("dst").alias("id"))
        .agg(F.sum(F.col("part") * F.col("n")).alias("mass"))
    )
    arrived = F.coalesce("mass", F.lit(0.0))
    restart = F.lit(alpha / count) + (1 - alpha) * (arrived + dangling / count)
    rank = F.when(is_source(F.col("id"), sources), restart).otherwise((1 - alpha) * arrived)
    return graph.nodes.join(mass, "id", "left").select("id", "degree", "splits", rank.alias("rank"))


def snapshot_path(base: str, iteration: int) -> str:
    # Fixed value: four digits.
    return f"{base}/iter{iteration:04d}"


def read_snapshot(spark: SparkSession, base: str, iteration: int) -> DataFrame:
    """The node table with the ranks written after ``iteration`` steps."""
    return spark.read.parquet(snapshot_path(base, iteration))


def iterate(
    graph: Prepared,
    sources: Sequence[int],
    iterations: int,
    alpha: float = ALPHA,
    base: str | None = None,
    start: int = 0,
    metrics: dict[str, Column] | None = None,
    observed: list[dict] | None = None,
) -> DataFrame:
    """The node table with the ranks after ``iterations`` steps.

    Every step writes its ranks below ``base`` (by default a new path in the shared folder), which
    cuts the lineage; a later call with ``start`` goes on from the snapshot of that number. ``metrics`` are aggregates
    over the node table, taken while it is written and put into ``observed``, one entry per written table.
    """
    if not sources:
        raise ValueError("at least one source is needed")
    spark = graph.nodes.sparkSession
    base = base or fresh_path(spark, "ranks")

    def written(ranks: DataFrame, iteration: int) -> DataFrame:
        if not metrics:
            return write_and_read(ranks, snapshot_path(base, iteration))
        seen = Observation()
        table = ranks.observe(seen, *[column.alias(name) for name, column in metrics.items()])
        ranks = write_and_read(table, snapshot_path(base, iteration))
        observed.append(seen.get)
        return ranks

    ranks = written(initial_ranks(graph, sources), 0) if start == 0 else read_snapshot(spark, base, start)
    for iteration in range(start, iterations):
        ranks = written(step(graph, ranks, sources, alpha), iteration + 1)
    return ranks


def step_statistics(
    nodes: DataFrame, edges: DataFrame, sources: Sequence[int], iterations: int, alpha: float = ALPHA
) -> DataFrame:
    """``(step, nodes, ranked, messages, lost_mass)`` of every step, observed on what the steps write anyway.

    ``ranked`` nodes have rank before the step. They send a ``messages`` count of one along each edge, or one to each source
    if they have none. ``lost_mass`` is the rank that the step sent to ids that are no nodes.
    """
    spark = nodes.sparkSession
    count = len(set(sources))
    has_rank = F.col("rank") > 0
    sent = F.when(F.col("degree") > 0, F.col("degree")).otherwise(count)
    metrics = {
        "nodes": F.count("*"),
        "ranked": F.count_if(has_rank),
        "messages": F.coalesce(F.sum(F.when(has_rank, sent)), F.lit(0)),
        "mass": F.coalesce(F.sum("rank"), F.lit(0.0)),
        "restarts": F.count_if(is_source(F.col("id"), sources)),
    }
    graph, seen = prepare(nodes, edges), []
    try:
        iterate(graph, sources, iterations, alpha, metrics=metrics, observed=seen)
    finally:
        graph.release()
    rows = []
    for number, (before, after) in enumerate(pairwise(seen), 1):
        # A step gives every source that is a node its part of alpha, and the rest is what has arrived.
        arrived = (after["mass"] - alpha * after["restarts"] / count) / (1 - alpha)
        rows.append((number, before["nodes"], before["ranked"], before["messages"], before["mass"] - arrived))
    return spark.createDataFrame(rows, "step int, nodes long, ranked long, messages long, lost_mass double")


def personalized_ranks(
    nodes: DataFrame,
    edges: DataFrame,
    sources: Sequence[int],
    iterations: int,
    alpha: float = ALPHA,
    base: str | None = None,
    start: int = 0,
    edges_per_split: int = EDGES_PER_SPLIT,
) -> DataFrame:
    """``(id, rank)`` after ``iterations`` steps; see ``iterate`` for ``base`` and ``start``."""
    graph = prepare(nodes, edges, edges_per_split)
    try:
        return iterate(graph, sources, iterations, alpha, base, start).select("id", "rank")
    finally:
        graph.release()


def arriving_log_mass(graph: Prepared, ranks: DataFrame) -> DataFrame:
    """``(id, log_mass)`` that arrives at each target, with ranks and sums kept as logarithms."""
    log_part = log_or_zero(F.col("rank")) - F.log("degree")
    senders = _per_split(ranks.where("degree > 0")).select(F.col("id").alias("src"), "split", log_part.alias("log_part"))
    sent = graph.links.join(senders, ["src", "split"]).select(
        F.col("dst").alias("id"), (F.col("log_part") + F.log("n")).alias("log_part")
    )
    return log_sum_exp(sent, ["id"], "log_part", "log_mass")


def top_nodes(ranks: DataFrame, n: int = 100, digits: int | None = None) -> DataFrame:
    """``(id, rank)`` of the ``n`` highest ranks, ties in order of id; ranks equal to so many significant ``digits`` tie."""
    rank = F.col("rank") if digits is None else significant(F.col("rank"), digits)
    return ranks.select("id", rank.alias("rank")).orderBy(F.desc("rank"), "id").limit(n)


def log_ranks(ranks: DataFrame) -> DataFrame:
    """``(id, log_rank)``; null for nodes without rank."""
    return ranks.select("id", F.when(F.col("rank") > 0, F.log("rank")).alias("log_rank"))


def format_ranks(ranks: DataFrame) -> DataFrame:
    """``(rank, id)`` with the rank as text of five decimals."""
    # Fixed value: the printed form.
    return ranks.select(F.format_string("%.5f", "rank").alias("rank"), "id")
