"""A graph of the order tables, and the ranking of its nodes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import ranking
from millrace.session import fresh_path, write_and_read
from millrace.sources.tables import read_table

KINDS = ("customer", "order", "part", "supplier")
NODE_TABLES = (
    ("customer", "customer", "c_custkey"),
    ("order", "orders", "o_orderkey"),
    ("part", "part", "p_partkey"),
    ("supplier", "supplier", "s_suppkey"),
)


def node_id(kind: str, key: Column) -> Column:
    """Ids of the kinds never meet, however large the keys."""
    return key * len(KINDS) + KINDS.index(kind)


def order_graph(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """Nodes ``(id)`` and edges ``(src, dst)`` of the order tables.

    A customer points to its orders, an order to the part and to the supplier of each of its items,
    and a part to the customers who returned it. Nothing leads out of a supplier.
    """
    orders = read_table(spark, directory, "orders").select("o_orderkey", "o_custkey")
    items = read_table(spark, directory, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    customer = node_id("customer", F.col("o_custkey"))
    order = node_id("order", F.col("l_orderkey"))
    part = node_id("part", F.col("l_partkey"))
    placed = orders.select(customer.alias("src"), node_id("order", F.col("o_orderkey")).alias("dst"))
    targets = F.array(part, node_id("supplier", F.col("l_suppkey")))
    contains = items.select(order.alias("src"), F.explode(targets).alias("dst"))
    returned = (
        items.where(F.col("l_returnflag") == "R")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(part.alias("src"), customer.alias("dst"))
    )
    nodes = [
        read_table(spark, directory, table).select(node_id(kind, F.col(key)).alias("id"))
        for kind, table, key in NODE_TABLES
    ]
    return reduce(DataFrame.union, nodes), placed.union(contains).union(returned)


def customers(keys: Sequence[int]) -> list[int]:
    """Node ids of customers."""
    return [key * len(KINDS) + KINDS.index("customer") for key in keys]


def graph_build(spark: SparkSession, directory: str, sources: Sequence[int]) -> DataFrame:
    """``(id, degree, rank)``: the nodes with their number of edges and their first rank."""
    nodes, edges = order_graph(spark, directory)
    start = 1.0 / len(set(sources))
    rank = F.when(ranking.is_source(F.col("id"), sources), F.lit(start)).otherwise(F.lit(0.0))
    return nodes.join(ranking.degrees(edges), "id", "left").select(
        "id", F.coalesce("degree", F.lit(0)).alias("degree"), rank.alias("rank")
    )


def graph_statistics(spark: SparkSession, directory: str) -> DataFrame:
    return ranking.graph_statistics(*order_graph(spark, directory))


def message_statistics(spark: SparkSession, directory: str, sources: Sequence[int]) -> DataFrame:
    return ranking.message_statistics(*order_graph(spark, directory), sources)


def missing_targets(spark: SparkSession, directory: str) -> DataFrame:
    """Targets that are no nodes when the suppliers are left out of the node table."""
    nodes, edges = order_graph(spark, directory)
    return ranking.missing_targets(nodes.where(F.col("id") % len(KINDS) != KINDS.index("supplier")), edges)


def step_statistics(spark: SparkSession, directory: str, sources: Sequence[int], iterations: int) -> DataFrame:
    """Statistics of every step when the suppliers are left out of the node table, so that rank sent to them is lost."""
    nodes, edges = order_graph(spark, directory)
    known = nodes.where(F.col("id") % len(KINDS) != KINDS.index("supplier"))
    return ranking.step_statistics(known, edges, sources, iterations)


def personalized_ranks(
    spark: SparkSession, directory: str, sources: Sequence[int], iterations: int, alpha: float = ranking.ALPHA
) -> DataFrame:
    nodes, edges = order_graph(spark, directory)
    return ranking.personalized_ranks(nodes, edges, sources, iterations, alpha)


def log_mass(spark: SparkSession, directory: str, sources: Sequence[int], iterations: int) -> DataFrame:
    """``(id, log_mass)`` that the ranks after some steps send in the next one."""
    graph = ranking.prepare(*order_graph(spark, directory))
    try:
        arriving = ranking.arriving_log_mass(graph, ranking.iterate(graph, sources, iterations))
        return write_and_read(arriving, fresh_path(spark, "log_mass"))
    finally:
        graph.release()
