"""Graphs from adjacency text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_adjacency(lines: DataFrame, line: str = "line") -> DataFrame:
    """``(id, neighbours)`` of lines ``id n1 n2 ...``; a lone id has no neighbours. Blank lines are skipped."""
    fields = F.regexp_extract_all(F.col(line), F.lit(r"\S+"), F.lit(0))
    records = lines.select(fields.alias("_f")).where(F.size("_f") > 0)
    return records.select(
        F.get("_f", F.lit(0)).cast("long").alias("id"),
        F.slice("_f", 2, F.size("_f")).cast("array<bigint>").alias("neighbours"),
    )


def adjacency_to_graph(adjacency: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Node ids ``(id)`` and edges ``(src, dst)``."""
    nodes = adjacency.select("id")
    edges = adjacency.select(F.col("id").alias("src"), F.explode("neighbours").alias("dst"))
    return nodes, edges
