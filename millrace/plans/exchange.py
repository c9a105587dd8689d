"""Text records and files: the tables rendered in the forms that jobs read, and read back; results written and read.

Nothing is rendered per key of unknown size: an order is as many records as it has blocks of line numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import ranking
from millrace.plans import classify, text
from millrace.plans.graph import order_graph
from millrace.session import fresh_path
from millrace.sinks.files import write_minutes, write_model, write_sorted, write_text, write_text_model, write_text_models
from millrace.sources.features import parse_instances, parse_model, read_model, read_text_models
from millrace.sources.graphs import adjacency_to_graph, parse_adjacency
from millrace.sources.tables import read_table
from millrace.sources.text import read_lines
from millrace.streaming import replay, windows

BLOCK_LINES = 4
DAY = "2015-12-01 00:00:00"
# The events have no places. Clicks become yellow trips and views green ones, at points over the two blocks.
WEST, SOUTH, STEP_X, STEP_Y, SPREAD, SCALE = -740_150_000, 407_130_000, 60, 90, 7919, 1e7


def trips(spark: SparkSession, directory: str) -> DataFrame:
    """``(ts, line)``: the events as comma-separated trips."""
    events = read_table(spark, directory, "events")
    x = F.format_string("%.7f", (F.lit(WEST) + F.col("event_id") % 1000 * STEP_X) / SCALE)
    y = F.format_string("%.7f", (F.lit(SOUTH) + F.col("event_id") * SPREAD % 1000 * STEP_Y) / SCALE)
    none = F.lit("-")
    yellow = F.concat_ws(",", F.lit("yellow"), *[none] * 9, x, y)
    green = F.concat_ws(",", F.lit("green"), *[none] * 7, x, y, none)
    other = F.concat_ws(",", F.lit("black"), *[none] * 7, x, y, x, y)
    kind = F.col("event_type")
    return events.select("ts", F.when(kind == "click", yellow).when(kind == "view", green).otherwise(other).alias("line"))


def trip_lines(spark: SparkSession, directory: str) -> DataFrame:
    """``(line_id, line)``: the trips, written as text and read back."""
    path = fresh_path(spark, "trips")
    write_text(trips(spark, directory).select("line"), path)
    return read_lines(spark, path)


def trips_by_minute(spark: SparkSession, directory: str, length: str, files_per_batch: int, delay: str) -> DataFrame:
    """``(window_end, key, n)``: trips that end inside each block, from a stream over a text file per minute of the day.

    The trips of all days are laid over one day, ``DAY``, whose minutes are in the names of the files.
    """
    minute = F.hour("ts") * 60 + F.minute("ts")
    path = fresh_path(spark, "minutes")
    write_minutes(trips(spark, directory).select("line", minute.alias("minute")), path, "line", "minute")
    lines = replay.minute_lines(spark, path, DAY, files_per_batch)
    arrivals = windows.taxi_arrivals(windows.with_event_time(lines, delay=delay))
    return replay.replay(windows.window_counts(arrivals, length), "window_end", "key")


def trips_per_region(spark: SparkSession, directory: str) -> DataFrame:
    """``(key, n)``: trips that end inside each block, read from their text."""
    return windows.taxi_arrivals(trip_lines(spark, directory)).groupBy("key").agg(F.count("*").alias("n"))


def _order_blocks(spark: SparkSession, directory: str) -> DataFrame:
    """``(l_orderkey, parts)``: the parts of each block of an order, blank-separated in order."""
    items = read_table(spark, directory, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    block = F.floor(F.col("l_linenumber") / BLOCK_LINES)
    parts = F.array_join(F.sort_array(F.collect_list("l_partkey")).cast("array<string>"), " ")
    return items.groupBy("l_orderkey", block.alias("block")).agg(parts.alias("parts"))


def order_instances(spark: SparkSession, directory: str) -> DataFrame:
    """``(doc_id, label, n_features, feature_sum)``: order blocks as labelled feature lines, parsed."""
    label = F.when(F.col("l_orderkey") % 3 == 0, "spam").otherwise("ham")
    lines = _order_blocks(spark, directory).select(F.concat_ws(" ", F.col("l_orderkey"), label, "parts").alias("line"))
    total = F.aggregate("features", F.lit(0).cast("long"), lambda a, x: a + x)
    parsed = parse_instances(lines)
    return parsed.select("doc_id", "label", F.size("features").alias("n_features"), total.alias("feature_sum"))


def _order_graph(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """Order blocks as adjacency lines, parsed into a graph; an order of several blocks is defined several times."""
    lines = _order_blocks(spark, directory).select(F.concat_ws("\t", F.col("l_orderkey"), "parts").alias("line"))
    return adjacency_to_graph(parse_adjacency(lines))


def duplicate_orders(spark: SparkSession, directory: str) -> DataFrame:
    """``(id, definitions)`` of the orders that have more than one adjacency record."""
    nodes, _ = _order_graph(spark, directory)
    return ranking.duplicate_nodes(nodes)


def order_adjacency(spark: SparkSession, directory: str) -> DataFrame:
    """``(src, edges, targets)``: order blocks as adjacency lines, parsed into a graph."""
    _, edges = _order_graph(spark, directory)
    return edges.groupBy("src").agg(F.count("*").alias("edges"), F.sum("dst").alias("targets"))


def text_model(spark: SparkSession, directory: str, epochs: int) -> DataFrame:
    """``(feature, weight)`` of a model written as text and read back."""
    path = fresh_path(spark, "text-model")
    write_text_model(classify.train_classifier(spark, directory, epochs=epochs), path)
    return parse_model(read_lines(spark, path))


def text_ensemble(spark: SparkSession, directory: str, epochs: int, method: str = "vote") -> DataFrame:
    """``(doc_id, label, score, predicted)`` of all documents by the models of all languages, each read from its own text file."""
    path = fresh_path(spark, "text-models")
    write_text_models(classify.train_classifier(spark, directory, per_language=True, epochs=epochs), path)
    return classify.apply_ensemble(spark, directory, read_text_models(spark, path), method)


def model_table(spark: SparkSession, directory: str, epochs: int) -> DataFrame:
    """``(model_id, feature, weight)`` of the models of all languages, written as a table and read back."""
    path = fresh_path(spark, "model-table")
    write_model(classify.train_classifier(spark, directory, per_language=True, epochs=epochs), path)
    return read_model(spark, path)


def sorted_text(spark: SparkSession, directory: str) -> DataFrame:
    """``(word, n)``: the word counts written as sorted tab-separated text and read back."""
    path = fresh_path(spark, "word-count")
    write_sorted(text.word_count(spark, directory), path, "word")
    field = F.split("line", "\t")
    return read_lines(spark, path).select(F.get(field, F.lit(0)).alias("word"), F.get(field, F.lit(1)).cast("long").alias("n"))


def resumed_ranks(spark: SparkSession, directory: str, sources: list[int], first: int, last: int) -> DataFrame:
    """``(id, rank)`` after ``last`` steps, the run being broken off after ``first`` and resumed from its snapshot."""
    base = fresh_path(spark, "resumed")
    graph = ranking.prepare(*order_graph(spark, directory))
    try:
        ranking.iterate(graph, sources, first, base=base)
        return ranking.iterate(graph, sources, last, base=base, start=first).select("id", "rank")
    finally:
        graph.release()
