"""Windowed counts and trends of the events, from the table or as a stream over its files."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.regions import Region
from millrace.session import fresh_path
from millrace.sources.tables import read_table
from millrace.streaming import replay, state, windows

# The events have no places. Clicks and views are given a point from different columns, as records of
# different types are, and the two regions overlap.
EVENT_REGIONS = (
    Region("north", "North Side", 5.0, 60.0, 40.0, 140.0),
    Region("south", "South Side", 20.0, 90.0, 5.0, 60.0),
)


def events(spark: SparkSession, directory: str, streaming: bool = False, delay: str | None = None) -> DataFrame:
    """The events with their time, as a table or as a stream."""
    table = read_table(spark, directory, "events")
    if streaming:
        table = replay.table_stream(spark, directory, table.schema, "events.parquet")
    return windows.with_event_time(table, "ts", delay)


def regional_events(spark: SparkSession, directory: str, streaming: bool = False, delay: str | None = None) -> DataFrame:
    """The events inside a region, with its name as key."""
    return in_regions(events(spark, directory, streaming, delay))


def in_regions(found: DataFrame) -> DataFrame:
    """The events inside a region, with its name as key."""
    point = windows.coordinates_by_type(
        F.col("event_type"),
        {
            "click": (F.col("value"), F.col("user_id").cast("double")),
            "view": (F.get_json_object("props", "$.k").cast("double"), F.col("value")),
        },
    )
    return windows.with_region(found, *point, EVENT_REGIONS)


def event_count(spark: SparkSession, directory: str, length: str = "60 minutes", streaming: bool = False) -> DataFrame:
    """``(window_end, key, n)`` of all events."""
    keyed = windows.with_constant_key(events(spark, directory, streaming))
    return _result(windows.window_counts(keyed, length), streaming)


def region_count(spark: SparkSession, directory: str, length: str = "60 minutes", streaming: bool = False) -> DataFrame:
    """``(window_end, key, n)`` of the events in each region."""
    return _result(windows.window_counts(regional_events(spark, directory, streaming), length), streaming)


def trends(
    spark: SparkSession, directory: str, length: str = "10 minutes", streaming: bool = False
) -> DataFrame:
    """``(window_end, key, cur, prev)`` of each region."""
    found = _result(windows.trend(regional_events(spark, directory, streaming), length), streaming)
    return windows.until_last_arrival(found)


def batched_events(spark: SparkSession, directory: str, batches: int) -> Iterator[DataFrame]:
    """The events as a stream over files that grow by a batch at a time.

    The batches are equal spans of time in their order. Each comes when the one before has been processed, in as many
    files as the scan of the events has tasks with rows of it.
    """
    table = read_table(spark, directory, "events")
    time = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = table.agg(F.min(time), F.max(time)).first()
    path = fresh_path(spark, "event-files")
    part = F.floor(F.lit(batches) * (time - F.lit(first)) / (F.lit(last) - F.lit(first) + 1))
    for batch in range(batches):
        table.where(part == batch).write.mode("append").parquet(path)
        stream = replay.table_stream(spark, path, table.schema, files_per_batch=replay.ALL_FILES)
        yield windows.with_event_time(stream)


def late_after(arriving: DataFrame, delay: str) -> DataFrame:
    """With a watermark that follows the latest of these events; put on after filters, so that none is moved below it."""
    return arriving.withWatermark("event_time", delay)


def event_count_in_batches(
    spark: SparkSession, directory: str, length: str = "60 minutes", batches: int = 6, delay: str = "2 hours"
) -> DataFrame:
    """``(window_end, key, n)`` of all events, from a stream of several batches that carries its open windows on."""
    arriving = batched_events(spark, directory, batches)
    counts = (windows.window_counts(windows.with_constant_key(late_after(e, delay)), length) for e in arriving)
    return replay.replay_in_turn(spark, counts, "window_end", "key")


def kept_trends(
    spark: SparkSession, directory: str, length: str = "60 minutes", batches: int = 3, delay: str = "2 hours"
) -> DataFrame:
    """``(window_end, key, cur, prev)`` of each region from its first window on, windows without events included.

    From a stream of several batches with state per key; windows that the watermark has not passed are not there.
    """
    arriving = batched_events(spark, directory, batches)
    found = (state.kept_trend(late_after(in_regions(e), delay), length) for e in arriving)
    with replay.keyed_state(spark):
        return replay.append_in_turn(spark, found, state.TREND_SCHEMA)


def closed_windows(
    spark: SparkSession, directory: str, length: str = "60 minutes", batches: int = 3, delay: str = "2 hours"
) -> DataFrame:
    """``(window_end, key, n)`` of the events of the windows that the watermark has passed, appended as they close.

    The sink has one directory per window, named by its end in milliseconds.
    """
    arriving = batched_events(spark, directory, batches)
    counts = (
        windows.window_counts(windows.with_constant_key(late_after(e, delay)), length).select("key", "n", F.unix_millis("window_end").alias("end_ms"))
        for e in arriving
    )
    written = replay.append_in_turn(spark, counts, "key string, n long, end_ms long", "end_ms")
    return written.select(F.timestamp_millis("end_ms").alias("window_end"), "key", "n")


def trends_and_alerts(
    spark: SparkSession,
    directory: str,
    min_arrivals: int,
    factor: int,
    length: str = "60 minutes",
    batches: int = 3,
    delay: str = "2 hours",
) -> DataFrame:
    """``(kind, key, cur, ts, prev, message)``: trend rows and alerts, two tables written from the same batches of a stream."""
    base = fresh_path(spark, "two-tables")
    outputs = {
        f"{base}/trends": windows.trend_rows,
        f"{base}/alerts": lambda batch: windows.alerts(batch, min_arrivals, factor, EVENT_REGIONS),
    }
    for arriving in batched_events(spark, directory, batches):
        replay.run_batches(windows.trend(late_after(in_regions(arriving), delay), length), outputs, f"{base}/checkpoint")
    columns = "key string, cur long, ts long, prev long"
    rows = spark.read.schema(columns).parquet(f"{base}/trends")
    raised = spark.read.schema(f"{columns}, message string").parquet(f"{base}/alerts")
    tagged = rows.withColumns({"kind": F.lit("trend"), "message": F.lit(None).cast("string")})
    return tagged.unionByName(raised.withColumn("kind", F.lit("alert"))).drop("batch")


def _result(windowed: DataFrame, streaming: bool) -> DataFrame:
    return replay.replay(windowed, "window_end", "key") if streaming else windowed
