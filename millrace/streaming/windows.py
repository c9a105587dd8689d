"""Windowed counts and trends.

Every function takes and returns a DataFrame and works on a table as on a stream. Windows are by event
time and start at multiples of their length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.regions import OFFICE_REGIONS, Region, by_type, region_of, region_title, taxi_position
from millrace.session import fresh_path, write_and_read

# An arrival is trending from 10 arrivals on, twice as many as in the window before.
MIN_ARRIVALS = 10
FACTOR = 2
EVERYTHING = "all"

UTC = "UTC"


def without_zone(time: Column) -> Column:
    """A time as UTC without a zone."""
    return F.convert_timezone(F.current_timezone(), F.lit(UTC), time.cast("timestamp_ntz"))


def with_event_time(events: DataFrame, column: str = "ts", delay: str | None = None) -> DataFrame:
    """Add ``event_time``; with ``delay`` as watermark, events later than that are dropped on a stream.

    Times without a zone are taken as UTC, whatever the zone of the session.
    """
    time = F.col(column)
    if isinstance(events.schema[column].dataType, T.TimestampNTZType):
        time = F.convert_timezone(F.lit(UTC), F.current_timezone(), time)
    timed = events.withColumn("event_time", time.cast("timestamp"))
    return timed.withWatermark("event_time", delay) if delay else timed


def with_constant_key(events: DataFrame) -> DataFrame:
    """One key for all events."""
    return events.withColumn("key", F.lit(EVERYTHING))


def with_region(events: DataFrame, x: Column, y: Column, regions: Sequence[Region] = OFFICE_REGIONS) -> DataFrame:
    """Keep the events inside a region, with its name as ``key``."""
    return events.withColumn("key", region_of(x, y, regions)).where(F.col("key").isNotNull())


def taxi_arrivals(lines: DataFrame, line: str = "line", regions: Sequence[Region] = OFFICE_REGIONS) -> DataFrame:
    """Trips that end inside a region; records of an unknown type belong to none."""
    _, x, y = taxi_position(F.col(line))
    return with_region(lines, x, y, regions)


def coordinates_by_type(kind: Column, places: dict[str, tuple[Column, Column]]) -> tuple[Column, Column]:
    """Coordinates whose columns depend on the type of the record."""
    return (
        by_type(kind, {k: x for k, (x, _) in places.items()}),
        by_type(kind, {k: y for k, (_, y) in places.items()}),
    )


def window_counts(events: DataFrame, length: str = "60 minutes", key: str = "key") -> DataFrame:
    """``(window_end, key, n)`` of tumbling windows."""
    return (
        events.groupBy(F.window("event_time", length).alias("w"), F.col(key).alias("key"))
        .agg(F.count("*").alias("n"))
        .select(F.col("w.end").alias("window_end"), "key", "n")
    )


def seconds_of(length: str) -> int:
    """Length of a window given as a number of minutes, hours or days."""
    number, unit = length.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def trend(events: DataFrame, length: str = "10 minutes", key: str = "key") -> DataFrame:
    """``(window_end, key, cur, prev)``: the count of a window and of the one before it.

    A window of twice the length, moved by one length, covers both, so no state beyond the
    aggregation is kept. A key absent from the window before has ``prev`` 0. Rows where both counts
    would be 0 are not produced; ``dense`` adds them.
    """
    seconds = seconds_of(length)
    both = F.window("event_time", f"{2 * seconds} seconds", f"{seconds} seconds")
    spread = events.select(both.alias("w"), F.col(key).alias("key"), "event_time")
    is_current = F.col("event_time") >= F.col("w.end") - F.make_dt_interval(secs=F.lit(seconds))
    return (
        spread.withColumn("is_current", is_current)
        .groupBy("w", "key")
        .agg(F.count_if(F.col("is_current")).alias("cur"), F.count_if(~F.col("is_current")).alias("prev"))
        .select(F.col("w.end").alias("window_end"), "key", "cur", "prev")
    )


def until_last_arrival(trends: DataFrame) -> DataFrame:
    """Without the windows that end after the last one with an arrival. The counts are written first, to be read twice."""
    trends = write_and_read(trends, fresh_path(trends.sparkSession, "trends"))
    last = trends.where("cur > 0").agg(F.max("window_end")).scalar()
    return trends.where(F.col("window_end") <= last)


def trend_rows(trends: DataFrame) -> DataFrame:
    """``(key, cur, ts, prev)`` with the end of the window in milliseconds."""
    return trends.select("key", "cur", F.unix_millis("window_end").alias("ts"), "prev")


def alerts(
    trends: DataFrame,
    min_arrivals: int = MIN_ARRIVALS,
    factor: int = FACTOR,
    regions: Sequence[Region] = OFFICE_REGIONS,
) -> DataFrame:
    """``(key, cur, ts, prev, message)`` where arrivals have grown at least ``factor`` times."""
    risen = trend_rows(trends).where((F.col("cur") >= min_arrivals) & (F.col("cur") >= F.col("prev") * factor))
    # Fixed value: the text of an alert.
    message = F.format_string(
        "Number of arrivals to %s has doubled from %d to %d at %d!",
        region_title(F.col("key"), regions),
        F.col("prev"),
        F.col("cur"),
        F.col("ts"),
    )
    return risen.withColumn("message", message)


def dense(counts: DataFrame, length: str) -> DataFrame:
    """Tumbling counts with a row of 0 for every later window of a key once it was seen.

    The windows are generated per key from its first one on, so there is no product of windows and
    keys to join: ``counts``, written first to be read three times, are added to generated zeros.
    """
    counts = write_and_read(counts, fresh_path(counts.sparkSession, "window-counts"))
    last = counts.agg(F.max("window_end")).scalar()
    step = F.make_dt_interval(secs=F.lit(seconds_of(length)))
    first = counts.groupBy("key").agg(F.min("window_end").alias("first"))
    zeros = first.select(
        F.explode(F.sequence("first", last, step)).alias("window_end"), "key", F.lit(0).cast("long").alias("n")
    )
    return counts.unionByName(zeros).groupBy("window_end", "key").agg(F.sum("n").alias("n"))
