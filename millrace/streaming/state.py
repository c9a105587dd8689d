"""Keyed state on a stream: window counts of every key once it was seen, windows without events included."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.streaming.windows import seconds_of, window_counts

STATE_SCHEMA = "key string, at long, cur long, prev long"
TREND_SCHEMA = "window_end timestamp, key string, cur long, prev long"


class KeptCounts(StatefulProcessor):
    """Emits the count of each window of a key and of the one before, from the first window with events on.

    Counts of closed windows come in; a timer at the end of the next window says when the watermark has passed it. If
    no count has come by then, none will, and the window has 0. The state of a key is one value: the end of its next
    window, the count before it, and the counts that have come but are not due yet.
    """

    def __init__(self, length: int) -> None:
        self.length = length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("windows", "at long, prev long, ends array<long>, counts array<long>")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        come = {row["at"]: row["n"] for row in rows}
        held = self.state.get()
        if held is None:
            at, prev, due = min(come), 0, come
            self.handle.registerTimer(at)
        else:
            at, prev, ends, counts = held
            due = dict(zip(ends, counts, strict=True)) | come
        self.state.update((at, prev, list(due), list(due.values())))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at, prev, ends, counts = self.state.get()
        due = dict(zip(ends, counts, strict=True))
        passed = timerValues.getCurrentWatermarkInMs()
        while at <= passed:
            cur = due.pop(at, 0)
            yield Row(key=key[0], at=at, cur=cur, prev=prev)
            at, prev = at + self.length, cur
        self.state.update((at, prev, list(due), list(due.values())))
        self.handle.registerTimer(at)

    def close(self) -> None:
        pass


def kept_trend(events: DataFrame, length: str = "10 minutes", key: str = "key") -> DataFrame:
    """``(window_end, key, cur, prev)`` of a stream with a watermark: counts of a window and of the one before it.

    A key that was seen once has a row for every later window, with ``cur`` 0 where it had no events, as soon as
    the watermark has passed the end of the window. ``prev`` is 0 in the first. Only window counts reach the state, so a key with many events
    is counted in parts like any other; the state of a key is small and does not grow with time.
    """
    counts = window_counts(events, length, key).withColumn("at", F.unix_millis("window_end"))
    kept = counts.groupBy("key").transformWithState(KeptCounts(1000 * seconds_of(length)), STATE_SCHEMA, "append", "eventTime")
    return kept.select(F.timestamp_millis("at").alias("window_end"), "key", "cur", "prev")
