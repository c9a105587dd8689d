import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.functions.regions import OFFICE_REGIONS, Region
from millrace.plans import arrivals
from millrace.sinks import files
from millrace.streaming import replay, state, windows

START = dt.datetime(2015, 12, 1)
GOLDMAN, CITIGROUP, NOWHERE = (-74.0140, 40.7145), (-74.0110, 40.7210), (-73.0, 40.0)


def trip(kind, point):
    fields = ["0"] * 16
    fields[0] = kind
    x, y = {"yellow": (10, 11), "green": (8, 9)}.get(kind, (10, 11))
    fields[x], fields[y] = str(point[0]), str(point[1])
    return ",".join(fields)


def at(minute, second=0):
    return START + dt.timedelta(minutes=minute, seconds=second)


@pytest.fixture
def minutes(tmp_path):
    """Files of one minute each: arrivals in minutes 0, 5, 12 and 45, none from minute 20 to 29."""
    arriving = {0: 3, 5: 2, 12: 11, 19: 1, 30: 4, 45: 25}
    where = tmp_path / "trips"
    where.mkdir()
    for minute in range(60):
        lines = [trip("yellow" if k % 2 else "green", GOLDMAN) for k in range(arriving.get(minute, 0))]
        lines += [trip("yellow", CITIGROUP)] if minute % 10 == 3 else []
        lines += [trip("yellow", NOWHERE), trip("blue", GOLDMAN), "green"] if minute == 7 else []
        lines += [trip("yellow", (OFFICE_REGIONS[0].max_x, 40.7145))] if minute == 8 else []
        (where / f"part-2015-12-01-{minute:04d}.csv").write_text("".join(line + "\n" for line in lines))
    (where / "notes.txt").write_text("not a part file\n")
    return str(where), arriving


WANT_TREND = {
    ("goldman", 10): (5, 0),
    ("goldman", 20): (12, 5),
    ("goldman", 30): (0, 12),
    ("goldman", 40): (4, 0),
    ("goldman", 50): (25, 4),
    ("goldman", 60): (0, 25),
    **{("citigroup", end): (1, 0 if end == 10 else 1) for end in range(10, 61, 10)},
}


def trends_of(spark, where, streaming):
    lines = replay.minute_lines(spark, where, "2015-12-01 00:00:00", files_per_batch=7, streaming=streaming)
    trend = windows.trend(windows.taxi_arrivals(windows.with_event_time(lines)))
    return replay.replay(trend, "window_end", "key") if streaming else trend


@pytest.mark.parametrize("streaming", [False, True])
def test_trends_of_a_replay(spark, minutes, streaming):
    where, _ = minutes
    trend = windows.until_last_arrival(trends_of(spark, where, streaming))
    got = {(r.key, (r.window_end - START).seconds // 60): (r.cur, r.prev) for r in trend.collect()}
    assert got == WANT_TREND
    found = {(r.key, r.message) for r in windows.alerts(trend).collect()}
    millis = {end: int((at(end) - dt.datetime(1970, 1, 1)).total_seconds() * 1000) for end in (20, 50)}
    assert found == {
        ("goldman", f"Number of arrivals to Goldman Sachs has doubled from 5 to 12 at {millis[20]}!"),
        ("goldman", f"Number of arrivals to Goldman Sachs has doubled from 4 to 25 at {millis[50]}!"),
    }


def test_every_line_counts_without_a_key(spark, minutes):
    where, arriving = minutes
    lines = replay.minute_lines(spark, where, "2015-12-01 00:00:00", streaming=False)
    counted = windows.window_counts(windows.with_constant_key(windows.with_event_time(lines))).collect()
    assert [(r.key, r.n) for r in counted] == [("all", sum(arriving.values()) + 6 + 4)]


def test_appending_writes_the_finished_windows(spark, minutes, tmp_path):
    where, _ = minutes
    lines = replay.minute_lines(spark, where, "2015-12-01 00:00:00", files_per_batch=20)
    timed = windows.with_event_time(lines, delay="60 minutes")
    counts = windows.window_counts(windows.taxi_arrivals(timed), "10 minutes")
    sink, checkpoint = str(tmp_path / "sink"), str(tmp_path / "checkpoint")
    replay.run_appending(counts, sink, checkpoint)
    assert spark.read.schema(counts.schema).parquet(sink).count() == 0
    late = f"{where}/part-2015-12-01-0150.csv"
    with open(late, "w") as out:
        out.write(trip("yellow", GOLDMAN) + "\n")
    replay.run_appending(counts, sink, checkpoint)
    got = {(r.key, (r.window_end - START).seconds // 60): r.n for r in spark.read.parquet(sink).collect()}
    assert got == {k: cur for k, (cur, _) in WANT_TREND.items() if cur}


def test_finished_windows_as_rows_and_as_alerts(spark, minutes, tmp_path):
    where, _ = minutes
    with open(f"{where}/part-2015-12-01-0240.csv", "w") as out:
        out.write(trip("yellow", GOLDMAN) + "\n")
    lines = replay.minute_lines(spark, where, "2015-12-01 00:00:00", files_per_batch=100)
    trend = windows.trend(windows.taxi_arrivals(windows.with_event_time(lines, delay="0 seconds")))
    table, alarms = str(tmp_path / "rows"), str(tmp_path / "alerts")
    replay.run_batches(trend, {table: windows.trend_rows, alarms: windows.alerts}, str(tmp_path / "checkpoint"))
    ends = {(r.key, r.ts): (r.cur, r.prev) for r in spark.read.parquet(table).collect()}
    zero = int((START - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    got = {(key, (ts - zero) // 60000): counts for (key, ts), counts in ends.items()}
    assert {k: v for k, v in got.items() if k[1] <= 60} == WANT_TREND
    assert sorted((r.cur, r.prev) for r in spark.read.parquet(alarms).collect()) == [(12, 5), (25, 4)]


def test_a_file_is_no_directory(spark, minutes, tmp_path):
    where, _ = minutes
    lines = replay.minute_lines(spark, f"{where}/part-2015-12-01-0000.csv", "2015-12-01 00:00:00")
    with pytest.raises(Exception):
        replay.run_updating(windows.window_counts(windows.with_constant_key(windows.with_event_time(lines))), str(tmp_path / "s"), str(tmp_path / "c"))
    with pytest.raises(Exception):
        replay.minute_lines(spark, f"{where}/absent", "2015-12-01 00:00:00")


def test_dense_counts_keep_a_key_once_seen(spark, minutes):
    where, _ = minutes
    lines = replay.minute_lines(spark, where, "2015-12-01 00:00:00", streaming=False)
    events = windows.taxi_arrivals(windows.with_event_time(lines))
    dense = windows.dense(windows.window_counts(events, "10 minutes"), "10 minutes").collect()
    got = {(r.key, (r.window_end - START).seconds // 60): r.n for r in dense}
    assert got == {k: WANT_TREND[k][0] for k in WANT_TREND}


@pytest.mark.parametrize("job", [arrivals.event_count, arrivals.region_count, arrivals.trends])
def test_streams_equal_tables(spark, small, rows, job):
    columns = sorted(job(spark, small).columns)
    assert rows(job(spark, small, streaming=True).select(*columns)) == rows(job(spark, small).select(*columns))


def test_batches_replace_what_they_wrote(spark, minutes, tmp_path):
    where, _ = minutes
    lines = replay.minute_lines(spark, where, "2015-12-01 00:00:00", files_per_batch=13)
    counts = windows.window_counts(windows.with_constant_key(windows.with_event_time(lines)), "10 minutes")
    sink = str(tmp_path / "sink")
    replay.run_updating(counts, sink, str(tmp_path / "first"))
    before = Counter(tuple(r) for r in replay.latest(spark, sink, "window_end", "key").collect())
    replay.run_updating(counts, sink, str(tmp_path / "second"))
    assert Counter(tuple(r) for r in replay.latest(spark, sink, "window_end", "key").collect()) == before


def test_titles_of_other_keys(spark):
    trend = spark.createDataFrame([(START, "x", 10, 5)], "window_end timestamp, key string, cur bigint, prev bigint")
    boxes = (Region("y", "Y", 0, 1, 0, 1),)
    assert windows.alerts(trend, regions=boxes).first().message.startswith("Number of arrivals to x has doubled from 5 to 10")


def test_batches_of_many_files_lose_no_event(spark, small, rows, tmp_path, monkeypatch):
    scattered = spark.read.parquet(f"{small}/events.parquet").repartition(3, "event_id")
    scattered.write.parquet(f"{tmp_path}/events.parquet")
    made, table_stream = [], replay.table_stream
    monkeypatch.setattr(replay, "table_stream", lambda s, path, *a, **k: made.append(path) or table_stream(s, path, *a, **k))
    spark.conf.set("spark.sql.files.openCostInBytes", "64m")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    try:
        got = arrivals.event_count_in_batches(spark, str(tmp_path), batches=4, delay="0 seconds")
        assert rows(got) == rows(arrivals.event_count(spark, small))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    files = spark.read.parquet(made[0]).inputFiles()
    assert len(files) == 4 * 3


# Keyed state ----------------------------------------------------------------------------------------


def arriving_in_turn(spark, where, turns):
    """A stream over files that grow by a turn at a time; a turn is a list of ``(minute, key)``."""
    for nth, turn in enumerate(turns):
        rows = [(at(minute), key) for minute, key in turn]
        spark.createDataFrame(rows, "ts timestamp_ntz, key string").coalesce(1).write.mode("append").parquet(where)
        stream = replay.table_stream(spark, where, spark.read.parquet(where).schema, files_per_batch=replay.ALL_FILES)
        yield windows.with_event_time(stream).withWatermark("event_time", "0 seconds")


def kept(spark, where, turns, length="10 minutes"):
    found = (state.kept_trend(e, length) for e in arriving_in_turn(spark, where, turns))
    with replay.keyed_state(spark):
        rows = replay.append_in_turn(spark, found, state.TREND_SCHEMA).collect()
    got = {(r.key, (r.window_end - START).seconds // 60): (r.cur, r.prev) for r in rows}
    assert len(got) == len(rows)
    return got


def test_a_silent_key_has_rows_of_zero_as_the_watermark_passes(spark, tmp_path):
    # Key "a" is silent from minute 10 to 39, "b" comes late, and nothing is said of windows that are open at the end.
    turns = [[(1, "a"), (2, "a"), (12, "c")], [(25, "c"), (31, "c")], [(44, "a"), (45, "b"), (52, "c")]]
    got = kept(spark, str(tmp_path / "events"), turns)
    assert got == {
        ("a", 10): (2, 0), ("a", 20): (0, 2), ("a", 30): (0, 0), ("a", 40): (0, 0), ("a", 50): (1, 0),
        ("b", 50): (1, 0),
        ("c", 20): (1, 0), ("c", 30): (1, 1), ("c", 40): (1, 1), ("c", 50): (0, 1),
    }


def test_one_batch_gives_what_many_give(spark, tmp_path):
    turns = [[(m, "ab"[m % 2]) for m in range(0, 30, 3)], [(m, "a") for m in (31, 47)], [(80, "b")]]
    many = kept(spark, str(tmp_path / "many"), turns)
    assert kept(spark, str(tmp_path / "one"), [[e for turn in turns for e in turn]]) == many
    assert many["a", 80] == (0, 0) and many["b", 80] == (0, 0)


def test_a_null_key_is_a_key(spark, tmp_path):
    got = kept(spark, str(tmp_path / "events"), [[(1, None), (22, None)]])
    assert got == {(None, 10): (1, 0), (None, 20): (0, 1)}


def test_keyed_state_leaves_the_session_as_it_was(spark):
    before = spark.conf.get(replay.STORE_KEY)
    with pytest.raises(RuntimeError), replay.keyed_state(spark):
        assert spark.conf.get(replay.STORE_KEY) == replay.KEYED_STORE
        raise RuntimeError
    assert spark.conf.get(replay.STORE_KEY) == before


# Sinks ----------------------------------------------------------------------------------------------


def test_a_directory_per_closed_window(spark, tmp_path):
    turns = [[(1, "a"), (12, "a")], [(13, "b"), (25, "a")], [(47, "a")]]
    counts = (
        windows.window_counts(e, "10 minutes").select("key", "n", F.unix_millis("window_end").alias("end_ms"))
        for e in arriving_in_turn(spark, str(tmp_path / "events"), turns)
    )
    sink, checkpoint = str(tmp_path / "sink"), str(tmp_path / "checkpoint")
    seen = []
    for result in counts:
        replay.run_appending(result, sink, checkpoint, "end_ms")
        seen.append(sorted(p.name for p in (tmp_path / "sink").glob("end_ms=*")))
    ends = [f"end_ms={int((at(m) - dt.datetime(1970, 1, 1)).total_seconds() * 1000)}" for m in (10, 20, 30)]
    assert seen == [ends[:1], ends[:2], ends]
    read = spark.read.schema("key string, n long, end_ms long").parquet(sink)
    assert sorted((r.key, r.n, f"end_ms={r.end_ms}") for r in read.collect()) == [
        ("a", 1, ends[0]), ("a", 1, ends[1]), ("a", 1, ends[2]), ("b", 1, ends[1]),
    ]


def test_minute_files_are_taken_in_their_order(spark, tmp_path):
    where = str(tmp_path / "minutes")
    spread = [(trip("yellow", GOLDMAN), minute) for minute in (59, 3, 3, 0, 31, 44, 59, 3)] + [(trip("green", CITIGROUP), 1439), (None, 7)]
    files.write_minutes(spark.createDataFrame(spread, "text string, m long").repartition(4), where, "text", "m")
    names = sorted(p.name for p in (tmp_path / "minutes").iterdir() if not p.name.startswith("."))
    assert names == [f"part-0-{m:05d}" for m in (0, 3, 7, 31, 44, 59, 1439)]
    times = [(tmp_path / "minutes" / n).stat().st_mtime for n in names]
    assert times == sorted(times)
    # With no delay at all, a file that came before its turn would be dropped.
    lines = replay.minute_lines(spark, where, "2015-12-01 00:00:00", files_per_batch=1)
    timed = windows.with_event_time(lines, delay="0 seconds")
    counted = replay.replay(windows.window_counts(windows.taxi_arrivals(timed), "10 minutes"), "window_end", "key").collect()
    got = {(r.key, int((r.window_end - START).total_seconds()) // 60): r.n for r in counted}
    assert got == {("goldman", 10): 4, ("goldman", 40): 1, ("goldman", 50): 1, ("goldman", 60): 2, ("citigroup", 1440): 1}
