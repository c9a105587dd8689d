"""Streams over directories of files, and bounded runs of streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import fresh_path

# Fixed value: names of the files of a replayed collection, one per minute, numbered in time order.
PART_FILES = "part-*"
ALL_FILES = (1 << 31) - 1  # a batch takes whatever files there are

STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
#: The store that keyed state with timers needs.
KEYED_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def table_stream(
    spark: SparkSession, directory: str, schema: T.StructType, files: str = "*.parquet", files_per_batch: int = 1000
) -> DataFrame:
    """A stream over the Parquet files of a directory; ``files`` selects them by name."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", files)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(directory)
    )


def minute_lines(
    spark: SparkSession, directory: str, start: str, files_per_batch: int = 1, streaming: bool = True
) -> DataFrame:
    """``(ts, line)`` of text files that hold one minute each.

    The last number in a file's name says which minute after ``start`` it is. Taking the time from the
    name and not from a clock makes a replay give the same windows at any speed. A stream takes files in the
    order of their times, which ``write_minutes`` sets to that of the minutes.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch) if streaming else spark.read
    lines = reader.option("pathGlobFilter", PART_FILES).text(directory)
    minute = F.regexp_extract("_metadata.file_name", r"(\d+)(?:\.\w+)?$", 1).cast("int")
    ts = F.to_timestamp(F.lit(start)) + F.make_dt_interval(mins=minute)
    return lines.select(ts.alias("ts"), F.col("value").alias("line"))


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started here keep their state in the store that keyed state needs."""
    before = spark.conf.get(STORE_KEY, None)
    spark.conf.set(STORE_KEY, KEYED_STORE)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STORE_KEY)
        else:
            spark.conf.set(STORE_KEY, before)


def run_appending(result: DataFrame, sink: str, checkpoint: str, *by: str) -> None:
    """Process what there is and append every finished window to a Parquet sink, a directory per value of ``by``.

    A window is finished when the watermark has passed its end, so the windows still open at the end
    of the data are not written. The log of the sink names the files of finished batches, so a batch that is
    written again after a failure counts once.
    """
    writer = result.writeStream.format("parquet").outputMode("append").option("path", sink)
    if by:
        writer = writer.partitionBy(*by)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_batches(
    result: DataFrame,
    outputs: dict[str, Callable[[DataFrame], DataFrame]],
    checkpoint: str,
    mode: str = "append",
) -> None:
    """Process what there is and write several tables made of each batch of the result.

    ``outputs`` maps a path to what is written there. The batch is computed once for all of them. Each
    output has one directory per batch; writing a batch again after a failure replaces it, so the
    tables stay exact.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if len(outputs) > 1:
            batch.persist()
        try:
            for path, made_of in outputs.items():
                made_of(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()

    query = (
        result.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def run_updating(result: DataFrame, sink: str, checkpoint: str) -> None:
    """Process what there is and write the windows each batch has changed, one directory per batch."""
    run_batches(result, {sink: lambda batch: batch}, checkpoint, "update")


def latest(spark: SparkSession, sink: str, *keys: str) -> DataFrame:
    """The last written state of every key of an updating sink."""
    written = spark.read.parquet(sink)
    values = [c for c in written.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*values), "batch").alias("_newest")
    return written.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


def replay(result: DataFrame, *keys: str) -> DataFrame:
    """Run a bounded stream to its end and return its last state, windows still open included."""
    return replay_in_turn(result.sparkSession, [result], *keys)


def replay_in_turn(spark: SparkSession, results: Iterable[DataFrame], *keys: str) -> DataFrame:
    """Run one bounded stream to the end of what there is, again for each of ``results``, and return its last state.

    The results are the same query; its input may grow before the next is taken, and its state and watermark go on.
    """
    base = fresh_path(spark, "stream")
    for result in results:
        run_updating(result, f"{base}/sink", f"{base}/checkpoint")
    return latest(spark, f"{base}/sink", *keys)


def append_in_turn(spark: SparkSession, results: Iterable[DataFrame], schema: str, *by: str) -> DataFrame:
    """The same for finished windows only, appended to a sink with a directory per value of ``by``."""
    base = fresh_path(spark, "stream")
    for result in results:
        run_appending(result, f"{base}/sink", f"{base}/checkpoint", *by)
    return spark.read.schema(schema).parquet(f"{base}/sink")
