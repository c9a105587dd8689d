"""Helpers shared by the operators: written intermediate tables, keyed ranks and packed hashing of words.

Word hashes are 64-bit and made with numpy over whole byte buffers, so no Python object exists per word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.session import fresh_path, shuffle_partitions, write_and_read

SPACE_WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/documents.parquet")


BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def limit_batches(spark: SparkSession) -> None:
    """Let Arrow batches of the session hold ``BATCH_BYTES`` at most: tasks have some of them outside of the heap, and again in Python."""
    spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """The same while something is written here."""
    before = spark.conf.get(BATCH_KEY)
    limit_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(BATCH_KEY, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    with small_batches(df.sparkSession):
        return write_and_read(df, fresh_path(df.sparkSession, label))


def give_back() -> None:
    """Return freed memory to the system: Python workers stay for later tasks, and so would what they once held.

    Functions shipped by value refer to themselves, so what a task before has held waits for the collector of cycles.
    """
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over Arrow batches that gives its memory back at the end of the task, and that of the task before at its begin."""

    def tidied(rows: Iterator) -> Iterator:
        give_back()
        yield from run(rows)
        give_back()

    return tidied


def tidy_group(run: Callable) -> Callable:
    """The same for a function of a group."""

    def tidied(table):
        try:
            return run(table)
        finally:
            give_back()

    return tidied


class Scratch:
    """Tables that a call writes for itself, deleted when nothing reads them any more."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def path(self, label: str) -> str:
        self.paths.append(fresh_path(self.spark, label))
        return self.paths[-1]

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        with small_batches(self.spark):
            return write_and_read(df, self.path(label))

    def delete(self) -> None:
        """Delete all tables written so far. What was computed from them has to be written elsewhere by then."""
        for path in self.paths:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
        self.paths.clear()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def salts(spark: SparkSession) -> int:
    """Into how many parts each key is cut where rows are numbered."""
    return 8 * shuffle_partitions(spark)


def with_rank(df: DataFrame, key: str, order: list[str], rank: str) -> DataFrame:
    """Number the rows of each key from 0 without gaps, however many rows one key holds.

    Rows of a key are dealt to parts by a hash, numbered within the part, and shifted by the sizes of the parts
    before it. The table of part sizes has at most ``salts`` rows per key. Rows that are equal in every column
    may swap their numbers. ``df`` is read twice, so it should be a written table.
    """
    n = salts(df.sparkSession)
    part = F.pmod(F.xxhash64(F.lit(0), *order), F.lit(n)).cast("int")
    dealt = df.withColumn("_part", part)
    within = Window.partitionBy(key, "_part").orderBy(*order)
    numbered = dealt.withColumn("_in", F.row_number().over(within) - 1)
    sizes = dealt.groupBy(key, "_part").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        F.col(key).alias("_key"),
        F.col("_part").alias("_of"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"),
    )
    return (
        numbered.join(shifts, (F.col(key) == F.col("_key")) & (F.col("_part") == F.col("_of")))
        .withColumn(rank, (F.col("_in") + F.col("_shift")).cast("long"))
        .drop("_in", "_shift", "_key", "_of", "_part")
    )


# Hashing of words -----------------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15
_CHUNK = 1 << 19
_cache: dict[str, np.ndarray] = {}


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finalizer, in a new array."""
    h = h + np.uint64((seed * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) % 2**64)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def forget_tables() -> None:
    """Drop the tables made by hashing on the driver, which would travel with every function that hashes."""
    _cache.clear()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, to ``n``."""
    if "up" not in _cache or len(_cache["up"]) <= n:
        size = max(n, _CHUNK) + 1
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _cache[name] = np.cumprod(steps, dtype=np.uint64)
    return _cache["up"], _cache["down"]


def _bytes_table() -> np.ndarray:
    if "bytes" not in _cache:
        _cache["bytes"] = mix(np.arange(256, dtype=np.uint64), 17) | np.uint64(1)
    return _cache["bytes"]


def space_bytes() -> np.ndarray:
    """True for the bytes that end a word: blank and \\x09 to \\x0D."""
    table = np.zeros(256, dtype=bool)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return table


def lower_bytes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte of every word."""
    word = np.zeros(len(buf) + 2, dtype=np.int8)
    word[1:-1] = ~space_bytes()[buf]
    change = np.diff(word)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def hash_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges that lie in order, computed piece by piece to bound the memory."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        first = starts[at]
        upto = max(int(np.searchsorted(ends, first + _CHUNK, side="right")), at + 1)
        s, e = starts[at:upto] - first, ends[at:upto] - first
        up, down = _powers(int(e[-1]))
        sums = np.zeros(int(e[-1]) + 1, dtype=np.uint64)
        np.cumsum(_bytes_table()[buf[first : first + int(e[-1])]] * up[: int(e[-1])], out=sums[1:], dtype=np.uint64)
        out[at:upto] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(_BASE))
        at = upto
    return out


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; empty if there are fewer."""
    size = len(words) - n + 1
    if size <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(size, dtype=np.uint64)
    for i in range(n):
        total += words[i : i + size] * np.uint64(pow(_BASE, 2 * i + 1, 2**64))
    return mix(total, n)


def text_words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(buffer, starts, ends, offsets)``: words of all texts, and where those of each text begin."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    if lower:
        buf = lower_bytes()[buf]
    starts, ends = word_bounds(buf)
    begins = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    return buf, starts, ends, np.searchsorted(starts, begins)


MAX_SLICE_ROWS = 60_000


def batches_of(rows: Iterator, size: int = 4 << 20, width: str = "text") -> Iterator:
    """Cut Arrow batches into slices of about ``size`` bytes of text, one row at least."""
    for batch in rows:
        lengths = _lengths(batch.column(width))
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(np.cumsum(lengths[at:]), size, side="right")) + at)
            upto = min(upto, at + MAX_SLICE_ROWS)
            yield batch.slice(at, upto - at)
            at = upto


def _lengths(column) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
