"""Blocks of documents, and packed exchanges between blocks and hash buckets.

Documents are written once, a few megabytes of text to a block. What a block has to ask about its hashes (are
they known elsewhere, how often) goes to the bucket of each hash as one packed row per block and bucket, and the
answers come back in the order in which they were asked. A hash is asked about once per block however often it
occurs there, so a frequent one costs no more than a row's worth per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batches_of, small_batches, tidy
from millrace.session import Bucketed, fresh_path, shuffle_partitions

BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 64 << 20
BLOCKS = "block long, docs binary"


def _pack(rows: Iterator) -> Iterator:
    import pyarrow as pa
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 32
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches_of(rows, BLOCK_BYTES):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
            writer.write_batch(batch)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "docs"]
        )
        block += 1


def open_block(blob) -> tuple[list, list[bytes]]:
    """Ids and texts, in bytes, of a block; a null text is empty."""
    import pyarrow as pa

    table = pa.ipc.open_stream(blob).read_all()
    texts = table.column("text").cast(pa.binary()).to_pylist()
    return table.column("doc_id").to_pylist(), [t or b"" for t in texts]


def write_blocks(docs: DataFrame, label: str) -> Bucketed:
    """All columns of ``docs`` as a table of blocks, bucketed by block so that joins on it do not move the texts."""
    spark = docs.sparkSession
    path = fresh_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    with small_batches(spark):
        (
            docs.mapInArrow(tidy(_pack), BLOCKS)
            .write.format("parquet")
            .option("path", path)
            .option("compression", "none")
            .bucketBy(shuffle_partitions(spark), "block")
            .saveAsTable(name)
        )
    return Bucketed(name, spark.table(name))


def bucket_count(blocks: DataFrame) -> int:
    """Enough hash buckets for as much as the blocks hold, and at least one per shuffle partition."""
    return max(shuffle_partitions(blocks.sparkSession), -(-blocks.count() * BLOCK_BYTES // BUCKET_BYTES))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets in the order of the hashes, so that sorted hashes are sorted by bucket too."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def cuts(sorted_hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """``(bucket, first, past the last)`` of the buckets that sorted hashes fall in."""
    where = bucket_of(sorted_hashes, buckets)
    if not len(where):
        return
    firsts = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
    for first, past in zip(firsts, np.r_[firsts[1:], len(where)], strict=True):
        yield int(where[first]), int(first), int(past)


def gathered(answers: DataFrame) -> DataFrame:
    """``(block, answers)``: all packed answers of a block, in no particular order."""
    return answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "blob")).alias("answers"))


def with_answers(blocks: DataFrame, answers: DataFrame, name: str = "answers") -> DataFrame:
    """Blocks with the answers to what they asked; null where nothing was asked."""
    return blocks.join(gathered(answers).withColumnRenamed("answers", name), "block", "left")
