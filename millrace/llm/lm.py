"""Stupid-backoff scores of documents under the counts of all other documents.

The count table of each order is partitioned by hash. Every block asks the partitions for the counts of its distinct
n-grams, so an n-gram costs one entry per block however frequent it is, and sums the scores of its documents from the
answers. An n-gram can only occur elsewhere if both of its shorter ones do; only those are asked about. N-grams are
known by 64-bit hashes, so two that meet by chance would be counted as one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from millrace.llm import blocks as B
from millrace.llm.common import grams, hash_words, stored, text_words, tidy, tidy_group

ORDER = 3
BACKOFF = 0.4
ROWS = "bucket int, block long, blob binary"


class Words:
    """The words of a block and the n-grams that begin at each."""

    def __init__(self, blob) -> None:
        self.ids, texts = B.open_block(blob)
        buf, starts, ends, self.offsets = text_words(texts, lower=True)
        self.words = hash_words(buf, starts, ends)
        self.doc = np.repeat(np.arange(len(self.ids)), np.diff(self.offsets))
        self.left = self.offsets[1:][self.doc] - np.arange(len(self.words))  # words from here to the end of the text

    def grams(self, n: int, elsewhere: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Places where an n-gram begins that may occur elsewhere, and the hashes there."""
        places = self.left >= n
        if elsewhere is not None:
            places &= elsewhere
            places[:-1] &= elsewhere[1:]
        at = np.flatnonzero(places)
        return at, (grams(self.words, n) if n > 1 else self.words)[at]

    def others(self, n: int, elsewhere: np.ndarray | None, totals) -> np.ndarray:
        """How often the n-gram that begins at each word occurs in other documents, given the sums of the answers."""
        at, hashes = self.grams(n, elsewhere)
        keys, which = np.unique(hashes, return_inverse=True)
        code, own, counts = np.unique(which * np.int64(len(self.ids)) + self.doc[at], return_inverse=True, return_counts=True)
        out = np.zeros(len(self.words), dtype=np.int64)
        out[at] = totals(keys)[which] - counts[own]
        return out


def _totals(answers: list, buckets: int):
    """The answers to the sorted keys of a block."""
    import zstandard

    expand = zstandard.ZstdDecompressor()
    by_bucket = {a["bucket"]: a["blob"] for a in answers or ()}

    def of(keys: np.ndarray) -> np.ndarray:
        parts = [np.frombuffer(expand.decompress(by_bucket[b]), np.int64) for b, _, _ in B.cuts(keys, buckets)]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    return of


def _known(words: Words, batch, row: int, orders: int, buckets: int) -> list[np.ndarray]:
    """Counts in other documents, for the orders that were answered."""
    counts: list[np.ndarray] = []
    for n in range(1, orders + 1):
        answers = batch.column(f"order{n}")[row].as_py()
        counts.append(words.others(n, counts[-1] > 0 if counts else None, _totals(answers, buckets)))
    return counts


def pack_counts(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as steps of six bytes where they fit, and their counts."""
    import zstandard

    steps = np.diff(keys, prepend=np.uint64(0))
    wide = int(len(steps) > 1 and steps[1:].max() >> np.uint64(48) > 0)
    rest = steps[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, : 8 if wide else 6]
    small = zstandard.ZstdCompressor(level=1).compress(counts.astype("<u4").tobytes())
    return bytes([wide]) + np.int64(len(keys)).tobytes() + steps[:1].tobytes() + rest.tobytes() + small


def unpack_counts(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    size = 8 if blob[0] else 6
    n = int(np.frombuffer(blob, np.int64, 1, 1)[0])
    steps = np.zeros((n, 8), dtype=np.uint8)
    steps[0] = np.frombuffer(blob, np.uint8, 8, 9)
    steps[1:, :size] = np.frombuffer(blob, np.uint8, size * (n - 1), 17).reshape(-1, size)
    counts = zstandard.ZstdDecompressor().decompress(blob[17 + size * (n - 1) :])
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64), np.frombuffer(counts, "<u4").astype(np.int64)


def _ask(order: int, buckets: int):
    """The distinct n-grams of every block, with their counts there, by bucket."""

    def run(rows: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in rows:
            for row in range(batch.num_rows):
                block = batch.column("block")[row].as_py()
                words = Words(batch.column("docs")[row].as_buffer())
                known = _known(words, batch, row, order - 1, buckets)
                _, hashes = words.grams(order, known[-1] > 0 if known else None)
                keys, counts = np.unique(hashes, return_counts=True)
                out = [(b, block, pack_counts(keys[x:y], counts[x:y])) for b, x, y in B.cuts(keys, buckets)]
                columns = list(zip(*out, strict=True)) if out else [[], [], []]
                types = (pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["bucket", "block", "blob"]
                )

    return run


def _sum(table):
    """Counts over all blocks, for each block in the order asked."""
    import pyarrow as pa
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=1)
    asked = [unpack_counts(blob) for blob in table.column("blob").to_pylist()]
    keys, which = np.unique(np.concatenate([k for k, _ in asked]), return_inverse=True)
    # Sums of integers below 2**53 are exact in the doubles that bincount adds.
    totals = np.bincount(which, np.concatenate([c for _, c in asked]), len(keys)).astype(np.int64)[which]
    answers, at = [], 0
    for k, _ in asked:
        answers.append(squeeze.compress(totals[at : at + len(k)].tobytes()))
        at += len(k)
    return pa.table({"bucket": table.column("bucket"), "block": table.column("block"), "blob": pa.array(answers, pa.binary())})


def backoff_scores(words: Words, counts: list[np.ndarray], total: int, backoff: float) -> list[np.ndarray]:
    """Per word: the logarithm of its score, and the order that it was found at (0: nowhere else)."""
    n = len(words.words)
    place = np.arange(n) - words.offsets[:-1][words.doc]
    rest = total - np.diff(words.offsets)[words.doc]
    found = np.zeros(n, dtype=np.int64)
    score = -np.log(rest + 1.0)
    for order, count in enumerate(counts, 1):
        here = np.flatnonzero(place >= order - 1)
        here = here[count[here - order + 1] > 0]
        begin = here - order + 1
        base = rest[here] if order == 1 else counts[order - 2][begin]
        score[here] = np.log(count[begin] / base)
        found[here] = order
    possible = np.minimum(place + 1, len(counts))
    return [score + np.log(backoff) * (possible - np.maximum(found, 1)), found]


def _score(orders: int, buckets: int, total: int, backoff: float):
    def run(rows: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in rows:
            for row in range(batch.num_rows):
                words = Words(batch.column("docs")[row].as_buffer())
                counts = _known(words, batch, row, orders, buckets)
                score, found = backoff_scores(words, counts, total, backoff)
                n_words = np.diff(words.offsets)
                columns = [pa.array(words.ids, pa.int64()), pa.array(n_words, pa.int64())]
                columns.append(pa.array(_by_doc(score, words.offsets), pa.float64()))
                for order in range(orders + 1):
                    columns.append(pa.array(_by_doc(found == order, words.offsets).astype(np.int64), pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "log_score", *_found_names(orders)])

    return run


def _by_doc(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums over the words of each document."""
    sums = np.add.reduceat(np.r_[values.astype(np.float64), 0.0], offsets[:-1])
    return np.where(np.diff(offsets) > 0, sums, 0.0)


def _found_names(orders: int) -> list[str]:
    return ["n_unseen", *[f"n_order{n}" for n in range(1, orders + 1)]]


def _count_words(rows: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in rows:
        sizes = [len(Words(blob.as_buffer()).words) for blob in batch.column("docs")]
        yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], names=["n"])


def score_documents(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF) -> DataFrame:
    """``(doc_id, n_words, log_score, n_unseen, n_order1, ...)`` for every row of ``docs(doc_id, text)``.

    The score of a word is its n-gram's count over that of the n-gram without it, both in all other rows, for the
    longest n-gram found there; each word of context given up costs a factor of ``backoff``. A word found nowhere
    else scores as one in one more than all other words. ``log_score`` is the sum of logarithms, 0 for texts without
    words (null, empty and blank ones). Words are lower-cased (A-Z). A copy in another row counts as another
    document, so repeated rows score each other high. Null ids stay, other columns are not read, and an empty table
    gives no rows.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    blocks = B.write_blocks(rows, "lm-blocks").table
    buckets = B.bucket_count(blocks)
    total = blocks.mapInArrow(tidy(_count_words), "n long").groupBy().sum("n").first()[0] or 0
    known = blocks
    for n in range(1, order + 1):
        summed = known.mapInArrow(tidy(_ask(n, buckets)), ROWS).groupBy("bucket").applyInArrow(tidy_group(_sum), ROWS)
        answers = stored(B.gathered(summed), f"lm-order{n}").withColumnRenamed("answers", f"order{n}")
        known = known.join(answers, "block", "left")
    schema = "doc_id long, n_words long, log_score double, " + ", ".join(f"{n} long" for n in _found_names(order))
    return known.mapInArrow(tidy(_score(order, buckets, total, backoff)), schema)
